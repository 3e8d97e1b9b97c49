"""Operators that look at one text at a time, against brute force on edge cases."""

from __future__ import annotations

import base64
import hashlib
import math
from collections import Counter
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm import docs as fixture
from trailmark.llm import bpe, gru, licenses, lm, quality, token_counts, toxicity
from trailmark.llm.common import shared_folder
from trailmark.llm.pieces import pieces
from trailmark.llm.shingles import shingle_set

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def bag(df, *columns):
    return Counter(tuple(row) for row in df.select(*columns).collect())


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab'S 1\n\t é—東\x1c　."), max_size=30))
def test_pieces_split_as_their_text_does(text):
    split = regex.compile(PATTERN).findall
    assert "".join(pieces(text)) == text
    assert [t for piece in pieces(text) for t in split(piece)] == split(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="aAb", max_size=400))
def test_encoding_equals_the_library(reference, text):
    ids = bpe.Encoder(RANKS, PATTERN).encode(text).tolist()
    assert ids == reference.encode_ordinary(text)


def test_long_pre_tokens(reference):
    for text in ("a" * 30_000, "ab" * 9_000, "東" * 4_000):
        assert bpe.Encoder(RANKS, PATTERN).encode(text).tolist() == reference.encode_ordinary(text)


def test_bpe_round_trip(spark, reference):
    encoded = bpe.encode(fixture.table(spark), RANKS, PATTERN)
    expected = Counter((i, tuple(reference.encode_ordinary(t))) for i, t in fixture.texts())
    assert Counter((row.doc_id, tuple(row.ids)) for row in encoded.collect()) == expected
    decoded = bpe.decode(encoded, RANKS)
    found = Counter((row.doc_id, bytes(row.decoded)) for row in decoded.collect())
    assert found == Counter((i, t.encode()) for i, t in fixture.texts())
    assert bpe.decode(encoded.limit(0), RANKS).count() == 0
    cut = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert bytes(bpe.decode(cut, RANKS).first().decoded) == b""


def test_counts_and_cache(spark):
    tokenizer = Tokenizer.from_file(JSON)
    special = [(100, "a <|endoftext|> b", None, None, None)]
    rows = fixture.rows() + special
    docs, cache = fixture.table(spark, rows), shared_folder(spark, "cache")

    def expected():
        for doc_id, text in fixture.texts(rows):
            n = len(tokenizer.encode(text, add_special_tokens=False).ids)
            yield doc_id, len(text.encode()), n, n > 512

    for by_piece in (True, False):
        counted = token_counts.count_tokens(docs, JSON, cache, by_piece=by_piece)
        assert bag(counted, "*") == Counter(expected())
    # All was stored the first time, once for each text.
    stored = token_counts.read_cache(spark, cache)
    assert stored.count() == len({text for _, text in fixture.texts(rows)})
    empty = token_counts.count_tokens(docs.limit(0), JSON, shared_folder(spark, "cache"))
    assert empty.count() == 0


def test_toxicity_learns_and_settles_edges(spark):
    rows, marks = [], []
    for i in range(600):
        bad = i % 4 == 0
        text = fixture.prose(i, 40) + (" you awful fool" if bad else " you kind friend")
        rows.append((i, text, "en", "s", 1))
        marks.append((i, int(bad)))
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    model = toxicity.train(fixture.table(spark, rows), labels.where(~toxicity.held_out()))
    scored = toxicity.score(fixture.table(spark, rows), model).collect()
    held = {i for i, _ in marks if crc32(str(i).encode()) % 5 == 0}
    right = [(row.score >= 0.5) == (row.doc_id % 4 == 0) for row in scored if row.doc_id in held]
    assert len(right) > 80 and np.mean(right) > 0.97
    again = toxicity.train(fixture.table(spark, rows), labels.where(~toxicity.held_out()))
    assert np.array_equal(again.linear, model.linear)
    edge = toxicity.score(fixture.table(spark), model)
    assert edge.count() == len(fixture.rows())
    assert edge.where("score is null or score < 0 or score > 1").count() == 0
    kept = toxicity.without_toxic(fixture.table(spark, rows), model)
    assert kept.columns == fixture.table(spark, rows).columns
    assert {row.doc_id for row in kept.collect()} == {
        row.doc_id for row in scored if row.score < 0.5
    }
    nothing = toxicity.train(fixture.table(spark, rows), labels.limit(0))
    assert toxicity.score(fixture.table(spark), nothing).count() == len(fixture.rows())


def test_pair_weights_say_what_single_weights_cannot():
    """Label 1 exactly when one of two terms stands alone: no linear score tells."""
    texts, labels = [], []
    for i in range(800):
        a, b = i % 2, i // 2 % 2
        texts.append([1] * a + [2] * b + [3])
        labels.append(a ^ b)
    chosen = toxicity.Settings(signal=0.0, epochs=200, rate=0.3, decay=0.0)
    model = toxicity.fit(texts, np.array(labels), chosen)
    right = (model.scores(texts) >= 0.5) == np.array(labels, bool)
    assert right.all()


def brute_quality(text):
    words = [w for w in regex.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = list(zip(words, words[1:], words[2:]))
    again = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if regex.search(r"[^\x20\x09-\x0D]", line)]
    dup = sum(line in lines[:i] for i, line in enumerate(lines))
    symbols = sum(char in "#*$%&|<>" for char in text)
    return len(words), sum(map(len, words)), symbols, dup, len(again)


def test_quality_base_counts_and_verdicts(spark):
    rows = [row for row in fixture.rows() if len(row[1] or "") < 20_000]
    rows += [(200, "a b c a b c # <x>\n\na b c\na b c", "en", "s", 1)]
    rows += [(300 + i, fixture.prose(50 + i, 150), "en", "s", 1) for i in range(40)]
    rows += [(400, " ".join(f"{w}$%#&" for w in fixture.prose(9, 150).split()), "en", "s", 1)]
    found = quality.assess(fixture.table(spark, rows)).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    expected = Counter((i, *brute_quality(text)) for i, text in fixture.texts(rows))
    assert Counter((row.doc_id, *(row[name] for name in names)) for row in found) == expected
    for row in found:
        failed = row.n_words < 50 or 100 * row.n_repeat_words > 50 * row.n_words
        assert row.base_failed == failed
        assert not (failed and row.kept)
    kept = {row.doc_id: row.kept for row in found}
    assert all(kept[300 + i] for i in range(40))
    assert not kept[400]
    assert quality.assess(fixture.table(spark, []).limit(0)).count() == 0


def test_jensen_shannon_distance():
    half = np.array([0.5, 0.5, 0.0])
    assert quality.distance(np.array([3, 3, 0]), half) == 0
    assert quality.distance(np.array([0, 0, 7]), half) == 1
    assert quality.distance(np.array([1, 0, 0]), half) == pytest.approx(0.5579, abs=1e-3)


def test_language_model_scores(spark):
    rows = fixture.rows() + [(500 + i, fixture.prose(90 + i, 200), "en", "s", 1) for i in range(60)]
    chosen = lm.Settings(vocabulary=50, pack_bytes=20_000, every=2, slot_bytes=20_000)
    scored = lm.score_texts(fixture.table(spark, rows), lm.held_out_rows(), chosen)
    counts, training = Counter(), 0
    split = lambda text: text.encode().lower().split() + ["end"]
    for doc_id, text in fixture.texts(rows):
        if crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 != 2:
            counts.update(split(text))
    training = sum(counts.values())
    expected = Counter()
    for doc_id, text in fixture.texts(rows):
        words = split(text)
        base = sum(math.log10((counts[w] + 1) / (training + len(counts) + 1)) for w in words)
        known = sum(counts[w] > 0 for w in words)
        held = crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2
        expected[doc_id, held, len(words), known, training, round(base, 6)] += 1
    found = scored.collect()
    assert expected == Counter(
        (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
        for r in found
    )
    assert all(math.isfinite(row.score) and row.score < 0 for row in found)
    assert lm.score_texts(fixture.table(spark).limit(0), lm.held_out_rows(), chosen).count() == 0


def test_model_is_a_distribution_and_carries_its_state():
    counts = np.array([50, 20, 10, 5, 3, 2, 1, 1], float)
    model = gru.Model(gru.start(counts, gru.Shape(classes=3)), counts, gru.Shape(classes=3, window=4))
    random = np.random.default_rng(0)
    text = random.integers(0, 8, 37).astype(np.int32)
    model.train(np.tile(text, 20), np.arange(740) % 37 == 0, 0)
    total = sum(math.exp(model.score([np.append(text[:6], w).astype(np.int32)], 0)[0]) for w in range(8))
    assert total == pytest.approx(math.exp(model.score([text[:6]], 0)[0]), rel=1e-4)
    # Windows and neighbours change nothing.
    wide = gru.Model(model.w, counts, gru.Shape(classes=3, window=1000))
    alone = wide.score([text], 0)[0]
    others = [random.integers(0, 8, n).astype(np.int32) for n in (5, 90, 0, 37)]
    assert model.score([*others, text], 0)[-1] == pytest.approx(alone, rel=1e-4)


def test_gradients_are_those_of_the_loss():
    counts = np.array([9, 5, 4, 2, 1], float)
    shape = gru.Shape(hidden=4, embed=3, classes=2, window=5)
    model = gru.Model(gru.start(counts, shape), counts, shape)
    for name in gru.NAMES:
        model.w[name] = model.w[name].astype(np.float64)
    random = np.random.default_rng(1)
    targets, inputs = random.integers(0, 5, (2, 5, 3))
    fresh = np.zeros((5, 3), bool)
    fresh[0] = fresh[3, 1] = True

    def loss():
        trace, _ = model._steps(inputs, fresh, np.zeros((3, 4)))
        states = np.concatenate([step[5] for step in trace])
        return -model._outputs(states, targets.ravel())[0].sum() / 3

    trace, _ = model._steps(inputs, fresh, np.zeros((3, 4)))
    for name, rows, grad in model._gradients(trace, inputs, fresh, targets):
        part = model.w[name][rows]
        at = tuple(random.integers(0, n) for n in part.shape)
        step, old = 1e-2, part[at]
        values = []
        for shift in (step, -step):
            changed = model.w[name][rows].copy()
            changed[at] = old + shift
            model.w[name][rows] = changed
            values.append(loss())
        changed[at] = old
        model.w[name][rows] = changed
        assert grad[at] == pytest.approx((values[0] - values[1]) / (2 * step), rel=0.05, abs=2e-3)


def test_licences_in_paragraphs(spark):
    lines = {
        "Released under the MIT License.": "MIT",
        "This work is licensed under the GNU General Public License, version 3.": "GPL",
        "Licensed under the Apache License, Version 2.0.": "Apache",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC",
        "the licence of the work is not told": None,
        "software under version conditions terms of the public": None,
    }
    rows = [row for row in fixture.rows() if row[0] != 10]
    for i, line in enumerate(lines):
        rows.append((600 + i, f"{fixture.prose(i, 30)}\n{line}\n{fixture.prose(i + 9, 30)}", "en", "s", 1))
    docs = fixture.table(spark, rows)
    model = licenses.train(docs)
    found = {row.doc_id: row for row in licenses.scan(docs, model).collect()}
    for i, family in enumerate(lines.values()):
        named = [(one.paragraph, one.family) for one in found[600 + i].licences]
        assert named == ([(1, family)] if family else [])
    for doc_id, text in fixture.texts():
        if doc_id in found:
            assert found[doc_id].licences == []
            assert found[doc_id].n_paragraphs == len(licenses.paragraphs(text))
    assert licenses.scan(docs.limit(0), licenses.train(docs.limit(0))).count() == 0


def test_ids_are_decoded_by_the_worker_that_made_them(spark):
    docs = fixture.table(spark)
    both = bpe.encode(docs, RANKS, PATTERN, decoded=True)
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    apart = bpe.decode(bpe.encode(docs, RANKS, PATTERN).withColumn("kept", F.col("ids")), RANKS)
    want = Counter((r.doc_id, tuple(r.kept), bytes(r.decoded)) for r in apart.collect())
    assert Counter((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in both.collect()) == want


def test_a_worker_remembers_one_operator_at_a_time():
    encoder = bpe.encoder(RANKS, PATTERN)
    encoder.encode("one two")
    assert bpe.encoder(RANKS, PATTERN) is encoder
    shingle_set("one two three four")
    assert bpe.encoder(RANKS, PATTERN) is not encoder
