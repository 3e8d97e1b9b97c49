"""BPE by shared chunks against the public library, over whole texts."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm import docs as fixture
from trailmark.llm import chunk_reuse as chunks
from trailmark.llm import queries
from trailmark.llm.common import make_importable

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def expected(library, doc_id, text):
    ids = library.encode(text, add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    packed = np.array(ids, "<u4").tobytes()
    digest = lambda data: hashlib.sha256(data).hexdigest()
    return doc_id, len(ids), digest(packed), digest(decoded.encode())


def rows():
    rng = random.Random(2)
    passage = fixture.prose(9, 400)
    texts = [passage + " " + fixture.prose(i, 300) for i in range(20, 30)]
    texts += [fixture.prose(i, 200) + "\n" + passage + "\t" + fixture.prose(i + 50, 200) for i in range(30, 40)]
    texts += [passage] * 60  # one group of copies has a third of all rows
    alphabet = "aB é́ΣſK  \x1c\x85東'S’ 1٣!?\n\t\r\x0b<|endoftext|> "
    texts += ["".join(rng.choice(alphabet) for _ in range(n)) for n in (5, 700, 3000, 3000)]
    texts += ["<|endoftext|>" * 600, "é" * 4000, "́" * 3000, "字" * 5000, "x" * 20_000]
    texts += [" " * 9000, "a b " * 5000, "<|startoftext|> " + passage + "<|endoftext|>"]
    more = [(1000 + i, text, "en", "src", len(text)) for i, text in enumerate(texts)]
    return fixture.rows() + more


def test_query_equals_the_library(spark, tmp_path, library):
    made = rows()
    fixture.table(spark, made).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_chunked_bpe(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    want = Counter(expected(library, doc_id, text) for doc_id, text in fixture.texts(made))
    assert Counter(map(tuple, got.collect())) == want


def test_given_table(spark, library):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    want = Counter(expected(library, row.doc_id, row.text or "") for row in docs)
    assert Counter(map(tuple, queries.op11_chunked_bpe(spark, folder).collect())) == want


def test_empty_table(spark, tmp_path):
    fixture.table(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op11_chunked_bpe(spark, str(tmp_path)).collect() == []


def parts_of(text: str):
    data = text.encode()
    places = chunks.candidates(np.frombuffer(data, np.uint8)).tolist()
    return data, chunks.chunks(data, places, 0, len(data))


@settings(max_examples=150, deadline=None)
@given(
    st.lists(
        st.sampled_from(list("ab É́'sS1 \n\t\x0b\x1c 東<|!") + ["<|endoftext|>"]), max_size=600
    ).map(lambda parts: "".join(parts) * 4)
)
def test_chunks_encode_as_their_text_does(library, text):
    data, parts = parts_of(text)
    assert b"".join(data[a:b] for a, b, _ in parts) == data
    ids = b"".join(chunks.coder(PATH).encode(data[a:b]) for a, b, _ in parts)
    encoded = library.encode(text, add_special_tokens=False).ids
    assert ids == np.array(encoded, "<u4").tobytes()
    assert chunks.coder(PATH).decode(ids) == library.decode(encoded, skip_special_tokens=False)


def test_a_passage_is_cut_alike_wherever_it_stands():
    passage = fixture.prose(5, 2000)
    bodies = []
    for around in (fixture.prose(1, 333), fixture.prose(2, 1234)):
        data, parts = parts_of(f"{around} {passage} {around}")
        bodies.append({data[a:b] for a, b, join in parts if not join})
    assert sum(map(len, bodies[0] & bodies[1])) > 0.8 * len(passage)


def test_shared_chunks_are_encoded_once(spark):
    made = [(i, fixture.prose(7, 900), "en", "s", 1) for i in range(50)]
    make_importable(spark)
    texts = fixture.table(spark, made).selectExpr("doc_id AS id", "text")
    shared = chunks.shared_chunks(texts)
    n = shared.count()
    assert n > 3
    sent, bits = chunks.bloom.broadcast_field(shared, "a")
    parts = chunks._parts(texts, PATH, "bigint", sent, bits)
    once = chunks._encoded_once(parts, PATH).collect()
    assert len(once) == n and {row.n for row in once} == {50}


def test_other_kinds_are_refused():
    import json

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        with pytest.raises(ValueError):
            chunks.check_kind(json.load(file))


def test_ids_are_decoded_by_the_worker_that_made_them(spark):
    docs = fixture.table(spark, rows())
    both = chunks.encode(docs, PATH, decoded=True)
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 2  # texts without shared chunks, and the others
    apart = chunks.decode(chunks.encode(docs, PATH), PATH, keep=True)
    assert Counter(map(tuple, both.collect())) == Counter(map(tuple, apart.collect()))
