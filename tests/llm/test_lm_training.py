"""What the recurrent model learns from, with the settings that are in use."""

from __future__ import annotations

import random
from dataclasses import replace

import numpy as np

from tests.llm import docs as fixture
from trailmark.llm import gru, lm


def chained(seed, words):
    """Text in which a word names the one that follows it, mostly."""
    rng = random.Random(seed)
    made, at = [], rng.randrange(120)
    for _ in range(words):
        at = (at * 7 + 3) % 120 if rng.random() < 0.9 else rng.randrange(120)
        made.append(f"w{at}")
    return " ".join(made)


def test_held_out_scores_beat_the_unigram_scores(spark):
    rows = [(i, chained(i, 200), "en", "s", 1) for i in range(300)]
    scored = lm.score_texts(fixture.table(spark, rows), lm.held_out_rows()).where("held_out").collect()
    assert len(scored) > 20
    gain = sum(row.score - row.base_score for row in scored) / sum(row.n_tokens for row in scored)
    assert gain > 0.05  # log10 of a token's probability
    assert sum(row.score > row.base_score for row in scored) > 0.9 * len(scored)


def test_every_training_text_is_in_a_slot():
    table = lm.pa.table({"text": [f"text {i}" for i in range(90)], "held_out": [i % 3 == 0 for i in range(90)]})
    for chosen in (lm.Settings(), lm.Settings(slot_bytes=50)):
        slots = list(lm._slots(table, chosen))
        assert sorted(text for slot in slots for text in slot) == sorted(
            f"text {i}" for i in range(90) if i % 3
        )


def test_vocabulary_grows_with_the_corpus(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(lm, "_fitted", lambda packs, weights, counts, *_: seen.append(len(counts)) or weights)
    rows = [(i, " ".join(f"t{i}x{k}" for k in range(200)), "en", "s", 1) for i in range(700)]
    lm.score_texts(fixture.table(spark, rows), lm.held_out_rows())
    assert seen[0] > 3_000


def test_the_last_tokens_of_a_slot_are_learned():
    """A stream that does not fill its lanes; a word stands at its very end alone."""
    counts = np.array([500.0, 300, 200, 40, 30, 20, 10, 1])
    shape = replace(gru.Shape(), classes=3, window=4, lanes=8, updates=2)
    stream = np.array([i % 7 for i in range(67)] + [7], np.int32)
    fresh = np.zeros(len(stream), bool)
    fresh[::17] = True

    def trained(stream):
        model = gru.Model(gru.start(counts, shape), counts, shape)
        assert model.train(stream, fresh, 0) == len(stream)
        return model.w

    one, other = trained(stream), trained(np.append(stream[:-1], 6).astype(np.int32))
    assert any((one[name] != other[name]).any() for name in gru.NAMES)


def test_filled_up_steps_teach_nothing():
    counts = np.array([50.0, 30, 20, 4, 3, 2])
    shape = replace(gru.Shape(), classes=2, window=4)
    model = gru.Model(gru.start(counts, shape), counts, shape)
    random = np.random.default_rng(1)
    inputs, targets = random.integers(0, 6, (2, 4, 3))
    fresh, used = np.zeros((4, 3), bool), np.ones((4, 3), bool)
    used[2:, 2] = False
    changed = targets.copy()
    changed[2:, 2] = (targets[2:, 2] + 1) % 6

    def gradients(targets):
        total = {name: np.zeros_like(value) for name, value in model.w.items()}
        trace, _ = model._steps(inputs, fresh, np.zeros((3, shape.hidden), np.float32))
        for name, rows, grad in model._gradients(trace, inputs, fresh, targets, used):
            total[name][rows] += grad
        return total

    one, other = gradients(targets), gradients(changed)
    assert all(np.allclose(one[name], other[name], atol=1e-6) for name in gru.NAMES)


def test_weights_move_in_pieces(spark, monkeypatch):
    rows = [(i, fixture.prose(i, 150), "en", "s", 1) for i in range(60)]
    packs = lm._packs(
        fixture.table(spark, rows).repartition(4).selectExpr("doc_id id", "text", "doc_id % 7 = 2 held_out"),
        lm.Settings(),
    ).where("texts is not null")
    words = sorted({word for row in rows for word in lm.tokens(row[1])} - {lm.END})
    places = {word: i for i, word in enumerate([*words, lm.END, b""])}
    counts = np.ones(len(places))
    start = gru.start(counts, gru.Shape())
    rounds = []
    monkeypatch.setattr(lm, "stored", lambda df, name, real=lm.stored: rounds.append(real(df, name)) or rounds[-1])
    made = lm._fitted(packs, start, counts, places, lm.Settings(rounds=2))
    whole = sum(value.size for value in start.values())
    assert len(rounds) == 2 and whole > 2 * lm.PIECE
    for step in rounds:
        sizes = [len(row.weights) for row in step.collect()]
        assert sum(sizes) == 4 * whole and max(sizes) <= 4 * lm.PIECE
    # As one process learns them: each round's slots from common weights, then their mean.
    expected = start
    for turn in range(2):
        total, seen = 0.0, 0
        for blob in [row.texts for row in packs.collect()]:
            for slot in lm._slots(lm._unpacked(bytes(blob)), lm.Settings(rounds=2), turn):
                lists = lm._numbered(slot, places, places[b""])
                fresh = np.zeros(sum(map(len, lists)), bool)
                fresh[np.cumsum([0] + [len(one) for one in lists[:-1]])] = True
                model = gru.Model(expected, counts, gru.Shape())
                n = model.train(np.concatenate(lists), fresh, places[lm.END])
                total = total + n * np.frombuffer(gru.pack(model.w), "<f4").astype(float)
                seen += n
        expected = gru.unpack((total / seen).astype("<f4").tobytes(), start)
    assert np.allclose(np.frombuffer(gru.pack(made), "<f4"), np.frombuffer(gru.pack(expected), "<f4"), atol=1e-6)


def test_words_are_split_as_python_splits_bytes():
    texts = ["", " ", "A b\tÉ\x0bc\x0c\x1cd\r\n", " x Y\x85z ", "ẞ İ\x00 q", "plain", "\n\n a  a "]
    words, sizes = lm._split(lm.pa.array(texts))
    expected = [text.encode().lower().split() for text in texts]
    assert sizes.tolist() == [len(one) for one in expected]
    assert [word.encode() for word in words.to_pylist()] == [word for one in expected for word in one]
    distinct, codes, cuts = lm._coded(lm.pa.array(texts))
    found = [[distinct[int(i)].as_py().encode() for i in codes[a:b]] for a, b in zip(cuts, cuts[1:])]
    assert found == [[*one, lm.END] for one in expected] == [lm.tokens(text) for text in texts]
    # An empty place is no word, though it is the key of the unknown one.
    numbers = lm._numbered(texts, {b"a": 0, b"": 1, lm.END: 2, b"plain": 3}, 1)
    assert [one.tolist() for one in numbers][5:] == [[3, 2], [0, 0, 2]] and numbers[0].tolist() == [2]


def test_counts_come_back_to_each_pack_in_few_rows(spark):
    rows = [(i, fixture.prose(i % 40, 150) + f" own{i}", "en", "s", 1) for i in range(120)]
    texts = fixture.table(spark, rows).repartition(3).selectExpr("doc_id id", "text", "doc_id % 7 = 2 held_out")
    packs = lm._packs(texts, lm.Settings(pack_bytes=20_000))
    told = packs.collect()
    assert len(told) > 3 and len({row.pack for row in told}) == len(told)
    counted = lm._counted(packs, 5).collect()
    train = lm.pd.Series([word for i, text, *_ in rows if i % 7 != 2 for word in lm.tokens(text)])
    expected = train.value_counts().to_dict()
    assert {row.word.encode(): row.n for row in counted if row.word is not None} == expected
    for one in told:
        words = [word.encode() for word in one.words.split(" ")]
        found = {}
        answers = [row for row in counted if row.pack == one.pack]
        assert len(answers) <= 5  # one row a bucket, not one a word
        for row in answers:
            found |= zip(np.frombuffer(row.at, "<i4").tolist(), np.frombuffer(row.c, "<i8").tolist())
        assert found == {at: expected.get(word, 0) for at, word in enumerate(words)}


def test_the_most_frequent_words_are_cut_by_word_among_equals(spark):
    rows = [("b", 5), ("a", 2), ("c", 2), ("d", 2), ("\n", 9), ("e", 1)]
    words = spark.createDataFrame(rows, "word string, c bigint")
    for size, expected in ((0, []), (1, ["b"]), (3, ["b", "a", "c"]), (4, ["b", "a", "c", "d"]), (9, [*"bacde"])):
        found, all_v = lm._most_frequent(words, size)
        assert all_v == 6 and found[-1] == (lm.END, 9)
        assert sorted(found[:-1]) == sorted((word.encode(), dict(rows)[word]) for word in expected)
    assert lm._most_frequent(words.limit(0), 3) == ([(lm.END, 0)], 0)


def test_few_tasks_send_their_weights(spark, monkeypatch):
    rows = [(i, fixture.prose(i, 50), "en", "s", 1) for i in range(200)]
    many = 3 * spark.sparkContext.defaultParallelism
    packs = lm._packs(
        fixture.table(spark, rows).repartition(many).selectExpr("doc_id id", "text", "false held_out"), lm.Settings()
    )
    assert packs.count() == many
    asked = []
    monkeypatch.setattr(lm, "stored", lambda df, name, real=lm.stored: asked.append(df) or real(df, name))
    places = {word: i for i, word in enumerate([b"a", lm.END, b""])}
    sent = []
    monkeypatch.setattr(type(packs), "coalesce", lambda self, n, real=type(packs).coalesce: sent.append(n) or real(self, n))
    lm._fitted(packs, gru.start(np.ones(3), gru.Shape()), np.ones(3), places, lm.Settings(rounds=1))
    assert sent == [spark.sparkContext.defaultParallelism] and len(asked) == 1


def plain_logs(w, of, states, targets):
    """Log probabilities, and gradients of their negative sum, one target after another."""
    total, grads = 0.0, {name: np.zeros(w[name].shape) for name in ("wclass", "bclass", "wword", "bword")}
    dstates = np.zeros(states.shape)
    for i, (state, target) in enumerate(zip(states.astype(float), targets)):
        own = of == of[target]
        for weights, bias, at, keys, name in (
            (w["wclass"].T, w["bclass"], of[target], slice(None), "class"),
            (w["wword"][own], w["bword"][own], np.flatnonzero(own).tolist().index(target), own, "word"),
        ):
            scores = weights.astype(float) @ state + bias
            p = np.exp(scores - scores.max())
            p /= p.sum()
            total += np.log(p[at])
            p[at] -= 1
            dstates[i] += p @ weights
            grads["b" + name][keys] += p
            grads["w" + name][keys if name == "word" else slice(None)] += np.outer(p, state) if name == "word" else np.outer(state, p)
    return total, grads, dstates


def test_outputs_in_blocks_are_those_of_single_rows(monkeypatch):
    """Rows cut into blocks, classes of one word, and scores past what exp can hold."""
    counts = np.array([900.0, 60, 50, 40, 30, 20, 10, 5, 4, 3, 2, 1])
    shape = replace(gru.Shape(), hidden=5, embed=4, classes=4)
    random = np.random.default_rng(3)
    for block, times in ((1, 1), (7, 1), (98_304, 1), (7, 400)):
        monkeypatch.setattr(gru, "_BLOCK", block)
        model = gru.Model(gru.start(counts, shape), counts, shape)
        for name in ("wclass", "wword"):
            model.w[name] *= times
        assert (np.diff(model.bounds) == 1).any()
        targets, inputs = random.integers(0, 12, (2, 6, 3))
        trace, _ = model._steps(inputs, np.zeros((6, 3), bool), np.zeros((3, 5), np.float32))
        states = np.concatenate([step[5] for step in trace])
        total, grads, dstates = plain_logs(model.w, model.of, states, targets.ravel())
        assert np.isclose(model._outputs(states, targets.ravel())[0].sum(), total, rtol=1e-4)
        found = {name: np.zeros(value.shape) for name, value in model.w.items()}
        for name, rows, grad in model._gradients(trace, inputs, np.zeros((6, 3), bool), targets):
            found[name][rows] += grad
        for name, grad in grads.items():
            assert np.allclose(found[name] * 3, grad, atol=2e-4 * max(1, times / 10)), (block, times, name)


def test_a_window_allocates_no_gradient_of_the_whole_vocabulary(monkeypatch):
    """Outputs' weights are learned class by class, where their gradient is made."""
    counts = 1e6 / np.arange(1, 4_001)
    shape = replace(gru.Shape(), classes=60, window=8, lanes=8, updates=2)
    model = gru.Model(gru.start(counts, shape), counts, shape)
    widest = []
    monkeypatch.setattr(gru, "_learn", lambda w, past, grad, *rest, real=gru._learn: widest.append(grad.size) or real(w, past, grad, *rest))
    stream = np.random.default_rng(0).integers(0, 4_000, 600).astype(np.int32)
    model.train(stream, np.arange(600) % 50 == 0, 0)
    assert max(widest) < 0.2 * model.w["wword"].size
