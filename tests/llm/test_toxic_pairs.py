"""Terms that tell something only in a pair, with the settings that are in use."""

from __future__ import annotations

import numpy as np

from trailmark.llm import toxicity


def texts_with_a_pair(seed):
    """16,000 texts, 11 percent of label 1; term 1 is in 320, term 2 in 800, both in 16."""
    random = np.random.default_rng(seed)
    n = 16_000
    order = random.permutation(n)
    one, two = set(order[:320].tolist()), set(order[304:1_104].tolist())
    share = 1 / np.arange(1, 3_001)
    labels = (random.random(n) < 0.11).astype(float)
    texts = []
    for i in range(n):
        own = set((10 + random.choice(3_000, 30, p=share / share.sum())).tolist())
        own |= ({1} if i in one else set()) | ({2} if i in two else set())
        texts.append(sorted(own))
    both = sorted(one & two)
    labels[both] = 1
    return texts, labels, both


def test_rare_pairs_that_single_terms_do_not_tell():
    texts, labels, both = texts_with_a_pair(0)
    assert len(both) == 16
    model = toxicity.fit(texts, labels, toxicity.Settings())
    assert {1, 2} <= set(model.kept.tolist())
    fresh, _, both = texts_with_a_pair(5)
    wrong = model.scores(fresh) >= 0.5
    assert wrong[both].all()
    assert wrong.sum() < 3 * len(both)  # chance makes no other pairs


def test_a_pair_may_also_speak_for_label_0():
    """Each of two terms is often in texts of label 1, both together never."""
    random = np.random.default_rng(1)
    texts, labels = [], []
    for i in range(8_000):
        a, b = random.random(2) < 0.2
        texts.append([1] * int(a) + [2] * int(b) + [3 + i % 50])
        labels.append(float(random.random() < (0.0 if a and b else 0.4)))
    model = toxicity.fit(texts, np.array(labels), toxicity.Settings(signal=50.0))
    assert {1, 2} == set(model.kept.tolist())


def test_scores_equal_the_sum_over_pairs():
    """b + sum w + sum over pairs of <v, v>, pair by pair."""
    random = np.random.default_rng(3)
    kept = np.array([3, 8, 9, 20, 21, 40])
    model = toxicity.Model(
        toxicity.Settings(), kept, 0.3, random.normal(size=6), random.normal(size=(6, 4))
    )
    texts = [[], [3], [1, 2], [3, 8, 40], [8, 9, 20, 21, 40, 41], sorted(kept.tolist())]
    for text, score in zip(texts, model.scores(texts)):
        own = [kept.tolist().index(h) for h in text if h in kept]
        z = model.bias + sum(model.linear[i] for i in own)
        z += sum(model.pairs[i] @ model.pairs[j] for i in own for j in own if i < j)
        assert abs(score - 1 / (1 + np.exp(-z))) < 1e-12


def test_rows_that_repeat_an_id_teach_once(spark):
    rows = [(i % 40, f"{'vile' if i % 40 % 2 else 'kind'} words {i % 7}") for i in range(4_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    assert toxicity.labelled_terms(docs, labels).count() == 40
    model = toxicity.train(docs, labels)
    low, high = model.scores([toxicity.terms(word, model.settings) for word in ("kind", "vile")])
    assert low < 0.5 < high
