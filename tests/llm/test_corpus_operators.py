"""Operators that look at the whole corpus, against brute force on edge cases."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.compare import differences
from tests.llm import docs as fixture
from trailmark.llm import jaccard, mixing, queries, repeats, topk
from trailmark.llm.components import components

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_same_rows_as_the_twin(spark, name):
    df = queries.queries()[name](spark, FOLDER)
    assert differences(df, FOLDER, queries.oracle_sql()[name]) == []


def test_mixing_redistributes_among_siblings_first(spark):
    leaves = spark.createDataFrame(
        [("a", "en", "x", 1000), ("a", "en", "y", 10), ("a", "de", "z", 500), ("b", "en", "w", 1000)],
        "domain string, lang string, source string, tokens long",
    )
    mix = mixing.Mix(budget_percent=40, max_epochs=1)
    budgets = {row.source: row.budget for row in mixing.budgets(leaves, mix).collect()}
    # 1004 in all: 502 to each domain, 251 to each language of a; y's shortage goes to x.
    assert budgets == {"x": 241, "y": 10, "z": 251, "w": 502}
    mix = mixing.Mix(budget_percent=100, max_epochs=1, weights={"domain": {"b": 3}})
    budgets = {row.source: row.budget for row in mixing.budgets(leaves, mix).collect()}
    assert budgets == {"x": 1000, "y": 10, "z": 500, "w": 1000}
    mix = mixing.Mix(budget_percent=50, max_epochs=1, weights={"domain": {"b": 0}})
    budgets = {row.source: row.budget for row in mixing.budgets(leaves, mix).collect()}
    assert budgets["w"] == 0 and sum(budgets.values()) == 1255


def test_mixing_edges(spark):
    docs = fixture.table(spark)
    for mix in (mixing.Mix(), mixing.Mix(budget_percent=150), mixing.Mix(budget_percent=0)):
        mixed = mixing.mix_sources(docs, mixing.source_domain(docs["source"]), mix)
        assert mixed.columns == [*docs.columns, "mix_domain", "mix_tokens", "mix_copies"]
        rows = mixed.collect()
        assert Counter(row.doc_id for row in rows) == Counter(i for i, _ in fixture.texts())
        total = sum(row.mix_tokens for row in rows)
        taken = sum(row.mix_tokens * row.mix_copies for row in rows)
        assert taken <= total * mix.budget_percent / 100
        assert max(row.mix_copies for row in rows) <= mix.max_epochs
    empty = docs.limit(0)
    assert mixing.mix_sources(empty, mixing.source_domain(empty["source"])).count() == 0


def test_mixing_columns_with_names_it_adds(spark):
    docs = fixture.table(spark).selectExpr("*", *(f"'mine' AS {name}" for name in mixing.ADDED))
    domain = mixing.source_domain(docs["source"])
    bare = fixture.table(spark)
    plain = mixing.mix_sources(bare, mixing.source_domain(bare["source"]))
    plain = plain.select("doc_id", *mixing.ADDED)
    told = mixing.mix_sources(docs, domain)
    assert Counter(told.columns) == Counter(docs.columns)
    assert Counter(told.select(*plain.columns).collect()) == Counter(plain.collect())
    rows = mixing.placed(docs, domain).collect()
    assert {row.row[name] for row in rows for name in mixing.ADDED} == {"mine"}


def brute_sets(texts):
    made = []
    for _, text in texts:
        words = text.encode().lower().split()
        runs = zip(words, words[1:], words[2:]) if len(words) > 2 else [tuple(words)] * bool(words)
        made.append(frozenset(runs))
    return made


def brute_components(sets):
    group = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 90 * len(a | b) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return group


def near_copies(seed, n, words):
    """A chain of texts, each one word away from one before it, and unlike texts."""
    rng = random.Random(seed)
    base = [fixture.prose(seed, words).split()]
    for _ in range(n):
        copy = list(rng.choice(base))
        copy[rng.randrange(len(copy))] = f"new{rng.randrange(10**6)}"
        base.append(copy)
    return [" ".join(words) for words in base]


@pytest.mark.parametrize("small", [2, 24])
def test_groups_equal_brute_force(spark, small):
    rows = fixture.rows()
    texts = near_copies(5, 90, 110) + near_copies(6, 20, 70) + near_copies(7, 10, 30)
    rows += [(1000 + i, text, "en", "s", 1) for i, text in enumerate(texts)]
    docs = fixture.table(spark, rows).repartition(5)
    found = jaccard.similar_groups(docs, jaccard.Settings(small=small, sketch_bits=20))
    sets = brute_sets(fixture.texts(rows))
    group = brute_components(sets)
    ids = [row[0] for row in rows]
    expected = Counter()
    for i, own in enumerate(ids):
        members = [ids[j] for j in range(len(ids)) if group[j] == group[i] and ids[j] is not None]
        expected[own, len(sets[i]), own if not sets[i] else min(members, default=None)] += 1
    assert Counter(tuple(row) for row in found.collect()) == expected
    kept = jaccard.one_of_each(docs, jaccard.Settings(small=small, sketch_bits=20))
    assert kept.columns == docs.columns
    named = {(i, c) for i, n, c in expected if n and i == c} | {(i, c) for i, n, c in expected if not n}
    named.add((None, None))
    assert Counter(row.doc_id for row in kept.collect()) == Counter(i for i, _ in named)


def test_no_documents_have_no_groups(spark):
    assert jaccard.similar_groups(fixture.table(spark).limit(0)).count() == 0
    assert jaccard.one_of_each(fixture.table(spark).limit(0)).count() == 0


def test_similar_sets_share_prefix_tokens_in_every_order():
    random_ = np.random.default_rng(2)
    chosen = jaccard.Settings()
    levels = random_.integers(1, 200, 1 << 10).astype(np.uint8)
    for n in (1, 2, 9, 10, 11, 19, 20, 57, 200):
        a = np.unique(random_.integers(0, 2**63, n).astype(np.uint64))
        drop = n // 19  # the most a link allows when one side loses and one gains as many
        b = np.unique(np.concatenate([a[drop:], random_.integers(0, 2**63, drop).astype(np.uint64)]))
        common = len(np.intersect1d(a, b))
        if jaccard.enough(common, len(a), len(b), 90):
            for order in range(3):
                pa_, pb = (jaccard._prefix(x, levels, order, chosen) for x in (a, b))
                assert len(np.intersect1d(pa_, pb))


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    edges += [(300, 301), (301, 300)]
    frame = spark.createDataFrame([(b, a) if a % 2 else (a, b) for a, b in edges], "x long, y long")
    found = {row.node: row.component for row in components(frame).collect()}
    expected = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {300: 300, 301: 300}
    assert found == expected


def brute_repeats(texts, length):
    data = [text.encode() for text in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    made = []
    for d in data:
        gone = set()
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone.update(range(i, i + length))
        spans, at = [], sorted(gone)
        for i in at:
            if spans and spans[-1][1] == i:
                spans[-1][1] = i + 1
            else:
                spans.append([i, i + 1])
        kept = bytes(byte for i, byte in enumerate(d) if i not in gone)
        made.append((len(d), tuple(map(tuple, spans)), kept))
    return made


def test_repeats_equal_brute_force(spark):
    rng = random.Random(3)
    shared = [fixture.prose(70 + i, 40) for i in range(4)]
    rows = [row for row in fixture.rows() if row[0] != 10]
    for i in range(30):
        parts = [fixture.prose(900 + i, rng.randrange(1, 60)) for _ in range(2)]
        cut = rng.choice(shared)[: rng.choice([150, 199, 200, 201, 240])]
        rows.append((700 + i, parts[0] + cut + parts[1], "en", "s", 1))
    rows.append((800, "ab" * 150 + "東" * 100, "en", "s", 1))
    docs = fixture.table(spark, rows).repartition(4)
    for chosen in (repeats.Settings(), repeats.Settings(pack_bytes=3_000, bucket_bytes=5_000)):
        cut = repeats.remove_repeats(docs, chosen)
        found = Counter(
            (r.doc_id, r.n_bytes, tuple((s.start, s.stop) for s in r.spans), bytes(r.kept))
            for r in cut.collect()
        )
        expected = brute_repeats([text for _, text in fixture.texts(rows)], 200)
        assert found == Counter((row[0], *made) for row, made in zip(rows, expected))
    texts = repeats.with_text(cut)
    assert texts.columns == ["doc_id", "n_bytes", "spans", "text"]
    assert repeats.remove_repeats(docs.limit(0)).count() == 0


def test_cover_has_a_common_sample_for_every_two_offsets():
    cover = set(repeats.COVER)
    for i in range(repeats.PERIOD):
        for j in range(repeats.PERIOD):
            shifts = [
                k
                for k in range(repeats.PERIOD)
                if (i + k) % repeats.PERIOD in cover and (j + k) % repeats.PERIOD in cover
            ]
            assert len(shifts) == (len(cover) if i == j else 1)


def test_names_tell_strings_apart():
    data = np.frombuffer(fixture.prose(1, 3_000).encode() * 2, np.uint8)
    half = len(data) // 2
    places = np.arange(len(data) - 200 + 1)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    names, second = repeats.named(padded, places, 200)
    same = np.arange(half - 200)
    assert (names[same] == names[same + half]).all() and (second[same] == second[same + half]).all()
    assert len(np.unique(names[:half])) == half


def brute_top(vectors, k):
    made = set()
    for q, a in vectors.items():
        if q % 50:
            continue
        scores = sorted((-sum(x * y for x, y in zip(a, b)), v) for v, b in vectors.items() if v != q)
        made |= {(q, rank, v, -score) for rank, (score, v) in enumerate(scores[:k], 1)}
    return made


@pytest.mark.parametrize("lists", [1, 2, 5])
def test_top_k_equals_brute_force(spark, lists):
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)], "x") for i in range(300)]
    rows += [(400 + i, rows[3][1], "x") for i in range(9)]  # ties
    rows += [(500, [1.0] * 8, "x"), (500, [1.0] * 8, "x")]  # a row twice
    taken = {i: [int(np.floor(256 * x)) for x in v] for i, v, _ in rows}
    rows += [
        (None, [1.0] * 8, "x"), (550, None, "x"), (600, [], "x"), (650, [None] + [1.0] * 7, "x"),
        (700, [float("nan")] * 8, "x"), (750, [float("inf")] * 8, "x"),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, id string")
    chosen = topk.Settings(lists=lists, query_block=3, row_block=64, tile=10)
    found = topk.top_inner_products(frame, F.col("id") % 50 == 0, settings=chosen)
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == brute_top(taken, 5)
    few = frame.where("vec_id in (0, 1, 2)")
    got = topk.top_inner_products(few, F.col("id") % 50 == 0, settings=chosen).collect()
    assert [row["rank"] for row in got] == [1, 2]
    assert topk.top_inner_products(frame.limit(0), F.col("id") % 50 == 0).count() == 0
