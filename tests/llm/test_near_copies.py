"""Near copies by runs of five words, 80 percent in common, against brute force."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from tests.llm import docs as fixture
from trailmark.llm import jaccard
from trailmark.llm.shingles import shingle_set


def brute_groups(texts, width, percent):
    sets = []
    for text in texts:
        words = text.encode().lower().split()
        size = min(width, len(words))
        sets.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set())
    group = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and group[i] != group[j] and 100 * len(a & b) >= percent * len(a | b):
                old, new = group[i], group[j]
                group = [new if one == old else one for one in group]
    return sets, group


def edited(text, places):
    words = text.split()
    for place in places:
        words[place] = f"edit{place}"
    return " ".join(words)


@pytest.fixture(scope="module")
def rows():
    made = []
    for base in range(8):
        text = fixture.prose(300 + base, 230)
        # Five words edited: 201 of 251 runs of five in common, 213 of 243 runs of three.
        for edits in ([], [50, 90, 130, 170, 210], [20, 60, 100, 140, 180], range(9, 150, 20)):
            made.append(edited(text, edits))
    base = fixture.prose(400, 230)
    made += [edited(base, [5 + i, 50 + i, 95 + i, 140 + i, 185 + i]) for i in range(40)] + [base]
    return fixture.rows() + [(1000 + i, text, "en", "s", len(text)) for i, text in enumerate(made)]


@pytest.mark.parametrize("small", [2, 24])
def test_groups_at_five_words_and_80_percent(spark, rows, small):
    docs = fixture.table(spark, rows).repartition(5)
    chosen = jaccard.Settings(percent=80, width=5, small=small, sketch_bits=20)
    sets, group = brute_groups([text for _, text in fixture.texts(rows)], 5, 80)
    assert len(set(group)) < len(set(brute_groups([text for _, text in fixture.texts(rows)], 3, 90)[1]))
    ids = [row[0] for row in rows]
    expected = Counter()
    for i, own in enumerate(ids):
        members = [ids[j] for j in range(len(ids)) if group[j] == group[i] and ids[j] is not None]
        expected[own, len(sets[i]), own if not sets[i] else min(members, default=None)] += 1
    found = jaccard.similar_groups(docs, chosen).collect()
    assert Counter(tuple(row) for row in found) == expected


def test_stage_keeps_one_of_each_group(spark, rows):
    docs = fixture.table(spark, rows, extra=False).repartition(5)
    sets, group = brute_groups([text for _, text in fixture.texts(rows)], 5, 80)
    expected = {}
    for row, own, one in zip(rows, group, sets):
        place = (row[0] is None, row[0] or 0)
        key = own if one else ("empty", row[0])
        expected[key] = min(expected.get(key, place), place)
    kept = corpus_pipeline.near_duplicates_removed(spark, docs, "").collect()
    assert Counter((row.doc_id is None, row.doc_id or 0) for row in kept) == Counter(expected.values())


def test_large_buckets_get_packed_counts():
    chosen = jaccard.Settings()
    sets = [shingle_set(fixture.prose(i, n)) for i, n in enumerate((4, 150, 9_000))]
    marks = [jaccard.packed_counts(tokens, chosen) for tokens in sets]
    assert len(marks[1]) < chosen.classes * 3 // 4
    room = jaccard.room_of(marks)
    for tokens, counts in zip(sets, room):
        classes = (tokens >> np.uint64(40)).astype(np.int64) % chosen.classes
        assert counts.tolist() == np.bincount(classes, minlength=chosen.classes).tolist()


def test_sketch_parts_are_packed_to_about_a_byte_a_counter():
    rng = np.random.default_rng(5)
    tokens = rng.integers(0, 1 << 24, 2_000_000)
    found, counts = np.unique(tokens, return_counts=True)
    cuts = np.searchsorted(found >> jaccard._PART, np.arange((1 << (24 - jaccard._PART)) + 1))
    size = 0
    for low, high in zip(cuts[:-1], cuts[1:]):
        at = found[low:high] & ((1 << jaccard._PART) - 1)
        blob = jaccard.packed_part(at, counts[low:high])
        own, told = jaccard.part_of(blob)
        assert (own == at).all() and (told == counts[low:high]).all()
        size += len(blob)
    assert size < 1.5 * len(found)


def test_sets_move_once_for_both_sides_of_a_pair(spark, tmp_path):
    keys = [bytes([i]) * 16 for i in range(60)]
    sets = {key: np.arange(i % 3, 30, dtype="<u8").tobytes() for i, key in enumerate(keys)}
    spark.createDataFrame([(k, bytearray(v)) for k, v in sets.items()], "key binary, data binary").write.parquet(
        f"{tmp_path}/sets"
    )
    pairs = [(a, len(sets[a]) // 8, b, len(sets[b]) // 8) for a in keys for b in keys if a < b]
    spark.createDataFrame(pairs, jaccard.KEY).write.parquet(f"{tmp_path}/pairs")
    read = [spark.read.parquet(f"{tmp_path}/{name}") for name in ("pairs", "sets")]
    chosen = jaccard.Settings(percent=95)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        links = jaccard._verified(*read, chosen)
        found = {(bytes(row.key), bytes(row.other)) for row in links.collect()}
        plan = links._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    expected = {(a, b) for a, n, b, m in pairs if 100 * min(n, m) >= 95 * max(n, m)}
    assert found == expected and 0 < len(found) < len(pairs)
    assert "ReusedExchange" in plan
