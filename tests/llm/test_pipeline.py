"""The pipeline's stages on a small corpus, each against brute force on its own input."""

from __future__ import annotations

from collections import Counter

import pytest
import tiktoken
from public_tokenizers import PATTERN, path

import corpus_pipeline
from tests.llm import docs as fixture
from tests.llm.test_corpus_operators import brute_components, brute_repeats, brute_sets
from trailmark.llm import toxicity
from trailmark.llm.bpe import load_ranks


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("corpus"))
    rows = [row for row in fixture.rows() if row[0] != 10]
    passage = fixture.prose(77, 60)
    for i in range(300):
        bad = " you awful fool" if i % 4 == 0 else ""
        text = fixture.prose(i, 40) + bad + ("\n" + passage if i % 9 == 0 else "")
        rows.append((1000 + i, text, "en" if i % 2 else "de", f"src{i % 12}", len(text)))
    fixture.table(spark, rows, extra=False).write.parquet(f"{root}/documents.parquet")
    marks = [(1000 + i, 1, int(i % 4 == 0)) for i in range(0, 300)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{root}/labels.parquet")
    return root


@pytest.fixture(scope="module")
def kept(spark, folder, tmp_path_factory):
    """The rows before the first stage and after each."""
    frames = [spark.read.parquet(f"{folder}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, frames[-1], folder).write.parquet(out)
        frames.append(spark.read.parquet(out))
    return frames


def test_columns(kept):
    assert len(corpus_pipeline.STAGES) == 5
    for frame in kept[1:-1]:
        assert frame.dtypes == kept[0].dtypes


def test_toxic_documents_go(spark, folder, kept):
    model = toxicity.train(kept[0], spark.read.parquet(f"{folder}/labels.parquet"))
    scores = {(row.doc_id, row.score) for row in toxicity.score(kept[0], model).collect()}
    assert {row.doc_id for row in kept[1].collect()} == {i for i, s in scores if s < 0.5}
    assert not {row.doc_id for row in kept[1].collect()} & set(range(1000, 1300, 4))


def test_one_of_each_group_stays(kept):
    rows = [(row.doc_id, row.text or "") for row in kept[1].collect()]
    sets = brute_sets(rows)
    group = brute_components(sets)
    expected = {}
    for (doc_id, _), own, one in zip(rows, group, sets):
        place = (doc_id is None, doc_id or 0)
        key = own if one else ("empty", doc_id)
        expected[key] = min(expected.get(key, place), place)
    found = Counter((row.doc_id is None, row.doc_id or 0) for row in kept[2].collect())
    assert found == Counter(expected.values())


def test_repeats_are_cut_and_rows_stay(kept):
    before = {row.doc_id: row.text or "" for row in kept[2].collect()}
    cut = brute_repeats(list(before.values()), 200)
    expected = {i: made[2].decode("utf-8", "ignore") for i, made in zip(before, cut)}
    after = kept[3].collect()
    assert {row.doc_id: row.text for row in after} == expected and len(after) == len(before)
    assert all(row.n_chars == len(row.text) for row in after)
    assert any(len(expected[i]) < len(before[i]) for i in before)


def chained_workers(plan):
    """Python steps of a plan that a task runs one on another, each in a worker of its own."""
    found, above = [], []
    for line in plan.splitlines():
        name = line.lstrip(" :+-")
        depth = len(line) - len(name)
        above = [(at, step) for at, step in above if at < depth]
        if name.startswith("Exchange"):
            above.append((depth, None))
        elif name.startswith(("MapIn", "FlatMap", "ArrowEval", "BatchEval")):
            found += [(above[-1][1], name)] if above and above[-1][1] else []
            above.append((depth, name))
    return found


@pytest.mark.parametrize("name", ["repeated_strings", "bpe"])
def test_a_task_has_one_worker(spark, folder, name):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    made = dict(corpus_pipeline.STAGES)[name](spark, docs, folder)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" in plan and not chained_workers(plan)


def test_mixed_rows_are_rows_of_the_stage_before(kept):
    before = {tuple(row) for row in kept[3].collect()}
    after = Counter(tuple(row) for row in kept[4].collect())
    assert after.keys() <= before and max(after.values()) <= 2 and len(after) > 20


def test_encoding_of_what_is_left(kept):
    ranks = load_ranks(path(corpus_pipeline.RANKS))
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = Counter((row.doc_id, tuple(library.encode_ordinary(row.text))) for row in kept[4].collect())
    found = kept[5].collect()
    assert Counter((row.doc_id, tuple(row.ids)) for row in found) == expected
    assert all(row.n_tokens == len(row.ids) for row in found)
