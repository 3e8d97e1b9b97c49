"""Conversation repair against brute force: rules applied row by row, edits by recursion."""

from __future__ import annotations

import hashlib
import random
import re
from functools import lru_cache
from zlib import crc32

import pytest

from trailmark.llm import conversations, queries
from trailmark.llm.role_repair import repairer

SCHEMA = "conv_id long, turn long, role string, text string"
STEPS = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def cheapest(rows: tuple) -> tuple:
    """(cost, audit) over every way to keep, rerole, delete and insert."""

    @lru_cache(None)
    def best(i, state, inserts):
        ways = [(0, "")] if i == len(rows) and state in ("", "a") else []

        def go(letter, price, after, at, n):
            rest = best(at, after, n) if after is not None else None
            if rest:
                ways.append((price + rest[0], letter + rest[1]))

        if inserts < 4:
            for role in "ua":
                go("I", 2, STEPS.get((state, role)), i, inserts + 1)
        if i < len(rows):
            initial, fault = rows[i]
            go("D", 3, state, i + 1, 0)
            if fault not in ("b", "d"):
                extra = fault == "t"
                go("K", extra, STEPS.get((state, initial)), i + 1, 0)
                for role in "ua":
                    go("R", 2 + extra, STEPS.get((state, role)), i + 1, 0)
        return min(ways, default=None)

    for i in range(len(rows), 0, -1):  # from the end on, so that recursion stays shallow
        for state in ("", "s", "u", "a"):
            best(i, state, 0)
    return best(0, "", 0)


def lines(rows, audit):
    length = sum(letter != "D" for letter in audit)
    made, left = [], list(rows)
    for letter in audit:
        role, text = ("", "") if letter == "I" else left.pop(0)
        if letter != "D":
            place = ("user", "assistant")[(len(made) - length % 2) % 2]
            made.append(f"{role if letter == 'K' else place}:{text}")
    return made


def report(rows) -> tuple:
    """Expected row of a conversation from its (turn, role, text) after damage."""
    by_turn = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest())
    rows = sorted(rows, key=by_turn)
    seen, signs = set(), []
    for _, role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
        fault = "b" if not last else "d" if (role, text) in seen else "t" if last[0] not in ".!?" else ""
        seen.add((role, text))
        signs.append((role[:1], fault))
    turns = [turn for turn, _, _ in rows if turn is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(signs, signs[1:]))
    cost, audit = cheapest(tuple(signs))
    text = "\n".join(lines([row[1:] for row in rows], audit))
    counts = [sum(fault == f for _, fault in signs) for f in "bdt"]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def damaged(rows) -> dict:
    made: dict = {}
    for conv, turn, role, text in rows:
        key = ":".join(" " if part is None else str(part) for part in (conv, turn))
        role, text = (" " if part is None else part for part in (role, text))
        kept = made.setdefault(conv, [])
        dealt = crc32(key.encode()) % 20
        if dealt:
            text = "" if dealt == 1 else re.sub("[.!?]", "", text) if dealt == 2 else text
            kept += [(turn, "user" if dealt == 4 else role, text)] * (2 if dealt == 3 else 1)
    return made


def write(spark, tmp_path, rows, extra=True):
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        df = df.selectExpr("*", *(f"'x' AS {n}" for n in ("conv", "digest", "plan", "kind", "dealt")))
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    return str(tmp_path)


def cases():
    rng = random.Random(5)
    texts = ["Fine.", "Well then!", "unfinished", "", " \t\n\x0b", None, "Is it?  \r\n", "a.\x1c", "x" * 300_000 + "."]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "usher"]
    rows = []
    for conv in [*range(120), None]:
        for turn in range(rng.randrange(1, 9)):
            told = rng.choice(texts) if rng.random() < 0.5 else f"Said {rng.randrange(9)}."
            turn = None if rng.random() < 0.1 else turn * rng.choice((1, 1, 1, 2))
            rows.append((conv, turn, rng.choice(roles), told))
    rows += [(500, i, ("user", "assistant")[i % 2], f"Turn {i}.") for i in range(3000)]  # long
    rows += [(501, None, "user", "Again."), (501, None, "user", "Again.")]
    # A conversation all of whose rows are dropped.
    lost = next(c for c in range(1000, 9000) if crc32(f"{c}:0".encode()) % 20 == 0)
    return rows + [(lost, 0, "user", "Lost.")]


def test_query_equals_brute_force(spark, tmp_path):
    rows = cases()
    got = queries.op13_conversation_repair(spark, write(spark, tmp_path, rows))
    assert got.columns == [
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256",
    ]
    told = {row[0]: tuple(row)[1:] for row in got.collect()}
    expected = damaged(rows)
    assert len(told) == got.count() == len(expected)
    for conv, kept in expected.items():
        assert told[conv] == report(kept), conv


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_given_table(spark, sf):
    folder = f"/root/testdata/{sf}"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()]
    told = {r[0]: tuple(r)[1:] for r in queries.op13_conversation_repair(spark, folder).collect()}
    assert told == {conv: report(kept) for conv, kept in damaged(rows).items()}


def test_empty_table(spark, tmp_path):
    assert queries.op13_conversation_repair(spark, write(spark, tmp_path, [])).collect() == []


def test_repaired_turns(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 2, "user", "Why"), (1, 3, "system", "Now.")]
    got = conversations.repair(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.position, r.edit, r.role, r.text) for r in got] == [
        (0, None, None, None),
        (1, "I", "user", ""),
        (2, "K", "assistant", "Hello."),
        (3, "K", "user", "Why"),
        (4, "R", "assistant", "Now."),
    ]
    assert (got[0].plan.gaps, got[0].plan.cost, got[0].plan.audit) == (1, 5, "IKKR")


def test_every_short_sequence():
    from itertools import product

    signs = [("s", ""), ("u", ""), ("a", ""), ("x", ""), ("u", "t"), ("a", "t"), ("s", "b")]
    for n in range(5):
        for rows in product(signs, repeat=n):
            text = "".join("d" if f == "b" else i.upper() if f else i for i, f in rows)
            assert repairer().repair(text)[:2] == cheapest(rows), text


def test_a_long_sequence_takes_linear_time():
    rows = "uaSd" * 100_000
    cost, audit, roles = repairer().repair(rows)
    assert len(audit) - audit.count("I") == len(rows)
    assert re.fullmatch("(s?(ua)+)?", roles.replace("-", "")) and cost > 0
