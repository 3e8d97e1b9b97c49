"""Repair of conversation structure: cheapest edits, then the repaired turns.

Two passes over rows sorted by conversation and turn. The first reads no text, only a
character per row (role and fault), and works out the edits; the second streams the texts
past the edits. A conversation of any length is held as two characters a row, which is what
its audit is long; its texts never are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmark.llm.role_repair import DOOMED, repairer

BLANKS = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
LEGAL = {"su", "ua", "au"}
NAMES = {"u": "user", "a": "assistant"}

COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
PLAN = "struct<" + ",".join(f"{name}:bigint" for name in COUNTS) + ",audit:string,roles:string>"

ROWS_OUT = 4096  # rows a batch of repaired turns has at most

# A conversation's structure is looked up if it is short and was met before.
MEMO_ENTRIES = 100_000
MEMO_LENGTH = 64


def _turns(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, digest, text); null roles and texts are one space."""
    told = df.select(
        df[conv].alias("conv"),
        df[turn].cast("bigint").alias("turn"),
        F.coalesce(df[role], F.lit(" ")).alias("role"),
        F.coalesce(df[text], F.lit(" ")).alias("text"),
    )
    return told.withColumn("digest", F.md5(F.col("text").cast("binary")))


def _order() -> list[Column]:
    """Order inside a conversation. Rows of one turn go by role and digest of their text,
    so rows that are equal are neighbours."""
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]


def _signs(turns: DataFrame) -> DataFrame:
    """A row's sign, which is all the repair has to know: initial and first fault."""
    earlier = Window.partitionBy("conv", "role", "digest").orderBy(F.col("turn").asc_nulls_first())
    left = F.rtrim(F.col("text"), F.lit(BLANKS))
    told = turns.select(
        "conv",
        "turn",
        "role",
        "digest",
        (F.length(left) == 0).alias("blank"),
        (~F.substring(left, -1, 1).isin(*ENDS)).alias("unfinished"),
    )
    fault = (
        F.when(F.col("blank"), "b")
        .when(F.row_number().over(earlier) > 1, "d")
        .when(F.col("unfinished"), "t")
        .otherwise("")
    )
    return told.select(
        "conv", "turn", "role", "digest", F.substring("role", 1, 1).alias("initial"), fault.alias("fault")
    )


class _Open:
    """A conversation whose rows are being read."""

    def __init__(self, conv) -> None:
        self.conv = conv
        self.rows = bytearray()
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.initial = self.least = self.most = None

    def add(self, turn, initial: str, fault: str) -> None:
        if self.initial is not None and self.initial + initial not in LEGAL:
            self.illegal += 1
        self.initial = initial
        if turn is not None and turn != self.most:
            self.distinct += 1
            self.most = turn
            if self.least is None:
                self.least = turn
        sign = initial if initial in ("s", "u", "a") else "x"
        if fault == "t":
            self.truncated += 1
            sign = sign.upper()
        elif fault:
            self.blank += fault == "b"
            self.duplicate += fault == "d"
            sign = DOOMED
        self.rows += sign.encode()

    def plan(self, known: dict) -> dict:
        rows = self.rows.decode()
        found = known.get(rows)
        if found is None:
            found = repairer().repair(rows)
            if len(rows) <= MEMO_LENGTH:
                if len(known) >= MEMO_ENTRIES:
                    known.clear()
                known[rows] = found
        gaps = 0 if self.most is None else self.most - self.least + 1 - self.distinct
        cost, audit, roles = found
        counts = (gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost)
        return dict(zip(COUNTS, counts)) | {"audit": audit, "roles": roles}


def plans(turns: DataFrame) -> DataFrame:
    """(conv, plan): faults and edits of each conversation, from rows as of ``_turns``."""
    kind = turns.schema["conv"].dataType.simpleString()
    schema = turns.sparkSession.createDataFrame([], f"conv {kind}, plan {PLAN}").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple] = {}
        now: _Open | None = None

        def batch_of(ended: list[_Open]) -> pa.RecordBatch:
            columns = [[one.conv for one in ended], [one.plan(known) for one in ended]]
            return pa.RecordBatch.from_pydict(dict(zip(("conv", "plan"), columns)), arrow)

        for batch in batches:
            ended = []
            for conv, turn, initial, fault in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or conv != now.conv:
                    if now is not None:
                        ended.append(now)
                    now = _Open(conv)
                now.add(turn, initial, fault)
            if ended:
                yield batch_of(ended)
        if now is not None:
            yield batch_of([now])

    arrow = _arrow(schema)
    ordered = _signs(turns).repartition("conv").sortWithinPartitions("conv", *_order())
    return ordered.select("conv", "turn", "initial", "fault").mapInArrow(run, schema)


def _arrow(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def repair(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """(conv, position, edit, role, text, plan): repaired turns of every conversation.

    A conversation starts with a row of position 0 that carries only ``plan``: turn numbers
    missing (``gaps``), rows that are blank, repeat an earlier row or end unfinished, pairs
    of neighbours whose roles may not follow each other, and the cheapest edits (``cost``,
    ``audit``). The turns follow from position 1 on, with ``edit`` K (kept), R (role
    changed) or I (inserted, empty text). Rows of a conversation are in one partition and
    in this order.

    Rows are read by turn, null turns first; rows of one turn by role, then by digest of
    their text. Null roles and texts count as one space, a null conversation id is a
    conversation like others, equal rows stay rows (the later ones are duplicates), other
    columns are left out. An empty table gives no rows. Null turns leave no gaps.
    """
    turns = _turns(conversations, conv_col, turn_col, role_col, text_col)
    planned = plans(turns)
    none = {"turn": "bigint", "role": "string", "digest": "string", "text": "string"}
    heads = planned.select(
        "conv", F.lit(0).alias("kind"), *(F.lit(None).cast(t).alias(n) for n, t in none.items()), "plan"
    )
    bodies = turns.select("conv", F.lit(1).alias("kind"), *none, F.lit(None).cast(PLAN).alias("plan"))
    ordered = heads.union(bodies).repartition("conv").sortWithinPartitions("conv", "kind", *_order())
    kind = turns.schema["conv"].dataType.simpleString()
    schema = conversations.sparkSession.createDataFrame(
        [], f"conv {kind}, position bigint, edit string, role string, text string, plan {PLAN}"
    ).schema
    arrow = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, roles = None, "", ""
        at = position = 0  # edits and turns of the conversation so far
        made: list[tuple] = []

        def inserted() -> Iterator[tuple]:
            nonlocal at, position
            while at < len(audit) and audit[at] == "I":
                position += 1
                yield conv, position, "I", NAMES[roles[at]], "", None
                at += 1

        def ready() -> Iterator[pa.RecordBatch]:
            if made:
                columns = list(zip(*made))
                made.clear()
                arrays = [pa.array(c, field.type) for c, field in zip(columns, arrow)]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

        for batch in batches:
            for key, head, role, text, plan in zip(*(c.to_pylist() for c in batch.columns)):
                if head == 0:
                    made += inserted()
                    conv, audit, roles, at, position = key, plan["audit"], plan["roles"], 0, 0
                    made.append((key, 0, None, None, None, plan))
                else:
                    made += inserted()
                    if audit[at] != "D":
                        position += 1
                        new = role if audit[at] == "K" else NAMES[roles[at]]
                        made.append((key, position, audit[at], new, text, None))
                    at += 1
                if len(made) >= ROWS_OUT:
                    yield from ready()
            yield from ready()
        made += inserted()
        yield from ready()

    return ordered.select("conv", "kind", "role", "text", "plan").mapInArrow(run, schema)


def digests(repaired: DataFrame) -> DataFrame:
    """(conv, plan, repaired_sha256) of what ``repair`` returned: the digest of its turns as
    ``role:text`` lines, taken as they pass."""
    kind = repaired.schema["conv"].dataType.simpleString()
    schema = repaired.sparkSession.createDataFrame(
        [], f"conv {kind}, plan {PLAN}, repaired_sha256 string"
    ).schema
    arrow = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, hashed = None, None

        def batch_of(ended: list[tuple]) -> pa.RecordBatch:
            arrays = [pa.array(c, field.type) for c, field in zip(zip(*ended), arrow)]
            return pa.RecordBatch.from_arrays(arrays, schema=arrow)

        for batch in batches:
            ended = []
            for conv, position, role, text, plan in zip(*(c.to_pylist() for c in batch.columns)):
                if position == 0:
                    if head is not None:
                        ended.append((*head, hashed.hexdigest()))
                    head, hashed = (conv, plan), hashlib.sha256()
                else:
                    hashed.update(f"{chr(10) if position > 1 else ''}{role}:{text}".encode())
            if ended:
                yield batch_of(ended)
        if head is not None:
            yield batch_of([(*head, hashed.hexdigest())])

    told = repaired.select("conv", "position", "role", "text", "plan")
    return told.mapInArrow(run, schema)
