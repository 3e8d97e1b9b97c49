"""N-gram Jaccard join by filters of several global token orders.

Two sets of Jaccard similarity t or more share a token among the first
|s| - ceil(t |s|) + 1 of each, whatever order all tokens are put in. Rare tokens come first
here: a sketch of fixed size counts every token of the corpus, and orders differ in how
they deal out tokens of like counts. Buckets of the first order propose pairs; a pair
lives on only if the prefixes of the other orders meet as well and the counts of tokens
by hash class leave room for enough common ones. What is left is verified exactly.

Equal sets are one entity from the start. Components, not all links, are asked for, so
large buckets first propose neighbours in a few seeded orders, and then only pairs that are
still between components.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.llm import bloom
from trailmark.llm.common import stored, text_of
from trailmark.llm.components import components
from trailmark.llm.shingles import mix, set_key, shingle_set

KEY = "key binary, n int, other binary, other_n int"
PAIR = ("key", "n", "other", "other_n")


@dataclass(frozen=True)
class Settings:
    """Links are pairs with ``percent`` / 100 of their union in common. The sketch has
    2^``sketch_bits`` counters whatever the input's size; a bucket above ``small`` members
    proposes neighbours before pairs."""

    percent: int = 90
    width: int = 3
    orders: int = 3
    sketch_bits: int = 24
    small: int = 24
    classes: int = 256
    seeds: int = 3


def prefix_length(n: int, percent: int) -> int:
    """Tokens of a set of ``n`` of which a similar set must share one."""
    return n - -(-percent * n // 100) + 1


def enough(common, n, m, percent: int):
    """Whether ``common`` tokens of sets of n and m make a link."""
    return 100 * common >= percent * (n + m - common)


# --- the corpus-wide token counts ---------------------------------------------------------

_PART = 12  # the sketch is dealt out in parts of 2^12 counters


def _planes(numbers: np.ndarray, kind: str) -> bytes:
    """Numbers as their lowest bytes, then their next ones: those that are 0 pack to nothing."""
    return numbers.astype(kind).view(np.uint8).reshape(len(numbers), -1).T.tobytes()


def packed_part(at: np.ndarray, counts: np.ndarray) -> bytes:
    """Counters of a part that are not 0, by ascending place: gaps between places, counts."""
    return zlib.compress(_planes(np.diff(at, prepend=0), "<u2") + _planes(counts, "<u4"), 1)


def part_of(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places and counts of a packed part."""
    raw = np.frombuffer(zlib.decompress(blob), np.uint8)
    n = len(raw) // 6
    gaps, counts = raw[: 2 * n].reshape(2, n), raw[2 * n :].reshape(4, n)
    at = np.cumsum(np.ascontiguousarray(gaps.T).view("<u2").ravel(), dtype=np.int64)
    return at, np.ascontiguousarray(counts.T).view("<u4").ravel()


def _index(docs: DataFrame, settings: Settings) -> DataFrame:
    """Rows of two kinds: documents with their sets' names, and parts of each task's sketch."""
    kind = docs.schema["id"].dataType.simpleString()
    names = ["id", "content", "n", "key", "part", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = np.uint64((1 << settings.sketch_bits) - 1)
        id_type = None
        tokens: list[np.ndarray] = []
        waiting = 0

        def sketch() -> pa.RecordBatch:
            found, counts = np.unique(np.concatenate(tokens) & mask, return_counts=True)
            cuts = np.searchsorted(found >> np.uint64(_PART), np.arange((1 << (settings.sketch_bits - _PART)) + 1))
            rows = []
            for part in np.flatnonzero(np.diff(cuts)):
                run = slice(cuts[part], cuts[part + 1])
                low = (found[run] & np.uint64((1 << _PART) - 1)).astype(np.int64)
                rows.append((int(part), packed_part(low, counts[run])))
            part, blobs = zip(*rows)
            n = len(rows)
            arrays = [
                pa.nulls(n, id_type), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()),
                pa.nulls(n, pa.binary()), pa.array(part, pa.int32()), pa.array(blobs, pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            id_type = batch.column("id").type
            sizes, keys = [], []
            for text in batch.column("text"):
                made = shingle_set(text.as_py(), settings.width)
                sizes.append(len(made))
                keys.append(set_key(made))
                tokens.append(made)
                waiting += len(made)
            n = len(sizes)
            arrays = [
                batch.column("id"), batch.column("content"), pa.array(sizes, pa.int32()),
                pa.array(keys, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names)
            if waiting > 2_000_000:
                yield sketch()
                tokens, waiting = [], 0
        if waiting:
            yield sketch()

    schema = f"id {kind}, content bigint, n int, key binary, part int, counts binary"
    return stored(docs.mapInArrow(run, schema), "jaccard-index")


def _levels(index: DataFrame, settings: Settings) -> np.ndarray:
    """A byte for each counter that grows with its count: 0 for none, 1 for a single token.

    16 MB with the default size, for any corpus. The parts of the tasks' sketches are added up
    as they stream by in order: a task holds one sum at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << _PART, np.int64)
        now = None

        def made() -> pa.RecordBatch:
            level = np.zeros(len(total), np.uint8)
            at = np.flatnonzero(total)
            level[at] = np.minimum(255, 1 + np.round(8 * np.log2(total[at])))
            blob = zlib.compress(level.tobytes(), 1)
            return pa.RecordBatch.from_arrays(
                [pa.array([now], pa.int32()), pa.array([blob], pa.binary())], ["part", "levels"]
            )

        for batch in batches:
            for part, blob in zip(batch.column("part").to_pylist(), batch.column("counts")):
                if part != now:
                    if now is not None:
                        yield made()
                    now = part
                    total[:] = 0
                at, counts = part_of(blob.as_py())
                total[at] += counts
        if now is not None:
            yield made()

    parts = index.where("part is not null").select("part", "counts")
    dealt = parts.repartition("part").sortWithinPartitions("part")
    summed = stored(dealt.mapInArrow(run, "part int, levels binary"), "jaccard-levels")
    levels = np.zeros(1 << settings.sketch_bits, np.uint8)
    for row in summed.toLocalIterator():
        low = row.part << _PART
        levels[low : low + (1 << _PART)] = np.frombuffer(zlib.decompress(row.levels), np.uint8)
    return levels


def _prefix(tokens: np.ndarray, levels: np.ndarray, order: int, settings: Settings) -> np.ndarray:
    """The first tokens of a set in one of the orders: by count first, roughly after the
    first order, then by that order's own permutation."""
    size = prefix_length(len(tokens), settings.percent)
    level = levels[tokens & np.uint64(len(levels) - 1)].astype(np.uint64)
    if order:
        level >>= np.uint64(4)
    rank = level << np.uint64(56) | mix(tokens, order + 1) >> np.uint64(8)
    return tokens[np.argpartition(rank, size - 1)[:size]] if size < len(tokens) else tokens


# --- candidates ---------------------------------------------------------------------------


def _buckets(docs: DataFrame, sent, settings: Settings) -> DataFrame:
    """(token, key, n): each entity's prefix in the first order. A task sends an entity
    once, however many copies it has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = sent.value
        seen: set[bytes] = set()
        for batch in batches:
            tokens, keys, sizes, repeats = [], [], [], []
            for text in batch.column("text"):
                made = shingle_set(text.as_py(), settings.width)
                key = set_key(made)
                if not len(made) or key in seen:
                    continue
                seen.add(key)
                first = _prefix(made, levels, 0, settings)
                tokens.append(first)
                keys.append(key)
                sizes.append(len(made))
                repeats.append(len(first))
            if tokens:
                flat = np.concatenate(tokens).view(np.int64)
                which = np.repeat(np.arange(len(keys)), repeats)
                arrays = [
                    pa.array(flat), pa.array(keys, pa.binary()).take(pa.array(which)),
                    pa.array(np.array(sizes, np.int32)[which]),
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["token", "key", "n"])

    return docs.select("text").mapInArrow(run, "token bigint, key binary, n int")


def _close(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Sizes that allow a link."""
    return 100 * np.minimum(n, m) >= percent * np.maximum(n, m)


def _bucket_pairs(keys, sizes, groups, large: bool, settings: Settings):
    """Index pairs that one bucket proposes: neighbours if it is ``large``, else all that
    are in different groups (groups None: no two share one)."""
    order = np.argsort(sizes, kind="stable")
    m = len(order)
    if large:
        hashed = np.frombuffer(b"".join(key[:8] for key in keys), "<u8")
        rings = [np.lexsort((hashed, sizes))]
        rings += [np.argsort(mix(hashed, seed)) for seed in range(1, settings.seeds)]
        left = np.concatenate([ring[:-1] for ring in rings])
        right = np.concatenate([ring[1:] for ring in rings])
        yield left, right
        return
    sorted_sizes = sizes[order]
    stops = np.searchsorted(100 * sorted_sizes, 10_000 * sorted_sizes // settings.percent, side="right")
    for i in range(m - 1):
        right = order[i + 1 : stops[i]]
        left = np.full(len(right), order[i])
        if groups is not None:
            apart = groups[left] != groups[right]
            left, right = left[apart], right[apart]
        if len(right):
            yield left, right


def _by_class(tokens: np.ndarray, settings: Settings) -> bytes:
    """A set's token counts by hash class, a byte each. A full class counts as 255 in both
    sets, which only leaves room for more pairs."""
    classes = (tokens >> np.uint64(40)).astype(np.int64) % settings.classes
    counts = np.bincount(classes, minlength=settings.classes)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def packed_counts(tokens: np.ndarray, settings: Settings) -> bytes:
    """What an entity sends to each of its large buckets: most counts are small."""
    return zlib.compress(_by_class(tokens, settings), 1)


def room_of(marks: list[bytes]) -> np.ndarray:
    """The counts by hash class of each mark."""
    return np.stack([np.frombuffer(zlib.decompress(mark), np.uint8) for mark in marks])


def _pairs(buckets: DataFrame, settings: Settings, grouped: bool) -> DataFrame:
    """Pairs (key, n, other, other_n) that buckets propose, key < other, with repeats.

    Large buckets first propose neighbours, and their members come out as well (token,
    key, n). With ``grouped`` (such members with a ``component`` and their ``data`` for the
    filters) they propose the pairs between components that the count filter leaves. A
    bucket streams through one task, never through a group.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[tuple[bytes, bytes]] = set()
        rest = None

        def one(table: pa.Table) -> Iterator[pa.RecordBatch]:
            token = table["token"].to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(token[1:] != token[:-1]) + 1, [len(token)]])
            keys, sizes = table["key"].to_pylist(), table["n"].to_numpy()
            names = table["component"].to_pylist() if grouped else keys
            marks = table["data"].to_pylist() if grouped else None
            made: list[tuple] = []
            for low, high in zip(cuts[:-1], cuts[1:]):
                if high - low < 2:
                    continue
                own = {keys[i]: i for i in range(low, high)}
                large = len(own) > settings.small
                if len(own) < 2:
                    continue
                at = np.array(list(own.values()))
                bucket = list(own)
                if large and not grouped:
                    yield _rows([(k, sizes[i], None, None, token[low]) for k, i in own.items()])
                groups = None
                if grouped:
                    numbers: dict = {}
                    groups = np.array([numbers.setdefault(names[i], len(numbers)) for i in at])
                    if len(numbers) < 2:
                        continue
                    room = room_of([marks[i] for i in at])
                for left, right in _bucket_pairs(bucket, sizes[at], groups, large and not grouped, settings):
                    near = _close(sizes[at[left]], sizes[at[right]], settings.percent)
                    if grouped and near.any():
                        left, right = left[near], right[near]
                        both = np.minimum(room[left[0]], room[right])
                        common = both.sum(1, dtype=np.int64)
                        near = enough(common, sizes[at[left]], sizes[at[right]], settings.percent)
                        near |= (both == 255).any(1)  # a full class says nothing
                    for a, b in zip(left[near].tolist(), right[near].tolist()):
                        x, y = bucket[a], bucket[b]
                        n, m = sizes[at[a]], sizes[at[b]]
                        if x > y:
                            x, y, n, m = y, x, m, n
                        if (x, y) not in sent:
                            if len(sent) < 100_000:  # repeats beyond it go in the distinct
                                sent.add((x, y))
                            made.append((x, n, y, m, None))
                if len(made) > 20_000:
                    yield _rows(made)
                    made = []
            if made:
                yield _rows(made)

        for batch in batches:
            table = pa.Table.from_batches([batch])
            if rest is not None:
                table = pa.concat_tables([rest, table])
            token = table["token"].to_numpy()
            last = int(np.searchsorted(token, token[-1])) if len(token) else 0
            rest = table.slice(last)  # the last bucket may go on in the next batch
            if last:
                yield from one(table.slice(0, last))
        if rest is not None and rest.num_rows:
            yield from one(rest)

    ordered = buckets.repartition("token").sortWithinPartitions("token")
    return ordered.mapInArrow(run, KEY + ", token bigint")


def _rows(made: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.binary(), pa.int32(), pa.binary(), pa.int32(), pa.int64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(zip(*made), kinds)], [*PAIR, "token"]
    )


# --- filters and verification -------------------------------------------------------------


def _entities(
    docs: DataFrame, index: DataFrame, pairs: DataFrame, make, name: str, settings: Settings
) -> DataFrame:
    """(key, data) of the entities in ``pairs``, one row each; ``data`` is make(set).

    One text stands for an entity. A Bloom filter of the wanted texts goes out with the
    tasks, so that others are neither read into sets nor moved; it has 16 bits for each
    wanted text, 64 MB at most, and an exact join follows.
    """
    keys = pairs.select("key").union(pairs.select(F.col("other").alias("key"))).distinct()
    wanted = stored(
        index.where("key is not null").groupBy("key").agg(F.min("content").alias("content")).join(keys, "key"),
        f"jaccard-{name}-wanted",
    )
    sent, bits = bloom.broadcast_field(wanted, "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = sent.value
        seen: set[int] = set()
        for batch in batches:
            content = batch.column("content").to_numpy()
            keys, data, kept = [], [], []
            for i in np.flatnonzero(bloom.holds(field, content, bits)).tolist():
                if content[i] in seen:
                    continue
                seen.add(content[i])
                tokens = shingle_set(batch.column("text")[i].as_py(), settings.width)
                keys.append(set_key(tokens))
                data.append(make(tokens))
                kept.append(content[i])
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kept, pa.int64()), pa.array(keys, pa.binary()), pa.array(data, pa.binary())],
                    ["content", "key", "data"],
                )

    found = docs.select("content", "text").mapInArrow(run, "content bigint, key binary, data binary")
    # Joined by key alone, so that they lie as the step to one row of each key needs them.
    told = wanted.select("key", F.col("content").alias("wanted"))
    chosen = found.join(told, "key").where("content = wanted")
    return stored(chosen.dropDuplicates(["key"]).select("key", "data"), f"jaccard-{name}")


def _meet(pairs: DataFrame, entities: DataFrame, agree) -> DataFrame:
    """The pairs for whose data ``agree`` holds. Both joins have the same plan of ``entities``,
    which therefore move once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [batch.column(name).to_pylist() for name in ("n", "other_n")]
            data = zip(batch.column("left"), batch.column("right"))
            keep = [agree(a.as_buffer(), b.as_buffer(), n, m) for (a, b), n, m in zip(data, *sizes)]
            yield batch.select(list(PAIR)).filter(pa.array(keep, pa.bool_()))

    joined = pairs.alias("pair").join(entities.alias("one"), F.expr("pair.key = one.key"))
    joined = joined.join(entities.alias("two"), F.expr("pair.other = two.key"))
    both = joined.select(
        *(f"pair.{name}" for name in PAIR), F.col("one.data").alias("left"), F.col("two.data").alias("right")
    )
    return both.mapInArrow(run, KEY)


def _filters(sent, settings: Settings):
    """What stands for a set in the filters: prefixes of the other orders in 32 bits a
    token, then its token counts by hash class."""

    def make(tokens: np.ndarray) -> bytes:
        parts = []
        for order in range(1, settings.orders):
            prefix = _prefix(tokens, sent.value, order, settings).astype("<u4")
            parts.append(np.uint32(len(prefix)).tobytes() + np.sort(prefix).tobytes())
        parts.append(_by_class(tokens, settings))
        return b"".join(parts)

    def agree(left: bytes, right: bytes, n: int, m: int) -> bool:
        at = [0, 0]
        for _ in range(1, settings.orders):
            prefixes = []
            for side, data in enumerate((left, right)):
                size = int(np.frombuffer(data, "<u4", 1, at[side])[0])
                prefixes.append(np.frombuffer(data, "<u4", size, at[side] + 4))
                at[side] += 4 + 4 * size
            if not _common(*prefixes):
                return False
        a = np.frombuffer(left, np.uint8, settings.classes, at[0]).astype(int)
        b = np.frombuffer(right, np.uint8, settings.classes, at[1]).astype(int)
        room = np.minimum(a, b)
        if (room == 255).any():
            return True
        return bool(enough(int(room.sum()), n, m, settings.percent))

    return make, agree


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Common numbers of two sorted arrays, repeats counted once each."""
    both = np.concatenate([a, b])
    both.sort()
    return int((both[1:] == both[:-1]).sum())


def _verified(pairs: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """The pairs that are links, by their whole sets."""

    def agree(left: bytes, right: bytes, n: int, m: int) -> bool:
        common = _common(np.frombuffer(left, "<u8"), np.frombuffer(right, "<u8"))
        return bool(enough(common, n, m, settings.percent))

    return _meet(pairs, sets, agree)


def _joined(docs: DataFrame, settings: Settings, id_col: str, text_col: str):
    """The rows (id, content, n, key), and the components (node, component) of linked keys."""
    spark = docs.sparkSession
    texts = docs.select(
        docs[id_col].alias("id"),
        text_of(text_col).alias("text"),
        F.xxhash64(text_of(text_col)).alias("content"),
    )
    index = _index(texts, settings)
    sent = spark.sparkContext.broadcast(_levels(index, settings))
    proposed = stored(_pairs(_buckets(texts, sent, settings), settings, grouped=False), "jaccard-pairs")
    pairs = proposed.where("token is null").select(*PAIR).dropDuplicates(["key", "other"])
    pairs = stored(pairs, "jaccard-pairs-once")
    make, agree = _filters(sent, settings)
    whole = lambda tokens: tokens.astype("<u8").tobytes()

    def filtered(pairs: DataFrame, name: str) -> DataFrame:
        marks = _entities(texts, index, pairs, make, f"{name}-marks", settings)
        return stored(_meet(pairs, marks, agree), f"jaccard-{name}")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        sets = _entities(texts, index, pairs, whole, f"{name}-sets", settings)
        return stored(_verified(pairs, sets, settings), f"jaccard-{name}-links")

    near = filtered(pairs, "near")
    links = verified(near, "near")
    groups = _groups(links)
    large = proposed.where("token is not null").select("token", "key", "n")
    if not large.isEmpty():
        members = large.select("key", F.col("key").alias("other"))
        # Of the filter data the counts by hash class alone go to each bucket of an entity.
        counts = lambda tokens: packed_counts(tokens, settings)
        marks = _entities(texts, index, members, counts, "large-marks", settings)
        named = large.join(groups.withColumnRenamed("node", "key"), "key", "left").join(marks, "key")
        named = named.select(
            "token", "key", "n", F.coalesce("component", "key").alias("component"), "data"
        )
        rest = _pairs(named, settings, grouped=True).select(*PAIR).dropDuplicates(["key", "other"])
        rest = stored(rest.join(pairs, ["key", "other"], "left_anti"), "jaccard-rest")
        if not rest.isEmpty():
            groups = _groups(links.union(verified(filtered(rest, "far"), "far")))
    return index.where("key is not null").select("id", "content", "n", "key"), groups


def _groups(links: DataFrame) -> DataFrame:
    return components(links.select(F.col("key").alias("x"), F.col("other").alias("y")))


def similar_groups(
    docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_shingles, component_id): the smallest id that links reach from each row.

    Null and empty texts, and texts without words, have an empty set and are linked with
    nothing: their component is their own id. Equal sets are linked. Rows without an id
    take part, and a component in which no row has one has none.
    """
    rows, groups = _joined(docs, settings, id_col, text_col)
    first = _grouped(rows, groups, F.min("id").alias("first"))
    least = first.groupBy("component").agg(F.min("first").alias("least"))
    named = first.join(least, "component").select("key", "least")
    return rows.join(named, "key").select(
        F.col("id").alias(id_col),
        F.col("n").cast("bigint").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("id")).alias("component_id"),
    )


def one_of_each(
    docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, rows without an id
    last, then of the smallest hash of its text. Texts without words stay; rows that repeat
    an id and a text count once."""
    rows, groups = _joined(docs, settings, id_col, text_col)
    order = F.struct(F.col("id").isNull().alias("none"), "id", "content").alias("first")
    first = _grouped(rows.where("n > 0"), groups, F.min(order).alias("first"))
    chosen = first.groupBy("component").agg(F.min("first").alias("first"))
    kept = chosen.select("first.id", "first.content").union(
        rows.where("n = 0").select("id", "content")
    )
    kept = kept.select(F.struct("id", "content").alias("row_key")).distinct()
    named = docs.select(
        F.struct(*(docs[name] for name in docs.columns)).alias("row"),
        F.struct(docs[id_col].alias("id"), F.xxhash64(text_of(text_col)).alias("content")).alias(
            "row_key"
        ),
    )
    return named.join(kept, "row_key", "left_semi").dropDuplicates(["row_key"]).select("row.*")


def _grouped(rows: DataFrame, groups: DataFrame, first) -> DataFrame:
    """(key, first, component) of every set."""
    keys = rows.groupBy("key").agg(first)
    return keys.join(groups.withColumnRenamed("node", "key"), "key", "left").select(
        "key", "first", F.coalesce("component", "key").alias("component")
    )
