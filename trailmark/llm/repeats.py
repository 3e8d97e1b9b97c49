"""Removal of repeated byte strings by blockwise suffix sorting with a difference cover.

Suffixes count up to ``length`` bytes. Cover samples are the positions whose offset modulo
v is in a difference cover D: for any two positions i, j some k < v makes both i + k and
j + k samples. Two suffixes that agree on ``length`` bytes therefore have a pair of
samples that agree on length - v + 1 bytes, whatever their offsets. So samples are ranked
first, bucket by bucket; a suffix none of whose samples shares its rank cannot have a long
tie and is sorted no further. The rest is dealt out to suffix buckets by name, and one
bucket at a time is sorted, which bounds the memory of a task.

Substrings are compared by names: a name of 2n bytes is a hash of the names of its halves,
as in prefix doubling, and a length that is no power of two is named by two halves that
overlap. The bucket of a substring comes from a second hash, so two different strings are
taken for equal only if 64 bits and the bucket's number agree.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.llm import bloom
from trailmark.llm.common import drop_held, give_back, stored, text_of

# A fixed value: a perfect difference set modulo 91; its differences are all of 1..90 once.
COVER = (0, 1, 3, 9, 27, 49, 56, 61, 77, 81)
PERIOD = 91

_A, _B, _C = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))
_BLOCK = 1 << 16


@dataclass(frozen=True)
class Settings:
    """``length``: bytes of a repeat, at least the period + 64. A pack of texts has about
    ``pack_bytes``; there is a bucket for each ``bucket_bytes`` of all texts."""

    length: int = 200
    pack_bytes: int = 4 << 20
    bucket_bytes: int = 16 << 20

    @property
    def sample_length(self) -> int:
        return self.length - PERIOD + 1


# --- names --------------------------------------------------------------------------------


def _join(a: np.ndarray, b: np.ndarray, seed: int = 0) -> np.ndarray:
    made = a * _A
    made += b
    made ^= np.uint64((seed * 0xA24BAED4963EE407) % 2**64)
    made ^= made >> np.uint64(32)
    made *= _C
    made ^= made >> np.uint64(29)
    made *= _B
    made ^= made >> np.uint64(32)
    return made


def _halves(data: np.ndarray, length: int) -> tuple[np.ndarray, int]:
    """Names of the 2^p bytes from each position, 2^p <= length < 2^(p+1), and 2^p."""
    n = len(data) - 7
    names = np.lib.stride_tricks.as_strided(data, (n, 8), (1, 1)).copy().view("<u8").ravel()
    size = 8
    while 2 * size <= length:
        names = _join(names[:-size], names[size:])
        size *= 2
    return names, size


def named(data: np.ndarray, places: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(name, bucket hash) of the ``length`` bytes from each of the ascending ``places``."""
    names = np.empty(len(places), np.uint64)
    second = np.empty(len(places), np.uint64)
    for low in range(0, len(data), _BLOCK):
        first, last = np.searchsorted(places, (low, low + _BLOCK))
        if first == last:
            continue
        halves, size = _halves(data[low : low + _BLOCK + length], length)
        at = places[first:last] - low
        a, b = halves[at], halves[at + (length - size)]
        names[first:last] = _join(a, b, 1)
        second[first:last] = _join(b, a, 2)
    return names, second


# --- packs --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Pack:
    """Texts one after another; text i is data[starts[i]:starts[i + 1]]."""

    data: np.ndarray
    starts: np.ndarray

    def samples(self, length: int) -> np.ndarray:
        """Cover samples with ``length`` bytes of their text from them on."""
        sizes = np.diff(self.starts)
        longest = int(sizes.max(initial=0))
        cover = np.zeros(PERIOD, bool)
        cover[list(COVER)] = True
        offsets = np.flatnonzero(np.resize(cover, longest))
        counts = np.searchsorted(offsets, np.maximum(sizes - length + 1, 0))
        return np.concatenate([offsets[:n] + low for n, low in zip(counts, self.starts)] or [offsets])

    def suffixes(self, samples: np.ndarray, length: int) -> np.ndarray:
        """Positions with one of ``samples`` less than a period on, and ``length`` bytes."""
        near = np.zeros(len(self.data) + 1, np.int32)
        low = np.maximum(samples - (PERIOD - 1), 0)
        np.add.at(near, low, 1)
        np.add.at(near, samples + 1, -1)
        open_ = np.cumsum(near[:-1]) > 0
        for start, stop in zip(self.starts[:-1], self.starts[1:]):
            open_[max(start, stop - length + 1) : stop] = False
        return np.flatnonzero(open_)

    def covered(self, suffixes: np.ndarray, length: int) -> np.ndarray:
        marks = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(marks, suffixes, 1)
        np.add.at(marks, suffixes + length, -1)
        return np.cumsum(marks[:-1]) > 0


def _pack_batches(settings: Settings, content_field=None, bits: int = 0):
    """A task that packs texts. With a filter of contents, texts it may hold come out as
    rows of their own, once per task and content, to be told apart first."""
    names = ["pack", "ids", "data", "content", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_held()
        squeeze = zstandard.ZstdCompressor(level=1)
        seen: set[str] = set()
        held: list[pa.RecordBatch] = []
        size = 0
        kinds = [pa.string(), pa.binary(), pa.binary(), pa.string(), pa.binary()]

        def made() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            texts = table["text"].to_pylist()
            sink = pa.BufferOutputStream()
            rows = table.select(["id", "whole"]).append_column("n", pa.array([len(t) for t in texts], pa.int64()))
            with pa.ipc.new_stream(sink, rows.schema) as writer:
                writer.write_table(rows)
            row = [table["name"][0].as_py(), sink.getvalue().to_pybytes(), squeeze.compress(b"".join(texts)), None, None]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

        for batch in batches:
            if content_field is not None:
                maybe = bloom.holds(content_field.value, batch.column("hash").to_numpy(), bits)
                apart = []
                for i in np.flatnonzero(maybe).tolist():
                    content = batch.column("content")[i].as_py()
                    if content not in seen:
                        seen.add(content)
                        apart.append(i)
                if apart:
                    rows = batch.take(pa.array(apart))
                    n = len(apart)
                    arrays = [pa.nulls(n, k) for k in kinds[:3]] + [rows.column("content"), rows.column("text")]
                    yield pa.RecordBatch.from_arrays(arrays, names)
                batch = batch.filter(pa.array(~maybe))
            low = 0
            for i, n in enumerate(pa.compute.binary_length(batch.column("text")).to_pylist()):
                size += n
                if size >= settings.pack_bytes:
                    held.append(batch.slice(low, i + 1 - low))
                    yield made()
                    held, size, low = [], 0, i + 1
            if low < batch.num_rows:
                held.append(batch.slice(low))
        if held:
            yield made()

    return run


_PACKS = "pack string, ids binary, data binary, content string, text binary"


def _unpacked(data: bytes, ids: bytes) -> tuple[Pack, pa.Table]:
    rows = pa.ipc.open_stream(ids).read_all()
    starts = np.zeros(rows.num_rows + 1, np.int64)
    np.cumsum(rows["n"].to_numpy(), out=starts[1:])
    raw = zstandard.ZstdDecompressor().decompressobj().decompress(data)
    return Pack(np.frombuffer(raw, np.uint8), starts), rows


# --- exchanges: names out to buckets, marks back to packs ---------------------------------


def _dealt(data: np.ndarray, places: np.ndarray, length: int, buckets: int):
    """The distinct names at ``places`` by bucket: (bucket numbers in name order, cuts of
    each bucket, names, whether met twice here, which distinct name each place has)."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    names, second = named(padded, places, length)
    distinct, first, which, counts = np.unique(
        names, return_index=True, return_inverse=True, return_counts=True
    )
    bucket = (second[first] % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    return distinct, counts > 1, which, order, cuts


def _sent(pack: str, dealt) -> pd.DataFrame:
    distinct, twice, _, order, cuts = dealt
    rows = []
    for bucket in np.flatnonzero(np.diff(cuts)):
        run = order[cuts[bucket] : cuts[bucket + 1]]
        rows.append((int(bucket), pack, distinct[run].tobytes(), np.packbits(twice[run]).tobytes()))
    return pd.DataFrame(rows, columns=["bucket", "pack", "names", "twice"])


def _sorted_bucket(rows: pd.DataFrame) -> pd.DataFrame:
    """Marks the names of one bucket that occur again: in another pack or twice in one."""
    parts = [np.frombuffer(blob, "<u8") for blob in rows["names"]]
    names = np.concatenate(parts)
    order = np.argsort(names, kind="stable")
    same = names[order][1:] == names[order][:-1]
    again = np.zeros(len(names), bool)
    again[order[1:]] |= same
    again[order[:-1]] |= same
    made, at = [], 0
    for part, twice in zip(parts, rows["twice"]):
        own = np.unpackbits(np.frombuffer(twice, np.uint8), count=len(part)).astype(bool)
        made.append(np.packbits(again[at : at + len(part)] | own).tobytes())
        at += len(part)
    return pd.DataFrame({"bucket": rows["bucket"], "pack": rows["pack"], "marks": made})


def _marked(dealt, marks: pd.DataFrame) -> np.ndarray:
    """Which places of ``dealt`` have names that occur again."""
    distinct, _, which, order, cuts = dealt
    again = np.zeros(len(distinct), bool)
    for bucket, blob in zip(marks["bucket"], marks["marks"]):
        run = order[cuts[bucket] : cuts[bucket + 1]]
        again[run] = np.unpackbits(np.frombuffer(blob, np.uint8), count=len(run))
    return again[which]


_SENT = "bucket long, pack string, names binary, twice binary"
_MARKS = "bucket long, pack string, marks binary"


def _repeated(packs: DataFrame, settings: Settings, buckets: int, decoded: bool) -> DataFrame:
    """Packs grouped with the marks of their suffixes, and the function that cuts them."""
    last = "text" if decoded else "kept"
    length, sample_length = settings.length, settings.sample_length

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack, ids, data in zip(*(batch.column(c).to_pylist() for c in ("pack", "ids", "data"))):
                one, _ = _unpacked(data, ids)
                rows = _sent(pack, _dealt(one.data, one.samples(sample_length), sample_length, buckets))
                yield pa.RecordBatch.from_pandas(rows, schema=pa.schema(
                    [("bucket", pa.int64()), ("pack", pa.string()), ("names", pa.binary()), ("twice", pa.binary())]
                ), preserve_index=False)

    def opened(data: bytes, ids: bytes, ranks: pd.DataFrame):
        one, rows = _unpacked(data, ids)
        samples = one.samples(sample_length)
        tied = samples[_marked(_dealt(one.data, samples, sample_length, buckets), ranks)]
        suffixes = one.suffixes(tied, length)
        return one, rows, suffixes, _dealt(one.data, suffixes, length, buckets)

    def dealt(left: pd.DataFrame, ranks: pd.DataFrame) -> pd.DataFrame:
        made = [
            _sent(pack, opened(data, ids, ranks)[3])
            for pack, ids, data in zip(left["pack"], left["ids"], left["data"])
        ]
        return pd.concat(made) if made else _sent("", _dealt(np.zeros(0, np.uint8), np.zeros(0, int), length, buckets))

    ranks = packs.select("pack", "ids", "data").mapInArrow(ranked, _SENT)
    ranks = stored(ranks.groupBy("bucket").applyInPandas(_sorted_bucket, _MARKS), "repeat-ranks")
    by_pack = packs.groupBy("pack")
    names = by_pack.cogroup(ranks.groupBy("pack")).applyInPandas(dealt, _SENT)
    marks = stored(names.groupBy("bucket").applyInPandas(_sorted_bucket, _MARKS), "repeat-marks")
    both = ranks.withColumn("step", F.lit(0)).union(marks.withColumn("step", F.lit(1)))

    def cut(left: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        made = []
        for ids, data in zip(left["ids"], left["data"]):
            first = replies[replies["step"] == 0]
            one, rows, suffixes, dealt_ = opened(data, ids, first)
            again = suffixes[_marked(dealt_, replies[replies["step"] == 1])]
            gone = one.covered(again, length)
            for i, (id_, whole) in enumerate(zip(rows["id"].to_pylist(), rows["whole"].to_pylist())):
                if whole:
                    continue
                run = slice(one.starts[i], one.starts[i + 1])
                out, text = gone[run], one.data[run]
                edges = np.flatnonzero(np.diff(np.concatenate([[0], out.view(np.int8), [0]])))
                spans = [{"start": int(a), "stop": int(b)} for a, b in zip(edges[::2], edges[1::2])]
                kept = text[~out].tobytes()
                made.append((id_, len(text), spans, _text(kept) if decoded else kept))
        return pd.DataFrame(made, columns=["id", "n_bytes", "spans", last])

    def cut_alone(left: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        made = cut(left, replies)
        give_back()
        return made

    return by_pack.cogroup(both.groupBy("pack")), cut_alone


SPANS = "array<struct<start:bigint,stop:bigint>>"


def remove_repeats(
    docs: DataFrame,
    settings: Settings = Settings(),
    id_col: str = "doc_id",
    text_col: str = "text",
    decoded: bool = False,
) -> DataFrame:
    """(id, n_bytes, spans, kept): the bytes of each text that are in no repeated string.

    A byte goes if a string of ``settings.length`` bytes covers it that also starts
    anywhere else, in the same text or another; strings are judged on the input. ``spans``
    are the removed runs, ``kept`` the other bytes joined (binary, as a cut may fall inside
    a character). Null texts count as empty; shorter texts than ``length`` stay as they
    are; null ids and repeated rows stay rows of their own, and equal rows of that length
    remove each other whole. With ``decoded`` there is ``text`` in place of ``kept``, as
    ``with_text`` makes it, but by the worker that cut it: a second one in the same task
    would double the workers that an executor has to hold.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(docs[id_col].alias("id"), text_of(text_col).cast("binary").alias("text"))
    texts = texts.withColumn("n_bytes", F.octet_length("text").cast("bigint"))
    long = texts.where(F.col("n_bytes") >= settings.length)
    long = long.withColumn("content", F.sha2("text", 256)).withColumn("hash", F.xxhash64("content"))
    rows = stored(long.select("id", "n_bytes", "content", "hash"), "repeat-rows")
    copied = stored(
        rows.groupBy("content", "hash").count().where("count > 1").select("content", "hash"), "repeat-copied"
    )
    # Copies of a whole text go whole; one of them stays behind to meet other texts.
    field, bits = bloom.broadcast_field(copied, "hash")
    named_ = long.select(
        F.expr("uuid()").alias("name"), "id", F.lit(False).alias("whole"), "content", "hash", "text"
    )
    packed = stored(named_.mapInArrow(_pack_batches(settings, field, bits), _PACKS), "repeat-packs")
    apart = packed.where("pack is null").select("content", "text").dropDuplicates(["content"])
    apart = apart.join(copied.select("content", F.lit(True).alias("copied")), "content", "left").join(
        rows.groupBy("content").agg(F.min("id").alias("id")), "content"
    )
    apart = apart.select(
        F.expr("uuid()").alias("name"), "id", F.coalesce("copied", F.lit(False)).alias("whole"), "text"
    )
    more = stored(apart.mapInArrow(_pack_batches(settings), _PACKS), "repeat-packs-more")
    packs = packed.where("pack is not null").union(more).select("pack", "ids", "data")
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = int(max(1, -(-total // settings.bucket_bytes)))
    kept = "text string" if decoded else "kept binary"
    schema = f"id {kind}, n_bytes bigint, spans {SPANS}, {kept}"
    grouped, cut = _repeated(packs, settings, buckets, decoded)
    found = grouped.applyInPandas(cut, schema)
    none = F.array().cast(SPANS)
    short = texts.where(F.col("n_bytes") < settings.length).select("id", "n_bytes", none.alias("spans"), F.col("text").alias("kept"))
    all_ = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n_bytes").alias("stop")))
    gone = rows.join(copied.select("content"), "content", "left_semi").select(
        "id", "n_bytes", all_.alias("spans"), (F.lit("") if decoded else F.lit(b"")).alias(kept.split()[0])
    )
    short = with_text(short) if decoded else short
    return found.union(short).union(gone).withColumnRenamed("id", id_col)


def _text(kept: bytes) -> str:
    return kept.decode("utf-8", "ignore")


def with_text(cut: DataFrame) -> DataFrame:
    """``cut`` with ``text`` in place of ``kept``: its bytes as text, without what is left
    of a character that a cut went through."""
    rest = [name for name in cut.columns if name != "kept"]
    schema = cut.select(*rest).schema.add("text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_text(kept.as_py()) for kept in batch.column(len(rest))]
            columns = [*batch.columns[:-1], pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return cut.select(*rest, "kept").mapInArrow(run, schema)
