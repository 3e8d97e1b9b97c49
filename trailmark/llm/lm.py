"""Language-model scores of whole documents, with counts of the whole corpus.

Texts are stored once as packs of a bounded size. A pack's distinct words are dealt over
buckets by hash, many words in a row, each with its place in the pack; a bucket counts its
words and answers by place. A pack is scored where the answers meet it, so neither the
vocabulary nor its counts are ever whole in one place. The most frequent words are the recurrent
model's own; any other word is its ``unknown`` word, drawn by corpus counts:
    P(w | unknown) = (c + 1) / (N' + V' + 1)
with N' and V' the counts and number of words outside the model's vocabulary.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.llm import gru
from trailmark.llm.common import crc_of, stored, text_of
from trailmark.llm.shingles import mix

# A token that no word can be, as words hold no white space.
END = b"\n"

# Weights that move as one row. Averages of many tasks meet row by row, never whole.
PIECE = 4_096

# Training tokens for each weight that a task sends: what moves follows the texts.
TOLD = 2

# Words of packs, and their bytes, that a bucket counts at once, about.
BUCKET = (250_000, 4 << 20)


@dataclass(frozen=True)
class Settings:
    """The recurrent weights are fitted on every training text (one in ``every``), once each:
    texts are dealt over ``rounds`` by their crc32. In a round each slot of about
    ``slot_bytes`` trains on its own from common weights, and the slots' weights are
    averaged. The recurrent vocabulary has ``vocabulary`` words, and from
    some size of the corpus on ``growth`` times the square root of its training tokens.
    """

    vocabulary: int = 2_000
    growth: float = 10.0
    pack_bytes: int = 8 << 20
    every: int = 1
    slot_bytes: int = 8 << 20
    rounds: int = 3
    shape: gru.Shape = gru.Shape()


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts with A-Z in lower case, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words, offsets = lists.flatten(), lists.offsets.to_numpy()
    # Space at a text's ends leaves empty words.
    full = pc.not_equal(pc.binary_length(words), 0)
    upto = np.append(0, np.cumsum(full.to_numpy(zero_copy_only=False)))
    return words.filter(full), np.diff(upto[offsets])


def tokens(text: str) -> list[bytes]:
    """Words with A-Z in lower case, then the end."""
    return [*(word.encode() for word in _split(pa.array([text], pa.string()))[0].to_pylist()), END]


def _ended(numbers: np.ndarray, sizes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all texts' tokens, each text's end included, and where texts start and end."""
    cuts = np.append(0, np.cumsum(sizes + 1))
    made = np.full(cuts[-1], end, numbers.dtype)
    inside = np.ones(len(made), bool)
    inside[cuts[1:] - 1] = False
    made[inside] = numbers
    return made, cuts


def _coded(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct tokens, the end last, every token's place among them, and where texts start
    and end. The same for the same texts at any time."""
    words, sizes = _split(texts)
    found = words.dictionary_encode()
    distinct = pa.concat_arrays([found.dictionary, pa.array([END.decode()], words.type)])
    return distinct, *_ended(found.indices.to_numpy(), sizes, len(distinct) - 1)


def _packs(texts: DataFrame, settings: Settings) -> DataFrame:
    """Packs of texts, each with its distinct tokens in the order of ``_coded``, joined by
    spaces, their training counts (0 for words of held-out texts only), and the numbers of
    its distinct and its training tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        names = ["pack", "texts", "words", "n", "n_words", "n_train"]
        held: list[pa.RecordBatch] = []
        size = 0

        def made() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            name = table["name"][0].as_py()
            table = table.drop_columns("name")
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as writer:
                writer.write_table(table)
            blob = squeeze.compress(sink.getvalue())
            distinct, codes, cuts = _coded(pa.concat_arrays(table["text"].chunks))
            train = np.array([not out for out in table["held_out"].to_pylist()], bool)
            n = np.bincount(codes[np.repeat(train, np.diff(cuts))], minlength=len(distinct))
            row = [name, blob, " ".join(distinct.to_pylist()), n.astype("<i4").tobytes(), len(n), int(n.sum())]
            kinds = [pa.string(), pa.binary(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

        for batch in batches:
            sizes = pc.binary_length(batch.column("text")).to_pylist()
            low = 0
            for i, n in enumerate(sizes):
                size += n
                if size >= settings.pack_bytes:
                    held.append(batch.slice(low, i + 1 - low))
                    yield made()
                    held, size, low = [], 0, i + 1
            if low < len(sizes):
                held.append(batch.slice(low))
        if held:
            yield made()

    # Named by the plan, not in the task: a task run again names its packs anew as a whole.
    named = texts.withColumn("name", F.expr("uuid()"))
    schema = "pack string, texts binary, words string, n binary, n_words bigint, n_train bigint"
    return stored(named.mapInArrow(run, schema), "lm-packs")


def _words(joined: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of rows that are joined by spaces, and how many each row has."""
    lists = pc.split_pattern(joined, " ")
    return lists.flatten(), np.diff(lists.offsets.to_numpy())


def _hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of words, none of which is empty."""
    words = pa.concat_arrays([words])
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset :][: len(words) + 1].astype(np.int64)
    letters = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].astype(np.uint64)
    starts, sizes = offsets[:-1] - offsets[0], np.diff(offsets)
    powers = np.full(sizes.max(), 0x9E3779B97F4A7C15, np.uint64).cumprod()
    places = np.arange(len(letters)) - np.repeat(starts, sizes)
    return mix(np.add.reduceat((letters + np.uint64(1)) * powers[places], starts))


def _counted(packs: DataFrame, buckets: int) -> DataFrame:
    """Rows of two kinds: (pack, at, c) has the corpus counts of a pack's distinct tokens at
    places ``at``, part by part; (word, n) has the training count of each training token."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, joined, blob in zip(*(batch.column(k).to_pylist() for k in ("pack", "words", "n"))):
                words, n = _words(pa.array([joined], pa.string()))[0], np.frombuffer(blob, "<i4")
                bucket = (_hashes(words) % np.uint64(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable").astype("<i4")
                found, low = np.unique(bucket[order], return_index=True)
                cuts = np.append(low, len(order)).astype(np.int32)
                parts = [slice(low, high) for low, high in zip(cuts, cuts[1:])]
                lists = pa.ListArray.from_arrays(cuts, words.take(pa.array(order)))
                columns = [
                    pa.array(found),
                    pa.array([name] * len(parts), pa.string()),
                    pc.binary_join(lists, " "),
                    pa.array([order[part].tobytes() for part in parts], pa.binary()),
                    pa.array([n[order[part]].tobytes() for part in parts], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "pack", "words", "at", "n"])

    def count(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        words, sizes = _words(pa.concat_arrays(rows["words"].chunks))
        found = words.dictionary_encode()
        codes = found.indices.to_numpy()
        n = np.concatenate([np.frombuffer(blob, "<i4") for blob in rows["n"].to_pylist()])
        # Sums of whole numbers, exact in double precision below 2^53.
        total = np.bincount(codes, n, len(found.dictionary)).astype("<i8")
        cuts = np.append(0, np.cumsum(sizes))
        counts = [total[codes[low:high]].tobytes() for low, high in zip(cuts, cuts[1:])]
        taught = np.flatnonzero(total)
        packs, some = len(sizes), len(taught)
        columns = [
            pa.concat_arrays([*rows["pack"].chunks, pa.nulls(some, rows["pack"].type)]),
            pa.concat_arrays([*rows["at"].chunks, pa.nulls(some, rows["at"].type)]),
            pa.concat_arrays([pa.array(counts, pa.binary()), pa.nulls(some, pa.binary())]),
            pa.concat_arrays([pa.nulls(packs, words.type), found.dictionary.take(pa.array(taught))]),
            pa.concat_arrays([pa.nulls(packs, pa.int64()), pa.array(total[taught])]),
        ]
        return pa.Table.from_arrays(columns, ["pack", "at", "c", "word", "n"])

    dealt = packs.select("pack", "words", "n").mapInArrow(
        deal, "bucket int, pack string, words string, at binary, n binary"
    )
    answered = dealt.groupBy("bucket").applyInArrow(
        count, "pack string, at binary, c binary, word string, n bigint"
    )
    return stored(answered, "lm-counts")


def _unpacked(blob: bytes) -> pa.Table:
    raw = zstandard.ZstdDecompressor().decompressobj().decompress(blob)
    return pa.ipc.open_stream(raw).read_all()


def _places(words: pa.Array, places: dict[bytes, int], unknown: int) -> np.ndarray:
    """The numbers of words."""
    own = pa.array(list(places), pa.binary())
    at = pc.fill_null(pc.index_in(words.cast(pa.binary()), value_set=own), len(places)).to_numpy()
    return np.append(np.fromiter(places.values(), np.int32, len(places)), np.int32(unknown))[at]


def _numbered(texts: list[str], places: dict[bytes, int], unknown: int) -> list[np.ndarray]:
    words, sizes = _split(pa.array(texts, pa.string()))
    numbers, cuts = _ended(_places(words, places, unknown), sizes, places[END])
    return np.split(numbers, cuts[1:-1])


def _slots(table: pa.Table, settings: Settings, turn: int | None = None) -> Iterator[list[str]]:
    """A pack's training texts in slots, in an order that its rows' order does not change;
    only those of round ``turn`` if one is given."""
    texts = [text for text, out in zip(table["text"].to_pylist(), table["held_out"].to_pylist()) if not out]
    ordered = sorted((zlib.crc32(text.encode()), text) for text in texts)
    slot, size = [], 0
    for crc, text in ordered:
        if crc % settings.every or turn not in (None, crc // settings.every % settings.rounds):
            continue
        slot.append(text)
        size += len(text)
        if size >= settings.slot_bytes:
            yield slot
            slot, size = [], 0
    if slot:
        yield slot


def _fitted(packs: DataFrame, weights: dict, counts: np.ndarray, places: dict, settings: Settings):
    """Weights after ``rounds`` of local training and averaging, each on its share of the
    texts. Texts stay in their packs; a task sends one average of its slots' weights, in
    pieces of ``PIECE``, and tasks are few enough to send less than they read."""
    context = packs.sparkSession.sparkContext
    unknown, end = places[b""], places[END]
    tasks = max(context.defaultParallelism, int(counts.sum()) // (TOLD * sum(map(np.size, weights.values()))))
    words = context.broadcast((places, counts))

    def train(sent, turn: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            places, counts = words.value
            base = gru.unpack(sent.value, gru.blank(counts, settings.shape))
            total, seen = np.zeros(len(sent.value) // 4), 0
            for batch in batches:
                for blob in batch.column("texts"):
                    for slot in _slots(_unpacked(blob.as_py()), settings, turn):
                        lists = _numbered(slot, places, unknown)
                        fresh = np.zeros(sum(map(len, lists)), bool)
                        fresh[np.cumsum([0] + [len(one) for one in lists[:-1]])] = True
                        model = gru.Model(base, counts, settings.shape)
                        n = model.train(np.concatenate(lists), fresh, end)
                        own = np.frombuffer(gru.pack(model.w), "<f4")
                        for low in range(0, len(own), PIECE):
                            total[low : low + PIECE] += n * own[low : low + PIECE].astype(float)
                        seen += n
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            for part in range(-(-len(total) // PIECE) if seen else 0):
                blob = (total[part * PIECE : (part + 1) * PIECE] / seen).astype("<f4").tobytes()
                columns = [[part], [TaskContext.get().partitionId()], [seen], [blob]]
                arrays = [pa.array(v, k) for v, k in zip(columns, kinds)]
                yield pa.RecordBatch.from_arrays(arrays, ["part", "slot", "n", "weights"])

        return run

    def mean(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("slot")
        n = rows["n"].to_numpy(float)
        total = sum(k * np.frombuffer(blob, "<f4").astype(float) for k, blob in zip(n, rows["weights"]))
        return pd.DataFrame({"part": rows["part"][:1], "weights": [(total / n.sum()).astype("<f4").tobytes()]})

    schema = "part bigint, slot bigint, n bigint, weights binary"
    for turn in range(settings.rounds):
        sent = context.broadcast(gru.pack(weights))
        step = packs.select("texts").coalesce(tasks).mapInArrow(train(sent, turn), schema)
        step = stored(step.groupBy("part").applyInPandas(mean, "part bigint, weights binary"), "lm-round")
        found = {row.part: bytes(row.weights) for row in step.toLocalIterator()}
        if found:  # else there is nothing to learn from in this round
            weights = gru.unpack(b"".join(found[part] for part in sorted(found)), weights)
        sent.destroy()
    return weights


def _most_frequent(words: DataFrame, size: int) -> tuple[list[tuple[bytes, int]], int]:
    """The ``size`` most frequent words and the end, with their counts, ties by word, and the
    number of all. How many words have which count tells where to cut, so that no more than
    these come to the driver."""
    end = F.col("word") == F.lit(END.decode())
    many: dict[int, int] = {}
    end_n = all_v = 0
    for row in words.groupBy(end.alias("end"), "c").count().collect():
        all_v += row["count"]
        if row.end:
            end_n = row.c
        else:
            many[row.c] = row["count"]
    left = size
    for least in sorted(many, reverse=True):
        if many[least] >= left:
            break
        left -= many[least]
    else:
        least = 0
    chosen = words.where(~end)
    found = chosen.where(F.col("c") > least).collect()
    found += chosen.where(F.col("c") == least).orderBy("word").limit(left).collect()
    return [*((row.word.encode(), row.c) for row in found), (END, end_n)], all_v


def score_texts(
    docs: DataFrame,
    held_out: Column,
    settings: Settings = Settings(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every text.

    ``held_out`` marks rows that teach nothing. Scores are log10 probabilities of the whole
    text with its end. Null texts count as empty and have the end alone; null ids and
    repeated rows stay rows of their own. With no training rows every word is unknown.
    """
    texts = docs.select(
        docs[id_col].alias("id"),
        text_of(text_col).alias("text"),
        held_out.alias("held_out"),
    )
    kind = texts.schema["id"].dataType.simpleString()
    packs = _packs(texts, settings)
    sums = [F.coalesce(F.sum(k), F.lit(0)) for k in ("n_train", "n_words", F.octet_length("words"))]
    all_n, *sizes = packs.agg(*sums).first()
    counted = _counted(packs, max(1, *(-(-size // most) for size, most in zip(sizes, BUCKET))))
    words = counted.where("word is not null").select("word", F.col("n").alias("c"))
    size = max(settings.vocabulary, int(settings.growth * math.sqrt(all_n)))
    found, all_v = _most_frequent(words, size)
    known_n = sum(c for _, c in found)
    rest_n, rest_v = all_n - known_n, all_v - sum(c > 0 for _, c in found)
    found.append((b"", rest_n))
    found.sort(key=lambda pair: (-pair[1], pair[0]))
    places = {word: i for i, (word, _) in enumerate(found)}
    counts = np.array([c for _, c in found], float)
    # As many as make the classes and the words of a token's class fewest together.
    share = counts[counts > 0] / max(1.0, counts.sum())
    classes = max(settings.shape.classes, int(np.sqrt(share).sum()))
    settings = replace(settings, shape=replace(settings.shape, classes=classes))
    packs = packs.select("pack", "texts")
    weights = _fitted(packs, gru.start(counts, settings.shape), counts, places, settings)
    # Both grow with the square root of the corpus.
    sent = docs.sparkSession.sparkContext.broadcast((gru.pack(weights), places, counts))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        blob, places, counts = sent.value
        unknown, end = places[b""], places[END]
        model = gru.Model(gru.unpack(blob, gru.blank(counts, settings.shape)), counts, settings.shape)
        made = []
        for packed in left["texts"].to_pylist():
            table = _unpacked(packed).combine_chunks()
            distinct, codes, cuts = _coded(pa.concat_arrays(table["text"].chunks))
            c = np.zeros(len(distinct))
            for at, told in zip(right["at"].to_pylist(), right["c"].to_pylist()):
                c[np.frombuffer(at, "<i4")] = np.frombuffer(told, "<i8")
            numbers = np.append(_places(distinct[:-1], places, unknown), np.int32(end))[codes]
            other = numbers == unknown
            base = np.log10((c + 1) / (all_n + all_v + 1))[codes]
            spelled = np.log10((c + 1) / (rest_n + rest_v + 1))[codes]
            texts = [slice(low, high) for low, high in zip(cuts, cuts[1:])]
            score = model.score(np.split(numbers, cuts[1:-1]), end) / math.log(10)
            score += [spelled[text][other[text]].sum() for text in texts]
            known = np.diff(np.append(0, np.cumsum(c[codes] > 0))[cuts])
            columns = [
                *(pa.chunked_array(table[k].chunks) for k in ("id", "held_out")),
                np.diff(cuts),
                known,
                np.full(len(texts), all_n),
                np.array([base[text].sum() for text in texts]),
                score,
            ]
            made.append(pa.table(columns, names))
        return pa.concat_tables(made)

    schema = (
        f"id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double"
    )
    names = [part.split()[0] for part in schema.split(", ")]
    scored = (
        packs.groupBy("pack")
        .cogroup(counted.where("pack is not null").select("pack", "at", "c").groupBy("pack"))
        .applyInArrow(run, schema)
    )
    return scored.withColumnRenamed("id", id_col)


def held_out_rows(id_col: str = "doc_id") -> Column:
    """Rows kept from training: crc32 of the id's text leaves 2 by 7."""
    return crc_of(id_col) % 7 == 2
