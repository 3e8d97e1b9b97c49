"""BPE with word ends, where chunks that documents share are encoded once.

A rolling hash over 32 bytes cuts texts where their content says so, so equal passages are
cut alike wherever they stand. A cut may tear anything: a word, a character, the string of
an added token. Every join is repaired: what stands between the last white space before a
cut and the first one after it is encoded anew, over as many chunks as that takes. There
both sides agree exactly with the encoding of the whole text, as this kind of tokenizer
(``check_kind``) never joins anything across white space. A chunk therefore counts as what
lies between two repaired joins, and that is what its digest names.

Three passes over the texts, none of which moves them: digests are counted; texts without
a shared chunk are encoded where they are; of the others, parts that are theirs alone are
encoded in place, and shared chunks go by digest to one task that encodes them once.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.llm import bloom
from trailmark.llm.common import held, join_counted, stored, text_of
from trailmark.llm.shingles import mix

WINDOW = 32  # bytes the rolling hash sees
LEAST, MOST = 256, 4096  # bytes from cut to cut
BITS = 9  # a place is a cut with probability 2^-BITS
REUSED = 64  # shorter chunks are encoded where they stand

BLOCK = 4 << 20  # bytes hashed, and of texts encoded, at a time
ROWS = 500  # texts put together at a time
SEEN = 200_000  # digests whose texts a task remembers to have sent
MEMO_WORDS = 100_000  # words a worker remembers, twice; results do not depend on these bounds
MEMO_LENGTH = 48

BLANK = re.compile(rb"[ \t\n\r]")
TO_SPACE = bytes.maketrans(b"\t\n\r", b"   ")


def check_kind(tokenizer: dict) -> None:
    """Raises unless white space ends everything: the first pre-tokenizer drops what is not
    matched by a pattern that takes no white space, and no added token holds or eats any."""
    steps = (tokenizer.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
    split = steps[0]
    added = tokenizer.get("added_tokens", [])
    known = (
        split.get("type") == "Split"
        and split.get("behavior") == "Removed"
        and split.get("invert")
        and split["pattern"].get("Regex", " ").endswith(r"[^\s\p{L}\p{N}]+")
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)
        and not any(BLANK.search(t["content"].encode()) for t in added)
        and tokenizer["model"]["type"] == "BPE"
        and not tokenizer["model"].get("dropout")
        and tokenizer.get("decoder") is None
    )
    if not known:
        raise ValueError("not a tokenizer whose tokens end at white space")


@lru_cache(maxsize=1)
def _gear() -> np.ndarray:
    return mix(np.arange(256, dtype=np.uint64), 11).astype(np.uint32)


def candidates(data: np.ndarray) -> np.ndarray:
    """Places where the hash of the ``WINDOW`` bytes before them asks for a cut."""
    found = []
    for start in range(0, len(data), BLOCK):
        before = min(start, WINDOW - 1)
        h = _gear()[data[start - before : start + BLOCK]]
        shift = 1
        while shift < WINDOW:
            h[shift:] = h[shift:] + (h[:-shift] << np.uint32(shift))
            shift *= 2
        at = np.flatnonzero(h >> np.uint32(32 - BITS) == 0) + (start - before + 1)
        found.append(at[at > start])
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def cuts(places: list[int], start: int, end: int) -> list[int]:
    """Cuts of a text from ``start`` to ``end``, by the sorted candidate places."""
    made, last = [], start
    i = bisect_left(places, start + LEAST)
    while end - last > LEAST:
        i = bisect_left(places, last + LEAST, i)
        place = places[i] if i < len(places) else end
        last = min(place, last + MOST)
        if last >= end:
            break
        made.append(last)
    return made


def chunks(data: bytes, places: list[int], start: int, end: int) -> list[tuple[int, int, bool]]:
    """(start, end, whether a repaired join) of consecutive parts that add up to a text."""
    parts: list[tuple[int, int, bool]] = []
    at = start  # all before it is in ``parts``
    for cut in cuts(places, start, end):
        if cut < at:
            continue  # inside the join before it
        left = max(data.rfind(blank, at, cut) for blank in (b" ", b"\t", b"\n", b"\r")) + 1
        found = BLANK.search(data, cut, end)
        right = found.start() if found else end
        if left:
            parts.append((at, left, False))
        elif parts and parts[-1][2]:
            left = parts.pop()[0]  # no white space since the last join: both are one
        else:
            left = at
        parts.append((left, right, True))
        at = right
    if at < end:
        parts.append((at, end, False))
    return parts


class Coder:
    """Encodes words (bytes without the four white spaces above) to little-endian uint32.

    Words are remembered in two generations: when the young one is full it becomes the old
    one, and words that are met again move back, so frequent words stay known.
    """

    def __init__(self, path: str) -> None:
        self.young, self.old = {b"": b""}, {}
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # cores belong to Spark's tasks
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            check_kind(json.load(file))
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.texts = [self.tokenizer.id_to_token(i) for i in range(size)]

    def encode(self, data: bytes) -> bytes:
        words = data.translate(TO_SPACE).split(b" ")
        ids = list(map(self.young.get, words))
        if None in ids:
            missed = {word for word, found in zip(words, ids) if found is None}
            fresh = {word: self.old[word] for word in missed if word in self.old}
            unknown = list(missed - fresh.keys())
            texts = [word.decode() for word in unknown]
            made = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            fresh |= {word: np.array(one.ids, "<u4").tobytes() for word, one in zip(unknown, made)}
            ids = [fresh[word] if found is None else found for word, found in zip(words, ids)]
            if len(self.young) > MEMO_WORDS:
                self.young, self.old = {b"": b""}, self.young
            self.young.update(item for item in fresh.items() if len(item[0]) <= MEMO_LENGTH)
        return b"".join(ids)

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.texts.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def coder(path: str) -> Coder:
    """One per worker process: tasks that follow find its memory filled."""
    return held(("chunks", path), lambda: Coder(path))


class Text:
    """A text's chunks, with the digests of those worth reusing."""

    __slots__ = ("row", "data", "parts", "digests")

    def __init__(self, row: int, data: bytes, parts: list) -> None:
        self.row, self.data, self.parts = row, data, parts
        self.digests = [
            hashlib.blake2b(data[a:b], digest_size=16).digest() if not join and b - a >= REUSED else None
            for a, b, join in parts
        ]


def _texts(column: pa.Array) -> Iterator[list[Text]]:
    """The chunked texts of a column, about ``BLOCK`` bytes of them at a time."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
    row = 0
    while row < len(column):
        stop = int(np.searchsorted(offsets, offsets[row] + BLOCK, "right")) - 1
        stop = min(max(stop, row + 1), len(column))
        base = int(offsets[row])
        held = column.buffers()[2]
        data = held[base : int(offsets[stop])].to_pybytes() if held else b""
        places = candidates(np.frombuffer(data, np.uint8)).tolist()
        ends = (offsets[row : stop + 1] - base).tolist()
        yield [
            Text(row + i, data, chunks(data, places, a, b)) for i, (a, b) in enumerate(pairwise(ends))
        ]
        row = stop


def _pairs(digests: list[bytes]) -> np.ndarray:
    """Digests as two columns of int64."""
    return np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)


def shared_chunks(texts: DataFrame) -> DataFrame:
    """(a, b) digests of the chunks that occur more than once in (id, text) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in _texts(batch.column("text")):
                found = [d for text in block for d in text.digests if d]
                columns = _pairs(found).T
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b"])

    found = texts.select("text").mapInArrow(run, "a bigint, b bigint")
    return found.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")


def _found(block: list[Text], field: np.ndarray, bits: int) -> list[list[bool]]:
    """For each text, which of its parts the filter of shared chunks may hold."""
    digests = [d for text in block for d in text.digests if d]
    told = iter(bloom.holds(field, np.ascontiguousarray(_pairs(digests)[:, 0]), bits).tolist())
    return [[bool(d) and next(told) for d in text.digests] for text in block]


def _row(rows: pa.Array, ids: list[bytes], coding: Coder | None) -> pa.RecordBatch:
    """(id, ids), and the decoded texts if there is a ``coding``."""
    columns, names = [rows, pa.array(ids, pa.binary())], ["id", "ids"]
    if coding:
        columns.append(pa.array(list(map(coding.decode, ids)), pa.string()))
        names.append("decoded")
    return pa.RecordBatch.from_arrays(columns, names)


def _schema(kind: str, decoded: bool) -> str:
    return f"id {kind}, ids binary" + (", decoded string" if decoded else "")


def _alone(texts: DataFrame, path: str, kind: str, sent, bits: int, decoded: bool) -> DataFrame:
    """The ids (and decoded texts) of the texts that share nothing, encoded where they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coding = coder(path)
        for batch in batches:
            for block in _texts(batch.column("text")):
                held = _found(block, sent.value, bits)
                own = [text for text, parts in zip(block, held) if not any(parts)]
                ids = [b"".join(coding.encode(t.data[a:b]) for a, b, _ in t.parts) for t in own]
                rows = batch.column("id").take(pa.array([t.row for t in own], pa.int64()))
                yield _row(rows, ids, coding if decoded else None)

    return texts.mapInArrow(run, _schema(kind, decoded))


def _parts(texts: DataFrame, path: str, kind: str, sent, bits: int) -> DataFrame:
    """The other texts in parts: (task, row, seq) with ids, or the digest of a shared chunk
    and, the first time a task meets it, its bytes. A text's first part has its id."""
    schema = f"task int, row bigint, seq int, id {kind}, ids binary, a bigint, b bigint, chunk binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coding, task, rows = coder(path), TaskContext.get().partitionId(), 0
        seen: set[bytes] = set()
        for batch in batches:
            for block in _texts(batch.column("text")):
                made: list[tuple] = []
                for text, held in zip(block, _found(block, sent.value, bits)):
                    if not any(held):
                        continue
                    rows += 1
                    own, seq = [], 0
                    for (a, b, _), digest, shared in zip(text.parts, text.digests, held):
                        if not shared:
                            own.append(coding.encode(text.data[a:b]))
                            continue
                        if own or not seq:
                            made.append((rows, seq, text.row, b"".join(own), None, None))
                            own, seq = [], seq + 1
                        fresh = digest not in seen
                        if fresh:
                            if len(seen) >= SEEN:
                                seen.clear()
                            seen.add(digest)
                        made.append((rows, seq, text.row, None, digest, text.data[a:b] if fresh else None))
                        seq += 1
                    if own:
                        made.append((rows, seq, text.row, b"".join(own), None, None))
                if not made:
                    continue
                row, seq, at, ids, digests, chunk = zip(*made)
                told = np.array([d is not None for d in digests])
                pairs = np.zeros((len(made), 2), np.int64)
                pairs[told] = _pairs([d for d in digests if d])
                first = pa.array([i if s == 0 else None for i, s in zip(at, seq)], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(made), task, np.int32)),
                        pa.array(row, pa.int64()),
                        pa.array(seq, pa.int32()),
                        batch.column("id").take(first),
                        pa.array(ids, pa.binary()),
                        pa.array(pairs[:, 0], mask=~told),
                        pa.array(pairs[:, 1], mask=~told),
                        pa.array(chunk, pa.binary()),
                    ],
                    ["task", "row", "seq", "id", "ids", "a", "b", "chunk"],
                )

    return texts.mapInArrow(run, schema)


def _encoded_once(parts: DataFrame, path: str) -> DataFrame:
    """(a, b, n, ids) of every shared chunk, encoded once, with how often it is referred to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coding = coder(path)
        for batch in batches:
            ids = [coding.encode(chunk.as_py()) for chunk in batch.column("chunk")]
            columns = [*(batch.column(name) for name in ("a", "b", "n")), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "n", "ids"])

    once = parts.where("a is not null").groupBy("a", "b")
    told = once.agg(F.first("chunk", ignorenulls=True).alias("chunk"), F.count(F.lit(1)).alias("n"))
    return told.mapInArrow(run, "a bigint, b bigint, n bigint, ids binary")


def _assembled(
    parts: DataFrame, chunk_ids: DataFrame, path: str, kind: str, decoded: bool
) -> DataFrame:
    """The ids (and decoded texts) of texts from their parts, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coding = coder(path) if decoded else None
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                part = batch.slice(low, ROWS)
                ids = []
                for one in part.column("parts"):
                    found = sorted(one.as_py(), key=lambda part: part["seq"])
                    ids.append(b"".join(part["ids"] for part in found))
                yield _row(part.column("id"), ids, coding)

    refs = parts.where("a is not null").select("task", "row", "seq", "a", "b")
    found = join_counted(refs, chunk_ids, ["a", "b"], "n").select("task", "row", "seq", "ids")
    own = parts.where("a is null").select("task", "row", "seq", "ids", "id")
    rows = own.unionByName(found, allowMissingColumns=True)
    texts = rows.groupBy("task", "row").agg(
        F.first("id", ignorenulls=True).alias("id"),
        F.collect_list(F.struct("seq", "ids")).alias("parts"),
    )
    return texts.select("id", "parts").mapInArrow(run, _schema(kind, decoded))


def encode(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    decoded: bool = False,
) -> DataFrame:
    """(id, ids): the token ids of every whole text as the public library gives them without
    begin and end tokens, as little-endian unsigned 32-bit numbers in one binary. With
    ``decoded`` also the text that the ids stand for, as ``decode`` gives it, by the same
    worker, so that the ids need not come to a second one.

    ``tokenizer_path`` must exist on every executor and name a tokenizer of the kind above.
    Null and empty texts give an empty binary, null ids and repeated rows stay rows of their
    own, other columns are left out, an empty table gives no rows.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        check_kind(json.load(file))
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(docs[id_col].alias("id"), text_of(text_col).alias("text"))
    shared = stored(shared_chunks(texts), "shared-chunks")
    sent, bits = bloom.broadcast_field(shared, "a")
    parts = stored(_parts(texts, tokenizer_path, kind, sent, bits), "chunked-texts")
    chunk_ids = stored(_encoded_once(parts, tokenizer_path), "chunk-ids")
    alone = _alone(texts, tokenizer_path, kind, sent, bits, decoded)
    made = alone.unionByName(_assembled(parts, chunk_ids, tokenizer_path, kind, decoded))
    return made.withColumnRenamed("id", id_col)


def decode(
    encoded: DataFrame, tokenizer_path: str, ids_col: str = "ids", keep: bool = False
) -> DataFrame:
    """``encoded`` with ``decoded`` in place of ``ids_col`` (beside it with ``keep``): the
    text the library decodes the ids to, special tokens included. Null ids give empty texts;
    an id outside the vocabulary is an error."""
    rest = [name for name in encoded.columns if keep or name != ids_col]
    schema = encoded.select(*(encoded[name] for name in rest)).schema.add("decoded", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coding = coder(tokenizer_path)
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            for start, stop in _slices(lists):
                part = batch.slice(start, stop - start)
                texts = [coding.decode(ids.as_py() or b"") for ids in part.columns[-1]]
                columns = [*part.columns[:-1], pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    ordered = encoded.select(*(encoded[name] for name in rest), encoded[ids_col].alias("decoded"))
    return ordered.mapInArrow(run, schema)


def _slices(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``BLOCK`` bytes."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy())
    row = 0
    while row < len(sizes):
        before = int(sizes[row - 1]) if row else 0
        stop = max(row + 1, int(np.searchsorted(sizes, before + BLOCK, "right")))
        yield row, stop
        row = stop
