"""Byte-level BPE encoding and decoding with a rank queue of hierarchical bitmaps.

A pre-token is a doubly linked list of parts. Every adjacent pair whose concatenation
has a rank waits in the bucket of that rank, by the position of its left part. Two levels
of bitmaps mark which buckets hold anything, so the lowest rank is two find-first-set
steps away whatever the number of ranks and of waiting pairs. Nothing is removed when a
merge changes a neighbouring pair: an entry whose pair has another rank by now is stale
and is skipped. A pre-token of n bytes takes O(n log n), which suits long ones.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame

from trailmark.llm.common import held, text_of
from trailmark.llm.pieces import pieces

# Bound of what a worker remembers of encoded pieces and pre-tokens, in each of two
# generations; results do not depend on it.
MEMO_ENTRIES = 600_000
MEMO_LENGTH = 64


def merge(token: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one pre-token: the lowest-ranked pair merges first, leftmost on ties."""
    get = ranks.get
    whole = get(token)
    if whole is not None:
        return [whole]
    n = len(token)
    if n == 2:  # one pair, which has no rank
        return [ranks[token[:1]], ranks[token[1:]]]
    end = list(range(1, n + 1))  # where the part that starts here ends
    before = list(range(-1, n - 1))  # where the part to the left starts
    pair: list[int | None] = [None] * n  # rank of the pair whose left part starts here
    buckets: dict[int, int | list[int]] = {}  # rank -> a position, or a heap of several
    words: dict[int, int] = {}  # rank >> 8 -> bitmap of the ranks that wait
    top = 0  # bitmap of the keys of ``words``
    fresh = [(i, i + 2) for i in range(n - 1)]  # where pairs that are new start and end
    while True:
        for i, stop in fresh:
            pair[i] = rank = get(token[i:stop])
            if rank is None:
                continue
            if rank in buckets:
                bucket = buckets[rank]
                if type(bucket) is int:
                    buckets[rank] = [bucket, i] if bucket < i else [i, bucket]
                else:
                    heappush(bucket, i)
                continue
            buckets[rank] = i
            high = rank >> 8
            if high in words:
                words[high] |= 1 << (rank & 255)
            else:
                words[high] = 1 << (rank & 255)
                top |= 1 << high
        if not top:
            break
        high = (top & -top).bit_length() - 1
        word = words[high]
        rank = high << 8 | (word & -word).bit_length() - 1
        i = buckets[rank]
        if type(i) is not int:
            bucket = i
            i = heappop(bucket)
            if len(bucket) == 1:
                buckets[rank] = bucket[0]
        else:
            del buckets[rank]
            word &= word - 1
            if word:
                words[high] = word
            else:
                del words[high]
                top &= top - 1
        fresh = ()
        if pair[i] != rank:
            continue
        j = end[i]
        end[i] = k = end[j]
        pair[j] = None
        left = before[i]
        if k < n:
            before[k] = i
            fresh = ((i, end[k]), (left, k)) if left >= 0 else ((i, end[k]),)
        else:
            pair[i] = None
            if left >= 0:
                fresh = ((left, k),)
    ids, i = [], 0
    while i < n:
        ids.append(ranks[token[i : end[i]]])
        i = end[i]
    return ids


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Encoder(dict):
    """Piece or pre-token -> its ids as little-endian int32 bytes, filled as they turn up.

    A pre-token alone splits into itself, so both kinds share one memory; most pieces are a
    single pre-token. When it is full it becomes the old generation, in which entries are
    still found and from which they move back: what is frequent is never forgotten.
    """

    def __init__(self, path: str, pattern: str) -> None:
        super().__init__()
        self.old: dict[str, bytes] = {}
        self.ranks = load_ranks(path)
        self.split = regex.compile(pattern).findall

    def __missing__(self, piece: str) -> bytes:
        packed = self.old.get(piece)
        if packed is None:
            parts = self.split(piece)
            if len(parts) == 1:
                return self._merged(piece)
            packed = b"".join([self.get(part) or self._part(part) for part in parts])
        return self._kept(piece, packed)

    def _part(self, token: str) -> bytes:
        packed = self.old.get(token)
        return self._merged(token) if packed is None else self._kept(token, packed)

    def _merged(self, token: str) -> bytes:
        ids = merge(token.encode(), self.ranks)
        return self._kept(token, struct.pack(f"<{len(ids)}i", *ids))

    def _kept(self, text: str, packed: bytes) -> bytes:
        if len(text) <= MEMO_LENGTH:
            if len(self) >= MEMO_ENTRIES:
                self.old = dict(self)
                self.clear()
            self[text] = packed
        return packed

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.__getitem__, pieces(text))), "<i4")


def encoder(path: str, pattern: str) -> Encoder:
    """One per worker process: tasks that follow find its memory filled."""
    return held(("bpe", path, pattern), lambda: Encoder(path, pattern))


@lru_cache(maxsize=4)
def tokens_by_id(path: str) -> pa.Array:
    """The bytes of each id; null where there is none."""
    ranks = load_ranks(path)
    made: list[bytes | None] = [None] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        made[rank] = token
    return pa.array(made, pa.binary())


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32()))


# Tokens decoded, and rows encoded, at a time.
_DECODED = 1 << 20
_ROWS = 1_000


def _runs(cuts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of lists, which end at ``cuts``, of about ``_DECODED`` ids."""
    row = 0
    while row < len(cuts):
        before = int(cuts[row - 1]) if row else 0
        stop = max(row + 1, int(np.searchsorted(cuts, before + _DECODED, "right")))
        yield row, stop
        row = stop


def _bytes_of(lists: pa.ListArray, tokens: pa.Array) -> pa.BinaryArray:
    """The bytes that each list of ids stands for; null lists have none."""
    cuts = np.cumsum(pa.compute.fill_null(pa.compute.list_value_length(lists), 0))
    flat = lists.flatten()
    made, low = [], 0
    # Bytes of all tokens stand one after another: a text is a slice of them.
    for start, stop in _runs(cuts):
        high = int(cuts[stop - 1])
        part = tokens.take(flat.slice(low, high - low))
        if part.null_count:
            raise ValueError("an id outside the ranks")
        ends = np.frombuffer(part.buffers()[1], np.int32)[part.offset :][: len(part) + 1]
        blob = part.buffers()[2].to_pybytes() if len(part) else b""
        bounds = ends[np.concatenate([[0], cuts[start:stop] - low])].tolist()
        made += [blob[a:b] for a, b in pairwise(bounds)]
        low = high
    return pa.array(made, pa.binary())


def encode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    decoded: bool = False,
) -> DataFrame:
    """(id, ids): the token ids of every whole text, without special tokens; with
    ``decoded`` also the bytes that the ids stand for, as ``decode`` gives them, by the same
    worker, so that the ids need not come to a second one.

    ``ranks_path`` must exist on every executor; ``pattern`` is the public split pattern
    of byte-level BPE, whose matches are encoded separately. Null and empty texts give an
    empty list, null ids and repeated rows stay rows of their own, other columns are left
    out. No shuffle: a text is one row of one task, of any length.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["id", "ids", "decoded"] if decoded else ["id", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(ranks_path, pattern)
        for batch in batches:
            for low in range(0, batch.num_rows, _ROWS):
                part = batch.slice(low, _ROWS)
                ids = _lists([coder.encode(text) for text in part.column(1).to_pylist()])
                columns = [part.column(0), ids]
                if decoded:
                    columns.append(_bytes_of(ids, tokens_by_id(ranks_path)))
                yield pa.RecordBatch.from_arrays(columns, names)

    chosen = docs.select(docs[id_col].alias("id"), text_of(text_col).alias("text"))
    schema = f"id {kind}, ids array<int>" + (", decoded binary" if decoded else "")
    return chosen.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, ranks_path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``ids_col`` replaced by ``decoded``, the bytes the ids stand for.

    Null lists and empty ones give empty bytes; an id outside the ranks is an error.
    Bytes, not text: ids cut from a longer list may end inside a character.
    """
    rest = [name for name in encoded.columns if name != ids_col]
    schema = encoded.select(*(encoded[name] for name in rest)).schema
    schema = schema.add("decoded", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_by_id(ranks_path)
        for batch in batches:
            columns = [*batch.columns[:-1], _bytes_of(batch.columns[-1], tokens)]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    ordered = encoded.select(*(encoded[name] for name in rest), encoded[ids_col])
    return ordered.mapInArrow(run, schema)
