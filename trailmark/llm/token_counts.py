"""Token counts behind a digest cache.

The cache is a Parquet table (content digest, tokenizer digest, count). A text whose
digest is stored is never encoded again; of the others, one text per digest is.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.llm.common import text_of
from trailmark.llm.pieces import pieces

CACHE_SCHEMA = "content string, tokenizer string, n_tokens bigint"

# Memory bound of the per-worker memory of counted pieces; results do not depend on it.
MEMO_ENTRIES = 400_000
MEMO_LENGTH = 64


class TextCounter:
    """Counts tokens with the public library.

    With ``by_piece`` (byte-level BPE with the public pattern and no normaliser) each
    distinct piece of text goes through the library once per worker. Texts that hold the
    string of an added token are always encoded whole.
    """

    def __init__(self, path: str, by_piece: bool) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # cores belong to Spark's tasks
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [token.content for token in added]
        self.by_piece = by_piece
        self.known: dict[str, int] = {}

    def whole(self, texts: list[str]) -> list[int]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [len(one.ids) for one in encoded]

    def count(self, text: str) -> int:
        if not self.by_piece or any(token in text for token in self.added):
            return self.whole([text])[0]
        found = pieces(text)
        counts = list(map(self.known.get, found))
        if None in counts:
            unknown = list({piece for piece, n in zip(found, counts) if n is None})
            fresh = dict(zip(unknown, self.whole(unknown)))
            counts = [fresh[piece] if n is None else n for piece, n in zip(found, counts)]
            if len(self.known) > MEMO_ENTRIES:
                self.known.clear()
            self.known.update((p, n) for p, n in fresh.items() if len(p) <= MEMO_LENGTH)
        return sum(counts)


@lru_cache(maxsize=4)
def counter(path: str, by_piece: bool) -> TextCounter:
    return TextCounter(path, by_piece)


def tokenizer_digest(path: str) -> str:
    """Names a tokenizer version: the digest of its file."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def content_digest(text: Column) -> Column:
    """Digest of normalised content. Null counts as empty; nothing else is changed, as
    every other change could alter the count."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The cache, which may not have been written yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return spark.createDataFrame([], CACHE_SCHEMA)
    return spark.read.schema(CACHE_SCHEMA).parquet(path)


def append_misses(
    docs: DataFrame,
    tokenizer_path: str,
    cache_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    by_piece: bool = False,
) -> None:
    """Encodes one text for each digest of ``docs`` that the cache lacks and appends it.

    Digests and ids alone are grouped: each missing digest chooses the row of its smallest
    id, and only chosen rows are encoded. Texts move by digest and id, so copies of one
    text spread over the tasks; when the list of chosen rows is small (a warm cache),
    adaptive execution broadcasts it by its measured size and no text moves.
    """
    spark = docs.sparkSession
    version = tokenizer_digest(tokenizer_path)
    known = read_cache(spark, cache_path).where(F.col("tokenizer") == version)
    texts = docs.select(
        F.coalesce(docs[id_col].cast("string"), F.lit("")).alias("row_id"),
        content_digest(docs[text_col]).alias("content"),
        docs[text_col].alias("text"),
    )
    chosen = (
        texts.groupBy("content")
        .agg(F.min("row_id").alias("row_id"))
        .join(known.select("content"), "content", "left_anti")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(tokenizer_path, by_piece)
        for batch in batches:
            made = [counts.count(text.as_py() or "") for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("content"), pa.array(made, pa.int64())], ["content", "n_tokens"]
            )

    once = texts.join(chosen, ["content", "row_id"], "left_semi")
    encoded = once.select("content", "text").mapInArrow(run, "content string, n_tokens bigint")
    encoded = encoded.dropDuplicates(["content"])  # rows may repeat an id and a text
    encoded.select("content", F.lit(version).alias("tokenizer"), "n_tokens").write.mode(
        "append"
    ).parquet(cache_path)


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    cache_path: str,
    limit: int = 512,
    id_col: str = "doc_id",
    text_col: str = "text",
    by_piece: bool = False,
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every whole text.

    ``tokenizer_path`` is a file of the public library that exists on every executor;
    ``cache_path`` is in a folder that all of them share. Null texts count as empty and
    have no tokens; null ids and repeated rows stay rows of their own.
    """
    append_misses(docs, tokenizer_path, cache_path, id_col, text_col, by_piece)
    spark = docs.sparkSession
    # Writers that met the same miss leave equal entries: one is enough.
    known = (
        read_cache(spark, cache_path)
        .where(F.col("tokenizer") == tokenizer_digest(tokenizer_path))
        .groupBy("content")
        .agg(F.max("n_tokens").alias("n_tokens"))
    )
    rows = docs.select(
        docs[id_col].alias(id_col),
        F.octet_length(text_of(text_col)).cast("bigint").alias("n_bytes"),
        content_digest(docs[text_col]).alias("content"),
    )
    return rows.join(known, "content").select(
        id_col, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
