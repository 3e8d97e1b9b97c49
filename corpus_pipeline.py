"""The corpus pipeline: stages over ``documents``, each calling one of the operators in llm/.

A stage takes (spark, docs, sf_dir), where docs is what the stage before it kept, and all
but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.llm import bpe, jaccard, mixing, repeats, toxicity
from trailmark.llm.common import make_importable, stored
from trailmark.llm.queries import MIX

# Stages without a SQL form (a trained model, byte spans): tested against brute force.
ORACLE_SQL = None

RANKS = "byte_bpe_multi_50k.tiktoken"

# Near copies in the pipeline; op5's own contract (three words, 90 percent) binds its query.
NEAR = jaccard.Settings(percent=80, width=5)


def toxic_removed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine, fitted on the labelled ones, does not reject."""
    make_importable(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.train(docs, labels))


def near_duplicates_removed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that has 80 percent of its runs of five words in common."""
    make_importable(spark)
    return jaccard.one_of_each(docs, NEAR)


def repeats_removed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 200 bytes that also start elsewhere. Every row stays,
    with ``n_chars`` of the text it has left; the halves of a character that a cut went
    through go with it."""
    make_importable(spark)
    others = [name for name in docs.columns if name != "text"]
    told = docs.select(F.struct(*others).alias("row"), "text")
    cut = repeats.remove_repeats(told, id_col="row", decoded=True)
    made = cut.select("row.*", "text").withColumn("n_chars", F.length("text").cast("bigint"))
    return made.select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by the target weights, each as often as its source's epochs take it."""
    told = mixing.placed(docs, mixing.source_domain(docs["source"]), MIX)
    copies = F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int")))
    # Inside a struct, so that a column of any name stays what it is.
    taken = told.where(F.col("mix_copies") > 0).select("row", copies)
    return taken.select("row.*")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids, decoded_sha256) of every row."""
    make_importable(spark)
    ranks = public_tokenizers.path(RANKS)
    told = docs.select(F.struct("doc_id", "lang", "source").alias("row"), "text")
    made = bpe.encode(told, ranks, public_tokenizers.PATTERN, id_col="row", decoded=True)
    n_tokens = F.size("ids").cast("bigint").alias("n_tokens")
    return made.select("row.*", n_tokens, "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", toxic_removed),
    ("ngram_jaccard", near_duplicates_removed),
    ("repeated_strings", repeats_removed),
    ("mix_sources", mixed),
    ("bpe", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each one's rows written and read again as the next one's documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
