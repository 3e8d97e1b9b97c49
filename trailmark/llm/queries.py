"""The registered queries of the operators, with their SQL twins where SQL has one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.llm import (
    bpe,
    chunk_reuse,
    conversations,
    jaccard,
    licenses,
    lm,
    mixing,
    oracle,
    quality,
    repeats,
    token_counts,
    topk,
    toxicity,
    whitening,
)
from trailmark.llm.common import make_importable, shared_folder

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    make_importable(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


MIX = mixing.Mix(
    weights={
        "domain": {"domain0": 3, "domain1": 2},
        "lang": {"en": 4, "de": 2, "fr": 2},
        "source": {"src0": 2},
    }
)


def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    mixed = mixing.mix_sources(docs, mixing.source_domain(docs["source"]), MIX)
    return mixed.select(
        "doc_id",
        F.col("mix_domain").alias("domain"),
        "lang",
        "source",
        F.col("mix_tokens").alias("n_tokens"),
        F.col("mix_copies").alias("copies"),
    )


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(
        _table(spark, folder, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        shared_folder(spark, "token-counts"),
        by_piece=True,
    )


def op3_licenses(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    scanned = licenses.scan(docs, licenses.train(docs))
    families = F.array_sort(F.array_distinct("licences.family"))
    return scanned.select(
        "doc_id",
        "n_paragraphs",
        F.size("licences").cast("bigint").alias("n_licences"),
        F.array_join(families, ",").alias("families"),
        F.coalesce(F.array_max("licences.probability"), F.lit(0.0)).alias("probability"),
    )


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    model = toxicity.train(docs, labels.where(~toxicity.held_out()))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op5_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar_groups(_table(spark, folder, "documents"))


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.assess(_table(spark, folder, "documents"))


def op7_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_inner_products(_table(spark, folder, "embeddings"), F.col("id") % 50 == 0)


def op8_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return lm.score_texts(_table(spark, folder, "documents"), lm.held_out_rows())


def op9_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = _table(spark, folder, "documents")
    encoded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, decoded=True)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_repeated_strings(spark: SparkSession, folder: str) -> DataFrame:
    cut = repeats.remove_repeats(_table(spark, folder, "documents"))
    return cut.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op11_chunked_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    encoded = chunk_reuse.encode(_table(spark, folder, "documents"), path, decoded=True)
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def _grid_vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, x): null entries stand for null and non-finite ones, and for those of 2^43 or
    more, whose grid number would not fit a long. The operator leaves such vectors out."""

    def on_grid(v):
        # NaN is greater than all numbers here.
        return F.when(F.abs(v) < 2.0**43, F.floor(v.cast("double") * 1024) + F.lit(100_000))

    return rows.select("vec_id", F.transform("embedding", on_grid).alias("x"))


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    told = whitening.whiten(_grid_vectors(_table(spark, folder, "embeddings")))
    return told.withColumn("deviation", F.col("deviation").cast("bigint"))


def _damaged(rows: DataFrame) -> DataFrame:
    """Conversations with the faults that the contract deals by the crc of their keys."""
    key = [F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn")]
    dealt = F.crc32(F.concat(key[0], F.lit(":"), key[1]).cast("binary")) % 20
    told = rows.select(
        "conv_id",
        "turn",
        *(F.coalesce(F.col(name), F.lit(" ")).alias(name) for name in ("role", "text")),
        dealt.alias("dealt"),
    ).where("dealt != 0")
    text = (
        F.when(F.col("dealt") == 1, "")
        .when(F.col("dealt") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
    )
    role = F.when(F.col("dealt") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("dealt") == 3, 2).otherwise(1)))
    return told.select("conv_id", "turn", role.alias("role"), text.alias("text"), times)


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "conversations")
    found = conversations.digests(conversations.repair(_damaged(rows)))
    asked = rows.select("conv_id").distinct()
    told = asked.join(found, asked["conv_id"].eqNullSafe(found["conv"]), "left")
    return told.select(
        "conv_id",
        *(F.coalesce(f"plan.{name}", F.lit(0)).alias(name) for name in conversations.COUNTS),
        F.coalesce("plan.audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def queries() -> dict[str, Query]:
    return {
        "op1_mix_sources": op1_mix_sources,
        "op2_token_counts": op2_token_counts,
        "op3_licenses": op3_licenses,
        "op4_toxicity": op4_toxicity,
        "op5_ngram_jaccard": op5_ngram_jaccard,
        "op6_quality": op6_quality,
        "op7_top_k": op7_top_k,
        "op8_lm_scores": op8_lm_scores,
        "op9_bpe": op9_bpe,
        "op10_repeated_strings": op10_repeated_strings,
        "op11_chunked_bpe": op11_chunked_bpe,
        "op12_whitening": op12_whitening,
        "op13_conversation_repair": op13_conversation_repair,
    }


def oracle_sql() -> dict[str, str]:
    """Twins of what SQL can express; the others are tested against brute force."""
    return {
        "op1_mix_sources": oracle.mix_sources(MIX),
        "op5_ngram_jaccard": oracle.NGRAM_JACCARD,
        "op7_top_k": oracle.TOP_K,
    }
