"""Exact top-k inner products by a three-phase uniform threshold.

A score is a sum over lists, one list for each run of vector components. Phase one gathers
the rows with the k highest entries of every list; their scores give a total that k
candidates reach. Phase two sends that total divided by the number of lists as the cutoff and
collects every entry that reaches it: a candidate below it in all lists falls short of the
total. Phase three looks up what bounds leave open and computes those scores exactly.

Queries and candidates meet in blocks of a fixed size, each a group of its own.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trailmark.llm.common import stored

# Sums of products stay exact in a double's 53 bits up to here.
_EXACT = 2**53


@dataclass(frozen=True)
class Settings:
    """``query_block`` x ``row_block`` pairs are one group; ``tile`` rows of it are
    multiplied at a time."""

    lists: int = 2
    query_block: int = 1_024
    row_block: int = 32_768
    tile: int = 1_024


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: int = 256) -> DataFrame:
    """(id, v): components as floor(scale * x). Rows without an id, and vectors that are
    null, empty or hold a null or non-finite component, are left out. Of rows with one id
    the smallest vector stands."""
    x = F.col("x").cast("array<double>")
    ok = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    chosen = rows.select(rows[id_col].cast("bigint").alias("id"), rows[vector_col].alias("x"))
    chosen = chosen.where(F.col("id").isNotNull() & (F.size("x") > 0) & ok)
    whole = F.transform(x, lambda e: F.floor(F.lit(float(scale)) * e))
    return chosen.groupBy("id").agg(F.min(whole).alias("v"))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """Rows as doubles, shorter vectors filled with zeros."""
    made = np.zeros((len(vectors), width))
    for i, vector in enumerate(vectors):
        made[i, : len(vector)] = vector
    return made


class _Block:
    """Queries and rows of one group, with the runs of components that make the lists."""

    def __init__(self, queries: pd.DataFrame, rows: pd.DataFrame, settings: Settings) -> None:
        width = max(max(map(len, queries["v"])), max(map(len, rows["v"])))
        a, b = _matrix(queries["v"], width), _matrix(rows["v"], width)
        if width * max(np.abs(a).max(), 1) * max(np.abs(b).max(), 1) >= _EXACT:
            a, b = a.astype(np.int64), b.astype(np.int64)
        self.a, self.b, self.tile = a, b, settings.tile
        self.query_ids, self.ids = queries["id"].to_numpy(), rows["id"].to_numpy()
        cuts = np.linspace(0, width, settings.lists + 1).astype(int)
        self.runs = [slice(low, high) for low, high in zip(cuts[:-1], cuts[1:])]

    def tiles(self):
        """(first row, partial scores by list, own rows) of each tile of rows."""
        for low in range(0, len(self.ids), self.tile):
            tile = slice(low, low + self.tile)
            parts = [(self.a[:, run] @ self.b[tile, run].T).astype(np.int64) for run in self.runs]
            yield low, parts, self.query_ids[:, None] == self.ids[None, tile]

    def entries(self, q: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
        """Partial scores, by list, of the rows ``at`` for the queries ``q``."""
        return [(self.a[q, run] * self.b[at, run]).sum(1).astype(np.int64) for run in self.runs]


def top_inner_products(
    embeddings: DataFrame,
    is_query: Column,
    k: int = 5,
    settings: Settings = Settings(),
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` highest integer inner products.

    ``is_query`` is a condition on ``id``; every other row is a candidate. Ties go to the
    smaller id, and a query with fewer candidates gets them all. Rows that take no part
    are those of ``integer_vectors``; an empty table gives no rows.
    """
    vectors = stored(integer_vectors(embeddings, id_col, vector_col), "topk-vectors")
    queries = stored(vectors.where(is_query), "topk-queries")
    n, n_queries = vectors.count(), queries.count()
    blocks = max(1, -(-n_queries // settings.query_block))
    slots = max(1, -(-n // settings.row_block))
    numbers = F.pmod(F.xxhash64("id"), F.lit(slots)).alias("slot")
    rows = vectors.select(
        "id", "v", numbers, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    ).groupBy("block", "slot")

    def met(asked: DataFrame):
        copies = F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot")
        number = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block")
        wide = asked.select("*", number, copies)
        return wide.groupBy("block", F.col("slot").cast("bigint").alias("slot")).cogroup(rows)

    sent = [f"sent{j}" for j in range(settings.lists)]
    least = [f"least{j}" for j in range(settings.lists)]
    schema = ", ".join(["query_id bigint, vec_id bigint", *(f"{name} bigint" for name in sent)])
    names = ["query_id", "vec_id", *sent]

    def highest(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """Rows with one of the k highest entries of a list, all their entries, and the
        least entry that each list has for the query in this block."""
        if not len(left) or not len(right):
            return pd.DataFrame(columns=[*names, *least])
        block = _Block(left, right, settings)
        best = [None] * settings.lists
        floors = [None] * settings.lists
        for low, parts, own in block.tiles():
            for j, partial in enumerate(parts):
                floor = np.where(own, np.iinfo(np.int64).max, partial).min(1)
                floors[j] = floor if floors[j] is None else np.minimum(floors[j], floor)
                partial[own] = np.iinfo(np.int64).min
                at = np.broadcast_to(np.arange(low, low + partial.shape[1]), partial.shape)
                if best[j] is not None:
                    partial = np.hstack([best[j][0], partial])
                    at = np.hstack([best[j][1], at])
                keep = min(k, partial.shape[1])
                chosen = np.argpartition(-partial, keep - 1, axis=1)[:, :keep]
                best[j] = tuple(np.take_along_axis(x, chosen, 1) for x in (partial, at))
        q = np.concatenate([np.repeat(np.arange(len(left)), x.shape[1]) for x, _ in best])
        at = np.concatenate([x.ravel() for _, x in best])
        real = np.concatenate([x.ravel() for x, _ in best]) > np.iinfo(np.int64).min
        q, at = np.unique(np.stack([q[real], at[real]]), axis=1)
        made = {"query_id": block.query_ids[q], "vec_id": block.ids[at]}
        made |= dict(zip(sent, block.entries(q, at)))
        made |= {name: floors[j][q] for j, name in enumerate(least)}
        return pd.DataFrame(made)

    floor_schema = ", ".join(f"{name} bigint" for name in least)
    local = stored(met(queries).applyInPandas(highest, f"{schema}, {floor_schema}"), "topk-local")
    floors = local.groupBy("query_id").agg(*(F.min(name).alias(name) for name in least))

    def total(parts) -> Column:
        return reduce(operator.add, parts)

    best_first = W.partitionBy("query_id").orderBy(F.desc("low"), "vec_id")

    def reached(candidates: DataFrame) -> DataFrame:
        """A total that k candidates of the query reach; null with fewer candidates."""
        first = candidates.select("query_id", "vec_id", "low").withColumn(
            "place", F.row_number().over(best_first)
        )
        return first.where(F.col("place") <= k).groupBy("query_id").agg(
            F.when(F.count("*") == k, F.min("low")).alias("total")
        )

    least_of_all = F.lit(np.iinfo(np.int64).min // 4)
    cutoff = F.coalesce(F.ceil(F.col("total") / settings.lists), least_of_all)
    known = local.withColumn("low", total(F.col(name) for name in sent))
    cutoffs = reached(known).join(floors, "query_id")
    cutoffs = stored(cutoffs.select("query_id", cutoff.alias("cutoff"), *least), "topk-cutoffs")
    asked = stored(queries.join(cutoffs.withColumnRenamed("query_id", "id"), "id"), "topk-asked")

    def sufficient(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """Every entry that reaches its query's cutoff, entries of one row side by side."""
        if not len(left) or not len(right):
            return pd.DataFrame(columns=names)
        block, cut = _Block(left, right, settings), left["cutoff"].to_numpy()
        made = []
        for low, parts, own in block.tiles():
            over = [(partial >= cut[:, None]) & ~own for partial in parts]
            q, v = np.nonzero(np.logical_or.reduce(over))
            frame = {"query_id": block.query_ids[q], "vec_id": block.ids[low + v]}
            for name, partial, held in zip(sent, parts, over):
                frame[name] = pd.arrays.IntegerArray(partial[q, v], ~held[q, v])
            made.append(pd.DataFrame(frame))
        return pd.concat(made)

    found = met(asked).applyInPandas(sufficient, schema).join(cutoffs, "query_id")
    found = found.select(
        "query_id",
        "vec_id",
        total(F.coalesce(s, f) for s, f in zip(sent, least)).alias("low"),
        total(F.coalesce(F.col(s), F.col("cutoff") - 1) for s in sent).alias("high"),
    )
    found = stored(found, "topk-entries")
    open_ = found.join(reached(found), "query_id").where(
        F.col("total").isNull() | (F.col("high") >= F.col("total"))
    )
    pairs = open_.select("query_id", "vec_id")
    exact = (
        pairs.join(queries.select(F.col("id").alias("query_id"), F.col("v").alias("q")), "query_id")
        .join(vectors.select(F.col("id").alias("vec_id"), "v"), "vec_id")
        .select("query_id", "vec_id", _inner_product(F.col("q"), F.col("v")).alias("score"))
    )
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = exact.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _inner_product(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: F.coalesce(x * y, F.lit(0)))
    return F.aggregate(products, F.lit(0).cast("bigint"), lambda total, x: total + x)
