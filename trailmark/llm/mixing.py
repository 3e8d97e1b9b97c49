"""Mixing sources to target weights by hierarchical budgeting.

Sources form a tree of three levels: domain, language, source. A budget of tokens comes
down from the root. Among siblings it is shared by weight; a sibling never gets more than
the tokens below it can give, and what it cannot use goes to its siblings, again by
weight. Only what all of them together cannot use stays with the level above, whose
siblings take it. The shares come from a running sum over the siblings sorted by how soon
they fill up, so one window per level settles all rounds of redistribution at once.

A leaf with a budget of b tokens and t tokens of its own takes b div t whole epochs, and
of the next epoch the longest prefix that fits what is left. Each leaf's epoch is a seeded
order: md5 of the seed, the epoch and the document id.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trailmark.llm.common import WORD, stored

LEVELS = ("domain", "lang", "source")

# A leaf's epoch is cut in one of so many ranges of its order; only that range is sorted.
RANGE_DIGITS = 3


@dataclass(frozen=True)
class Mix:
    """``weights`` has a whole-number weight by level and name; names not listed weigh 1,
    and 0 leaves a branch out. The budget is ``budget_percent`` of all tokens, and no
    document is taken more than ``max_epochs`` times."""

    budget_percent: int = 60
    max_epochs: int = 2
    seed: str = "mix-1"
    weights: dict[str, dict[str, int]] = field(default_factory=dict)


def word_count(text: Column) -> Column:
    """Tokens of a text, here its words."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def source_domain(source: Column, per_domain: int = 5) -> Column:
    """A domain for each run of ``per_domain`` numbered sources; others share one."""
    number = F.regexp_extract(source, r"([0-9]{1,9})$", 1).try_cast("bigint")
    named = F.concat(F.lit("domain"), F.floor(number / per_domain).cast("string"))
    return F.coalesce(F.when(source.isNotNull(), named), F.lit("other"))


def _weight(level: str, mix: Mix) -> Column:
    made = F.lit(1)
    for name, weight in mix.weights.get(level, {}).items():
        made = F.when(F.col(level) == name, weight).otherwise(made)
    return made.cast("bigint")


def _leaves(documents: DataFrame) -> DataFrame:
    return documents.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))


def budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """``leaves`` (domain, lang, source, tokens) with the ``budget`` of each."""
    n = mix.max_epochs
    nodes = leaves.withColumn("cap", F.col("tokens") * n)
    # A branch whose weight is 0 anywhere on its path can give nothing.
    path = _weight(LEVELS[0], mix) * _weight(LEVELS[1], mix) * _weight(LEVELS[2], mix)
    nodes = nodes.withColumn("cap", F.when(path > 0, F.col("cap")).otherwise(0))
    nodes = nodes.withColumn("budget", F.lit(0))
    for depth, level in enumerate(LEVELS):
        here = list(LEVELS[: depth + 1])
        branch = (
            nodes.groupBy(*here)
            .agg(
                F.sum("cap").alias("room"),
                F.sum("tokens").alias("tokens"),
                F.min("budget").alias("given"),
            )
            .withColumn("weight", _weight(level, mix))
        )
        if not depth:  # the root: one row for each domain
            total = F.sum("tokens").over(W.partitionBy(F.lit(0)))
            branch = branch.withColumn("given", F.floor(total * mix.budget_percent / 100))
        shared = _shared(branch, list(LEVELS[:depth]), level)
        nodes = nodes.drop("budget").join(shared.select(*here, "budget"), here)
    return nodes.select(*LEVELS, "tokens", "budget")


def _shared(branch: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Shares ``given`` among siblings by weight, none above its ``room``.

    Sorted by room / weight, the siblings that fill up come first. With those before it
    full, the rest of the budget over the rest of the weight is what one unit of weight
    gets; a sibling is full if that level reaches its own ratio. From the first sibling
    that is not full on the level falls, so the highest of those levels is the one.
    """
    keys = parent or [F.lit(0)]
    first = W.partitionBy(*keys).orderBy("ratio", name)
    all_ = W.partitionBy(*keys)
    earlier = first.rowsBetween(W.unboundedPreceding, -1)
    ratio = F.when(F.col("weight") > 0, F.col("room") / F.col("weight")).otherwise(0.0)
    sums = branch.withColumn("ratio", ratio).select(
        "*",
        F.coalesce(F.sum("room").over(earlier), F.lit(0)).alias("room_before"),
        F.coalesce(F.sum("weight").over(earlier), F.lit(0)).alias("weight_before"),
        F.sum("weight").over(all_).alias("weight_all"),
    )
    level = F.when(
        F.col("weight_all") > F.col("weight_before"),
        (F.col("given") - F.col("room_before")) / (F.col("weight_all") - F.col("weight_before")),
    ).otherwise(0.0)
    levels = sums.withColumn("level", level).withColumn("full", F.col("level") >= F.col("ratio"))
    open_level = F.max(F.when(~F.col("full"), F.col("level"))).over(all_)
    return levels.withColumn(
        "budget",
        F.when(F.col("full"), F.col("room"))
        .otherwise(F.least(F.col("room"), F.floor(open_level * F.col("weight"))))
        .cast("bigint"),
    )


def _plan(documents: DataFrame, mix: Mix) -> DataFrame:
    """Each leaf's whole epochs and the order up to which it takes one more."""
    leaves = budgets(stored(_leaves(documents), "mix-leaves"), mix)
    leaves = leaves.select(
        *LEVELS,
        F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(0).alias("epochs"),
        F.when(F.col("tokens") > 0, F.expr("budget % tokens")).otherwise(0).alias("rest"),
    )
    leaves = stored(leaves, "mix-budgets")
    ordered = documents.join(leaves.select(*LEVELS, "epochs", "rest"), list(LEVELS)).select(
        *LEVELS, "rest", "tokens", _order(mix, F.col("epochs")).alias("place")
    )
    ordered = ordered.withColumn("range", F.substring("place", 1, RANGE_DIGITS))
    ranges = ordered.groupBy(*LEVELS, "range").agg(
        F.sum("tokens").alias("n"), F.min("rest").alias("rest")
    )
    upto = W.partitionBy(*LEVELS).orderBy("range")
    ranges = ranges.withColumn("upto", F.sum("n").over(upto))
    # The first range that does not fit whole is the one the prefix ends in.
    cut = ranges.where("rest > 0 AND upto > rest").groupBy(*LEVELS).agg(
        F.min(F.struct("range", (F.col("upto") - F.col("n")).alias("before"))).alias("cut")
    )
    cut = cut.select(*LEVELS, F.col("cut.range").alias("range"), F.col("cut.before").alias("before"))
    inside = ordered.join(cut, [*LEVELS, "range"]).withColumn(
        "sum", F.col("before") + F.sum("tokens").over(W.partitionBy(*LEVELS).orderBy("place"))
    )
    last = inside.where(F.col("sum") <= F.col("rest")).groupBy(*LEVELS).agg(
        F.max("place").alias("last")
    )
    bounds = cut.join(last, list(LEVELS), "left").select(
        *LEVELS, F.coalesce("last", "range").alias("last")
    )
    # Without a cut the leaf takes no part of an epoch.
    return leaves.join(bounds, list(LEVELS), "left").select(*LEVELS, "epochs", "last")


def _order(mix: Mix, epoch: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(mix.seed), epoch.cast("string"), F.col("id")))


# Columns that ``mix_sources`` adds.
ADDED = ("mix_domain", "mix_tokens", "mix_copies")


def placed(
    docs: DataFrame,
    domain: Column,
    mix: Mix = Mix(),
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """``row`` (all columns of a row of ``docs``, of whatever names), ``mix_domain``,
    ``mix_tokens`` and ``mix_copies`` (0: left out).

    Null domains, languages and sources are branches named ''. Rows with equal ids have
    equal places and come in or stay out together; null ids count as ''. Texts without
    words weigh nothing: they come along with the prefix they stand in. Texts do not move:
    they meet the leaves' bounds, one row for each source, in a join that adaptive
    execution broadcasts by measured size and else splits where a source is hot.
    """
    told = docs.select(
        F.struct(*(docs[name] for name in docs.columns)).alias("row"),
        F.coalesce(docs[id_col].cast("string"), F.lit("")).alias("id"),
        F.coalesce(domain, F.lit("")).alias("domain"),
        F.coalesce(docs[lang_col], F.lit("")).alias("lang"),
        F.coalesce(docs[source_col], F.lit("")).alias("source"),
        word_count(docs[text_col]).alias("tokens"),
    )
    plan = _plan(stored(told.drop("row"), "mix-rows"), mix)
    more = F.coalesce(_order(mix, F.col("epochs")) <= F.col("last"), F.lit(False)).cast("bigint")
    return told.join(plan, list(LEVELS)).select(
        "row",
        F.col("domain").alias("mix_domain"),
        F.col("tokens").alias("mix_tokens"),
        (F.col("epochs") + more).alias("mix_copies"),
    )


def mix_sources(docs: DataFrame, domain: Column, mix: Mix = Mix(), **columns: str) -> DataFrame:
    """``docs`` with the columns ``ADDED`` as ``placed`` finds them; columns of these names
    in ``docs`` are replaced."""
    kept = [F.col("row").getField(name).alias(name) for name in docs.columns if name not in ADDED]
    return placed(docs, domain, mix, **columns).select(*kept, *ADDED)
