"""Most clicked products per area."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.functions.labels import (
    AREA_LEVELS,
    OTHER_AREA_LEVEL,
    area_level,
    product_status,
)
from trailmark.functions.texts import id_name, list_text
from trailmark.operators.ranking import top_per_group

TOP_PRODUCTS = 3


def click_city_join(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks with their city's name and area; clicks in unknown cities drop out."""
    return clicks.join(cities, "city_id").select("city_id", "city_name", "area", "product_id")


def area_product_counts(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks per area and product with the sorted ``id:name`` list of their cities.

    Clicks are counted per city and product before the city is looked up, so the
    join and the second count see one row per pair however hot a city or product is.
    """
    per_city = clicks.groupBy("city_id", "product_id").agg(F.count(F.lit(1)).alias("_clicks"))
    located = per_city.join(cities, "city_id")
    city = id_name(F.col("city_id"), F.col("city_name"))
    return (
        located.groupBy("area", "product_id")
        .agg(F.sum("_clicks").alias("click_count"), F.collect_set(city).alias("_cities"))
        .withColumn("city_infos", F.coalesce(list_text(F.col("_cities")), F.lit("")))
        .drop("_cities")
    )


def area_product_enriched(counts: DataFrame, products: DataFrame) -> DataFrame:
    """Adds product name and status; unknown products drop out."""
    named = products.select(
        "product_id", "product_name", product_status(F.col("extend_info")).alias("product_status")
    )
    return counts.join(named, "product_id").select(
        "area", "product_id", "click_count", "city_infos", "product_name", "product_status"
    )


def area_top_products(
    enriched: DataFrame,
    task_id: int = 0,
    limit: int = TOP_PRODUCTS,
    levels: Mapping[str, str] = AREA_LEVELS,
    other_level: str = OTHER_AREA_LEVEL,
) -> DataFrame:
    """The ``limit`` most clicked products of each area; ties by product id."""
    top = top_per_group(
        enriched, ["area"], [F.desc("click_count"), F.asc("product_id")], limit
    )
    return top.select(
        F.lit(task_id).cast("long").alias("task_id"),
        "area",
        area_level(F.col("area"), levels, other_level).alias("area_level"),
        "product_id",
        "city_infos",
        "click_count",
        "product_name",
        "product_status",
    )
