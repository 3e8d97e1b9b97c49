"""Dimension tables kept in a relational database."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import pairwise

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class JdbcConnection:
    """Where a database is. Credentials come from the caller, never from a file here."""

    url: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str | None = None

    def options(self) -> dict[str, str]:
        given = {
            "url": self.url,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
        }
        return {key: value for key, value in given.items() if value is not None}


@dataclass(frozen=True)
class JdbcSplit:
    """Reads a large table as ``partitions`` ranges of a numeric column."""

    column: str
    lower: int
    upper: int
    partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.partitions),
        }


def jdbc_read_options(
    connection: JdbcConnection,
    table: str,
    split: JdbcSplit | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    options = connection.options() | {"dbtable": table, "fetchsize": str(fetch_size)}
    return options | split.options() if split else options


def read_jdbc(
    spark: SparkSession,
    connection: JdbcConnection,
    table: str,
    split: JdbcSplit | None = None,
) -> DataFrame:
    options = jdbc_read_options(connection, table, split)
    return spark.read.format("jdbc").options(**options).load()


def quantile_query(table: str, column: str, partitions: int) -> str:
    """Asks the database for the smallest value of each of ``partitions`` parts of equally
    many rows: a row for each part."""
    return (
        f"SELECT MIN(v) AS bound FROM (SELECT {column} AS v, NTILE({partitions}) OVER "
        f"(ORDER BY {column}) AS part FROM {table} WHERE {column} IS NOT NULL) parts "
        "GROUP BY part ORDER BY 1"
    )


def split_predicates(column: str, bounds: Sequence[int]) -> list[str]:
    """Conditions of which each row, null values included, meets exactly one. ``bounds`` are
    where parts begin; repeated ones (a value with more rows than a part) count once."""
    inner = sorted(set(bounds))[1:]
    if not inner:
        return ["1 = 1"]
    ranges = [f"{column} >= {low} AND {column} < {high}" for low, high in pairwise(inner)]
    first = f"{column} < {inner[0]} OR {column} IS NULL"
    return [first, *ranges, f"{column} >= {inner[-1]}"]


def read_jdbc_evenly(
    spark: SparkSession,
    connection: JdbcConnection,
    table: str,
    column: str,
    partitions: int,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Reads a large table in parts of equally many rows by a whole-number column, whatever
    gaps and clusters its values have. The database is asked for the bounds first."""
    asked = connection.options() | {"query": quantile_query(table, column, partitions)}
    rows = spark.read.format("jdbc").options(**asked).load().collect()
    predicates = split_predicates(column, [int(row.bound) for row in rows])
    options = connection.options() | {"fetchsize": str(fetch_size)}
    url = options.pop("url")
    return spark.read.jdbc(url, table, predicates=predicates, properties=options)


def city_dimension(cities: DataFrame) -> DataFrame:
    """(city_id long, city_name, area); the database keeps the id as an int."""
    return cities.select(F.col("city_id").cast("long").alias("city_id"), "city_name", "area")
