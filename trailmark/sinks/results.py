"""Where finished reports go."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

from trailmark.sinks.task_reports import TaskReports
from trailmark.sources.dimensions import JdbcConnection

# (result table, rows) pairs of a task.
Reports = Sequence[tuple[str, DataFrame]]

# Names of the result tables.
SESSION_AGGR_STAT = "session_aggr_stat"
SESSION_RANDOM_EXTRACT = "session_random_extract"
SESSION_DETAIL = "session_detail"
TOP10_CATEGORY = "top10_category"
TOP10_CATEGORY_SESSION = "top10_category_session"
PAGE_SPLIT_CONVERT_RATE = "page_split_convert_rate"
AREA_TOP3_PRODUCT = "area_top3_product"
AD_USER_CLICK_COUNT = "ad_user_click_count"
AD_BLACKLIST = "ad_blacklist"


@dataclass(frozen=True)
class FileTarget:
    """Result tables as folders below ``root``."""

    root: str
    file_format: str = "parquet"

    def spread(self, df: DataFrame) -> DataFrame:
        return df.hint("rebalance")

    def save(self, writer: DataFrameWriter, table: str) -> None:
        writer.format(self.file_format).save(f"{self.root.rstrip('/')}/{table}")

    def replace(self, task_id: int, reports: Reports) -> None:
        """All tables become visible at once; ``read_report`` reads them."""
        TaskReports(reports[0][1].sparkSession, self.root, self.file_format).write(task_id, reports)


@dataclass(frozen=True)
class CatalogTarget:
    """Result tables in a catalog database."""

    database: str = "default"

    def spread(self, df: DataFrame) -> DataFrame:
        return df.hint("rebalance")

    def save(self, writer: DataFrameWriter, table: str) -> None:
        writer.saveAsTable(f"{self.database}.{table}")

    def replace(self, task_id: int, reports: Reports) -> None:
        """Each table's partition of the task is replaced as a whole, one table after the
        other: a rerun doubles nothing, but a catalog has no commit across tables."""
        for table, rows in _by_table(reports):
            name = f"{self.database}.{table}"
            last = [c for c in rows.columns if c != "task_id"] + ["task_id"]
            rows = self.spread(rows).select(*last)
            if rows.sparkSession.catalog.tableExists(name):
                writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                writer.insertInto(name)
            else:
                rows.write.partitionBy("task_id").saveAsTable(name)


@dataclass(frozen=True)
class JdbcTarget:
    """Result tables in a database, inserted in batches by the executors."""

    connection: JdbcConnection
    batch_size: int = 5_000
    connections: int = 10
    extra: dict[str, str] = field(default_factory=dict)

    def options(self, table: str) -> dict[str, str]:
        return (
            self.connection.options()
            | {
                "dbtable": table,
                "batchsize": str(self.batch_size),
                "numPartitions": str(self.connections),
            }
            | self.extra
        )

    def spread(self, df: DataFrame) -> DataFrame:
        """Rows of a report moved to as many tasks as there are connections. Spark would
        otherwise run the scan behind them in that few tasks."""
        return df.repartition(self.connections)

    def save(self, writer: DataFrameWriter, table: str) -> None:
        writer.format("jdbc").options(**self.options(table)).save()

    def replace(self, task_id: int, reports: Reports) -> None:
        """Executors fill staging tables; one transaction then replaces the task's rows in
        all tables."""
        statements = []
        for table, rows in _by_table(reports):
            staging = f"{table}_staging"
            self.save(self.spread(rows).write.mode("overwrite").option("truncate", "true"), staging)
            statements += replace_statements(table, staging, task_id, rows.columns)
        spark = reports[0][1].sparkSession
        self.transaction(spark, statements)

    def upsert(self, df: DataFrame, table: str, keys: Sequence[str], batch_id: int) -> None:
        """Replaces the rows of the given keys: executors fill a staging table, and one
        transaction merges it and moves the table's fence to ``batch_id``. A batch that the
        fence has passed changes nothing."""
        staging = f"{table}_staging"
        self.save(self.spread(df).write.mode("overwrite").option("truncate", "true"), staging)
        merge = merge_statement(self.connection.url, table, staging, keys, df.columns)
        self.transaction(df.sparkSession, [merge], fence_statement(table, batch_id))

    def transaction(
        self, spark: SparkSession, statements: Sequence[str], fence: str | None = None
    ) -> bool:
        """Runs all statements or none; none if there is a ``fence`` that updates no row."""
        options = self.connection.options()
        jvm = spark._jvm
        if self.connection.driver:
            registry = jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry
            registry.register(self.connection.driver)
        properties = jvm.java.util.Properties()
        for key in ("user", "password"):
            if key in options:
                properties.setProperty(key, options[key])
        connection = jvm.java.sql.DriverManager.getConnection(options["url"], properties)
        try:
            connection.setAutoCommit(False)
            statement = connection.createStatement()
            passed = fence is None or statement.executeUpdate(fence) > 0
            if passed:
                for text in statements:
                    statement.executeUpdate(text)
                connection.commit()
            else:
                connection.rollback()
            return passed
        finally:
            connection.close()


# Holds the last batch applied to each table (table_name, batch_id); made by the caller.
FENCES = "trailmark_batches"


def fence_statement(table: str, batch_id: int) -> str:
    return (
        f"UPDATE {FENCES} SET batch_id = {batch_id} "
        f"WHERE table_name = '{table}' AND batch_id < {batch_id}"
    )


def replace_statements(
    table: str, staging: str, task_id: int, columns: Sequence[str]
) -> list[str]:
    names = ", ".join(columns)
    return [
        f"DELETE FROM {table} WHERE task_id = {task_id}",
        f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging}",
    ]


def merge_statement(
    url: str, table: str, staging: str, keys: Sequence[str], columns: Sequence[str]
) -> str:
    """One statement that takes the rows of ``staging`` over by key, as the database at
    ``url`` has it."""
    names = ", ".join(columns)
    values = [name for name in columns if name not in keys]
    if url.startswith(("jdbc:mysql:", "jdbc:mariadb:")):
        changed = [f"{name} = VALUES({name})" for name in values] or [f"{keys[0]} = {table}.{keys[0]}"]
        return (
            f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} "
            f"ON DUPLICATE KEY UPDATE {', '.join(changed)}"
        )
    if url.startswith(("jdbc:postgresql:", "jdbc:sqlite:")):
        changed = ", ".join(f"{name} = excluded.{name}" for name in values)
        return (
            f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} WHERE true "
            f"ON CONFLICT ({', '.join(keys)}) DO {f'UPDATE SET {changed}' if values else 'NOTHING'}"
        )
    on = " AND ".join(f"t.{key} = s.{key}" for key in keys)
    changed = ", ".join(f"{name} = s.{name}" for name in values)
    update = f"WHEN MATCHED THEN UPDATE SET {changed} " if values else ""
    return (
        f"MERGE INTO {table} t USING {staging} s ON ({on}) {update}"
        f"WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({', '.join(f's.{n}' for n in columns)})"
    )


Target = FileTarget | CatalogTarget | JdbcTarget


def write_reports(reports: Reports, target: Target, task_id: int, mode: str = "replace") -> None:
    """Writes a task's reports. ``replace``: they take the place of what the task wrote
    before, at once. ``append`` and ``overwrite`` (of whole tables) write one after the
    other; rows of a table that is named twice are added up in each mode."""
    if mode == "replace":
        target.replace(task_id, reports)
        return
    written: set[str] = set()
    for table, rows in reports:
        write_result(rows, target, table, "append" if table in written else mode)
        written.add(table)


def read_report(spark: SparkSession, target: FileTarget, table: str) -> DataFrame:
    """What all finished tasks reported to ``table`` with ``replace``."""
    return TaskReports(spark, target.root, target.file_format).read(table)


def _by_table(reports: Reports) -> list[tuple[str, DataFrame]]:
    """Pairs with each table once."""
    merged: dict[str, DataFrame] = {}
    for table, rows in reports:
        merged[table] = merged[table].unionByName(rows) if table in merged else rows
    return list(merged.items())


def write_result(df: DataFrame, target: Target, table: str, mode: str = "append") -> None:
    """A report is a small part of what its scan reads, so its rows move once before they
    are written: into few files, or over the database's connections."""
    target.save(target.spread(df).write.mode(mode), table)


# The column that lookups of single sessions use; each row group tells by a Bloom filter,
# sized by the values it holds, which ones it can have.
INDEXED = "session_id"
INDEX_OPTIONS = {
    f"parquet.bloom.filter.enabled#{INDEXED}": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
}


def write_actions(
    actions: DataFrame, path: str, mode: str = "overwrite", options: dict[str, str] | None = None
) -> None:
    """The action log as parquet partitioned by day, the layout date scans prune, with the
    actions of a session next to each other and an index by session.

    Rows are rebalanced by day first: few files per day, and adaptive execution splits a
    day that is too large for one task. A lookup by session then reads the row groups
    whose Bloom filters may hold it.
    """
    spread = actions.hint("rebalance", "update_date")
    ordered = spread.sortWithinPartitions("update_date", INDEXED)
    writer = ordered.write.mode(mode).options(**INDEX_OPTIONS | (options or {}))
    writer.partitionBy("update_date").parquet(path)


def write_bucketed_actions(
    actions: DataFrame, table: str, buckets: int, mode: str = "overwrite", by_day: bool = True
) -> None:
    """The action log as a catalog table in buckets by session, sorted by session inside.

    Rows move once, here; rollups, joins and windows by session then start from rows that
    lie together and exchange nothing. ``by_day`` keeps days as folders, so that date scans
    still prune them, at a file for each day and bucket. A bucket is read by one task: for
    sessions of a size no task can take, keep ``write_actions``.
    """
    dealt = actions.repartition(buckets, INDEXED)
    writer = dealt.write.mode(mode).options(**INDEX_OPTIONS)
    if by_day:
        writer = writer.partitionBy("update_date")
    writer.bucketBy(buckets, INDEXED).sortBy(INDEXED).saveAsTable(table)
