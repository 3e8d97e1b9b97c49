"""Runs a job for a stored task: ``python -m trailmark session --task-id 1 ...``.

A table is named as in the catalog, as a parquet path (with a slash) or as
``jdbc:TABLE``; results go to a folder, to ``catalog:DATABASE`` or to ``jdbc:``.
The database password is read from the JDBC_PASSWORD environment variable.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession

from trailmark.operators.ads import THRESHOLD
from trailmark.operators.sampling import DEFAULT_TOTAL
from trailmark.plans import area_top_products, page_funnel, session_analysis
from trailmark.session import build_session, stream_session
from trailmark.sinks.results import (
    CatalogTarget,
    FileTarget,
    JdbcTarget,
    Target,
    write_actions,
    write_bucketed_actions,
)
from trailmark.sources.actions import read_table
from trailmark.sources.click_log import read_file_lines, read_kafka_lines
from trailmark.sources.dimensions import (
    JdbcConnection,
    JdbcSplit,
    read_jdbc,
    read_jdbc_evenly,
)
from trailmark.sources.tasks import find_task
from trailmark.streaming.ad_blacklist import AdBlacklistStream

_JDBC = "jdbc:"
_CATALOG = "catalog:"


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(
        prog="trailmark", description=__doc__, formatter_class=argparse.RawTextHelpFormatter
    )
    parser.add_argument("--hive", action="store_true", help="use the cluster's Hive metastore")
    jobs = parser.add_subparsers(dest="job", required=True)
    database = argparse.ArgumentParser(add_help=False)
    database.add_argument("--jdbc-url")
    database.add_argument("--jdbc-user")
    database.add_argument("--jdbc-driver")
    database.add_argument(
        "--jdbc-split",
        action="append",
        default=[],
        metavar="TABLE=COLUMN,LOWER,UPPER,PARTITIONS",
        help="read a large table in so many ranges of a numeric column",
    )
    database.add_argument(
        "--jdbc-even",
        action="append",
        default=[],
        metavar="TABLE=COLUMN,PARTITIONS",
        help="read a large table in parts of equally many rows, by bounds the database is\n"
        "asked for",
    )

    for job in ("session", "page", "product"):
        task = jobs.add_parser(job, parents=[database])
        task.add_argument("--task-id", type=int, required=True)
        task.add_argument("--tasks", default="task")
        task.add_argument("--actions", default="user_visit_action")
        task.add_argument("--out", required=True)
        task.add_argument(
            "--mode",
            default="replace",
            choices=["replace", "append", "overwrite"],
            help="replace what the task wrote before, in all tables at once (default),\n"
            "append to the tables, or overwrite them",
        )
    session = jobs.choices["session"]
    session.add_argument("--users", default="user_info")
    session.add_argument("--sample", type=int, default=DEFAULT_TOTAL)
    session.add_argument("--seed", default="0")
    session.add_argument(
        "--plain-detail",
        action="store_true",
        help="session detail without the columns source and top_category_id",
    )
    product = jobs.choices["product"]
    product.add_argument("--cities", default="city_info")
    product.add_argument("--products", default="product_info")
    product.add_argument(
        "--by-day", action="store_true", help="update_date is the day of the action's time"
    )

    store = jobs.add_parser("store", help="write an action log in the layout the jobs read best")
    store.add_argument("--actions", required=True)
    kind = store.add_mutually_exclusive_group(required=True)
    kind.add_argument("--path", help="folder: days, with an index by session")
    kind.add_argument("--table", help="catalog table: days, in buckets by session")
    store.add_argument("--buckets", type=int, default=512, help="with --table")

    ads = jobs.add_parser("ads")
    ads.add_argument("--root", required=True, help="folder for counts, blacklist, checkpoint")
    source = ads.add_mutually_exclusive_group(required=True)
    source.add_argument("--kafka", help="bootstrap servers")
    source.add_argument("--files", help="folder of log files")
    ads.add_argument("--topics", default="", help="comma list, with --kafka")
    ads.add_argument("--threshold", type=int, default=THRESHOLD)
    ads.add_argument("--max-offsets", type=int, help="most lines of a batch, with --kafka")
    ads.add_argument("--keep-days", type=int, help="drop a day's state when it is this old")
    ads.add_argument("--state-partitions", type=int, help="fixed when the stream first starts")
    ads.add_argument("--available-now", action="store_true", help="stop when all is read")

    export = jobs.add_parser("ads-export", parents=[database])
    export.add_argument("--root", required=True)
    export.add_argument("--out", required=True)
    return parser


def _connection(options: argparse.Namespace) -> JdbcConnection:
    if not options.jdbc_url:
        raise SystemExit("jdbc: needs --jdbc-url")
    password = os.environ.get("JDBC_PASSWORD")
    return JdbcConnection(options.jdbc_url, options.jdbc_user, password, options.jdbc_driver)


def _split(options: argparse.Namespace, table: str) -> JdbcSplit | None:
    for text in options.jdbc_split:
        name, _, parts = text.partition("=")
        if name == table:
            try:
                column, lower, upper, partitions = parts.split(",")
                return JdbcSplit(column, int(lower), int(upper), int(partitions))
            except ValueError:
                raise SystemExit(f"--jdbc-split: cannot read {text!r}") from None
    return None


def _source(spark: SparkSession, name: str, options: argparse.Namespace) -> DataFrame:
    if name.startswith(_JDBC):
        table = name.removeprefix(_JDBC)
        for text in options.jdbc_even:
            named, _, how = text.partition("=")
            column, _, parts = how.partition(",")
            if named == table:
                return read_jdbc_evenly(spark, _connection(options), table, column, int(parts))
        return read_jdbc(spark, _connection(options), table, _split(options, table))
    return read_table(spark, name)


def _target(options: argparse.Namespace) -> Target:
    if options.out.startswith(_JDBC):
        return JdbcTarget(_connection(options))
    if options.out.startswith(_CATALOG):
        return CatalogTarget(options.out.removeprefix(_CATALOG))
    return FileTarget(options.out)


def _run_ads(spark: SparkSession, options: argparse.Namespace) -> None:
    session = stream_session(spark, options.state_partitions)
    if options.kafka:
        topics, most = options.topics.split(","), options.max_offsets
        lines = read_kafka_lines(session, options.kafka, topics, max_offsets=most)
    else:
        lines = read_file_lines(session, options.files)
    stream = AdBlacklistStream(
        spark, options.root, options.threshold, keep_days=options.keep_days
    )
    running = [
        stream.start(lines, options.available_now),
        stream.start_quarantine(lines, options.available_now),
    ]
    if options.available_now:
        for query in running:
            query.awaitTermination()
    else:
        session.streams.awaitAnyTermination()


def _run_task(spark: SparkSession, options: argparse.Namespace) -> None:
    target, mode = _target(options), options.mode
    params = find_task(_source(spark, options.tasks, options), options.task_id)
    actions = read_table(spark, options.actions)
    if options.job == "session":
        users = _source(spark, options.users, options)
        total, seed = options.sample, options.seed
        told = not options.plain_detail
        session_analysis.run(actions, users, params, target, total, seed, mode, told)
    elif options.job == "page":
        page_funnel.run(actions, params, target, mode)
    else:
        cities = _source(spark, options.cities, options)
        products = _source(spark, options.products, options)
        by_day = options.by_day
        area_top_products.run(actions, cities, products, params, target, mode, by_day)


def main(argv: list[str] | None = None) -> None:
    options = _arguments().parse_args(argv)
    spark = build_session(f"trailmark-{options.job}", hive=options.hive)
    if options.job == "ads":
        _run_ads(spark, options)
    elif options.job == "store":
        actions = read_table(spark, options.actions)
        if options.path:
            write_actions(actions, options.path)
        else:
            write_bucketed_actions(actions, options.table, options.buckets)
    elif options.job == "ads-export":
        AdBlacklistStream(spark, options.root).export(_target(options))
    else:
        _run_task(spark, options)


if __name__ == "__main__":
    main()
