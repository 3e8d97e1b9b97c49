"""Runs the registered queries next to their SQL twins and compares whole results."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

_KINDS = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def oracle_rows(folder: str, sql: str) -> tuple[list[str], list[str], list[tuple]]:
    with duckdb.connect() as connection:
        for table in TABLES:
            connection.execute(
                f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'"
            )
        cursor = connection.execute(sql)
        names = [column[0] for column in cursor.description]
        kinds = [str(column[1]) for column in cursor.description]
        return names, kinds, cursor.fetchall()


def _cell(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else value


def _bag(names: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(df, folder: str, sql: str) -> list[str]:
    """What differs between a frame and its SQL twin: names, types or rows."""
    names, kinds, expected = oracle_rows(folder, sql)
    found = [tuple(row) for row in df.collect()]
    problems = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    oracle_kinds = dict(zip(names, kinds))
    for name, kind in df.dtypes:
        if _KINDS.get(kind, kind) != oracle_kinds[name]:
            problems.append(f"type of {name}: {kind} != {oracle_kinds[name]}")
    ours, theirs = _bag(df.columns, found), _bag(names, expected)
    if len(found) != len(expected):
        problems.append(f"rows {len(found)} != {len(expected)}")
    if ours != theirs:
        problems.append(f"only here {list((ours - theirs).items())[:3]}")
        problems.append(f"only there {list((theirs - ours).items())[:3]}")
    if not expected:
        problems.append("empty result proves nothing")
    return problems


def main(folder: str, wanted: list[str]) -> int:
    import __spark_entry__ as contract
    from tests.conftest import make_session

    spark = make_session()
    sqls, failed = contract.oracle_sql(), 0
    for name, query in contract.queries().items():
        if name not in sqls or (wanted and name not in wanted):
            continue
        started = time.time()
        try:
            problems = differences(query(spark, folder), folder, sqls[name])
        except Exception as error:  # report every query, not only the first bad one
            problems = [str(error)[:800]]
        failed += bool(problems)
        state = "FAIL" if problems else "ok"
        print(f"{state:4} {time.time() - started:6.2f}s {name}", *problems, sep="\n     ")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
