"""Run queries on Spark and on DuckDB and compare all rows exactly.

``python -m checks.compare SF_DIR [QUERY ...]``
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TYPES = {
    "bigint": "BIGINT",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "double": "DOUBLE",
    "int": "INTEGER",
    "string": "VARCHAR",
    "timestamp": "TIMESTAMP",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def _rows(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(frame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both results are equal, else what differs."""
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    wanted = {column[0]: str(column[1]) for column in result.description}
    kinds = {name: TYPES.get(kind, kind) for name, kind in frame.dtypes}
    if wanted != kinds:
        return f"types {sorted(set(kinds.items()) ^ set(wanted.items()))}"
    expected = _rows(names, result.fetchall())
    actual = _rows(frame.columns, frame.collect())
    if expected == actual:
        return None
    missing, extra = list((expected - actual).items()), list((actual - expected).items())
    return (
        f"{sorted(names)}: {sum(actual.values())} rows for {sum(expected.values())}, "
        f"{len(missing)} missing like {missing[:2]}, {len(extra)} extra like {extra[:2]}"
    )


def main(sf_dir: str, wanted: list[str]) -> int:
    from checks.oracle import ORACLE_SQL
    from checks.queries import QUERIES
    from plantmetrics.session import build_session
    from plantmetrics.sources import clear_scratch

    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(sf_dir)
    failed = 0
    for name in wanted or QUERIES:
        start = time.monotonic()
        try:
            found = difference(QUERIES[name](spark, sf_dir), connection, ORACLE_SQL[name])
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += found is not None
        print(f"{'FAIL' if found else 'ok  '} {name} {time.monotonic() - start:.1f}s {found or ''}", flush=True)
    print("unmatched:", set(QUERIES) ^ set(ORACLE_SQL), "failed:", failed)
    clear_scratch(spark)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
