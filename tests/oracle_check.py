"""Run queries and their SQL counterparts side by side.

Usage: python tests/oracle_check.py [folder of parquet tables] [query ...]
"""

from __future__ import annotations

import datetime
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


def connect(folder: str):
    import duckdb

    connection = duckdb.connect()
    for table in TABLES:
        path = Path(folder) / f"{table}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.date):
        return value.isoformat()
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, connection, sql: str) -> list[str]:
    """What differs between a DataFrame and a statement; empty when they agree."""
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    types = dict(zip(names, (str(d[1]) for d in cursor.description), strict=True))
    expected = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    found = [
        f"type of {f.name}: {f.dataType.simpleString()} != {types[f.name]}"
        for f in df.schema.fields
        if TYPES.get(f.dataType.simpleString()) != types[f.name]
    ]
    actual = rows_of(df.columns, df.collect())
    if len(actual) != len(expected):
        found.append(f"{len(actual)} rows != {len(expected)}")
    elif actual != expected:
        wrong = [(a, e) for a, e in zip(actual, expected, strict=True) if a != e]
        found.append(f"{len(wrong)} rows differ, such as {wrong[:2]}")
    return found


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__
    from touchline.registry import drop_databases
    from touchline.sources.workspace import clear_workspace

    QUERIES, ORACLES = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    failures = 0
    for key in wanted:
        began = time.time()
        try:
            if key in ORACLES:
                found = differences(QUERIES[key](spark, folder), connection, ORACLES[key])
            else:
                found = [] if QUERIES[key](spark, folder).count() else ["no rows"]
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        drop_databases(spark)
        clear_workspace(spark)
        failures += bool(found)
        kind = "ok" if key in ORACLES else "ok (rows only)"
        print(f"{key:24s} {time.time() - began:6.1f}s {'; '.join(found) or kind}", flush=True)
    print(f"{len(wanted) - failures} of {len(wanted)} agree")
    return failures


if __name__ == "__main__":
    sys.exit(main())
