"""Run registered queries and their comparison SQL side by side.

    python tests/compare.py [folder] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__  # noqa: E402
from ruleframe.workloads.data import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, list):
        return tuple(_plain(v) for v in value)
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark, con, name: str, sf_dir: str) -> str | None:
    """None when both sides agree, else what differs."""
    df = __spark_entry__.queries()[name](spark, sf_dir)
    mine = [tuple(r) for r in df.collect()]
    sql = __spark_entry__.oracle_sql().get(name)
    if sql is None:
        return None if mine else "no rows"
    result = con.execute(sql)
    columns, types = zip(*[(d[0], str(d[1])) for d in result.description])
    theirs = result.fetchall()
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    a, b = rows_of(df.columns, mine), rows_of(columns, theirs)
    if a != b:
        return f"{len(mine)} rows, {len(theirs)} expected; e.g. {list((a - b))[:2]} != {list((b - a))[:2]}"
    arrow = dict(zip(columns, types))
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema}
    names = {
        "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
        "boolean": "BOOLEAN", "date": "DATE", "tinyint": "TINYINT", "timestamp_ntz": "TIMESTAMP",
    }
    odd = {
        c: (spark_types[c], arrow[c])
        for c in columns
        if names.get(spark_types[c], spark_types[c].upper()) != arrow[c]
    }
    if odd:
        return f"types {odd}"
    return None if mine else "no rows on either side"


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    con = duck(folder)
    bad = 0
    for name in sys.argv[2:] or __spark_entry__.queries():
        start = time.time()
        try:
            wrong = difference(session, con, name, folder)
        except Exception as error:  # noqa: BLE001
            wrong = f"{type(error).__name__}: {str(error)[:600]}"
        bad += wrong is not None
        print(f"{time.time() - start:6.2f}s {name}: {wrong or 'ok'}", flush=True)
    print("failed:", bad)
