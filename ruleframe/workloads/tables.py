"""Result tables, statistics and jobs over the given tables."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ruleframe.operators.derive import Rule
from ruleframe.operators.stats import analyze, profile, read_stats
from ruleframe.plans.jobs import run_aggregate, run_steps
from ruleframe.session import fresh_path, stage
from ruleframe.sources.rules import FILE_COLUMNS, publish_rules
from ruleframe.sources.tables import (
    create_table_from_rules,
    drop_table,
    read_back,
    write_result,
)
from ruleframe.workloads.data import register_tables, sql_file, table
from ruleframe.workloads.derivations import (
    FLAGSHIP_RULES,
    FLAGSHIP_SHOWN,
    FLAGSHIP_SOURCE,
    FLAGSHIP_SQL,
)
from ruleframe.workloads.registry import query


def _table_name() -> str:
    return f"ruleframe_{uuid.uuid4().hex}"


@query("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def write_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written twice, since the second run replaces table and files."""
    orders, name, location = table(spark, sf_dir, "orders"), _table_name(), fresh_path(spark, "out")
    write_result(orders.select("o_orderkey"), name, location)
    write_result(orders, name, location)
    by_table = spark.table(name).groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    by_path = read_back(spark, location).groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    both = stage(by_table.intersect(by_path))  # before the table goes
    drop_table(spark, name)
    return both


@query("SELECT o_orderstatus, 2 * count(*) AS n, count(*) AS before FROM orders GROUP BY o_orderstatus")
def write_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced by a result that reads it twice, once in a subquery, after a write that failed half-way."""
    name, location = _table_name(), fresh_path(spark, "out")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    write_result(orders, name, location, ("o_orderstatus",))
    fails = F.when(F.col("o_orderkey") % 100 == 1, F.raise_error(F.lit("killed"))).otherwise(F.col("o_orderkey"))
    try:
        write_result(orders.withColumn("o_orderkey", fails), name, location, ("o_orderstatus",))
    except Exception as error:  # noqa: BLE001 - the failure is the point
        if "killed" not in str(error):
            raise
    before = f"(SELECT count(*) FROM {name} AS b WHERE b.o_orderstatus = a.o_orderstatus) AS before"
    counted = spark.sql(f"SELECT o_orderkey, {before}, o_orderstatus FROM {name} AS a")
    write_result(counted.unionAll(counted).cache(), name, location, ("o_orderstatus",))
    found = stage(spark.table(name).groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.max("before").alias("before")))
    drop_table(spark, name)
    return found


@query("""
SELECT CAST(o_orderkey AS BIGINT) AS order_key, CAST(o_totalprice AS DOUBLE) AS total,
       o_orderstatus AS status FROM orders
""")
def table_from_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An external table whose columns are declared by rules, over files written before."""
    rules = [
        Rule(1, "order_key", "LONG", 0, "o_orderkey"),
        Rule(2, "total", "DOUBLE", 0, "o_totalprice"),
        Rule(3, "status", "STRING", 1, "o_orderstatus"),
    ]
    location, name = fresh_path(spark, "out"), _table_name()
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS order_key", "o_totalprice AS total", "o_orderstatus AS status"
    )
    orders.write.parquet(location)
    create_table_from_rules(spark, name, stored_rules(spark, "orders", rules), location)
    return spark.table(name)


def stored_rules(spark: SparkSession, name: str, rules: list[Rule]) -> DataFrame:
    """Rules of one table as rows of a rules table."""
    rows = [
        (r.seq_no, name, name, r.column, r.type, str(r.level), r.expression, None, None, "1")
        for r in rules
    ]
    columns = ", ".join(f"{column} STRING" for column in FILE_COLUMNS)
    return spark.createDataFrame(rows, f"seq_no INT, {columns}")


STATS_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus"]


def _analyzed_orders(spark: SparkSession, sf_dir: str) -> str:
    name = _table_name()
    orders = table(spark, sf_dir, "orders")
    write_result(orders, name, fresh_path(spark, "out"), ("o_orderpriority",))
    analyze(spark, name)
    analyze(spark, name, ["o_orderpriority"], STATS_COLUMNS)
    return name


def _stored_statistics(column: str, least: str, most: str, length: str, extra: str = "") -> str:
    rows = {"min": least, "max": most, "num_nulls": f"count(*) - count({column})", "avg_col_len": length, "max_col_len": length}
    return " ".join(
        f"UNION ALL SELECT '{column}', '{name}', CAST({value} AS VARCHAR) FROM orders" for name, value in rows.items()
    ) + extra


@query(
    "SELECT CAST(NULL AS VARCHAR) AS column_name, 'size' AS statistic, concat(count(*), ' rows') AS value FROM orders "
    + " ".join(_stored_statistics(c, f"min({c})", f"max({c})", "max(8)") for c in ("o_orderkey", "o_custkey"))
    + " " + _stored_statistics(
        "o_orderstatus", "'NULL'", "'NULL'", "max(length(o_orderstatus))",
        " UNION ALL SELECT 'o_orderstatus', 'distinct_count', CAST(count(DISTINCT o_orderstatus) AS VARCHAR) FROM orders",
    ).replace("CAST('NULL' AS VARCHAR) FROM orders", "'NULL'")
)
def table_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All statistics of a written table, but for its size in bytes, which depends on the writer, and the distinct
    counts of its keys, which Spark estimates."""
    stats = read_stats(spark, _analyzed_orders(spark, sf_dir), STATS_COLUMNS)
    exact = stats.where("statistic <> 'distinct_count' OR column_name = 'o_orderstatus'")
    return exact.withColumn("value", F.regexp_replace("value", "^[0-9]+ bytes, ", ""))


def _row_count() -> Column:
    """The row count in a catalog text like "9 bytes, 5 rows"."""
    return F.regexp_extract("value", r"(\d+) rows", 1).cast("long").alias("row_count")


@query("SELECT count(*) AS row_count FROM orders")
def table_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a written table, as its catalog statistics have them."""
    name = _table_name()
    write_result(table(spark, sf_dir, "orders"), name, fresh_path(spark, "orders"))
    analyze(spark, name)
    stats = read_stats(spark, name)
    return stats.select(_row_count())


@query("SELECT o_orderpriority, count(*) AS row_count FROM orders GROUP BY o_orderpriority")
def partition_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each partition of a written table, as its catalog statistics have them."""
    name = _analyzed_orders(spark, sf_dir)
    priorities = spark.table(name).select("o_orderpriority").distinct().collect()
    counts = []
    for (priority,) in priorities:  # one row per partition of the catalog
        stats = read_stats(spark, name, partition=[f"o_orderpriority='{priority}'"])
        counts.append(stats.select(F.lit(priority).alias("o_orderpriority"), _row_count()))
    return reduce(DataFrame.unionByName, counts)


@query("""
SELECT 'o_orderkey' AS column_name, 'min' AS statistic, CAST(min(o_orderkey) AS VARCHAR) AS value
FROM orders
UNION ALL SELECT 'o_orderkey', 'max', CAST(max(o_orderkey) AS VARCHAR) FROM orders
UNION ALL SELECT 'o_custkey', 'min', CAST(min(o_custkey) AS VARCHAR) FROM orders
UNION ALL SELECT 'o_custkey', 'max', CAST(max(o_custkey) AS VARCHAR) FROM orders
UNION ALL SELECT 'o_orderstatus', 'distinct_count', CAST(count(DISTINCT o_orderstatus) AS VARCHAR)
FROM orders
UNION ALL SELECT 'o_orderstatus', 'num_nulls', CAST(count(*) - count(o_orderstatus) AS VARCHAR)
FROM orders
""")
def column_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact ones among the stored statistics."""
    stats = read_stats(spark, _analyzed_orders(spark, sf_dir), STATS_COLUMNS)
    return stats.filter(
        "statistic IN ('min', 'max') AND column_name <> 'o_orderstatus'"
        " OR statistic IN ('distinct_count', 'num_nulls') AND column_name = 'o_orderstatus'"
    )


def _profile(column: str, source: str) -> str:
    return f"""
SELECT '{column}' AS column_name, count(*) AS row_count, count(*) - count({column}) AS num_nulls,
       count(DISTINCT {column}) AS distinct_count, CAST(min({column}) AS VARCHAR) AS min,
       CAST(max({column}) AS VARCHAR) AS max, avg(length(CAST({column} AS VARCHAR))) AS avg_col_len,
       CAST(max(length(CAST({column} AS VARCHAR))) AS INTEGER) AS max_col_len
FROM {source}
"""


@query(
    " UNION ALL ".join(
        _profile(c, "(SELECT *, nullif(event_type, 'view') AS kind FROM events)")
        for c in ("user_id", "event_type", "kind", "props")
    )
)
def profile_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("kind", F.expr("nullif(event_type, 'view')"))
    return profile(events, ["user_id", "event_type", "kind", "props"])


def _published(spark: SparkSession, name: str, rules: list[Rule]) -> str:
    path = fresh_path(spark, "published")
    publish_rules(stored_rules(spark, name, rules), path)
    return path


@query(FLAGSHIP_SQL)
def job_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship as a stored job: SQL file, published rules, result table, read back."""
    register_tables(spark, sf_dir, FLAGSHIP_SOURCE)
    step = {
        "type": "aggregator", "seq": 1, "sqlfile": sql_file(spark, FLAGSHIP_SOURCE),
        "viewname": "flagship_view", "numpartition": 0, "tablename": _table_name(),
        "location": fresh_path(spark, "out"), "levels": "0,3", "rulestable": "FLAT_lines",
        "rules": _published(spark, "flat_lines", FLAGSHIP_RULES),
    }
    return run_aggregate(spark, step).selectExpr(*FLAGSHIP_SHOWN)


@query("""
SELECT c_mktsegment, count(*) AS customers, CAST(sum(order_count) AS BIGINT) AS orders
FROM (SELECT c_custkey, c_mktsegment, count(o_orderkey) AS order_count
      FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_mktsegment)
WHERE order_count > 9 GROUP BY c_mktsegment
""")
def job_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View, derived table, statistics and a closing query, as four steps."""
    prepare = """
      CREATE OR REPLACE TEMPORARY VIEW customer_orders AS -- one row per customer
      SELECT c_custkey, c_mktsegment, count(o_orderkey) AS order_count
      FROM customer LEFT JOIN orders ON c_custkey = o_custkey
      GROUP BY c_custkey, c_mktsegment
    """
    register_tables(spark, sf_dir, prepare)
    rules = [
        Rule(1, "segment", "STRING", 0, "job_view.c_mktsegment"),
        Rule(2, "order_count", "BIGINT", 0, "order_count"),
        Rule(3, "keen", "BOOLEAN", 1, "order_count > 9"),
        Rule(4, "customers", "BIGINT", 2, "count(*) OVER (PARTITION BY segment, keen)"),
        Rule(5, "orders", "BIGINT", 2, "sum(order_count) OVER (PARTITION BY segment, keen)"),
    ]
    name = _table_name()
    report = f"SELECT DISTINCT segment AS c_mktsegment, customers, orders FROM {name} WHERE keen"
    steps = [
        {"type": "execsql", "seq": 1, "sqlfile": sql_file(spark, prepare)},
        {
            "type": "aggregator", "seq": 2, "viewname": "job_view", "numpartition": 4,
            "sqlfile": sql_file(spark, "SELECT * FROM customer_orders"), "levels": "0,12",
            "tablename": name, "location": fresh_path(spark, "out"),
            "maprdbtablepath": _published(spark, "t", rules), "maprdbtablefilter": "T",
        },
        {"type": "analyze", "seq": 3, "tablename": name, "columns": ["segment"]},
        {"type": "execsql", "seq": 4, "sqlfile": sql_file(spark, report)},
    ]
    return run_steps(spark, steps)[-1]
