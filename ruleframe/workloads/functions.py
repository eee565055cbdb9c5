"""Most common value, weighted average and joined text over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ruleframe.functions.aggregates import (
    collect_ws,
    most_common,
    most_common_by,
    register_functions,
    weighted_average,
)
from ruleframe.workloads.data import table
from ruleframe.workloads.registry import query


def _usual(keys: str, value: str, source: str) -> str:
    return f"""
SELECT {keys}, value AS most_common FROM (
  SELECT {keys}, {value} AS value, row_number() OVER (
    PARTITION BY {keys} ORDER BY count({value}) DESC, {value}) AS rn
  FROM {source} GROUP BY {keys}, {value}) WHERE rn = 1
"""


@query(_usual("l_suppkey", "l_returnflag", "lineitem"))
def most_common_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.groupBy("l_suppkey").agg(most_common("l_returnflag").alias("most_common"))


@query(_usual("user_id", "event_type", "events"))
def most_common_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many ties among few values."""
    events = table(spark, sf_dir, "events")
    return events.groupBy("user_id").agg(most_common("event_type").alias("most_common"))


@query(_usual("event_type", "CAST(user_id AS VARCHAR)", "events"))
def most_common_by_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few keys with many values, counted in two steps."""
    return most_common_by(table(spark, sf_dir, "events"), ["event_type"], "user_id")


@query(
    _usual(
        "source", "nullif(nullif(nullif(lang, 'en'), 'fr'), 'de')", "documents"
    )
)
def most_common_by_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups whose only value is null give null."""
    rare = F.expr("nullif(nullif(nullif(lang, 'en'), 'fr'), 'de')")
    return most_common_by(table(spark, sf_dir, "documents"), ["source"], rare)


_SUPPLIER_AVERAGE = """
SELECT l_suppkey, CAST({total} AS DOUBLE) / CAST({weights} AS DOUBLE) AS average
FROM (SELECT l_suppkey, CAST(nullif(l_discount, 0) AS DECIMAL(12,2)) AS w,
             CAST(nullif(l_quantity, 7) AS DECIMAL(12,2)) AS v FROM lineitem)
GROUP BY l_suppkey
"""


def _with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey", "nullif(l_discount, 0D) AS w", "nullif(l_quantity, 7D) AS v"
    )


@query("""
SELECT l_suppkey, sum(l_quantity * l_linenumber) / sum(l_quantity) AS average
FROM lineitem GROUP BY l_suppkey
""")
def weighted_average_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    average = weighted_average("l_quantity", "l_linenumber").alias("average")
    return lines.groupBy("l_suppkey").agg(average)


@query(
    _SUPPLIER_AVERAGE.format(
        total="sum(coalesce(w, 0) * coalesce(v, 0))", weights="sum(coalesce(w, 0))"
    )
)
def weighted_average_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    average = weighted_average("w", "v", number_type="decimal(12,2)").alias("average")
    return _with_nulls(spark, sf_dir).groupBy("l_suppkey").agg(average)


@query(
    _SUPPLIER_AVERAGE.format(
        total="sum(w * v)", weights="sum(w) FILTER (WHERE v IS NOT NULL)"
    )
)
def weighted_average_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    average = weighted_average("w", "v", "skip", "decimal(12,2)").alias("average")
    return _with_nulls(spark, sf_dir).groupBy("l_suppkey").agg(average)


@query("""
SELECT user_id, CASE WHEN w <> 0 THEN wv / w WHEN wv > 0 THEN CAST('inf' AS DOUBLE)
                     WHEN wv < 0 THEN CAST('-inf' AS DOUBLE) END AS average
FROM (SELECT user_id, sum(w) AS w, sum(w * v) AS wv
      FROM (SELECT user_id, CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN -1 ELSE 0 END
                            AS DOUBLE) AS w,
                   CAST(event_id % 100 AS DOUBLE) AS v FROM events)
      GROUP BY user_id)
""")
def weighted_average_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights that cancel out give an infinite average, or null."""
    weight = F.expr("CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN -1 ELSE 0 END")
    average = weighted_average(weight, F.col("event_id") % 100).alias("average")
    return table(spark, sf_dir, "events").groupBy("user_id").agg(average)


@query("""
SELECT l_shipyear, l_returnflag, lines,
       sum(lines * l_shipyear) OVER w / sum(lines) OVER w AS mean_year
FROM (SELECT year(l_shipdate) AS l_shipyear, l_returnflag, CAST(count(*) AS DOUBLE) AS lines
      FROM lineitem GROUP BY ALL)
WINDOW w AS (PARTITION BY l_returnflag ORDER BY l_shipyear)
""")
def weighted_average_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A running weighted average over counts, so that a window holds years and not lines."""
    counts = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.year("l_shipdate").cast("bigint").alias("l_shipyear"), "l_returnflag")
        .agg(F.count("*").cast("double").alias("lines"))
    )
    window = Window.partitionBy("l_returnflag").orderBy("l_shipyear")
    average = weighted_average("lines", "l_shipyear", over=window)
    return counts.withColumn("mean_year", average)


@query("""
SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS kinds
FROM events GROUP BY user_id
""")
def collect_ws_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.sort_array(F.collect_set("event_type"))
    return table(spark, sf_dir, "events").groupBy("user_id").agg(collect_ws(kinds).alias("kinds"))


@query("""
SELECT vec_id, array_to_string(list_transform(embedding, lambda x: CAST(x > 0 AS INTEGER)), ',') AS signs
FROM embeddings
""")
def collect_ws_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered SQL name over an array column."""
    register_functions(spark)
    signs = "CollectWs(transform(embedding, x -> CAST(x > 0 AS INT))) AS signs"
    return table(spark, sf_dir, "embeddings").selectExpr("vec_id", signs)
