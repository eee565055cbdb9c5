"""Sliding frames, percentiles, distinct counts and joins along time, over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ruleframe.operators import lineage, percentiles, sketches, temporal
from ruleframe.operators.derive import Rule, derive
from ruleframe.operators.increment import attach_increment, group_state
from ruleframe.session import stage
from ruleframe.workloads.data import PART_RULES, rules_from, table
from ruleframe.workloads.registry import query


@query("""
SELECT event_id, CAST(sum(CAST(value AS DECIMAL(18,2))) OVER near AS DOUBLE) AS last_seven,
       max(event_id) OVER (ORDER BY ts, event_id ROWS BETWEEN 2 FOLLOWING AND 5 FOLLOWING) AS soon,
       first_value(user_id) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS 40 PRECEDING) AS user_before,
       count(*) OVER (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS of_a_day,
       min(value) OVER (PARTITION BY event_type ORDER BY user_id DESC RANGE BETWEEN 2 PRECEDING AND 1 FOLLOWING) AS least_near,
       avg(user_id) OVER (PARTITION BY event_type ORDER BY user_id RANGE BETWEEN CURRENT ROW AND 3 FOLLOWING) AS mean_user
FROM events WINDOW near AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
""")
def derive_sliding_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of rows and of ranges over few large keys, each computed in blocks."""
    of_type = "PARTITION BY event_type ORDER BY"
    rules = [
        Rule(1, "last_seven", "DOUBLE", 1, f"sum(CAST(value AS DECIMAL(18,2))) OVER ({of_type} ts, event_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"),
        Rule(2, "soon", "BIGINT", 1, "max(event_id) OVER (ORDER BY ts, event_id ROWS BETWEEN 2 FOLLOWING AND 5 FOLLOWING)"),
        Rule(3, "user_before", "BIGINT", 1, f"first_value(user_id) OVER ({of_type} ts, event_id ROWS 40 PRECEDING)"),
        Rule(4, "of_a_day", "BIGINT", 1, f"count(*) OVER ({of_type} ts RANGE BETWEEN INTERVAL '1' DAY PRECEDING AND CURRENT ROW)"),
        Rule(5, "least_near", "DOUBLE", 1, f"min(value) OVER ({of_type} user_id DESC RANGE BETWEEN 2 PRECEDING AND 1 FOLLOWING)"),
        Rule(6, "mean_user", "DOUBLE", 1, f"avg(user_id) OVER ({of_type} user_id RANGE BETWEEN CURRENT ROW AND 3 FOLLOWING)"),
    ]
    events = table(spark, sf_dir, "events").drop("props")
    return derive(events, rules).select("event_id", *[rule.column for rule in rules])


@query("""
WITH line AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_returnflag, l_quantity FROM lineitem),
     whole AS (SELECT quantile_cont(l_quantity, 0.75) AS q3 FROM line),
     flag AS (SELECT l_returnflag, median(l_quantity) AS usual, count(*) AS n FROM line GROUP BY l_returnflag),
     supp AS (SELECT l_suppkey, quantile_cont(CAST(l_linenumber AS DOUBLE), 0.25) AS low, quantile_cont(CAST(l_linenumber AS DOUBLE), 1) AS top
              FROM line GROUP BY l_suppkey)
SELECT l_orderkey, l_linenumber, usual, n, low, top, q3 FROM line JOIN flag USING (l_returnflag) JOIN supp USING (l_suppkey), whole
""")
def derive_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact percentiles of three key sets, one of them with a third of the rows in a key and one without keys."""
    rules = [
        Rule(1, "usual", "DOUBLE", 1, "median(l_quantity) OVER (PARTITION BY l_returnflag)"),
        Rule(2, "n", "BIGINT", 1, "count(*) OVER (PARTITION BY l_returnflag)"),
        Rule(3, "low", "DOUBLE", 1, "percentile(l_linenumber, 0.25) OVER (PARTITION BY l_suppkey)"),
        Rule(4, "top", "DOUBLE", 1, "percentile(l_linenumber, 1) OVER (PARTITION BY l_suppkey)"),
        Rule(5, "q3", "DOUBLE", 1, "percentile_cont(0.75) WITHIN GROUP (ORDER BY l_quantity) OVER ()"),
    ]
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_quantity")
    return derive(lines, rules).select("l_orderkey", "l_linenumber", *[rule.column for rule in rules])


@query("""
SELECT event_id, count(DISTINCT user_id) OVER (PARTITION BY event_type ORDER BY ts) AS users_so_far,
       count(DISTINCT nullif(user_id, 7)) OVER (ORDER BY CAST(ts AS DATE) DESC) AS later_users
FROM events
""")
def derive_running_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many users an event type, and all events from the last day back, have had so far."""
    rules = [
        Rule(1, "users_so_far", "BIGINT", 1, "RunningDistinct(user_id) OVER (PARTITION BY event_type ORDER BY ts)"),
        Rule(2, "later_users", "BIGINT", 1, "RunningDistinct(nullif(user_id, 7)) OVER (ORDER BY CAST(ts AS DATE) DESC)"),
    ]
    return derive(table(spark, sf_dir, "events").drop("props"), rules).select("event_id", "users_so_far", "later_users")


@query("""
WITH bought AS (SELECT user_id % 3 AS k, ts AS at, max(event_id) AS bought_id, arg_max(value, event_id) AS paid
                FROM events WHERE event_type = 'purchase' GROUP BY 1, 2)
SELECT e.event_id, b.bought_id, b.paid, CASE WHEN c.at >= e.ts - INTERVAL 6 HOURS THEN c.bought_id END AS lately
FROM (SELECT event_id, user_id % 3 AS k, ts FROM events WHERE event_type <> 'purchase') e
ASOF LEFT JOIN bought b ON e.k = b.k AND e.ts >= b.at
ASOF LEFT JOIN bought c ON e.k = c.k AND e.ts > c.at
""")
def join_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every other event the last purchase of its third of the users, and the one before its own time if recent."""
    events = table(spark, sf_dir, "events").withColumn("k", F.col("user_id") % 3)
    others = events.where("event_type <> 'purchase'").select("event_id", "k", "ts")
    bought = events.where("event_type = 'purchase'").select("k", F.col("ts").alias("at"), F.col("event_id").alias("bought_id"), F.col("value").alias("paid"))
    first = temporal.join_as_of(others, bought, ["k"], "ts", "at", ["bought_id", "paid"])
    before = bought.withColumnRenamed("bought_id", "lately")
    both = temporal.join_as_of(first, before, ["k"], "ts", "at", ["lately"], strict=True, within="INTERVAL '6' HOURS")
    return both.select("event_id", "bought_id", "paid", "lately")


@query("""
WITH valid AS (SELECT o_orderkey, o_custkey % 3 AS k, o_orderdate AS since,
                      CASE WHEN o_orderkey % 4999 = 1 THEN NULL ELSE o_orderdate + to_hours(CAST(o_orderkey % 5 * (o_orderkey % 17) AS INTEGER)) END AS until
               FROM orders WHERE o_orderkey % 5 < 3)
SELECT o_orderkey, count(l_orderkey) AS lines, CAST(sum(l_linenumber) AS BIGINT) AS numbers
FROM valid JOIN (SELECT *, l_suppkey % 3 AS m FROM lineitem) ON k = m AND l_shipdate >= since AND (until IS NULL OR l_shipdate < until)
GROUP BY o_orderkey
""")
def join_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines shipped while an order of their third was valid: short, long and open intervals."""
    orders = table(spark, sf_dir, "orders").where("o_orderkey % 5 < 3")
    until = "CASE WHEN o_orderkey % 4999 = 1 THEN NULL ELSE o_orderdate + make_dt_interval(0, CAST(o_orderkey % 5 * (o_orderkey % 17) AS INT)) END"
    valid = orders.selectExpr("o_orderkey", "o_custkey % 3 AS k", "o_orderdate AS since", f"{until} AS until")
    lines = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_shipdate", "l_suppkey % 3 AS k")
    totals = {"lines": ("count", "l_orderkey"), "numbers": ("sum", "l_linenumber")}
    found = temporal.join_intervals(lines, valid, ["k"], "l_shipdate", "since", "until", totals=totals)
    return found.groupBy("o_orderkey").agg(F.coalesce(F.sum("lines"), F.lit(0)).alias("lines"), F.sum("numbers").alias("numbers"))


_EDGES = f"""
names AS (SELECT DISTINCT lower(TableName) AS t, upper(ColumnName) AS c FROM ({PART_RULES})),
used AS (SELECT DISTINCT lower(TableName) AS t, upper(ColumnName) AS c,
                unnest(regexp_extract_all(replace(upper(Expression), 'C1 IS IT', ''), '\\bC[0-9]+\\b')) AS r FROM ({PART_RULES})),
edges AS (SELECT t, used.c, used.r FROM used JOIN names USING (t) WHERE names.c = used.r)"""


@query(f"""
WITH RECURSIVE {_EDGES},
chains AS (SELECT t, c, r, 1 AS steps FROM edges
           UNION SELECT chains.t, chains.c, edges.r, steps + 1 FROM chains JOIN edges ON chains.t = edges.t AND chains.r = edges.c WHERE steps < 45)
SELECT t AS TableName, c AS ColumnName, r AS reference, CAST(min(steps) AS INTEGER) AS steps FROM chains GROUP BY t, c, r
""")
def rule_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns that a column depends on through other rules; the generated rules have cycles too."""
    return lineage.rule_lineage(rules_from(spark, sf_dir, PART_RULES))


@query(f"""
WITH RECURSIVE {_EDGES},
chains AS (SELECT t, c, 0 AS steps FROM names
           UNION SELECT edges.t, edges.c, steps + 1 FROM chains JOIN edges ON chains.t = edges.t AND chains.c = edges.r WHERE steps < 45)
SELECT t AS TableName, c AS ColumnName, CASE WHEN max(steps) < 45 THEN CAST(max(steps) AS INTEGER) END AS lowest FROM chains GROUP BY t, c
""")
def rule_lowest_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lowest level of each column; none where it depends on a cycle."""
    return lineage.lowest_levels(rules_from(spark, sf_dir, PART_RULES))


@query(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS num_nulls, CAST(min({c}) AS VARCHAR) AS min, "
    f"CAST(max({c}) AS VARCHAR) AS max, true AS near, {middle} AS middle_near FROM (SELECT *, nullif(o_orderstatus, 'F') AS open FROM orders)"
    for c, middle in (("o_orderkey", "true"), ("o_custkey", "true"), ("open", "NULL"))
))
def merged_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of a table from those of its partitions, stored, and renewed for one partition only.

    Counts and bounds are exact; distinct counts and medians are compared with the exact ones, and are near.
    """
    orders = table(spark, sf_dir, "orders").withColumn("open", F.expr("nullif(o_orderstatus, 'F')"))
    columns, by = ["o_orderkey", "o_custkey", "open"], ["o_orderpriority"]
    before = stage(sketches.partition_statistics(orders.where("o_orderkey % 2 = 0 OR o_orderpriority <> '5-LOW'"), by, columns), "statistics")
    renewed = sketches.partition_statistics(orders.where("o_orderpriority = '5-LOW'"), by, columns)
    merged = sketches.merged_statistics(stage(sketches.replaced_partitions(before, renewed, by), "statistics"))
    exact = orders.select(F.explode(F.array(*[F.struct(F.lit(c).alias("of"), F.col(c).cast("string").alias("v"), F.col(c).try_cast("double").alias("x")) for c in columns])).alias("e"))
    exact = exact.select("e.*")
    # Counted and ranked apart: Spark's percentile, and all the more beside a distinct count, holds all values of a column in a task.
    counted = exact.groupBy(F.col("of").alias("column_name")).agg(F.count_distinct("v").alias("n"))
    ranked = percentiles.percentile_table(exact, ["of"], {"low": ("x", 0.45), "high": ("x", 0.55)})
    joined = merged.join(counted, "column_name").join(ranked, F.col("column_name") == F.col("of"), "left")
    near = F.abs(F.col("distinct_count") - F.col("n")) <= F.ceil(5 * sketches.DISTINCT_ERROR * F.col("n"))
    middle = F.col("quantiles")[1].between(F.col("low"), F.col("high"))
    return joined.select("column_name", "row_count", "num_nulls", "min", "max", near.alias("near"), middle.alias("middle_near"))


@query("""
WITH edges AS (SELECT DISTINCT unnest(quantile_cont(CAST(value AS DOUBLE), [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])) AS edge FROM events),
bounds AS (SELECT row_number() OVER (ORDER BY edge) AS bucket, edge AS low, lead(edge) OVER (ORDER BY edge) AS high FROM edges)
SELECT CAST(bucket AS INTEGER) AS bucket, round(low, 6) AS low, round(high, 6) AS high, count(*) AS rows, count(DISTINCT value) AS "values"
FROM bounds JOIN events ON (value > low OR bucket = 1 AND value >= low) AND value <= high WHERE high IS NOT NULL GROUP BY bucket, low, high
""")
def column_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equi-height buckets with exact counts, written to a table and read back."""
    found = stage(sketches.column_histogram(table(spark, sf_dir, "events"), "value"), "histogram")
    return found.withColumns({"low": F.round("low", 6), "high": F.round("high", 6)})


@query("""
WITH whole AS (
  SELECT *, sum(CAST(l_quantity AS DECIMAL(12,2))) OVER s AS quantity, count(*) OVER s AS lines, max(l_shipdate) OVER s AS latest,
         avg(l_linenumber) OVER s AS mean_line FROM lineitem WINDOW s AS (PARTITION BY l_suppkey, l_returnflag)),
usual AS (SELECT l_suppkey, l_returnflag, arg_min(v, (-n, v)) AS usual_line FROM (
  SELECT l_suppkey, l_returnflag, CAST(l_linenumber AS VARCHAR) AS v, count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY ALL)
SELECT l_orderkey, l_linenumber, CAST(quantity AS DOUBLE) AS quantity, lines, latest, mean_line, usual_line
FROM whole JOIN usual USING (l_suppkey, l_returnflag) WHERE l_orderkey % 10 = 0
""")
def derive_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New lines with group values over all lines, from stored states of the old ones and the new lines alone."""
    lines = table(spark, sf_dir, "lineitem")
    values = {
        "quantity": "sum(CAST(l_quantity AS DECIMAL(12,2)))", "lines": "count(*)", "latest": "max(l_shipdate)",
        "mean_line": "avg(l_linenumber)", "usual_line": "MostCommon(l_linenumber)",
    }
    old = group_state(lines.where("l_orderkey % 10 <> 0"), ["l_suppkey", "l_returnflag"], values)
    old = old.stored(stage(old.sums, "sums"), stage(old.counts, "counts"))
    found, _ = attach_increment(lines.where("l_orderkey % 10 = 0"), old)
    return found.selectExpr("l_orderkey", "l_linenumber", "CAST(quantity AS DOUBLE) AS quantity", "lines", "latest", "mean_line", "usual_line")
