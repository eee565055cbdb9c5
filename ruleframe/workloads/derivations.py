"""Derived tables: rules applied level by level to the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ruleframe.operators.derive import Rule, derive
from ruleframe.operators.groups import with_group_values
from ruleframe.workloads.data import register_tables, table
from ruleframe.workloads.registry import query

FLAGSHIP_SOURCE = """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_returnflag,
       l_shipdate, o_custkey, o_orderdate
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""

FLAGSHIP_RULES = [
    Rule(1, "order_key", "BIGINT", 0, "l_orderkey"),
    Rule(2, "line_no", "INT", 0, "l_linenumber"),
    Rule(3, "cust_key", "BIGINT", 0, "o_custkey"),
    Rule(4, "qty", "DECIMAL(18,2)", 0, "l_quantity"),
    Rule(5, "gross", "DECIMAL(18,2)", 0, "l_extendedprice"),
    Rule(6, "disc", "DECIMAL(4,2)", 0, "l_discount"),
    Rule(7, "flag", "STRING", 0, "l_returnflag"),
    Rule(8, "ship_date", "DATE", 0, "l_shipdate"),
    Rule(9, "order_date", "DATE", 0, "o_orderdate"),
    Rule(10, "net", "DECIMAL(24,4)", 1, "gross * (1 - disc)"),
    Rule(11, "lag_days", "INT", 1, "datediff(ship_date, order_date)"),
    Rule(12, "cust_net", "DECIMAL(34,4)", 2, "sum(net) OVER (PARTITION BY cust_key)"),
    Rule(
        13, "cust_flag", "STRING", 2,
        "mode(CAST(flag AS STRING), true) OVER (PARTITION BY cust_key)",
    ),
    Rule(
        14, "cust_disc", "DOUBLE", 2,
        "CAST(sum(qty * disc) OVER (PARTITION BY cust_key) AS DOUBLE)"
        " / CAST(sum(qty) OVER (PARTITION BY cust_key) AS DOUBLE)",
    ),
    Rule(15, "net_share", "DOUBLE", 3, "CAST(net AS DOUBLE) / CAST(cust_net AS DOUBLE)"),
]

FLAGSHIP_SHOWN = [
    "order_key", "line_no", "cust_key", "lag_days", "CAST(net AS DOUBLE) AS net",
    "CAST(cust_net AS DOUBLE) AS cust_net", "cust_flag", "cust_disc", "net_share",
]

FLAGSHIP_SQL = """
WITH l0 AS (
  SELECT l_orderkey AS order_key, l_linenumber AS line_no, o_custkey AS cust_key,
         CAST(l_quantity AS DECIMAL(18,2)) AS qty, CAST(l_extendedprice AS DECIMAL(18,2)) AS gross,
         CAST(l_discount AS DECIMAL(4,2)) AS disc, l_returnflag AS flag,
         CAST(l_shipdate AS DATE) AS ship_date, CAST(o_orderdate AS DATE) AS order_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
l1 AS (
  SELECT *, gross * (CAST(1 AS DECIMAL(4,2)) - disc) AS net,
         CAST(date_diff('day', order_date, ship_date) AS INTEGER) AS lag_days FROM l0),
f AS (
  SELECT cust_key, flag AS cust_flag FROM (
    SELECT cust_key, flag,
           row_number() OVER (PARTITION BY cust_key ORDER BY count(*) DESC, flag) AS rn
    FROM l0 WHERE flag IS NOT NULL GROUP BY cust_key, flag) WHERE rn = 1),
l2 AS (
  SELECT l1.*, sum(net) OVER (PARTITION BY cust_key) AS cust_net,
         CAST(sum(qty * disc) OVER (PARTITION BY cust_key) AS DOUBLE)
           / CAST(sum(qty) OVER (PARTITION BY cust_key) AS DOUBLE) AS cust_disc FROM l1)
SELECT order_key, line_no, l2.cust_key, lag_days, CAST(net AS DOUBLE) AS net,
       CAST(cust_net AS DOUBLE) AS cust_net, cust_flag, cust_disc,
       CAST(net AS DOUBLE) / CAST(cust_net AS DOUBLE) AS net_share
FROM l2 LEFT JOIN f ON f.cust_key = l2.cust_key
"""


def flagship(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    register_tables(spark, sf_dir, FLAGSHIP_SOURCE)
    source = spark.sql(FLAGSHIP_SOURCE)
    return derive(source, FLAGSHIP_RULES, **options).selectExpr(*FLAGSHIP_SHOWN)


@query(FLAGSHIP_SQL)
def derive_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flagship(spark, sf_dir)


@query("""
SELECT * EXCLUDE (o_orderdate) REPLACE (CAST(order_total AS DOUBLE) AS order_total,
                                        CAST(year_total AS DOUBLE) AS year_total),
       CAST(year_total AS DOUBLE) / CAST(order_total AS DOUBLE) AS year_factor FROM (
  SELECT *, CAST(sum(order_total) OVER (PARTITION BY o_custkey, order_year) AS DECIMAL(28,2))
              AS year_total FROM (
    SELECT *, CAST(year(o_orderdate) AS INTEGER) AS order_year,
           CAST(o_totalprice AS DECIMAL(18,2)) AS order_total FROM orders))
""")
def derive_no_level0(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without level 0 the source columns stay; level 3 is a gap."""
    rules = [
        Rule(1, "order_year", "INT", 1, "year(o_orderdate)"),
        Rule(2, "order_total", "DECIMAL(18,2)", 1, "o_totalprice"),
        Rule(
            3, "year_total", "DECIMAL(28,2)", 2,
            "sum(order_total) OVER (PARTITION BY o_custkey, order_year)",
        ),
        Rule(
            4, "year_factor", "DOUBLE", 4,
            "CAST(year_total AS DOUBLE) / CAST(order_total AS DOUBLE)",
        ),
    ]
    derived = derive(table(spark, sf_dir, "orders"), rules).drop("o_orderdate")
    doubles = ("order_total", "year_total")
    return derived.withColumns({name: derived[name].cast("double") for name in doubles})


@query("""
SELECT * REPLACE (CAST(qty AS DOUBLE) AS qty), CAST(qty AS DOUBLE) / CAST(line_count AS DOUBLE) AS mean_qty FROM (
  SELECT count(*) AS line_count,
         CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS qty,
         (SELECT l_returnflag FROM lineitem GROUP BY l_returnflag
          ORDER BY count(*) DESC, l_returnflag LIMIT 1) AS usual_flag,
         sum(l_quantity * l_linenumber) / sum(l_quantity) AS mean_line
  FROM lineitem)
""")
def derive_level0_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aggregates at level 0 give one row, which later levels extend."""
    rules = [
        Rule(1, "line_count", "BIGINT", 0, "count(*)"),
        Rule(2, "qty", "DECIMAL(28,2)", 0, "sum(CAST(l_quantity AS DECIMAL(18,2)))"),
        Rule(3, "usual_flag", "STRING", 0, "MostCommon(l_returnflag)"),
        Rule(4, "mean_line", "DOUBLE", 0, "WeightedAverage(l_quantity, l_linenumber)"),
        Rule(5, "mean_qty", "DOUBLE", 1, "CAST(qty AS DOUBLE) / CAST(line_count AS DOUBLE)"),
    ]
    derived = derive(table(spark, sf_dir, "lineitem"), rules)
    return derived.withColumn("qty", derived["qty"].cast("double"))


@query("""
SELECT o_orderkey AS order_key,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus <> 'F' THEN 'rush'
            WHEN o_orderstatus IS NULL OR NOT (o_totalprice > 100000) THEN 'small'
            ELSE 'normal' END AS handling,
       o_totalprice BETWEEN 100000 AND 200000 AS middle,
       CAST(split_part(o_orderpriority, '-', 1) AS TINYINT) AS priority,
       TRY_CAST(o_orderpriority AS INTEGER) AS not_a_number
FROM orders
""")
def derive_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conditions, literals with quotes, and a value that does not fit its type."""
    rules = [
        Rule(1, "order_key", "BIGINT", 0, "o_orderkey"),
        Rule(
            2, "handling", "VARCHAR(10)", 0,
            "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus <> 'F'"
            " THEN 'rush' WHEN o_orderstatus IS NULL OR NOT (o_totalprice > 100000)"
            " THEN 'small' ELSE 'normal' END",
        ),
        Rule(3, "middle", "BOOLEAN", 0, "o_totalprice BETWEEN 100000 AND 200000"),
        Rule(4, "priority", "TINYINT", 0, "split_part(o_orderpriority, '-', 1)"),
        Rule(5, "not_a_number", "INT", 0, "o_orderpriority"),
    ]
    return derive(table(spark, sf_dir, "orders"), rules)


@query("""
WITH l0 AS (
  SELECT event_id, user_id, event_type AS kind, CAST(value AS DECIMAL(18,2)) AS amount
  FROM events),
l1 AS (
  SELECT *, sum(amount) OVER (PARTITION BY user_id) AS user_total,
         sum(amount) OVER (PARTITION BY kind) AS kind_total,
         count(*) OVER () AS all_events FROM l0),
l2 AS (
  SELECT *, max(user_total) OVER (PARTITION BY kind) AS top_user,
         sum(CASE WHEN user_total > 6000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, kind)
           AS busy FROM l1)
SELECT event_id, user_id, kind, CAST(amount AS DOUBLE) AS amount,
       CAST(user_total AS DOUBLE) AS user_total, CAST(kind_total AS DOUBLE) AS kind_total,
       all_events, CAST(top_user AS DOUBLE) AS top_user, CAST(busy AS BIGINT) AS busy,
       CAST(max(busy) OVER (PARTITION BY user_id) AS BIGINT) AS most_busy
FROM l2
""")
def derive_groups_of_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group values of several key sets, on three levels that build on each other."""
    rules = [
        Rule(1, "event_id", "BIGINT", 0, "event_id"),
        Rule(2, "user_id", "BIGINT", 0, "user_id"),
        Rule(3, "kind", "STRING", 0, "event_type"),
        Rule(4, "amount", "DECIMAL(18,2)", 0, "value"),
        Rule(5, "user_total", "DECIMAL(28,2)", 1, "sum(amount) OVER (PARTITION BY user_id)"),
        Rule(6, "kind_total", "DECIMAL(28,2)", 1, "sum(amount) OVER (PARTITION BY kind)"),
        Rule(7, "all_events", "BIGINT", 1, "count(*) OVER ()"),
        Rule(8, "top_user", "DECIMAL(28,2)", 2, "max(user_total) OVER (PARTITION BY kind)"),
        Rule(
            9, "busy", "BIGINT", 2,
            "sum(CASE WHEN user_total > 6000 THEN 1 ELSE 0 END)"
            " OVER (PARTITION BY user_id, kind)",
        ),
        Rule(10, "most_busy", "BIGINT", 3, "max(busy) OVER (PARTITION BY user_id)"),
    ]
    derived = derive(table(spark, sf_dir, "events"), rules)
    doubles = ("amount", "user_total", "kind_total", "top_user")
    return derived.withColumns({name: derived[name].cast("double") for name in doubles})


@query("""
WITH flags AS (
  SELECT l_suppkey, l_returnflag AS usual_flag FROM (
    SELECT l_suppkey, l_returnflag, row_number() OVER (
      PARTITION BY l_suppkey ORDER BY count(*) DESC, l_returnflag) AS rn
    FROM lineitem GROUP BY l_suppkey, l_returnflag) WHERE rn = 1),
lines AS (
  SELECT l_suppkey, usual_line FROM (
    SELECT l_suppkey, CAST(l_linenumber AS VARCHAR) AS usual_line, row_number() OVER (
      PARTITION BY l_suppkey ORDER BY count(*) DESC, CAST(l_linenumber AS VARCHAR)) AS rn
    FROM lineitem GROUP BY l_suppkey, l_linenumber) WHERE rn = 1),
others AS (
  SELECT l_suppkey, string_agg(DISTINCT l_linestatus, ',' ORDER BY l_linestatus) AS statuses,
         sum(l_quantity * l_linenumber) / sum(l_quantity) AS mean_line
  FROM lineitem GROUP BY l_suppkey)
SELECT l_orderkey, l_linenumber, l.l_suppkey, usual_flag, usual_line, mean_line, statuses
FROM lineitem l JOIN flags USING (l_suppkey) JOIN lines USING (l_suppkey)
JOIN others USING (l_suppkey)
""")
def derive_library_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The library's three functions in rule text, over one key set."""
    over = "OVER (PARTITION BY l_suppkey)"
    rules = [
        Rule(1, "usual_flag", "STRING", 1, f"MostCommon(l_returnflag) {over}"),
        Rule(2, "usual_line", "STRING", 1, f"MostCommon(l_linenumber) {over}"),
        Rule(3, "mean_line", "DOUBLE", 1, f"WeightedAverage(l_quantity, l_linenumber) {over}"),
        Rule(
            4, "statuses", "STRING", 1,
            f"CollectWs(sort_array(collect_set(l_linestatus) {over}))",
        ),
    ]
    source = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_linestatus", "l_quantity"
    )
    return derive(source, rules).drop("l_returnflag", "l_linestatus", "l_quantity")


@query("""
SELECT c_custkey, c_mktsegment, c_acctbal,
       count(*) OVER (PARTITION BY c_mktsegment) AS segment_customers,
       max(c_acctbal) OVER (PARTITION BY c_mktsegment) AS segment_best
FROM customer
""")
def group_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    values = {"segment_customers": "count(*)", "segment_best": "max(c_acctbal)"}
    return with_group_values(customers, ["c_mktsegment"], values)


@query("""
SELECT event_id, user_id, event_type, running_rank, CAST(running_total AS DOUBLE) AS running_total,
       seen, two_before, next_type, top_place
FROM (
  SELECT *, CAST(max(place) OVER (PARTITION BY event_type) AS INTEGER) AS top_place FROM (
    SELECT event_id, user_id, event_type,
           CAST(rank() OVER (PARTITION BY event_type ORDER BY user_id % 10 DESC) AS INTEGER)
             AS running_rank,
           sum(CAST(value AS DECIMAL(18,2))) OVER (
             PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
             AS running_total,
           CAST(count(nullif(user_id, 7)) OVER (ORDER BY ts, event_id) AS BIGINT) AS seen,
           lag(value, 2) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS two_before,
           lead(event_type, 1, 'none') OVER (ORDER BY ts, event_id) AS next_type,
           CAST(row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS INTEGER)
             AS place
    FROM events))
""")
def derive_running_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered windows, of few large keys and of the whole table, computed in blocks."""
    rules = [
        Rule(
            1, "running_rank", "INT", 1,
            "rank() OVER (PARTITION BY event_type ORDER BY user_id % 10 DESC)",
        ),
        Rule(
            2, "running_total", "DECIMAL(28,2)", 1,
            "sum(CAST(value AS DECIMAL(18,2))) OVER ("
            "PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)",
        ),
        Rule(3, "seen", "BIGINT", 1, "count(nullif(user_id, 7)) OVER (ORDER BY ts, event_id)"),
        Rule(
            4, "place", "INT", 1,
            "row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id)",
        ),
        Rule(
            6, "two_before", "DOUBLE", 1,
            "lag(value, 2) OVER (PARTITION BY event_type ORDER BY ts, event_id)",
        ),
        Rule(
            7, "next_type", "STRING", 1,
            "lead(event_type, 1, 'none') OVER (ORDER BY ts, event_id)",
        ),
        Rule(5, "top_place", "INT", 2, "max(place) OVER (PARTITION BY event_type)"),
    ]
    events = table(spark, sf_dir, "events").drop("props")
    return derive(events, rules).selectExpr(
        "event_id", "user_id", "event_type", "running_rank",
        "CAST(running_total AS DOUBLE) AS running_total", "seen", "two_before", "next_type",
        "top_place",
    )


@query("""
SELECT event_id, percent_rank() OVER k AS share_before, cume_dist() OVER k AS share_up_to,
       CAST(ntile(7) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS INTEGER) AS seventh,
       avg(user_id) OVER k AS mean_user, CAST(count(*) FILTER (WHERE value > 50) OVER k AS BIGINT) AS dear,
       min(value) OVER (ORDER BY user_id % 10 RANGE UNBOUNDED PRECEDING) AS low
FROM events WINDOW k AS (PARTITION BY event_type ORDER BY user_id % 10)
""")
def derive_running_more(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relative ranks, averages and conditional counts, over few order values that repeat very often."""
    over = "OVER (PARTITION BY event_type ORDER BY user_id % 10)"
    rules = [
        Rule(1, "event_id", "BIGINT", 0, "event_id"),
        Rule(2, "share_before", "DOUBLE", 0, f"percent_rank() {over}"),
        Rule(3, "share_up_to", "DOUBLE", 0, f"cume_dist() {over}"),
        Rule(
            4, "seventh", "INT", 0,
            "ntile(7) OVER (PARTITION BY event_type ORDER BY ts, event_id)",
        ),
        Rule(5, "mean_user", "DOUBLE", 0, f"avg(user_id) {over}"),
        Rule(6, "dear", "BIGINT", 0, f"count_if(value > 50) {over}"),
        Rule(
            7, "low", "DOUBLE", 0,
            "min(value) OVER (ORDER BY user_id % 10 RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
        ),
    ]
    return derive(table(spark, sf_dir, "events"), rules)
