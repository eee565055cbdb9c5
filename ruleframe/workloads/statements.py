"""SQL files over the given tables: what a SQL step can say, one query per kind of operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ruleframe.plans.jobs import run_sql
from ruleframe.workloads.data import register_tables, sql_file
from ruleframe.workloads.registry import QUERIES, SQL

STATEMENTS = {
    "sql_join_agg": """
SELECT n_name, year(o_orderdate) AS order_year, count(*) AS line_count,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))))
         AS DOUBLE) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
     JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE r_name IN ('ASIA', 'EUROPE') AND l_shipdate >= DATE '1997-01-01'
GROUP BY n_name, year(o_orderdate)
""",
    "sql_semi_anti": """
SELECT c_custkey, c_name FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)
  AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P'
                  AND o_orderpriority = '1-URGENT')
""",
    "sql_outer_theta": """
SELECT s_suppkey, p_brand, count(p_partkey) AS parts
FROM supplier LEFT JOIN part ON s_suppkey = p_partkey % 500 AND p_size > s_nationkey
GROUP BY s_suppkey, p_brand
""",
    "sql_window_frame": """
SELECT segment, order_month, orders,
       CAST(sum(orders) OVER (PARTITION BY segment ORDER BY order_month
                              ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS BIGINT) AS last_three,
       lag(orders) OVER (PARTITION BY segment ORDER BY order_month) AS month_before,
       CAST(rank() OVER (PARTITION BY segment ORDER BY orders DESC) AS INT) AS place
FROM (SELECT c_mktsegment AS segment, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INT) AS order_month,
             count(*) AS orders
      FROM orders JOIN customer ON o_custkey = c_custkey
      GROUP BY c_mktsegment, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INT)) AS months
""",
    "sql_setops": """
(SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'
 INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')
EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'
UNION ALL SELECT c_custkey FROM customer WHERE c_acctbal < 0
""",
    "sql_grouping_sets": """
SELECT event_type, user_id % 10 AS user_class, count(*) AS n, count(DISTINCT user_id) AS users
FROM events
GROUP BY GROUPING SETS ((event_type, user_id % 10), (event_type), ())
""",
    "sql_rollup": """
SELECT r_name, n_name, count(*) AS suppliers, GROUPING(n_name) AS is_total
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY ROLLUP (r_name, n_name)
""",
    "sql_topk": """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 25
""",
    "sql_text_functions": """
SELECT page_id, lower(regexp_extract(url, '^(https?)://([^/?#]+)', 2)) AS host,
       length(html) AS html_length, url LIKE 'https%' AS secure,
       upper(substring(url, 1, 5)) AS scheme, concat_ws('-', page_id, 'x') AS label
FROM pages
""",
    "sql_having": """
SELECT lang, source, count(*) AS documents, avg(n_chars) AS mean_chars, max(n_chars) AS longest
FROM documents JOIN labels USING (doc_id)
WHERE toxic = 0 GROUP BY lang, source HAVING count(*) >= 5
""",
    "sql_library_functions": """
SELECT l_suppkey, MostCommon(l_returnflag) AS usual_flag, -- function names of the library
       WeightedAverage(l_quantity, l_linenumber) AS mean_line,
       CollectWs(sort_array(collect_set(l_linestatus))) AS statuses, count(*) AS line_count
FROM lineitem GROUP BY l_suppkey
""",
}

# Where the comparison engine spells things differently
SPELLED = {
    "sql_grouping_sets": STATEMENTS["sql_grouping_sets"],
    "sql_text_functions": STATEMENTS["sql_text_functions"].replace(
        "length(html)", "CAST(length(html) AS INTEGER)"
    ),
    "sql_rollup": STATEMENTS["sql_rollup"].replace(
        "GROUPING(n_name)", "CAST(GROUPING(n_name) AS TINYINT)"
    ),
    "sql_join_agg": STATEMENTS["sql_join_agg"]
    .replace("year(o_orderdate) AS", "CAST(year(o_orderdate) AS INTEGER) AS")
    .replace("(1 - CAST(l_discount", "(CAST(1 AS DECIMAL(4,2)) - CAST(l_discount"),
    "sql_library_functions": """
SELECT l_suppkey, usual_flag, mean_line, statuses, line_count FROM (
  SELECT l_suppkey, sum(l_quantity * l_linenumber) / sum(l_quantity) AS mean_line,
         string_agg(DISTINCT l_linestatus, ',' ORDER BY l_linestatus) AS statuses,
         count(*) AS line_count
  FROM lineitem GROUP BY l_suppkey)
JOIN (SELECT l_suppkey, l_returnflag AS usual_flag, row_number() OVER (
        PARTITION BY l_suppkey ORDER BY count(*) DESC, l_returnflag) AS rn
      FROM lineitem GROUP BY l_suppkey, l_returnflag) USING (l_suppkey)
WHERE rn = 1
""",
}


def _statement(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        text = STATEMENTS[name]
        register_tables(spark, sf_dir, text)
        return run_sql(spark, sql_file(spark, text))

    return run


for _name in STATEMENTS:
    QUERIES[_name] = _statement(_name)
    SQL[_name] = SPELLED.get(_name, STATEMENTS[_name])
