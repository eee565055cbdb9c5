import re
from pathlib import Path

import pytest
from conftest import SF, plan, rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ruleframe import Rule, append_level, derive, project_level, with_group_values
from ruleframe.operators.groups import GroupValues, partition_keys
from ruleframe.operators.running import (
    OrderedWindow,
    cut_into_blocks,
    ordered_window,
)
from ruleframe.session import session_settings, shared_folder
from ruleframe.workloads.derivations import flagship


@pytest.fixture(scope="module")
def sales(spark):
    data = [(1, "a", 10, 2.5), (2, "a", 20, None), (3, None, 30, 1.0), (4, None, 5, 4.0),
            (5, "b", None, 0.5)]
    return spark.createDataFrame(data, "id INT, k STRING, x INT, y DOUBLE")


def test_level_0_projects_and_later_levels_append(sales):
    rules = [
        Rule(2, "double_x", "BIGINT", 2, "x2 * 2"),
        Rule(1, "x2", "INT", 0, "x + 1"),
        Rule(3, "txt", "VARCHAR(1)", 0, "concat('[', k, ']')"),
    ]
    derived = derive(sales, rules)
    assert derived.columns == ["x2", "txt", "double_x"]
    assert rows(derived)[0] == (11, "[a]", 22)


def test_without_level_0_the_source_stays(sales):
    derived = derive(sales, [Rule(1, "z", "INT", 3, "x"), Rule(2, "zz", "INT", 12, "z + id")])
    assert derived.columns == [*sales.columns, "z", "zz"]
    assert derived.count() == 5


def test_no_rules_and_repeated_rules(sales):
    assert derive(sales, []).columns == sales.columns
    rule = Rule(1, "z", "INT", 0, "x")
    assert derive(sales, [rule, rule]).columns == ["z"]


def test_level_helpers(sales):
    assert project_level(sales, [(1, "z", "INT", 5, "x")]).columns == ["z"]
    assert append_level(sales, [(1, "z", "INT", 5, "x")]).columns[-1] == "z"


def test_names_with_hash(sales):
    derived = derive(sales, [Rule(1, "a#b", "INT", 0, "x"), Rule(2, "c#", "INT", 1, "`a#b` + 1")])
    assert derived.columns == ["a#b", "c#"]


def test_redefinition_is_refused(sales):
    with pytest.raises(ValueError, match="rule 7: column K"):
        derive(sales, [Rule(7, "K", "STRING", 1, "'x'")])
    with pytest.raises(ValueError, match="rule 2"):
        derive(sales, [Rule(1, "a", "INT", 0, "x"), Rule(2, "A", "INT", 0, "x")])


def test_same_level_reference_is_refused_and_setting_restored(spark, sales):
    name = "spark.sql.lateralColumnAlias.enableImplicitResolution"
    before = spark.conf.get(name)
    with pytest.raises(AnalysisException):
        derive(sales, [Rule(1, "p", "INT", 1, "x"), Rule(2, "q", "INT", 1, "p + 1")])
    assert spark.conf.get(name) == before


def test_values_that_do_not_fit_are_null(sales):
    rules = [
        Rule(1, "t", "TINYINT", 0, "x * 100"),
        Rule(2, "n", "INT", 0, "k"),
        Rule(3, "d", "DECIMAL(3,1)", 0, "x * 100"),
    ]
    assert {r[1] for r in derive(sales, rules).collect()} == {None}
    assert rows(derive(sales, rules).filter("t IS NOT NULL")) == []


def test_ansi_off_gives_null_instead_of_errors(spark, sales):
    rules = [Rule(1, "q", "DOUBLE", 0, "x / (id - 1)"), Rule(2, "c", "INT", 0, "CAST(k AS INT)")]
    before = spark.conf.get("spark.sql.ansi.enabled")
    found = derive(sales, rules, ansi=False)
    assert spark.conf.get("spark.sql.ansi.enabled") == before
    assert found.first()["q"] is None
    assert found.filter("c IS NOT NULL").count() == 0
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO|CAST_INVALID_INPUT"):
        derive(sales, rules, ansi=True).collect()


def test_rule_text_may_use_the_view(spark, sales):
    rules = [
        Rule(1, "id", "INT", 0, "sales_view.id"),
        Rule(2, "top", "INT", 1, "(SELECT max(id) FROM sales_view)"),
        Rule(3, "more", "INT", 2, "sales_view.top + 1"),
    ]
    derived = derive(sales, rules, view="sales_view")
    assert {r["more"] for r in derived.collect()} == {6}
    assert spark.table("sales_view").columns == ["id", "top", "more"]


WINDOWS = [
    Rule(1, "n", "BIGINT", 1, "count(*) OVER (PARTITION BY k)"),
    Rule(2, "n_all", "BIGINT", 1, "count(x) OVER ()"),
    Rule(3, "s", "DOUBLE", 1, "round(sum(y) over (partition by k) / count(y) OVER(PARTITION BY k))"),
    Rule(4, "m", "STRING", 1, "mode(x, true) OVER (PARTITION BY k)"),
    Rule(5, "m2", "STRING", 1, "mode(concat(k, ')'), true) OVER (PARTITION BY x % 2 = 0)"),
    Rule(7, "set", "INT", 1, "size(collect_set(x) OVER (PARTITION BY k, id > 3))"),
    Rule(8, "rank", "INT", 1, "rank() OVER (PARTITION BY k ORDER BY x)"),
    Rule(9, "run", "INT", 1, "sum(x) OVER (PARTITION BY k ORDER BY id ROWS UNBOUNDED PRECEDING)"),
    Rule(11, "mean", "DOUBLE", 1, "avg(x) OVER (PARTITION BY k)"),
    Rule(12, "top", "INT", 2, "max(n) OVER (PARTITION BY n_all)"),
]


@pytest.mark.parametrize("stage_groups", [False, True])
def test_joined_group_values_equal_spark_windows(sales, stage_groups):
    """Null keys are a group, in every form of window."""
    joined = derive(sales, WINDOWS, stage_groups=stage_groups)
    assert rows(joined) == rows(derive(sales, WINDOWS, windows="spark"))


def test_several_modes_and_uncombinable_aggregates_share_a_group_table(sales):
    over = "OVER (PARTITION BY k)"
    rules = [
        Rule(1, "a", "STRING", 1, f"MostCommon(x) {over}"),
        Rule(2, "b", "DOUBLE", 1, f"mode(y, true) {over}"),
        Rule(3, "c", "DOUBLE", 1, f"stddev(x) {over}"),
        Rule(4, "d", "BIGINT", 1, f"count(DISTINCT x) {over}"),
        Rule(5, "e", "DOUBLE", 1, f"WeightedAverage(y, x) {over}"),
        Rule(6, "f", "DECIMAL(20,2)", 1, f"sum(CAST(y AS DECIMAL(10,2))) {over}"),
        Rule(7, "g", "STRING", 1, f"max(k) {over}"),
    ]
    found = {r["id"]: r for r in derive(sales, rules).collect()}
    assert [found[i]["g"] for i in (1, 3, 5)] == ["a", None, "b"]
    assert (found[1]["a"], found[1]["b"], found[1]["d"], found[1]["e"]) == ("10", 2.5, 2, 10.0)
    assert (found[3]["a"], found[3]["b"], found[3]["e"]) == ("30", 1.0, 10.0)
    assert (found[5]["a"], found[5]["c"], found[5]["e"]) == (None, None, 0.0)
    assert str(found[3]["f"]) == "5.00"


def test_grand_total_with_window_keeps_its_single_row(sales):
    rules = [Rule(1, "n", "BIGINT", 0, "count(*)"), Rule(2, "w", "BIGINT", 0, "count(*) OVER ()")]
    assert rows(derive(sales, rules)) == [(5, 1)]


def test_windows_without_order_are_recognised():
    assert partition_keys("PARTITION BY a, f(b, c)") == ("a", "f(b, c)")
    assert partition_keys("partition by a order by b") is None
    assert partition_keys("") == ()
    found = GroupValues()
    text = found.extract("'sum(x) OVER ()' || sum( x ) OVER (PARTITION BY k)|| sum(x) OVER (PARTITION BY k)")
    assert text == "'sum(x) OVER ()' || __group_value_0|| __group_value_0"


def test_splitting_a_level_changes_nothing(sales):
    one = [Rule(1, "a", "INT", 1, "x + 1"), Rule(2, "b", "BIGINT", 1, "sum(x) OVER (PARTITION BY k)")]
    two = [one[0], one[1]._replace(level=2)]
    assert rows(derive(sales, one)) == rows(derive(sales, two))


def test_hot_key_is_split_by_the_join(spark):
    """A key with a third of the rows: same values, and its partition is read by several tasks."""
    df = spark.range(0, 60000, 1, 12).select(
        "id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.hash("id") % 5000).alias("k"),
        F.sha2(F.col("id").cast("string"), 512).alias("pad"),
    )
    rules = [
        Rule(1, "n", "BIGINT", 1, "count(pad) OVER (PARTITION BY k)"),
        Rule(2, "usual", "STRING", 1, "MostCommon(id % 3) OVER (PARTITION BY k)"),
        Rule(3, "last", "STRING", 1, "max(pad) OVER (PARTITION BY k)"),
    ]
    small = {
        "spark.sql.autoBroadcastJoinThreshold": -1,
        "spark.sql.adaptive.autoBroadcastJoinThreshold": -1,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": 100_000,
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": 2,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": 200_000,
    }
    with session_settings(spark, small):
        joined = derive(df, rules)
        found = joined.groupBy("k").agg(F.max("n").alias("n"), F.count("*").alias("rows"))
        assert found.filter("n <> rows").isEmpty()
        joined.persist()
        joined.count()
        assert "skew=true" in plan(joined)
        joined.unpersist()
    assert "Window" not in plan(derive(df, rules))


def test_flagship_plan_reads_needed_columns_and_has_no_window(spark):
    text = plan(flagship(spark, SF).select("order_key", "cust_net"))
    assert "Window" not in text
    assert "l_tax" not in text and "l_returnflag" not in text.split("ReadSchema", 1)[1][:400]
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_windows_with_equal_partitions_share_one_exchange(spark):
    text = plan(flagship(spark, SF, windows="spark"))
    tree = text.split("\n\n")[0]
    assert len(re.findall(r"[- ]Exchange \(", tree)) == 1
    assert len(re.findall(r"[- ]Window \(", tree)) == 1


def test_group_values_by_name(sales):
    found = with_group_values(sales, ["k"], {"total": "sum(x)", "rows": "count(*)"})
    assert rows(found.select("id", "total", "rows")) == [
        (1, 30, 2), (2, 30, 2), (3, 35, 2), (4, 35, 2), (5, None, 1),
    ]
    everything = with_group_values(sales, [], {"top": "max(x)"})
    assert {r["top"] for r in everything.collect()} == {30}


RUNNING = [
    Rule(1, "number", "INT", 1, "row_number() OVER (PARTITION BY k ORDER BY o DESC, id)"),
    Rule(2, "rank", "INT", 1, "rank() OVER (PARTITION BY k ORDER BY o)"),
    Rule(3, "dense", "INT", 1, "dense_rank() OVER (PARTITION BY k ORDER BY o) + 1"),
    Rule(4, "total", "BIGINT", 1, "sum(x) OVER (PARTITION BY k ORDER BY o)"),
    Rule(5, "n", "BIGINT", 1, "count(x) OVER (PARTITION BY k ORDER BY o DESC NULLS FIRST)"),
    Rule(
        6, "low", "INT", 1,
        "min(x) OVER (PARTITION BY k ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
    ),
    Rule(7, "high", "INT", 1, "max(x) OVER (PARTITION BY k ORDER BY id ROWS UNBOUNDED PRECEDING)"),
    Rule(8, "money", "DECIMAL(20,2)", 1, "sum(CAST(x AS DECIMAL(9,2))) OVER (ORDER BY id)"),
    Rule(9, "before", "INT", 1, "lag(x) OVER (PARTITION BY k ORDER BY id)"),
    Rule(12, "far", "INT", 1, "lag(x, 700, id) OVER (PARTITION BY k ORDER BY id)"),
    Rule(13, "after", "INT", 1, "lead(x * 2, 3) OVER (PARTITION BY k ORDER BY o DESC, id)"),
    Rule(14, "all", "INT", 1, "coalesce(lead(x) OVER (ORDER BY id), -7)"),
    Rule(15, "own", "BIGINT", 1, "lag(id, 0, -1) OVER (PARTITION BY k ORDER BY id)"),
    Rule(10, "of_key", "BIGINT", 1, "count(*) OVER (PARTITION BY k)"),
    Rule(11, "late", "BIGINT", 2, "max(n) OVER (PARTITION BY rank % 7)"),
]


@pytest.fixture(scope="module")
def ordered(spark):
    """A third of the rows has one key, some have none; orders repeat and may be null."""
    return spark.range(0, 4000, 1, 5).select(
        "id",
        F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 7 > 0, F.col("id") % 50).alias("k"),
        F.when(F.col("id") % 11 > 0, F.hash("id") % 40).alias("o"),
        F.when(F.col("id") % 13 > 0, F.hash(F.col("id") + 1) % 1000).alias("x"),
    )


MANY_BLOCKS = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}


def test_running_values_in_blocks_equal_spark_windows(spark, ordered):
    with session_settings(spark, MANY_BLOCKS):
        in_blocks = derive(ordered, RUNNING, blocks=20, view="ordered_view")
    assert in_blocks.dtypes == derive(ordered, RUNNING, windows="spark").dtypes
    assert rows(in_blocks) == rows(derive(ordered, RUNNING, windows="spark"))


def test_blocks_cut_a_large_key(spark, ordered):
    rules = [Rule(1, "n", "BIGINT", 1, "sum(x) OVER (PARTITION BY ordered_view.k ORDER BY id)")]
    with session_settings(spark, MANY_BLOCKS):
        in_blocks = derive(ordered, rules, view="ordered_view")
        blocks = cut_into_blocks(ordered, ordered_window("PARTITION BY k ORDER BY id")[0])
        assert blocks.filter("k = -1").select("__block").distinct().count() > 2
        finer = cut_into_blocks(ordered, ordered_window("ORDER BY id")[0], blocks=20)
        assert finer.select("__block").distinct().count() == 20
    text = plan(in_blocks)
    assert "__block" in text and "BroadcastHashJoin" in text
    assert "__block" not in plan(derive(ordered, rules, windows="spark", view="ordered_view"))
    assert rows(in_blocks) == rows(derive(ordered, rules, windows="spark", view="ordered_view"))


def test_rows_of_equal_order_fill_many_blocks(spark, ordered):
    """Three order values, some null, in twenty blocks of about equal size."""
    few = ordered.withColumn("o", F.expr("nullif(id % 4, 3)"))
    over = "OVER (PARTITION BY k ORDER BY o DESC"
    rules = [
        Rule(1, "rank", "INT", 1, f"rank() {over})"),
        Rule(2, "dense", "INT", 1, f"dense_rank() {over})"),
        Rule(3, "total", "BIGINT", 1, f"sum(x) {over} RANGE UNBOUNDED PRECEDING)"),
        Rule(4, "low", "INT", 1, f"min(x) {over})"),
        Rule(5, "n", "BIGINT", 1, f"count_if(x > 500) {over})"),
        Rule(9, "share", "DOUBLE", 1, f"percent_rank() {over})"),
        Rule(10, "up_to", "DOUBLE", 1, f"cume_dist() {over})"),
        Rule(11, "tile", "INT", 1, "ntile(30) OVER (PARTITION BY k ORDER BY id)"),
        Rule(12, "mean", "DOUBLE", 1, f"avg(x) {over})"),
        Rule(13, "mean_money", "DECIMAL(20,6)", 1, f"avg(CAST(x AS DECIMAL(9,2))) {over})"),
        Rule(6, "all_dense", "INT", 1, "dense_rank() OVER (ORDER BY o)"),
        Rule(7, "all_rank", "INT", 1, "rank() OVER (ORDER BY o)"),
        Rule(8, "all_money", "DECIMAL(20,2)", 1, "sum(CAST(x AS DECIMAL(9,2))) OVER (ORDER BY o)"),
    ]
    with session_settings(spark, MANY_BLOCKS):
        blocks = cut_into_blocks(few, ordered_window("ORDER BY o")[0], blocks=20)
        sizes = [row["count"] for row in blocks.groupBy("__block").count().collect()]
        assert len(sizes) == 20 and max(sizes) < 2 * 4000 / 20
        found = derive(few, rules, blocks=20)
        assert rows(found) == rows(derive(few, rules, windows="spark"))


def test_row_number_of_equal_orders_is_a_numbering(spark, ordered):
    rules = [Rule(1, "i", "INT", 1, "row_number() OVER (PARTITION BY k ORDER BY 1)")]
    with session_settings(spark, MANY_BLOCKS):
        found = derive(ordered, rules, blocks=20)
    counts = found.groupBy("k").agg(F.count("*").alias("n"), F.count_distinct("i").alias("d"),
                                    F.max("i").alias("m"))
    assert counts.filter("n <> d OR n <> m").isEmpty()


def test_ranks_have_one_type_in_both_plans(spark, ordered):
    rules = [
        Rule(1, "h", "BIGINT", 1, "hash(row_number() OVER (PARTITION BY k ORDER BY id))"),
        Rule(2, "i", "BIGINT", 1, "rank() OVER (ORDER BY id) * 500000"),
    ]
    assert rows(derive(ordered, rules)) == rows(derive(ordered, rules, windows="spark"))


def test_windows_of_a_subquery_stay_there(spark):
    vv = spark.range(10).selectExpr("id", "id % 2 AS k")
    text = "(SELECT max(s) FROM (SELECT sum(id) OVER (PARTITION BY k) AS s FROM vv))"
    rules = [Rule(1, "m", "BIGINT", 1, text), Rule(2, "s", "BIGINT", 1, "sum(id) OVER (PARTITION BY k)")]
    derived = derive(vv, rules, view="vv")
    assert {r.m for r in derived.collect()} == {25}


@pytest.mark.parametrize("call", ["approx_percentile(id, 0.5)", "percentile_cont(0.5) WITHIN GROUP (ORDER BY id)", "regr_count(id, id)"])
def test_any_aggregate_makes_level_0_a_total(spark, call):
    rules = [Rule(1, "a", "DOUBLE", 0, call), Rule(2, "n", "BIGINT", 0, "count(*) OVER ()")]
    source = spark.range(10)
    found = rows(derive(source, rules))
    assert found == rows(derive(source, rules, windows="spark")) and len(found) == 1


def test_other_windows_are_left_alone():
    for over in ("PARTITION BY k", "ORDER BY x ROWS BETWEEN 1 PRECEDING AND CURRENT ROW", "",
                 "PARTITION BY f(SELECT 1 ORDER BY 2) ORDER BY x", "PARTITION BY 'a' ORDER BY x",
                 "ORDER BY x RANGE BETWEEN 1 PRECEDING AND CURRENT ROW"):
        assert ordered_window(over) is None, over
    window = ordered_window("partition by a, f(b, c) order by d desc, e rows unbounded preceding")
    assert window == (OrderedWindow(("a", "f(b, c)"), ("d desc", "e")), True)
    ranged = ordered_window("ORDER BY x RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW")
    assert ranged == (OrderedWindow((), ("x",)), False)


def test_grand_total_counts_common_values_first(sales):
    rules = [
        Rule(1, "n", "BIGINT", 0, "count(y) + 1"),
        Rule(2, "m", "STRING", 0, "concat(MostCommon(k), '!')"),
        Rule(3, "t", "BIGINT", 0, "sum(x)"),
        Rule(4, "one", "INT", 0, "1"),
    ]
    for source, expected in ((sales, (5, "a!", 65, 1)), (sales.filter("false"), (1, None, None, 1))):
        derived = derive(source, rules)
        assert rows(derived) == [expected]
        assert "mode(" not in plan(derived)
    apart = [*rules, Rule(5, "low", "STRING", 0, "concat(min(k), max(k))")]
    assert rows(derive(sales, apart)) == [(5, "a!", 65, 1, "ab")]
    with_filter = [*rules, Rule(5, "f", "BIGINT", 0, "count(*) FILTER (WHERE x > 5)")]
    assert rows(derive(sales, with_filter)) == [(5, "a!", 65, 1, 3)]


def test_level_0_writes_needed_columns_only(spark, ordered):
    """Names that the source repeats do no harm, and what no rule names is not written."""
    twice = ordered.alias("a").join(ordered.select("id", "x").alias("b"), F.expr("a.id = b.id"))
    source = twice.selectExpr("a.id", "b.id", "k", "o", "a.x AS wide", "b.x AS `Amount`")
    rules = [
        Rule(1, "k", "INT", 0, "k"),
        Rule(2, "total", "BIGINT", 0, "sum(amount) OVER (PARTITION BY k ORDER BY o)"),
        Rule(3, "n", "BIGINT", 0, "count(*) OVER (PARTITION BY k)"),
    ]
    folder = Path(shared_folder(spark)) / "ruleframe"
    before = set(folder.glob("level-*"))
    found = derive(source, rules, stage_source=True)
    assert rows(found) == rows(derive(source, rules, windows="spark"))
    (written,) = set(folder.glob("level-*")) - before
    assert set(spark.read.parquet(str(written)).columns) == {"k", "o", "Amount"}


def test_windows_left_to_spark_are_named(sales):
    rules = [
        Rule(1, "a", "INT", 1, "sum(x) OVER (ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 FOLLOWING)"),
        Rule(2, "b", "INT", 1, "size(collect_list(x) OVER (PARTITION BY k))"),
        Rule(3, "c", "INT", 1, "sum(x) OVER (PARTITION BY k ORDER BY id) + count(x) OVER ()"),
    ]
    with pytest.warns(RuntimeWarning) as told:
        found = derive(sales, rules)
    assert rows(found) == rows(derive(sales, rules, windows="spark"))
    texts = [str(w.message) for w in told if w.category is RuntimeWarning and "rule " in str(w.message)]
    assert [("column a" in t, "whole table" in t) for t in texts] == [(True, True), (False, False)]
