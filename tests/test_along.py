"""Sliding frames, percentiles, distinct counts, group tables rolled up, joins along time, lineage, sketches."""

import datetime
import random
import warnings
from collections import Counter, defaultdict

import duckdb
import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from ruleframe import Rule, derive
from ruleframe.operators import sliding, temporal
from ruleframe.operators.groups import GroupValues, group_tables
from ruleframe.operators.increment import attach_increment, group_state, group_values_of
from ruleframe.operators.lineage import lowest_levels, rule_lineage
from ruleframe.operators.percentiles import plain_percentiles
from ruleframe.operators.running import OrderedWindow, cut_into_blocks
from ruleframe.operators.sketches import column_histogram, merged_statistics, partition_statistics, replaced_partitions
from ruleframe.operators.sliding import Frame, sliding_window
from ruleframe.operators.temporal import join_as_of, join_intervals
from ruleframe.session import stage
from ruleframe.workloads import along


@pytest.fixture(scope="module")
def uneven(spark):
    """A third of the rows in one key, null keys and orders, days with many rows."""
    r = random.Random(3)
    day = datetime.date(2020, 1, 1)
    rows = [
        (i, r.choice([None, 1, 1, 1, 1, 2, 3]), r.choice([None, *range(40)]), r.randrange(100), day + datetime.timedelta(days=r.randrange(60)))
        for i in range(1_500)
    ]
    df = spark.createDataFrame(rows, "id long, k int, o int, v long, d date").repartition(5)
    return stage(df, "uneven")


def same_as_spark(df, text, kind="STRING"):
    rules = [Rule(1, "x", kind, 1, text)]
    with warnings.catch_warnings():
        warnings.simplefilter("error", RuntimeWarning)  # a window left to Spark warns
        found = derive(df, rules, blocks=12).collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, derive(df, rules, windows="spark").collect()))


@pytest.mark.parametrize("text", [
    "sum(v) OVER (PARTITION BY k ORDER BY o, id ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)",
    "count(*) OVER (PARTITION BY k ORDER BY o DESC, id ROWS BETWEEN 5 PRECEDING AND 2 PRECEDING)",
    "max(v) OVER (ORDER BY o, id ROWS BETWEEN CURRENT ROW AND 400 FOLLOWING)",
    "first_value(v) OVER (PARTITION BY k ORDER BY o, id ROWS 2 PRECEDING)",
    "array_join(collect_list(v) OVER (PARTITION BY k ORDER BY o, id ROWS BETWEEN 1 FOLLOWING AND 4 FOLLOWING), ',')",
    "count(DISTINCT_V) OVER (PARTITION BY k ORDER BY o, id ROWS 1 PRECEDING)".replace("DISTINCT_V", "nullif(v, 3)"),
    "sum(v) OVER (PARTITION BY k ORDER BY o RANGE BETWEEN 3 PRECEDING AND 2 FOLLOWING)",
    "count(v) OVER (PARTITION BY k ORDER BY o DESC RANGE BETWEEN 3 PRECEDING AND 1 PRECEDING)",
    "min(v) OVER (PARTITION BY k ORDER BY d RANGE BETWEEN INTERVAL '7' DAYS PRECEDING AND CURRENT ROW)",
    "avg(v) OVER (PARTITION BY k ORDER BY o NULLS LAST RANGE BETWEEN CURRENT ROW AND 4 FOLLOWING)",
    "max(v) OVER (PARTITION BY k ORDER BY d DESC NULLS FIRST RANGE BETWEEN INTERVAL 1 MONTH PRECEDING AND INTERVAL 2 MONTHS FOLLOWING)",
    "bool_or(v > 98) OVER (ORDER BY o RANGE 1 PRECEDING)",
])
def test_sliding_frames_equal_sparks(uneven, text):
    same_as_spark(uneven, text)


def test_sliding_frames_of_a_weighted_average_and_a_view(uneven):
    over = "OVER (PARTITION BY v.k ORDER BY v.o RANGE BETWEEN 2 PRECEDING AND CURRENT ROW)"
    rules = [Rule(1, "w", "DOUBLE", 1, f"WeightedAverage(id, v.v) {over}"), Rule(2, "n", "BIGINT", 1, f"count_if(v.v > 50) {over}")]
    found = derive(uneven, rules, view="v", blocks=12).collect()
    expected = derive(uneven, rules, view="v", windows="spark").collect()
    near = lambda rows: {r.id: (pytest.approx(r.w) if r.w is not None else None, r.n) for r in rows}
    assert {r.id: (r.w, r.n) for r in found} == near(expected)


def test_frames_that_are_read(spark):
    assert sliding_window("PARTITION BY a ORDER BY b ROWS 3 PRECEDING")[1] == Frame("ROWS", (-1, "3"), (0, "0"))
    assert sliding_window("ORDER BY b RANGE BETWEEN INTERVAL '1' DAY PRECEDING AND 2 FOLLOWING") is not None
    for other in ("ORDER BY b", "ORDER BY b ROWS UNBOUNDED PRECEDING", "ORDER BY a, b RANGE 3 PRECEDING", "ORDER BY b ROWS n PRECEDING"):
        assert sliding_window(other) is None


def test_equal_rows_are_cut_apart(spark):
    """A third of all rows are alike in every column."""
    rows = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("v"), F.lit(1).alias("k"))
    cut = cut_into_blocks(rows, OrderedWindow(("k",), ("v",)), 32)
    sizes = [r["count"] for r in cut.groupBy("__block").count().collect()]
    assert sum(sizes) == 60_000 and len(sizes) > 28 and max(sizes) < 3 * 60_000 / 32


@pytest.mark.parametrize("text", [
    "percentile(v, 0.25) OVER (PARTITION BY k)",
    "median(v) OVER ()",
    "percentile_cont(0.9) WITHIN GROUP (ORDER BY CAST(v AS DOUBLE) / 7) OVER (PARTITION BY k)",
    "median(nullif(o, 3)) OVER (PARTITION BY k, v) + count(*) OVER (PARTITION BY k, v) + percentile(v, 1) OVER (PARTITION BY k, v)",
    "concat(MostCommon(v) OVER (PARTITION BY k), ' ', median(o) OVER (PARTITION BY k), ' percentile_cont(0.5) WITHIN GROUP (ORDER BY x)')",
])
def test_percentiles_equal_sparks(uneven, text):
    same_as_spark(uneven, text)


def test_percentile_text():
    assert plain_percentiles("percentile_cont(0.5) WITHIN GROUP (ORDER BY f(a, b)) OVER (x)") == "percentile(f(a, b), 0.5) OVER (x)"
    for kept in ("'percentile_cont(0.5) WITHIN GROUP (ORDER BY a)'", "percentile_cont(0.5) WITHIN GROUP (ORDER BY a DESC)", "my.percentile_cont(1)"):
        assert plain_percentiles(kept) == kept


@pytest.mark.parametrize("over", ["PARTITION BY k ORDER BY o NULLS FIRST", "ORDER BY d DESC, o NULLS LAST", "PARTITION BY k, v % 2 ORDER BY d"])
def test_running_distinct_counts(uneven, over):
    events = uneven.toArrow()  # noqa: F841 - DuckDB reads it by name
    found = derive(uneven, [Rule(1, "x", "BIGINT", 1, f"RunningDistinct(nullif(v, 4)) OVER ({over})")], blocks=12)
    expected = duckdb.sql(f"SELECT *, count(DISTINCT nullif(v, 4)) OVER ({over}) FROM events").fetchall()
    assert Counter(map(tuple, found.collect())) == Counter(expected)


def test_a_running_distinct_count_needs_an_order(uneven):
    with pytest.raises(ValueError, match="needs OVER"):
        derive(uneven, [Rule(1, "x", "BIGINT", 1, "RunningDistinct(v) OVER (PARTITION BY k)")])


# --- group tables of key sets that contain each other ----------------------------------------------


def test_three_key_sets_read_the_rows_once(spark, uneven, monkeypatch):
    found = GroupValues()
    for text in ("sum(v) OVER (PARTITION BY k)", "max(o) OVER (PARTITION BY k, o)", "count(*) OVER (PARTITION BY k, o, v)", "min(v) OVER ()"):
        found.extract(text)
    kept = []
    tables = group_tables(uneven, found.by_keys(), lambda table: kept.append(plan(table)) or stage(table, "groups"))
    assert len(tables) == 4 and len(kept) == 4
    assert sum("/uneven-" in text for text in kept) == 1 and sum("/groups-" in text for text in kept) == 3


@pytest.mark.parametrize("text", [
    "sum(v) OVER (PARTITION BY k) + sum(v) OVER (PARTITION BY k, o) + count(o) OVER (PARTITION BY o) + max(v) OVER ()",
    "concat(sum(CAST(v AS DECIMAL(10,2))) OVER (PARTITION BY k), ' ', min(d) OVER (PARTITION BY d, k), ' ', bit_xor(v) OVER (PARTITION BY k))",
    "concat(MostCommon(v) OVER (PARTITION BY k), count_if(v > 3) OVER (PARTITION BY k, o), median(v) OVER (PARTITION BY k, o))",
    "count(*) OVER (PARTITION BY o, k) - count(DISTINCT v) OVER (PARTITION BY k, o, d) - count(*) OVER (PARTITION BY k)".replace("DISTINCT v", "v"),
])
def test_rolled_up_values_equal_sparks(uneven, text):
    same_as_spark(uneven, text)


# --- values that grow with new rows ---------------------------------------------------------------


INCREMENT = {
    "total": "sum(v)", "n": "count(o)", "low": "min(d)", "odd": "bool_or(v % 2 = 1)", "mean": "avg(v)", "usual": "MostCommon(o)",
    "weighted": "WeightedAverage(v, o)", "mixed": "bit_xor(v)", "over_90": "count_if(v > 90)",
}


def test_increments_give_the_values_of_a_full_run(spark, uneven):
    state = None
    for low, high in ((0, 700), (700, 1_100), (1_100, 1_500)):
        rows = uneven.where(f"id >= {low} AND id < {high}")
        if state is None:
            state = group_state(rows, ["k"], INCREMENT)
        else:
            found, state = attach_increment(rows, state)
        state = state.stored(stage(state.sums, "sums"), stage(state.counts, "counts"))
    full = group_values_of(group_state(uneven, ["k"], INCREMENT))
    key = lambda r: (r[0] is None, r[0])
    for a, b in zip(sorted(group_values_of(state).collect(), key=key), sorted(full.collect(), key=key), strict=True):
        assert tuple(a) == pytest.approx(tuple(b)) if None not in tuple(a) else tuple(a) == tuple(b)
    over = {name: f"{text} OVER (PARTITION BY k)" for name, text in INCREMENT.items()}
    rules = [Rule(i, name, kind, 1, over[name]) for i, (name, kind) in enumerate(zip(over, [kind for _, kind in found.select(*over).dtypes]))]
    expected = {r.id: r for r in derive(uneven, rules).where("id >= 1100").collect()}
    for r in found.collect():
        for name in INCREMENT:
            assert r[name] == (pytest.approx(expected[r.id][name]) if isinstance(r[name], float) else expected[r.id][name])


def test_increments_do_not_read_the_old_rows(spark, uneven):
    old = stage(uneven.where("id < 1000"), "oldrows")
    state = group_state(old, ["k"], INCREMENT)
    state = state.stored(stage(state.sums, "sums"), stage(state.counts, "counts"))
    found, merged = attach_increment(uneven.where("id >= 1000"), state)
    for text in (plan(found), plan(merged.sums), plan(merged.counts)):
        assert "/oldrows-" not in text and ("/sums-" in text or "/counts-" in text)


@pytest.mark.parametrize("text", ["median(v)", "count(DISTINCT v)", "v + 1", "avg(CAST(v AS DECIMAL(5,1)))"])
def test_increments_refuse_what_does_not_merge(uneven, text):
    with pytest.raises(ValueError, match="cannot be merged"):
        group_state(uneven, ["k"], {"x": text})


# --- joins along time -----------------------------------------------------------------------------


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("strict", [False, True])
def test_as_of_join_against_brute_force(spark, direction, strict):
    r = random.Random(4)
    left = [(i, r.choice([1, 1, 1, 2, 3, None]), r.choice([None, *range(0, 60)])) for i in range(400)]
    right = [(r.choice([1, 1, 2, 4, None]), r.choice([None, *range(0, 60, 3)]), r.choice([None, *range(9)])) for _ in range(90)]
    a = spark.createDataFrame(left, "id int, k int, t int").repartition(4)
    b = spark.createDataFrame(right, "k int, at int, x int")
    found = join_as_of(a, b, ["k"], "t", "at", ["at", "x"], direction=direction, strict=strict, within="20", blocks=10)

    def match(k, t):
        if k is None or t is None:
            return None, None
        if direction == "backward":
            fit = [(at, -1 if x is None else x) for kk, at, x in right if kk == k and at is not None and (at < t or at == t and not strict)]
            best = max(fit, default=None)
        else:
            fit = [(at, -1 if x is None else x) for kk, at, x in right if kk == k and at is not None and (at > t or at == t and not strict)]
            best = min(fit, default=None)
        if best is None or abs(best[0] - t) > 20:
            return None, None
        return best[0], None if best[1] == -1 else best[1]

    assert sorted(map(tuple, found.collect()), key=repr) == sorted(((i, k, t, *match(k, t)) for i, k, t in left), key=repr)


def test_as_of_join_of_nothing_and_of_clashing_columns(spark):
    a = spark.createDataFrame([(1, 1, 5)], "id int, k int, t int")
    none = spark.createDataFrame([], "k int, at int, x int")
    assert join_as_of(a, none, ["k"], "t", "at", ["x"]).collect()[0].x is None
    assert join_as_of(a.limit(0), none, ["k"], "t", "at", ["x"]).collect() == []
    with pytest.raises(ValueError, match="both sides"):
        join_as_of(a, none.withColumn("ID", F.lit(1)), ["k"], "t", "at", ["ID"])


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("kind", ["int", "double", "timestamp_ntz", "date"])
def test_interval_join_against_brute_force(spark, how, kind):
    r = random.Random(5)
    make = {
        "int": lambda x: x, "double": lambda x: x / 7, "date": lambda x: datetime.date(2020, 1, 1) + datetime.timedelta(days=x),
        "timestamp_ntz": lambda x: datetime.datetime(2020, 3, 28) + datetime.timedelta(minutes=7 * x),
    }[kind]
    points = [(i, r.choice([1, 1, 2, None]), None if i % 31 == 0 else make(r.randrange(-50, 900))) for i in range(300)]
    spans = []
    for j in range(80):
        start = r.randrange(-80, 900)
        end = start + r.choice([-3, 0, 1, 2, 7, 40, 300, 5_000])
        spans.append((j, r.choice([1, 2, 3, None]), None if j % 17 == 0 else make(start), None if j % 13 == 0 else make(end)))
    a = spark.createDataFrame(points, f"id int, k int, at {kind}")
    b = spark.createDataFrame(spans, f"j int, k int, since {kind}, until {kind}")
    found = join_intervals(a, b, ["k"], "at", "since", "until", how=how)
    expected = []
    for i, k, at in points:
        hits = [
            (i, k, at, j, s, e) for j, kk, s, e in spans
            if at is not None and k is not None and k == kk and (s is None or s <= at) and (e is None or at < e) and (s is None or e is None or s < e)
        ]
        expected += hits or ([(i, k, at, None, None, None)] if how == "left" else [])
    assert found.columns == ["id", "k", "at", "j", "since", "until"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)
    assert "NestedLoop" not in plan(found) and "CartesianProduct" not in plan(found)


@pytest.mark.parametrize("kind", ["int", "double", "date", "timestamp_ntz"])
def test_totals_of_intervals_are_those_of_their_pairs(spark, kind):
    r = random.Random(6)
    make = {
        "int": lambda x: x, "double": lambda x: x / 7, "date": lambda x: datetime.date(2020, 1, 1) + datetime.timedelta(days=x),
        "timestamp_ntz": lambda x: datetime.datetime(2020, 3, 28) + datetime.timedelta(minutes=7 * x),
    }[kind]
    points = [(r.choice([1, 1, 2, None]), None if i % 31 == 0 else make(r.randrange(-5, 90)), r.choice([None, -3, 8])) for i in range(300)]
    spans = []
    for j in range(80):
        start = r.randrange(-8, 90)
        end = start + r.choice([-3, 0, 1, 1, 2, 7, 40, 500])
        spans.append((j % 70, r.choice([1, 2, 3, None]), None if j % 17 == 0 else make(start), None if j % 13 == 0 else make(end)))
    a = spark.createDataFrame(points, f"k int, at {kind}, v int").withColumn("w", F.expr("CAST(v / 4 AS DECIMAL(9,2))"))
    b = spark.createDataFrame(spans, f"j int, k int, since {kind}, until {kind}").withColumn("row", F.monotonically_increasing_id())
    totals = {"n": ("count", "at"), "known": ("count", "v"), "v": ("sum", "v"), "w": ("sum", "w")}
    found = join_intervals(a, b, ["k"], "at", "since", "until", totals=totals)
    pairs = join_intervals(a, b, ["k"], "at", "since", "until")
    expected = pairs.groupBy(*b.columns).agg(F.count("at").alias("n"), F.count("v").alias("known"), F.sum("v").alias("v"), F.sum("w").alias("w"))
    assert found.columns == [*b.columns, "n", "known", "v", "w"]
    assert found.dtypes == expected.select(*found.columns).dtypes
    assert rows(found) == rows(expected.select(*found.columns))
    with pytest.raises(ValueError, match="whole numbers"):
        join_intervals(a.withColumn("x", F.lit(1.5)), b, ["k"], "at", "since", "until", totals={"x": ("sum", "x")})


def test_running_sums_of_totals_do_not_overflow(spark):
    a = spark.createDataFrame([(1, i, 2**62) for i in range(8)] + [(1, 9, None)], "k int, at int, v long")
    b = spark.createDataFrame([(1, 6, 7), (1, 9, 10), (1, 20, None), (1, None, 1)], "k int, since int, until int")
    found = join_intervals(a, b, ["k"], "at", "since", "until", totals={"n": ("count", "v"), "v": ("sum", "v")})
    assert set(map(tuple, found.collect())) == {(1, 6, 7, 1, 2**62), (1, 9, 10, 0, None), (1, None, 1, 1, 2**62)}
    none = join_intervals(a, b.limit(0), ["k"], "at", "since", "until", totals={"n": ("count", "v")})
    assert none.count() == 0 and join_intervals(a.limit(0), b, ["k"], "at", "since", "until", totals={"n": ("count", "v")}).count() == 0


def test_interval_query_makes_no_pairs(spark, tmp_path):
    """Times that every line and order has at once would make 1,600 x 800 pairs."""
    noon = datetime.datetime(2020, 1, 1)
    lines = spark.createDataFrame([(i, 1, 3, noon) for i in range(1_600)], "l_orderkey long, l_linenumber int, l_suppkey long, l_shipdate timestamp_ntz")
    orders = spark.createDataFrame([(5 * i + 1, 3, noon) for i in range(800)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    found = along.join_intervals(spark, str(tmp_path))
    assert "l_shipdate" not in plan(found)
    assert {(r.lines, r.numbers) for r in found.collect()} == {(1_600, 1_600)}


def test_interval_join_of_nothing(spark):
    a = spark.createDataFrame([(1, 1, 5)], "id int, k int, at int")
    none = spark.createDataFrame([], "k int, since int, until int")
    assert join_intervals(a, none, ["k"], "at", "since", "until").collect() == []
    assert len(join_intervals(a, none, ["k"], "at", "since", "until", how="left").collect()) == 1
    assert join_intervals(a.limit(0), none, ["k"], "at", "since", "until").collect() == []


# --- lineage --------------------------------------------------------------------------------------


def test_lineage_of_a_chain_a_cycle_and_what_hangs_on_it(spark):
    rules = [("a", "x", 0), ("b", "a + 1", 1), ("c", "b * a", 2), ("d", "c", 3), ("p", "q", 1), ("q", "P + b", 1), ("r", "v.q + `d`", 4), ("s", "s", 1)]
    table = spark.createDataFrame([("T", c, e, str(n)) for c, e, n in rules] + [("U", "b", "d", "1")], "TableName string, ColumnName string, Expression string, Level string")
    found = {(r.TableName, r.ColumnName, r.reference): r.steps for r in rule_lineage(table).collect()}
    direct = {"B": "A", "C": "BA", "D": "C", "P": "Q", "Q": "PB", "R": "QD", "S": "S"}
    expected = {}
    for name in direct:
        front, steps, seen = set(direct[name]), 1, {}
        while front - set(seen):
            seen |= {x: steps for x in front - set(seen)}
            front, steps = {y for x in front for y in direct.get(x, "")}, steps + 1
        expected |= {("t", name, x): n for x, n in seen.items()}
    assert found == expected
    lowest = {r.ColumnName: r.lowest for r in lowest_levels(table).where("TableName = 't'").collect()}
    assert lowest == {"A": 0, "B": 1, "C": 2, "D": 3, "P": None, "Q": None, "R": None, "S": None}
    assert rule_lineage(table.limit(0)).collect() == [] and lowest_levels(table.limit(0)).collect() == []


# --- statistics that merge ------------------------------------------------------------------------


def test_statistics_of_parts_are_those_of_the_whole(spark, uneven):
    columns = ["id", "o", "v", "d"]
    parts = stage(partition_statistics(uneven, ["k"], columns), "parts")
    merged = {r.column_name: r for r in merged_statistics(parts).collect()}
    rows = [r.asDict() for r in uneven.collect()]
    for name in columns:
        values = [r[name] for r in rows if r[name] is not None]
        m = merged[name]
        assert (m.row_count, m.num_nulls, m.min, m.max) == (len(rows), len(rows) - len(values), str(min(values)), str(max(values)))
        assert abs(m.distinct_count - len(set(values))) <= max(1, 0.08 * len(set(values)))
        assert len(m.quantiles) == 3
    by_key = defaultdict(int)
    for r in rows:
        by_key[r["k"]] += 1
    found = merged_statistics(parts, ["k"]).where("column_name = 'v'").collect()
    assert {r.k: r.row_count for r in found} == dict(by_key)


def test_exact_values_beside_merged_statistics_are_not_gathered(spark, tmp_path):
    """No percentile or set of all values of a column is held by one task."""
    r = random.Random(8)
    rows = [(None if i % 40 == 0 else i, r.randrange(30), r.choice([None, "F", "O", "P"]), r.choice(["1-URGENT", "5-LOW"])) for i in range(400)]
    orders = spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    found = along.merged_statistics(spark, str(tmp_path))
    text = plan(found)
    assert "percentile(" not in text and "collect_set(" not in text
    assert {(x.column_name, x.near, x.middle_near) for x in found.collect()} == {("o_orderkey", True, True), ("o_custkey", True, True), ("open", True, None)}


def test_renewed_partitions_do_not_read_the_others(spark, uneven):
    parts = stage(partition_statistics(uneven.where("k <> 1 OR k IS NULL OR v < 50"), ["k"], ["v", "o"]), "parts")
    renewed = replaced_partitions(parts, partition_statistics(uneven.where("k = 1"), ["k"], ["v", "o"]), ["k"])
    whole = merged_statistics(partition_statistics(uneven, ["k"], ["v", "o"])).select("column_name", "row_count", "num_nulls", "min", "max", "distinct_count")
    found = merged_statistics(renewed).select(*whole.columns)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, whole.collect()))


def test_histograms_of_ties_nulls_and_nothing(spark):
    rows = spark.createDataFrame([(1.0,)] * 50 + [(float(i),) for i in range(2, 30)] + [(None,)] * 9, "x double")
    found = column_histogram(rows, "x", 10).orderBy("bucket").collect()
    assert sum(r.rows for r in found) == 78 and found[0].low == 1.0 and found[-1].high == 29.0
    assert all(a.high == b.low for a, b in zip(found, found[1:])) and all(r.rows > 0 for r in found)
    assert column_histogram(rows.where("x IS NULL"), "x").collect() == []
    assert [(r.low, r.high, r.rows, r["values"]) for r in column_histogram(rows.where("x = 1"), "x").collect()] == [(1.0, 1.0, 50, 1)]


# --- wide frames and many lengths of intervals ------------------------------------------------------


@pytest.mark.parametrize("text", [
    "count(*) OVER (PARTITION BY k ORDER BY t RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW)",
    "max(v) OVER (PARTITION BY k ORDER BY t DESC RANGE BETWEEN INTERVAL 7 HOURS PRECEDING AND INTERVAL 2 HOURS FOLLOWING)",
    "sum(v) OVER (PARTITION BY k ORDER BY d RANGE BETWEEN 300.5D PRECEDING AND 20D PRECEDING)",
    "avg(v) OVER (ORDER BY n DESC NULLS FIRST RANGE BETWEEN 10 FOLLOWING AND 700 FOLLOWING)",
    "min(v) OVER (PARTITION BY k ORDER BY n RANGE BETWEEN 2 PRECEDING AND 400 FOLLOWING)",
])
def test_wide_frames_equal_sparks_and_are_not_added_up_anew(spark, text, monkeypatch):
    table = spark.range(6000).selectExpr(
        "id", "IF(id % 50 = 0, NULL, id % 3) AS k", "CAST(pmod(xxhash64(id), 1000) AS INT) AS v",
        "IF(id % 97 = 0, NULL, timestamp_micros(pmod(xxhash64(id, 1), 6 * 86400) * 1000000)) AS t",
        "CASE id % 500 WHEN 0 THEN NULL WHEN 1 THEN double('NaN') WHEN 2 THEN double('Infinity') WHEN 3 THEN double('-Infinity') ELSE pmod(xxhash64(id, 2), 20000) / 8 END AS d",
        "IF(id % 89 = 0, NULL, pmod(xxhash64(id, 3), 4000)) AS n",
    )
    rule = [Rule(1, "x", "DOUBLE", 1, text)]
    expected = rows_of(derive(table, rule, windows="spark").select("id", "x"))
    monkeypatch.setattr(sliding, "_with_halo", None)  # what Spark's frames need
    monkeypatch.setattr(sliding, "FEW", 20)
    assert rows_of(derive(table, rule, blocks=5).select("id", "x")) == pytest.approx(expected)


def rows_of(df):
    return {r[0]: r[1] for r in df.collect()}


def test_points_are_not_looked_up_once_per_length(spark):
    points = spark.range(3000).selectExpr("id % 3 AS k", "pmod(xxhash64(id), 100000) AS at")
    spans = spark.range(800).selectExpr("id % 3 AS k", "id", "pmod(xxhash64(id, 1), 100000) AS since")
    spans = spans.selectExpr("*", "IF(id % 200 = 0, NULL, since + id % 7 * (id % 61)) AS until")
    found = join_intervals(points, spans, ["k"], "at", "since", "until")
    expected = spans.join(points, "k").where("at >= since AND (until IS NULL OR at < until)")
    assert rows(found.select("id", "at")) == rows(expected.select("id", "at"))
    assert plan(found).count(" AS __level") + plan(found).count("__level, ") <= 6


def test_levels_that_are_merged():
    merged = temporal._merged_levels({16: 500, 17: 500, 18: 500, 19: 500, 24: 1}, 10_000)
    assert len(set(merged.values())) <= 2
    assert temporal._merged_levels({}, 0) == {}
    assert temporal._merged_levels({0: 100_000, 9: 10}, 10) == {0: 0, 9: 9}  # neither many copies nor many comparisons
