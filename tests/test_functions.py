import math

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from ruleframe import (
    collect_ws,
    expand_calls,
    most_common,
    most_common_by,
    register_functions,
    weighted_average,
)
from ruleframe.functions.calls import replace_calls, split_arguments

EDGE = [
    (1, "b", 2.0, 10.0), (1, "a", 1.0, None), (1, "b", 0.0, 3.0), (1, "a", None, 4.0),
    (2, None, 1.0, 5.0), (2, None, -1.0, 6.0), (3, None, 0.0, 0.0),
]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, "k INT, s STRING, w DOUBLE, v DOUBLE")


def test_most_common_ties_and_nulls(edge):
    expected = [(1, "a"), (2, None), (3, None)]
    assert rows(edge.groupBy("k").agg(most_common("s"))) == expected
    assert rows(most_common_by(edge, ["k"], "s")) == expected


def test_most_common_of_numbers_compares_as_text(spark):
    df = spark.createDataFrame([(9,), (10,), (None,)], "x INT")
    assert df.agg(most_common("x")).first()[0] == "10"
    assert most_common_by(df, [], "x").first()[0] == "10"


def test_most_common_in_window(edge):
    window = Window.partitionBy("k")
    found = edge.select("k", most_common("s").over(window)).distinct()
    assert rows(found) == [(1, "a"), (2, None), (3, None)]


def test_most_common_by_equals_mode_on_random_groups(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 37).alias("k"),
        F.when(F.col("id") % 5 != 0, F.hash("id") % 11).alias("x"),
    )
    by_mode = df.groupBy("k").agg(most_common("x").alias("most_common"))
    assert rows(by_mode) == rows(most_common_by(df, ["k"], "x"))


def test_weighted_average_nulls(edge):
    zero = dict(rows(edge.groupBy("k").agg(weighted_average("w", "v"))))
    assert zero[1] == pytest.approx(20 / 3)
    assert zero[2] == -math.inf
    assert zero[3] is None
    skip = dict(rows(edge.groupBy("k").agg(weighted_average("w", "v", nulls="skip"))))
    assert skip == {1: 10.0, 2: -math.inf, 3: None}


def test_weighted_average_of_nothing_nan_and_text(spark):
    df = spark.createDataFrame([("1", "2.5"), ("3", "x")], "w STRING, v STRING")
    assert df.filter("false").agg(weighted_average("w", "v")).first()[0] is None
    assert df.agg(weighted_average("w", "v")).first()[0] == 2.5 / 4
    assert df.agg(weighted_average("w", "v", "skip")).first()[0] == 2.5
    nan = spark.createDataFrame([(0.0, float("nan"))], "w DOUBLE, v DOUBLE")
    assert nan.agg(weighted_average("w", "v")).first()[0] is None
    with pytest.raises(ValueError):
        weighted_average("w", "v", nulls="drop")


def test_collect_ws(spark):
    df = spark.createDataFrame([([1.5, 2.0],), ([],), ([None, 3.0],), (None,)], "a ARRAY<DOUBLE>")
    assert [r[0] for r in df.select(collect_ws("a")).collect()] == ["1.5,2.0", "", "3.0", None]
    register_functions(spark)
    register_functions(spark)  # a second time is no error
    assert [r[0] for r in df.selectExpr("CollectWs(a)").collect()] == ["1.5,2.0", "", "3.0", None]


def test_expanded_calls_in_sql(spark, edge):
    edge.createOrReplaceTempView("edge_rows")
    text = expand_calls(
        "SELECT k, mostcommon(s) AS m, WeightedAverage(w, nullif(v, 3)) AS a, count(*) AS n, "
        "CollectWs(collect_list(s)) AS 'MostCommon(s)' FROM edge_rows GROUP BY k"
    ).replace("AS 'MostCommon(s)'", "AS t")
    found = {r["k"]: r for r in spark.sql(text).collect()}
    assert (found[1]["m"], found[1]["n"], found[1]["t"]) == ("a", 4, "b,a,b,a")
    assert found[1]["a"] == pytest.approx(20 / 3)
    assert found[2]["a"] == -math.inf
    assert found[3]["a"] is None


def test_calls_are_found_outside_literals_only():
    seen = []

    def look(name, args, over):
        seen.append((name, args, over))

    replace_calls("a + f(g(x, ')'), \"h(1)\") OVER (PARTITION BY k) || 'f(2)'", look)
    assert seen[0] == ("f", "g(x, ')'), \"h(1)\"", "PARTITION BY k")
    assert [s[0] for s in seen] == ["f", "g"]
    assert split_arguments("a, f(b, 'x,y'), ','") == ["a", "f(b, 'x,y')", "','"]


def test_long_and_deep_text_is_handled_quickly():
    deep = "(" * 40 + "x" + ")" * 40
    assert expand_calls(deep) == deep
    unbalanced = "sum(" * 30 + "'" + "a(" * 2000
    assert expand_calls(unbalanced) == unbalanced
