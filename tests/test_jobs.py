import os
from pathlib import Path

import pytest
from conftest import SF, rows
from pyspark.sql import functions as F

from ruleframe import (
    Rule,
    analyze,
    create_table_from_rules,
    drop_table,
    profile,
    read_back,
    read_stats,
    run_aggregate,
    run_rules,
    run_sql,
    run_steps,
    write_result,
)
from ruleframe.session import fresh_path, run_folder, session_settings, shared_folder, stage
from ruleframe.sources import tables
from ruleframe.workloads.tables import stored_rules


@pytest.fixture
def orders(spark):
    return spark.read.parquet(f"{SF}/orders.parquet")


@pytest.fixture
def table(spark):
    yield "result_table"
    drop_table(spark, "result_table")


def test_write_replaces_table_and_files(spark, orders, table, tmp_path):
    location = str(tmp_path / "out")
    write_result(orders, table, location)
    write_result(orders.select("o_orderkey").limit(7), table, location)
    assert spark.table(table).columns == ["o_orderkey"]
    assert read_back(spark, location).count() == spark.table(table).count() == 7
    drop_table(spark, table)
    drop_table(spark, table)
    assert not spark.catalog.tableExists(table)
    assert read_back(spark, location).count() == 7


def test_write_over_a_managed_table(spark, orders, table, tmp_path):
    orders.limit(3).write.saveAsTable(table)
    write_result(orders.limit(5), table, str(tmp_path / "out"))
    assert spark.table(table).count() == 5


def test_a_result_may_replace_its_own_input(spark, orders, table, tmp_path):
    location = str(tmp_path / "out")
    write_result(orders.limit(4), table, location)
    write_result(read_back(spark, location), table, location + "/")
    assert read_back(spark, location).count() == 4
    cached = read_back(spark, location).cache()
    write_result(cached, table, location)
    assert read_back(spark, location).count() == spark.table(table).count() == 4
    cached.unpersist()
    read_back(spark, location).createOrReplaceTempView("own_input")
    inside = spark.sql("SELECT *, (SELECT count(*) FROM own_input) AS n FROM VALUES (1), (2) AS t(x)")
    write_result(inside, table, location)
    assert [tuple(r) for r in spark.table(table).orderBy("x").collect()] == [(1, 4), (2, 4)]
    write_result(spark.table(table).unionAll(spark.table(table)), table, location)
    assert spark.table(table).count() == 4
    assert os.listdir(tmp_path) == ["out"]


@pytest.mark.parametrize("name", ["with blank", "per%20cent", "ü", "deep/er", "it's"])
def test_any_spelling_of_a_location_is_replaced(spark, orders, table, tmp_path, name):
    location = str(tmp_path / name)
    orders.limit(4).write.parquet(location)
    for target in (location, f"file://{location}", os.path.relpath(location)):
        if "%" in target and "://" in target:
            continue  # an escape in a URI is another name
        assert write_result(read_back(spark, location), table, target) == 4
        assert read_back(spark, location).count() == spark.table(table).count() == 4


def test_a_failed_write_leaves_the_former_table(spark, orders, table, tmp_path):
    location = str(tmp_path / "out")
    write_result(orders.limit(4), table, location, ("o_orderstatus",))
    before = sorted(map(tuple, spark.table(table).collect()))
    fails = orders.withColumn("o_orderkey", F.when(F.col("o_orderkey") > 30, F.raise_error(F.lit("killed"))).otherwise(1))
    with pytest.raises(Exception, match="killed"):
        write_result(fails, table, location)
    assert sorted(map(tuple, spark.table(table).collect())) == before
    assert os.listdir(tmp_path) == ["out"]


def test_lost_rows_are_noticed(spark, orders, table, tmp_path, monkeypatch):
    location = str(tmp_path / "out")
    write_result(orders.limit(4), table, location)
    monkeypatch.setattr(tables.Observation, "get", {"rows": 7})
    with pytest.raises(tables.RowsLost, match="3 of 7 rows"):
        write_result(orders.limit(3), table, location)
    assert spark.table(table).count() == read_back(spark, location).count() == 4


def test_an_empty_result_and_odd_columns_are_written(spark, table, tmp_path):
    odd = spark.sql("SELECT 1 AS `a b`, '001' AS `p#`, struct(1 AS `x y`) AS s, array(1) AS l WHERE false")
    assert write_result(odd, table, str(tmp_path / "out"), ("p#",)) == 0
    assert spark.table(table).columns == ["a b", "s", "l", "p#"]
    full = spark.sql("SELECT 1 AS `a b`, '001' AS `p#`, struct(1 AS `x y`) AS s, array(1) AS l")
    assert write_result(full, table, str(tmp_path / "out"), ("p#",)) == 1
    assert spark.table(table).first()["p#"] == "001"


def test_a_folder_of_sql_files_runs_whole(spark, tmp_path):
    (tmp_path / "1.sql").write_text("SELECT 1 AS a -- it's one\n")
    (tmp_path / "2.sql").write_text("UNION ALL SELECT MostCommon(x) FROM VALUES (2), (2), (3) AS t(x)")
    assert sorted(str(r.a) for r in run_sql(spark, str(tmp_path)).collect()) == ["1", "2"]


def test_an_aggregator_without_levels_is_refused(spark):
    rules = spark.createDataFrame([], "seq_no int, TableName string")
    with pytest.raises(ValueError, match="needs levels"):
        run_aggregate(spark, {"sqlfile": "x", "rulestable": "T"}, rules)


def test_legacy_format_setting_is_restored(spark, orders, table, tmp_path):
    name = "spark.sql.parquet.writeLegacyFormat"
    before = spark.conf.get(name)
    write_result(orders.limit(1), table, str(tmp_path / "out"), legacy_format=before != "true")
    assert spark.conf.get(name) == before


def test_table_from_rules(spark, table, tmp_path):
    rules = [Rule(1, "a#b", "DECIMAL(10,2)", 0, "x"), Rule(2, "c", "STRING", 1, "y")]
    create_table_from_rules(spark, table, stored_rules(spark, "t", rules), str(tmp_path / "t"))
    assert spark.table(table).dtypes == [("a#b", "decimal(10,2)"), ("c", "string")]
    assert spark.table(table).count() == 0


def test_partition_and_column_statistics(spark, orders, table, tmp_path):
    write_result(orders, table, str(tmp_path / "out"), ("o_orderstatus",))
    analyze(spark, table, ["o_orderstatus='F'"], ["o_custkey"])
    described = spark.sql(f"DESCRIBE EXTENDED {table} PARTITION (o_orderstatus='F')").collect()
    count = orders.filter("o_orderstatus = 'F'").count()
    assert any(f"{count} rows" in (r.data_type or "") for r in described)
    analyze(spark, table)
    stats = {(r[0], r[1]): r[2] for r in read_stats(spark, table, ["o_custkey"]).collect()}
    assert f"{orders.count()} rows" in stats[(None, "size")]
    assert stats[("o_custkey", "num_nulls")] == "0"
    assert int(stats[("o_custkey", "max")]) == orders.agg({"o_custkey": "max"}).first()[0]


def test_profile_exact_and_approximate(spark):
    df = spark.createDataFrame([("a", 1), ("bbb", None), (None, 1)], "s STRING, n INT")
    for approximate in (False, True):
        assert rows(profile(df, ["s", "n"], approximate)) == [
            ("n", 3, 1, 1, "1", "1", 1.0, 1),
            ("s", 3, 1, 2, "a", "bbb", 2.0, 3),
        ]


def test_sql_file_keeps_comments_and_library_names(spark, tmp_path):
    path = tmp_path / "q.sql"
    path.write_text("SELECT MostCommon(x) AS m -- the mode\nFROM VALUES (2), (1), (2) AS t(x);\n")
    assert rows(run_sql(spark, str(path))) == [("2",)]


def test_aggregate_step(spark, orders, table, tmp_path):
    orders.createOrReplaceTempView("job_orders")
    source = tmp_path / "source.sql"
    source.write_text("SELECT o_custkey, o_totalprice\nFROM job_orders")
    rules = [
        Rule(1, "cust", "BIGINT", 0, "o_custkey"),
        Rule(2, "price", "DECIMAL(18,2)", 0, "o_totalprice"),
        Rule(3, "total", "DECIMAL(28,2)", 2, "sum(price) OVER (PARTITION BY cust)"),
        Rule(4, "beyond", "INT", 13, "1"),
    ]
    step = {
        "type": "aggregator", "seq": 1, "sqlfile": str(source), "viewname": "job_view",
        "numpartition": 3, "tablename": table, "location": str(tmp_path / "out"),
        "maprdbtablepath": "", "maprdbtablefilter": "FLAT_t", "levels": "0,12",
    }
    before = spark.conf.get("spark.sql.shuffle.partitions")
    result = run_aggregate(spark, step, stored_rules(spark, "flat_T", rules))
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert result.columns == ["cust", "price", "total"]
    assert result.count() == orders.count() == spark.table(table).count()
    assert rows(spark.table("job_view")) == rows(result)
    assert not list((Path(shared_folder(spark)) / "ruleframe").glob("run-*"))


def test_steps_run_in_order(spark, tmp_path):
    view, use = tmp_path / "view.sql", tmp_path / "use.sql"
    view.write_text("CREATE OR REPLACE TEMPORARY VIEW step_view AS SELECT 1 AS x")
    use.write_text("SELECT x + 1 AS y FROM step_view")
    steps = [{"type": "execsql", "seq": i, "sqlfile": str(p)} for i, p in enumerate((view, use))]
    assert rows(run_steps(spark, steps)[1]) == [(2,)]
    with pytest.raises(ValueError, match="unknown step types: compact"):
        run_steps(spark, [*steps, {"type": "compact"}])


HEADER = "Name\tTableName\tColumnName\tDataType\tLevel\tExpression\tOracleDataType\tSourceTable\tVersion\n"


def test_rules_job_publishes_sound_rules(spark, tmp_path):
    path = tmp_path / "rules.tsv"
    path.write_text(HEADER + "r\tT\ta\tINT\t0\tx\t\t\t1\nr\tT\tb\tINT\t1\ta + 1\t\t\t1\n")
    run = run_rules(spark, str(path), str(tmp_path / "published"), report=str(tmp_path / "log"))
    assert run.code == 0 and run.problems.isEmpty()
    assert [r.idColumn for r in run.published.orderBy("seq_no").collect()] == ["Ta1", "Tb2"]
    assert spark.read.text(str(tmp_path / "log")).count() == 0


def test_rules_job_stops_on_format_problems_only(spark, tmp_path):
    path = tmp_path / "rules.tsv"
    path.write_text(HEADER + "r\tT\ta\tNUMBER\t0\tx\t\t\t1\nr\tT\tb\tINT\t1\tzz\t\t\t1\n")
    run = run_rules(spark, str(path), str(tmp_path / "published"), report=str(tmp_path / "log"))
    assert run.code == 100 and run.published is None
    assert [p.kind for p in run.problems.collect()] == ["Validation Check"]
    assert spark.read.text(str(tmp_path / "log")).first()[0].startswith("Validation Check: Error at")
    assert not (tmp_path / "published").exists()


def test_rules_job_blocks_publishing_on_other_problems(spark, tmp_path):
    path = tmp_path / "rules.tsv"
    path.write_text(HEADER + "r\tT\ta\tINT\t0\tx\t\t\t1\nr\tT\tb\tINT\t1\tzz\t\t\t1\n")
    run = run_rules(spark, str(path), str(tmp_path / "published"))
    assert run.code == 0 and run.published is None
    assert [(p.kind, p.line_no) for p in run.problems.collect()] == [("Level Check For Columns", 3)]


def test_shared_folder_and_stage(spark):
    assert shared_folder(spark) == shared_folder(spark)
    assert fresh_path(spark, "x") != fresh_path(spark, "x")
    df = spark.createDataFrame([(1, None)], "a INT, b STRING")
    staged = stage(df)
    assert staged.dtypes == df.dtypes and rows(staged) == [(1, None)]


def test_a_run_folder_goes_with_its_block(spark):
    with run_folder(spark) as folder:
        assert stage(spark.range(3)).count() == 3
        assert len(os.listdir(folder)) == 1
    assert not os.path.exists(folder)
    assert not fresh_path(spark, "x").startswith(folder)


def test_settings_are_restored_after_errors(spark):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    with pytest.raises(KeyError), session_settings(spark, {name: 3, "spark.own.setting": "x"}):
        assert spark.conf.get(name) == "3"
        raise KeyError
    assert spark.conf.get(name) == before
    assert spark.conf.get("spark.own.setting", None) is None
