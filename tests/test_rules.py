import pytest
from conftest import SF, rows

from ruleframe import (
    Field,
    check_duplicates,
    check_fields,
    check_references,
    check_rules,
    clean_rules,
    duplicate_rows,
    expand_calls,
    expression_references,
    number_rows,
    load_rules,
    number_rows,
    publish_rules,
    read_rules,
    report_lines,
    select_rules,
)
from ruleframe.operators.derive import rule_list
from ruleframe.sources.rules import FILE_COLUMNS, rules_schema

RULES = f"seq_no INT, {', '.join(f'{name} STRING' for name in FILE_COLUMNS)}"


def rule(seq_no, column, level, expression, table="T", data_type="INT", name="n"):
    return (seq_no, name, table, column, data_type, level, expression, None, None, "1")


def frame(spark, *rules):
    return spark.createDataFrame(list(rules), RULES)


def test_read_rules_by_position(spark, tmp_path):
    path = tmp_path / "rules.tsv"
    path.write_text(
        "Rule\tTab\tCol\tType\tLvl\tExpr\tOra\tSrc\tVer\n"
        "r1\tT\ta\tINT\t0\tx + 1\tNUMBER\tsrc\t1\n"
        "r2\tT\t\"b\"\tDECIMAL(10,2)\t 1 \tCASE WHEN a > 1 THEN 'x, y' END\t\t\t\n"
        "r3\tT\tc\tINT\t2\ta * b\n"
    )
    found = read_rules(spark, str(path))
    assert found.columns == ["seq_no", *FILE_COLUMNS]
    assert dict(found.dtypes)["seq_no"] == "int"
    assert [(r.seq_no, r.ColumnName, r.Level, r.Version) for r in found.collect()] == [
        (1, "a", "0", "1"), (2, "b", " 1 ", None), (3, "c", "2", None),
    ]
    assert found.collect()[1].Expression == "CASE WHEN a > 1 THEN 'x, y' END"


def test_number_rows_over_many_tasks(spark):
    numbered = number_rows(spark.range(100, 1100, 1, 7).toDF("id")).collect()
    assert {r.seq_no - r.id for r in numbered} == {-99}
    assert sorted(r.seq_no for r in numbered) == list(range(1, 1001))


def test_number_rows_of_a_folder_is_gapless(spark, tmp_path):
    path = str(tmp_path / "many")
    spark.range(500).repartition(9).write.parquet(path)
    found = number_rows(spark.read.parquet(path)).collect()
    assert sorted(r.seq_no for r in found) == list(range(1, 501))


def test_clean_rules_takes_one_quote_from_each_end(spark):
    df = frame(spark, rule(1, '"a"', '"0"', '""x"" + "y"', table=' "T" '))
    cleaned = clean_rules(df).first()
    assert (cleaned.ColumnName, cleaned.Expression, cleaned.Level) == ("a", '"x"" + "y', '"0"')


def test_select_rules(spark):
    df = frame(
        spark, rule(3, "c", "2", "1"), rule(1, "a", " 1", "1"), rule(1, "a", " 1", "1"),
        rule(2, "b", "3", "1"), rule(4, "d", "1", "1", table="t"), rule(5, "e", "1", "1", table="U"),
        rule(6, "f", "x", "1"), rule(7, "g", "0", "1"),
    )
    found = select_rules(df, "t", 1, 2)
    assert [(r.seq_no, r.Level) for r in found.collect()] == [(1, 1), (4, 1), (3, 2)]


def test_quoted_levels_pass_the_checks_and_are_kept(spark, tmp_path):
    df = frame(spark, rule(1, "a", '"0"', "src"), rule(2, "b", ' "1"', "a"), rule(3, "c", "+2", "zz"))
    assert [p.line_no for p in check_rules(df).collect()] == [3, 4]
    sound = df.filter("seq_no <> 2")
    assert [r.Level for r in select_rules(sound, "T", 0, 9).collect()] == [0, 2]
    published = publish_rules(sound, str(tmp_path / "quoted"))
    assert sorted(r.Level for r in published.collect()) == [0, 2]
    assert [r.level for r in rule_list(sound)] == [0, 2]
    with pytest.raises(ValueError, match="rule 2 has no level"):
        rule_list(frame(spark, rule(2, "b", "1+2", "a")))


def test_publish_and_load(spark, tmp_path):
    path = str(tmp_path / "published")
    df = frame(spark, rule(1, "a", "0 ", "x"), rule(2, "b", "+1", "a"))
    published = publish_rules(df, path)
    assert published.columns[-2:] == ["idColumn", "insert_time"]
    assert [(r.idColumn, r.Level) for r in published.orderBy("seq_no").collect()] == [
        ("Ta1", 0), ("Tb2", 1),
    ]
    assert len({r.insert_time for r in published.collect()}) == 1
    publish_rules(df.limit(1), path)  # replaces
    assert load_rules(spark, path).count() == 1
    publish_rules(df, str(tmp_path / "as_table"), table="published_rules")
    assert load_rules(spark, table="published_rules").count() == 2
    spark.sql("DROP TABLE published_rules")


def test_rules_schema(spark):
    df = frame(spark, rule(2, "b#", "1", "x", data_type="DECIMAL(10,2)"),
               rule(1, "a", "0", "x", data_type="LONG"))
    assert [(f.name, f.dataType.simpleString()) for f in rules_schema(df)] == [
        ("a", "bigint"), ("b#", "decimal(10,2)"),
    ]


FAULTY = {
    "blank column": (rule(1, "  ", "0", "x"), ("Validation Check", "ColumnName: Is empty")),
    "null type": (rule(1, "a", "0", "x", data_type=None), ("Validation Check", "DataType: Is empty")),
    "bare varchar": (rule(1, "a", "0", "x", data_type="VARCHAR"),
                     ("Validation Check", "DataType: DataType mismatch")),
    "empty decimal": (rule(1, "a", "0", "x", data_type="DECIMAL()"),
                      ("Validation Check", "DataType: DataType mismatch")),
    "two types": (rule(1, "a", "0", "x", data_type="INTINT"),
                  ("Validation Check", "DataType: DataType mismatch")),
    "level sum": (rule(1, "a", "1+2", "3"), ("Validation Check", "Level: DataType mismatch")),
    "inner blank": (rule(1, "a b", "0", "x"), ("Validation Check", "ColumnName: DataType mismatch")),
    "not ascii": (rule(1, "a", "0", "'straße'"),
                  ("Validation Check", "Expression: DataType mismatch")),
}


@pytest.mark.parametrize("case", FAULTY)
def test_format_problems(spark, case):
    faulty, expected = FAULTY[case]
    found = check_rules(frame(spark, faulty)).collect()
    assert [(p.kind, p.reason) for p in found] == [expected]
    assert found[0].line_no == 2


def test_sound_formats(spark):
    df = frame(
        spark, rule(1, '"a#1"', "+0", '"x"', data_type='"varchar(10)"'),
        rule(2, "b", " 0 ", "x", data_type="decimal(10,2)"),
        rule(3, "c", "0", "x", data_type="Long", name="any é name\n"),
    )
    assert check_rules(df).isEmpty()


def test_duplicates_across_levels(spark):
    df = frame(spark, rule(1, "A", "0", "x"), rule(2, '"A"', "2", "1"), rule(3, "a", "0", "x"),
               rule(4, "A", "0", "x", table="U"))
    found = check_rules(df).collect()
    assert sorted((p.kind, p.line_no, p.level) for p in found) == [
        ("Duplicate Check", 2, "0"), ("Duplicate Check", 3, "2"), ("Duplicate Check", 4, "0"),
    ]


def test_duplicate_rows_match_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k INT, v INT")
    assert rows(check_duplicates(df, ["k"])) == [(None, 2)]
    assert rows(duplicate_rows(df, ["k"])) == [(None, 1, 2), (None, 2, 2)]


EXPRESSIONS = {
    "a + b * 2.5 - c1": {"A", "B", "C1"},
    "sum(net) OVER (PARTITION BY cust_key ORDER BY d DESC NULLS LAST)": {"NET", "CUST_KEY", "D"},
    "CASE WHEN a > 1 THEN 'yes it is' ELSE NULL END": {"A"},
    "a BETWEEN 1 AND 2 AND (b)AND c IN (1, d)": {"A", "B", "C", "D"},
    "CAST(x AS DECIMAL(10,2)) + 1e5 + 10L + 3BD": {"X"},
    "concat('it''s', \"a name\", z#1, 'esc\\' q')": {"Z#1"},
    "d + INTERVAL 3 DAYS + INTERVAL '1-2' YEAR TO MONTH": {"D"},
    "transform(arr, x -> x + y) || aggregate(arr, 0, (acc, e) -> acc + e)": {"ARR", "Y"},
    "sum(x) OVER (ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)": {"X", "T"},
    "a IS NOT NULL OR NOT TRUE": {"A"},
    "current_date": set(),
    "v.top + s.field.deep": {"V.TOP", "S.FIELD.DEEP"},
    "extract(YEAR FROM d) + timestampdiff(MONTH, a, b) + dateadd(DAY, 1, c)": {"D", "A", "B", "C"},
    "`a b` + v.`c d` + `order` + `v`.x": {"A B", "V.C D", "ORDER", "V.X"},
    "a -- it's a note\n + b /* c's * note **/ + d": {"A", "B", "D"},
    "`it's` + c + 'x'": {"IT'S", "C"},
    "f(a)[0].field + arr[i].g + db.f(x) + 2.5e3": {"A", "ARR", "I", "X"},
    "transform(arr, x -> x.f + y.f)": {"ARR", "Y.F"},
    r"""concat(r'\', a, R"b", X'1F', x"2A") || 'c\'d' || e""": {"A", "E"},
    "a + INTERVAL 1 YEAR 2 MONTHS + INTERVAL '3' DAY": {"A"},
    "CAST(a AS STRUCT<b: INT, c: MAP<STRING, STRUCT<d: DECIMAL(3, 1)>>>) = f AND g > h": {"A", "F", "G", "H"},
    "CAST(a AS TIMESTAMP WITHOUT TIME ZONE) < b AT TIME ZONE 'UTC'": {"A", "B"},
    "timestampadd(DAYOFYEAR, 1, a) + a:b.c['d'].e + f::INT": {"A", "F"},
    "a COLLATE UTF8_LCASE = b": {"A", "B"},
}


def test_expression_references(spark):
    df = spark.createDataFrame([(e,) for e in EXPRESSIONS], "e STRING")
    found = {r.e: set(r.r) for r in df.select("e", expression_references("e").alias("r")).collect()}
    assert found == EXPRESSIONS


def test_calls_behind_raw_literals_and_at_any_depth():
    assert expand_calls(r"concat(r'\', MostCommon(id) OVER (x))") == r"concat(r'\', mode(CAST(id AS STRING), true) OVER (x))"
    assert expand_calls("car'\\'' || CollectWs(a)") == "car'\\'' || array_join(CAST(a AS ARRAY<STRING>), ',')"
    deep = "(" * 20_000 + "MostCommon(a)" + ")" * 20_000
    assert expand_calls(deep) == deep.replace("MostCommon(a)", "mode(CAST(a AS STRING), true)")
    nested = "f(" * 3_000 + "CollectWs(a) OVER (CollectWs)" + ") OVER (PARTITION BY CollectWs(b))" * 3_000
    assert expand_calls(nested).count("array_join") == 1


def test_rows_are_numbered_in_the_order_of_their_files(spark, tmp_path):
    """Of files of uneven size Spark reads the largest first."""
    for i, (low, high) in enumerate(((0, 10), (10, 4_000), (4_000, 4_100), (4_100, 9_000))):
        part = tmp_path / "one"
        spark.range(low, high, numPartitions=1).write.mode("overwrite").csv(str(part))
        next(part.glob("*.csv")).rename(tmp_path / f"part-{i}.csv")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        found = number_rows(spark.read.schema("id long").csv(f"{tmp_path}/part-*.csv")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(found) == 9_000 and all(r.seq_no == r.id + 1 for r in found)


def test_expression_references_of_very_long_text(spark):
    text = "a + '" + "x" * 200_000 + "' + " + "b + " * 50_000 + "c"
    df = spark.createDataFrame([(text,)], "e STRING")
    assert df.select(expression_references("e")).first()[0] == ["A", "B", "C"]


def test_check_references(spark):
    df = frame(
        spark, rule(1, "A", "0", "src_a"), rule(2, "B", "1", "A + 1"),
        rule(3, "C", "1", "B + sum(a) OVER (PARTITION BY zz)"),
        rule(4, "D", "3", "CASE WHEN c > 1 THEN 'yes it is' ELSE NULL END"),
        rule(5, "B", "1", "A", table="t2"),
    )
    found = check_references(df).select("seq_no", "reference")
    assert rows(found) == [(3, "B"), (3, "ZZ"), (5, "A")]


def test_qualified_references(spark):
    df = frame(
        spark, rule(1, "A", "0", "src"), rule(2, "B", "1", "v.a + A.field"),
        rule(3, "C", "1", "v.zz + b.a + `a`"), rule(4, "D", "2", "v.d -- a"),
    )
    assert rows(check_references(df).select("seq_no", "reference")) == [(3, "V.ZZ"), (4, "V.D")]
    no_level_0 = frame(spark, rule(1, "A", "1", "v.src + src.f + w.other"))
    assert rows(check_references(no_level_0, ["src"]).select("reference")) == [("W.OTHER",)]


def test_source_columns_are_visible_without_level_0(spark):
    df = frame(spark, rule(1, "a", "1", "src + 1"), rule(2, "b", "2", "a + Src + other"),
               rule(3, "a", "0", "src", table="U"), rule(4, "b", "1", "src", table="U"))
    found = check_references(df, ["SRC"]).select("seq_no", "reference")
    assert rows(found) == [(2, "OTHER"), (4, "SRC")]
    assert len(rows(check_references(df))) == 4


def test_report_lines(spark):
    lines = report_lines(check_rules(frame(spark, rule(1, " ", "0", "x"))), "T0")
    assert rows(lines) == [
        ("Validation Check: Error at T0=>line 2, T. , level 0: ColumnName: Is empty",)
    ]


def test_check_fields_of_numbers_and_optional_fields(spark):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    fields = [Field("l_linenumber", "[1-3]"), Field("l_returnflag", "A|N", required=False)]
    found = check_fields(lines, fields, ["l_orderkey"]).groupBy("field").count()
    counts = {r["field"]: r["count"] for r in found.collect()}
    assert counts["l_linenumber"] == lines.filter("l_linenumber > 3").count()
    assert counts["l_returnflag"] == lines.filter("l_returnflag = 'R'").count()
