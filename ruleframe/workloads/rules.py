"""Rule tables made from the part table, and checks over large tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ruleframe.operators.checks import (
    RULE_FIELDS,
    Field,
    check_duplicates,
    check_fields,
    check_rules,
    duplicate_rows,
    report_lines,
)
from ruleframe.operators.references import check_references, expression_references
from ruleframe.plans.jobs import run_rules
from ruleframe.session import fresh_path
from ruleframe.sources.rules import (
    clean_rules,
    number_rows,
    publish_rules,
    read_rules,
    select_rules,
)
from ruleframe.sources.tables import create_table_from_rules
from ruleframe.workloads.data import (
    FAULTY_PART_RULES,
    PART_RULES,
    SOUND_PART_RULES,
    rules_file,
    rules_from,
    table,
)
from ruleframe.workloads.registry import query


@query(f"""
SELECT seq_no, Name, TableName, ColumnName, DataType, trim(Level) AS Level, Expression,
       OracleDataType, SourceTable, Version
FROM ({PART_RULES})
""")
def read_rules_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = rules_from(spark, sf_dir, PART_RULES)
    return read_rules(spark, rules_file(spark, rules)).withColumn("Level", F.trim("Level"))


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS seq_no FROM orders")
def number_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders file is sorted by key, so reading order is key order."""
    return number_rows(table(spark, sf_dir, "orders").select("o_orderkey"))


@query(r"""
SELECT doc_id, trim(regexp_replace(regexp_replace(t, '\A"', ''), '"\z', '')) AS text
FROM (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN concat('"', text, '"')
                                     WHEN 1 THEN concat('  ', text, '"') ELSE text END AS t
      FROM documents)
""")
def clean_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """CASE doc_id % 3 WHEN 0 THEN concat('"', text, '"')
              WHEN 1 THEN concat('  ', text, '"') ELSE text END AS text"""
    return clean_rules(table(spark, sf_dir, "documents").selectExpr("doc_id", text), ("text",))


@query(f"""
SELECT DISTINCT seq_no, Name, TableName, ColumnName, DataType,
       CAST(trim(Level) AS INTEGER) AS Level, Expression
FROM ({PART_RULES}) WHERE lower(TableName) = 'brand#2' AND CAST(trim(Level) AS INTEGER)
     BETWEEN 1 AND 3
""")
def select_rules_of_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule stands in the table twice and is selected once."""
    rules = rules_from(spark, sf_dir, PART_RULES)
    selected = select_rules(rules.union(rules), "BRAND#2", 1, 3)
    return selected.drop("OracleDataType", "SourceTable", "Version")


DOCUMENT_FIELDS = [
    Field("text", r"[\x20-\x7E]+"),
    Field("lang", "en|fr|de"),
    Field("source", "src[0-9]"),
    Field("first_line"),
    Field("note", "x+", required=False),
]


def _failure(field: str, condition: str, code: int, reason: str, source: str) -> str:
    return (
        f"SELECT doc_id, '{field}' AS field, {code} AS code, '{reason}' AS reason "
        f"FROM {source} WHERE {condition}"
    )


_DOCUMENTS = "(SELECT *, split_part(text, '.', 2) AS first_line FROM documents)"
_EMPTY = r"(first_line IS NULL OR NOT regexp_matches(first_line, '[^\x00-\x20]'))"


@query(
    " UNION ALL ".join(
        [
            _failure(
                "text", r"NOT regexp_full_match(trim(regexp_replace(regexp_replace(text, "
                r"'\A\"', ' '), '\"\z', ' ')), '[\x20-\x7E]+')", 1, "DataType mismatch", _DOCUMENTS,
            ),
            _failure("lang", "lang NOT IN ('en', 'fr', 'de')", 1, "DataType mismatch", _DOCUMENTS),
            _failure("source", "length(source) > 4", 1, "DataType mismatch", _DOCUMENTS),
            _failure("first_line", _EMPTY, 2, "Is empty", _DOCUMENTS),
        ]
    ).replace('\\"', '"')
)
def check_fields_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").selectExpr(
        "*", "split_part(text, '.', 2) AS first_line", "CAST(NULL AS STRING) AS note"
    )
    return check_fields(documents, DOCUMENT_FIELDS, ["doc_id"])


@query(f"""
SELECT seq_no, 'ColumnName' AS field, 2 AS code FROM ({FAULTY_PART_RULES})
WHERE trim(ColumnName) = ''
UNION ALL
SELECT seq_no, 'DataType', 1 FROM ({FAULTY_PART_RULES})
WHERE DataType = 'VARCHAR'
UNION ALL
SELECT seq_no, 'Level', 1 FROM ({FAULTY_PART_RULES}) WHERE Level = '1+2'
UNION ALL
SELECT seq_no, 'Expression', 2 FROM ({FAULTY_PART_RULES}) WHERE Expression IS NULL
""")
def check_fields_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = rules_from(spark, sf_dir, FAULTY_PART_RULES)
    return check_fields(rules, RULE_FIELDS, ["seq_no"]).drop("reason")


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def check_duplicates_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, n FROM (
  SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem)
WHERE n > 1
""")
def duplicate_rows_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    return duplicate_rows(lines, ["l_orderkey", "l_linenumber"])


# The words of the documents that are no names in SQL.
_NO_NAMES = "'ALL', 'AND', 'ANTI', 'AS', 'BY', 'FOR', 'FROM', 'IN', 'IS', 'OF', 'ON', 'OR', 'THEN', 'TO', 'WHEN'"


@query(rf"""
SELECT DISTINCT doc_id, reference FROM (
  SELECT doc_id, upper(trim(unnest(regexp_extract_all(
           regexp_replace(text, '\x27[^\x27]*\x27|"[^"]*"', ' ', 'g'),
           '[.]?[A-Za-z0-9_#]+(?:[.][A-Za-z0-9_#]+)* *[(]?')))) AS reference
  FROM documents)
WHERE NOT regexp_matches(reference, '^[.]|[(]$|^[0-9]+(E[0-9]+)?([LSYDF]|BD)?([.]|$)')
  AND reference NOT IN ({_NO_NAMES})
""")
def expression_references_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of whole texts, read as if they were expressions."""
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", F.explode(expression_references("text")).alias("reference"))


# The generated expressions name columns c0 to c39, in capitals too, and the first word of a part's
# name after current_date; 'c1 is it' is a literal.
_MISSING = f"""
SELECT u.seq_no, u.TableName, u.ColumnName, u.Level, u.reference
FROM (SELECT DISTINCT seq_no, TableName, ColumnName, Level, unnest(list_concat(
        regexp_extract_all(replace(upper(Expression), 'C1 IS IT', ''), '\\bC[0-9]+\\b'),
        regexp_extract_all(upper(Expression), 'CURRENT_DATE, ([A-Z]+)', 1))) AS reference
      FROM ({PART_RULES})) u
WHERE CAST(trim(u.Level) AS INTEGER) > 0 AND NOT EXISTS (
  SELECT 1 FROM ({PART_RULES}) d
  WHERE lower(d.TableName) = lower(u.TableName) AND upper(d.ColumnName) = u.reference
    AND CAST(trim(d.Level) AS INTEGER) < CAST(trim(u.Level) AS INTEGER))
"""


@query(_MISSING)
def check_references_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_references(rules_from(spark, sf_dir, PART_RULES))


QUALIFIED_RULES = f"""
SELECT seq_no, TableName, ColumnName, Level,
       CASE seq_no % 5
         WHEN 0 THEN concat('v.', ColumnName, ' + 1 -- supplier''s note')
         WHEN 1 THEN concat('extract(YEAR FROM ', ColumnName, ')')
         WHEN 2 THEN concat('timestampdiff(MONTH, ', ColumnName, ', `c 4`)')
         WHEN 3 THEN concat(ColumnName, '.part /* c1 */')
         ELSE concat('v.`', ColumnName, '`') END AS Expression
FROM ({PART_RULES}) AS r
"""


@query(f"""
SELECT u.seq_no, TableName, ColumnName, Level, reference FROM (
  SELECT *, CASE seq_no % 5 WHEN 0 THEN 'V.' || upper(ColumnName) WHEN 3 THEN upper(ColumnName) || '.PART'
                            WHEN 4 THEN 'V.' || upper(ColumnName) ELSE upper(ColumnName) END AS reference
  FROM ({QUALIFIED_RULES})
  UNION ALL SELECT *, 'C 4' FROM ({QUALIFIED_RULES}) WHERE seq_no % 5 = 2) u
WHERE CAST(trim(Level) AS INTEGER) > 0 AND (reference = 'C 4' OR NOT EXISTS (
  SELECT 1 FROM ({QUALIFIED_RULES}) d
  WHERE d.TableName = u.TableName AND d.ColumnName = u.ColumnName
    AND CAST(trim(d.Level) AS INTEGER) < CAST(trim(u.Level) AS INTEGER)))
""")
def check_references_qualified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of views, fields, backticks, units and comments: each rule uses its own column."""
    return check_references(rules_from(spark, sf_dir, QUALIFIED_RULES))


# Forms in which a rule names its own column (%), and whatever else looks like a name: the names that it refers to.
REFERENCE_FORMS = (
    ("X'1F' || %", ["%"]), ("concat(r'\\d', %) = r'\\'", ["%"]), ("% + INTERVAL 1 YEAR 2 MONTHS", ["%"]),
    ("CAST(% AS STRUCT<b: INT, d: DECIMAL(10, 2)>).b > b1", ["%", "B1"]), ("CAST(% AS TIMESTAMP WITHOUT TIME ZONE)", ["%"]),
    ("% AT TIME ZONE 'UTC'", ["%"]), ("timestampadd(DAYOFYEAR, 3, %)", ["%"]), ("% COLLATE UTF8_LCASE < e1", ["%", "E1"]),
    ("%:b.c[0].`d e` || v.f", ["%", "V.F"]), ("%::INT + 1.5e3 * 10L", ["%"]), ("transform(%, (k, w) -> k + w + z)", ["%", "Z"]),
    ("extract(DAY FROM %) -- it's a comment, no b", ["%"]), ("INTERVAL '1 2' DAY TO HOUR + % /* don't */", ["%"]),
)


@query(f"""
SELECT p_partkey, replace(unnest(CASE p_partkey % {len(REFERENCE_FORMS)} {
    " ".join(f"WHEN {i} THEN {names}" for i, (_, names) in enumerate(REFERENCE_FORMS))
} END), '%', concat('C', CAST(p_partkey AS VARCHAR))) AS reference FROM part
""")
def expression_references_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Literals with prefixes, intervals, types, time zones, collations, paths and comments, whose words are no names."""
    column = F.concat(F.lit("c"), F.col("p_partkey").cast("string"))
    forms = F.array(*[F.lit(form) for form, _ in REFERENCE_FORMS])
    form = F.element_at(forms, (F.col("p_partkey") % len(REFERENCE_FORMS) + 1).cast("int"))
    rules = table(spark, sf_dir, "part").select("p_partkey", F.replace(form, F.lit("%"), column).alias("Expression"))
    return rules.select("p_partkey", F.explode(expression_references("Expression")).alias("reference"))


@query(f"""
SELECT 'Duplicate Check' AS kind, seq_no + 1 AS line_no, TableName AS table_name,
       ColumnName AS column_name, Level AS level,
       concat('defined by rules: ', CAST(n AS VARCHAR)) AS reason
FROM (SELECT *, count(*) OVER (PARTITION BY TableName, ColumnName) AS n FROM ({PART_RULES}))
WHERE n > 1
UNION ALL
SELECT 'Level Check For Columns', seq_no + 1, TableName, ColumnName, Level,
       concat('not defined at a lower level: ', reference) FROM ({_MISSING})
""")
def check_rules_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_rules(rules_from(spark, sf_dir, PART_RULES))


@query(f"""
SELECT concat('Duplicate Check: Error at 2024-01-01T00:00:00=>line ', CAST(seq_no + 1 AS VARCHAR),
              ', ', TableName, '.', ColumnName, ', level ', Level, ': defined by rules: ',
              CAST(n AS VARCHAR)) AS value
FROM (SELECT *, count(*) OVER (PARTITION BY TableName, ColumnName) AS n FROM ({PART_RULES}))
WHERE n > 1
""")
def report_lines_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Problem rows as report lines, written as text and read back."""
    problems = check_rules(rules_from(spark, sf_dir, PART_RULES))
    repeated = problems.filter("kind = 'Duplicate Check'")
    path = fresh_path(spark, "report")
    report_lines(repeated, "2024-01-01T00:00:00").write.text(path)
    return spark.read.text(path)


@query(f"""
SELECT seq_no, TableName, ColumnName, CAST(trim(Level) AS INTEGER) AS Level,
       concat(TableName, ColumnName, CAST(seq_no AS VARCHAR)) AS idColumn,
       '2024-01-01T00:00:00' AS insert_time
FROM ({PART_RULES})
""")
def publish_rules_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = rules_from(spark, sf_dir, PART_RULES)
    path = fresh_path(spark, "published")
    published = publish_rules(rules, path, insert_time="2024-01-01T00:00:00")
    return published.select(
        "seq_no", "TableName", "ColumnName", "Level", "idColumn", "insert_time"
    )


@query(f"""
SELECT seq_no, Name, TableName, trim(ColumnName, '"') AS ColumnName, CAST(Level AS INTEGER) AS Level,
       trim(Expression, '"') AS Expression,
       concat(TableName, trim(ColumnName, '"'), CAST(seq_no AS VARCHAR)) AS idColumn
FROM ({SOUND_PART_RULES})
""")
def job_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rules file without problems is cleaned and published."""
    path = rules_file(spark, rules_from(spark, sf_dir, SOUND_PART_RULES))
    run = run_rules(spark, path, fresh_path(spark, "published"))
    return run.published.select(
        "seq_no", "Name", "TableName", "ColumnName", "Level", "Expression", "idColumn"
    )


@query(f"""
SELECT line_no, reason FROM (
  SELECT seq_no + 1 AS line_no, 'ColumnName: Is empty' AS reason, trim(ColumnName) = '' AS bad
  FROM ({FAULTY_PART_RULES})
  UNION ALL SELECT seq_no + 1, 'DataType: DataType mismatch', DataType = 'VARCHAR'
  FROM ({FAULTY_PART_RULES})
  UNION ALL SELECT seq_no + 1, 'Level: DataType mismatch', Level = '1+2'
  FROM ({FAULTY_PART_RULES})
  UNION ALL SELECT seq_no + 1, 'Expression: Is empty', Expression IS NULL
  FROM ({FAULTY_PART_RULES})) WHERE bad
""")
def job_rules_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rules file with format problems stops there."""
    path = rules_file(spark, rules_from(spark, sf_dir, FAULTY_PART_RULES))
    run = run_rules(spark, path, fresh_path(spark, "published"))
    return run.problems.select("line_no", "reason")


# One rule per brand: however many parts there are, the columns are as many as brands.
_BRAND_RULES = """
SELECT row_number() OVER (ORDER BY p_brand) AS seq_no, p_brand AS ColumnName,
       CASE WHEN smallest < 2 THEN 'LONG' ELSE 'DECIMAL(18,2)' END AS DataType,
       '0' AS Level, 'p_size' AS Expression
FROM (SELECT p_brand, min(p_size) AS smallest FROM part GROUP BY p_brand) AS brands
"""


@query(f"""
SELECT ColumnName AS column_name, CASE DataType WHEN 'LONG' THEN 'bigint' ELSE 'decimal(18,2)' END
         AS type_name
FROM ({_BRAND_RULES})
""")
def table_schema_of_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns and types that a table made from rules gets, as the catalog shows them."""
    rules = rules_from(spark, sf_dir, _BRAND_RULES)
    name = f"ruleframe_{uuid.uuid4().hex}"
    create_table_from_rules(spark, name, rules, fresh_path(spark, "declared"))
    shown = spark.sql(f"DESCRIBE {name}")
    return shown.selectExpr("col_name AS column_name", "data_type AS type_name")
