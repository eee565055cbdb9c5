"""Checks that report problems as rows, for rules and for any large table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ruleframe.operators.references import check_references
from ruleframe.sources.rules import clean_rules


class Field(NamedTuple):
    """What a text column must look like: all of it matches ``pattern``, unless that is None."""

    column: str
    pattern: str | None = None
    required: bool = True


# The format of each checked column of a rules file.
DATA_TYPES = (
    "TINYINT", "SMALLINT", "LONG", "INT", "BIGINT", "DOUBLE", "FLOAT", "STRING", "BOOLEAN",
    "BINARY", r"CHAR\(\d+\)", r"VARCHAR\(\d+\)", "TIMESTAMP", "DATE", r"DECIMAL\(\d+(?:,\d+)?\)",
)
RULE_FIELDS = (
    Field("Name"),
    Field("TableName", "[a-zA-Z0-9_#]+"),
    Field("ColumnName", "[a-zA-Z0-9_#]+"),
    Field("DataType", "(?i:" + "|".join(DATA_TYPES) + ")"),
    Field("Level", r"\+?\d+"),
    Field("Expression", r"[\x20-\x7E]+"),
)

# Problem kinds, as they stand at the start of a report line, and the code of a run
# that stops on format problems.
VALIDATION, DUPLICATE, LEVELS = "Validation Check", "Duplicate Check", "Level Check For Columns"
FORMAT_PROBLEM_CODE = 100

EMPTY, MISMATCH = 2, 1
PROBLEM_COLUMNS = ("kind", "line_no", "table_name", "column_name", "level", "reason")


def is_empty(col: Column) -> Column:
    """Null, empty or nothing but blanks and control characters."""
    return col.isNull() | ~col.rlike(r"[^\x00-\x20]")


def check_fields(df: DataFrame, fields: Iterable[Field], keep: Sequence[str] = ()) -> DataFrame:
    """One row per failed field: the columns ``keep``, then field, code and reason.

    Code 2 is an empty required field, code 1 a value that does not match its format, apart from
    one double quote at each end and blanks around it. Works row by row, without a shuffle.
    """
    failures = []
    for field in fields:
        value = F.col(field.column).cast("string")
        code = F.when(is_empty(value), EMPTY if field.required else F.lit(None))
        if field.pattern is not None:
            whole = rf'\A(?:" *| *)(?:{field.pattern})(?: *"| *)\z'
            code = code.when(~value.rlike(whole), MISMATCH)
        failure = F.struct(F.lit(field.column).alias("field"), code.alias("code"))
        failures.append(F.when(code.isNotNull(), failure))
    found = df.select(*keep, F.explode(F.array_compact(F.array(*failures))).alias("__failure"))
    reason = F.when(F.col("code") == EMPTY, "Is empty").otherwise("DataType mismatch")
    return found.select(*keep, "__failure.*").withColumn("reason", reason)


def check_duplicates(df: DataFrame, keys: Sequence[str], count: str = "n") -> DataFrame:
    """Key combinations that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias(count)).filter(F.col(count) > 1)


def duplicate_rows(df: DataFrame, keys: Sequence[str], count: str = "n") -> DataFrame:
    """All rows whose key occurs more than once, with the number of such rows.

    Rows rather than a list per key, so that a key with very many rows stays spread out.
    """
    named = [F.col(key).alias(f"__key_{i}") for i, key in enumerate(keys)]
    repeated = check_duplicates(df.select(*named), [f"__key_{i}" for i in range(len(keys))], count)
    same = [F.col(key).eqNullSafe(F.col(f"__key_{i}")) for i, key in enumerate(keys)]
    joined = df.join(repeated, reduce(lambda a, b: a & b, same))
    return joined.drop(*[f"__key_{i}" for i in range(len(keys))])


def format_problems(rules: DataFrame) -> DataFrame:
    """Empty and malformed fields of rules, as problem rows."""
    failed = check_fields(rules, RULE_FIELDS, ["seq_no", "TableName", "ColumnName", "Level"])
    text = F.concat_ws(" ", F.concat(F.col("field"), F.lit(":")), "reason")
    return _problems(failed, VALIDATION, text)


def duplicate_problems(rules: DataFrame) -> DataFrame:
    """Rules that define the same column of the same table, in any case, one problem row per rule."""
    names = {"__table": F.lower("TableName"), "__column": F.lower("ColumnName")}
    repeated = duplicate_rows(clean_rules(rules).withColumns(names), list(names))
    return _problems(repeated, DUPLICATE, F.concat(F.lit("defined by rules: "), F.col("n")))


def reference_problems(
    rules: DataFrame, source_columns: Sequence[str] | None = None
) -> DataFrame:
    """Columns used before their level, one problem row per rule and column."""
    missing = check_references(clean_rules(rules), source_columns)
    text = F.concat(F.lit("not defined at a lower level: "), F.col("reference"))
    return _problems(missing, LEVELS, text)


def check_rules(rules: DataFrame, source_columns: Sequence[str] | None = None) -> DataFrame:
    """Every problem of numbered rules: kind, line_no, table_name, column_name, level, reason.

    ``line_no`` is the line in the rules file, which starts with a header.
    """
    return (
        format_problems(rules)
        .unionByName(duplicate_problems(rules))
        .unionByName(reference_problems(rules, source_columns))
    )


def report_lines(problems: DataFrame, at: str) -> DataFrame:
    """Problems as text lines ``<kind>: Error at <time>=><reason>``, ready for ``write.text``."""
    where = F.concat(
        F.lit("line "), F.col("line_no"), F.lit(", "),
        F.coalesce("table_name", F.lit("")), F.lit("."), F.coalesce("column_name", F.lit("")),
        F.lit(", level "), F.coalesce("level", F.lit("")), F.lit(": "), F.col("reason"),
    )
    return problems.select(
        F.concat(F.col("kind"), F.lit(f": Error at {at}=>"), where).alias("value")
    )


def _problems(rows: DataFrame, kind: str, reason: Column) -> DataFrame:
    return rows.select(
        F.lit(kind).alias("kind"),
        (F.col("seq_no") + 1).alias("line_no"),
        F.col("TableName").alias("table_name"),
        F.col("ColumnName").alias("column_name"),
        F.col("Level").cast("string").alias("level"),
        reason.alias("reason"),
    )
