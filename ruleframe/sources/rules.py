"""The rules table: read, number, clean, select and publish."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ruleframe.functions.levels import level_number
from ruleframe.operators.derive import rule_list

# The columns of a rules file, in file order, all text.
FILE_COLUMNS = (
    "Name", "TableName", "ColumnName", "DataType", "Level", "Expression",
    "OracleDataType", "SourceTable", "Version",
)
RULES_SCHEMA = ", ".join(f"{name} STRING" for name in FILE_COLUMNS)
QUOTED_COLUMNS = ("TableName", "ColumnName", "DataType", "Expression")
# Fixed value: the text form of insert_time.
TIME_FORMAT = "%Y-%m-%dT%H:%M:%S"

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number in the low bits


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rules from a tab-separated file with a header; columns go by position. Adds ``seq_no``."""
    rows = spark.read.schema(RULES_SCHEMA).csv(path, sep="\t", header=True)
    return number_rows(rows).select(F.col("seq_no").cast("int"), *FILE_COLUMNS)


def number_rows(df: DataFrame, name: str = "seq_no") -> DataFrame:
    """Number rows from 1, by file name and place in the file, for a frame that scans files.

    Spark deals large files to tasks first, so the order of tasks is not that of the files. Every part of a
    file that a task reads numbers its own rows; the first number of a part is the row count of the parts
    before it, from a table with one row per part. No row is sorted or moved.
    """
    part = {"__file": F.input_file_name(), "__start": F.input_file_block_start()}
    tagged = df.select("*", F.monotonically_increasing_id().alias("__row"), *[c.alias(n) for n, c in part.items()])
    keys = ["__file", "__start", "__task"]
    tagged = tagged.withColumn("__task", F.shiftright("__row", _ROW_BITS))
    counts = tagged.groupBy(*keys).agg(F.count("*").alias("__rows"), F.min("__row").alias("__first"))
    before = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, "__first", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    # One row per part of a file, whatever the size of the data: safe to broadcast.
    numbered = tagged.join(F.broadcast(starts), keys)
    number = F.col("__before") + F.col("__row") - F.col("__first") + 1
    return numbered.withColumn(name, number).drop(*keys, "__row", "__first", "__before")


def clean_rules(df: DataFrame, columns: tuple[str, ...] = QUOTED_COLUMNS) -> DataFrame:
    """Remove one leading and one trailing double quote from text columns, and outer blanks."""
    cleaned = {c: F.trim(F.regexp_replace(c, r'\A"|"\z', "")) for c in columns}
    return df.withColumns(cleaned)


def select_rules(rules: DataFrame, table: str, low: int, high: int) -> DataFrame:
    """Distinct rules of one table, in any case, within a level range; ordered for ``derive``."""
    return (
        rules.withColumn("Level", level_number("Level"))
        .filter((F.lower("TableName") == table.lower()) & F.col("Level").between(low, high))
        .dropDuplicates()
        .orderBy("Level", "seq_no")
    )


def publishable(rules: DataFrame, insert_time: str | None = None) -> DataFrame:
    """Rules with ``idColumn`` and one ``insert_time`` for the whole run."""
    insert_time = insert_time or datetime.now().strftime(TIME_FORMAT)
    return rules.withColumns(
        {
            "idColumn": F.concat("TableName", "ColumnName", F.col("seq_no").cast("string")),
            "insert_time": F.lit(insert_time),
        }
    )


def publish_rules(
    rules: DataFrame,
    path: str | None = None,
    table: str | None = None,
    insert_time: str | None = None,
) -> DataFrame:
    """Store rules as Parquet at ``path``, or as a catalog table, and read them back."""
    writer = publishable(rules, insert_time).write.mode("overwrite")
    if table is None:
        writer.parquet(path)
    else:
        if path is not None:
            writer = writer.option("path", path)
        writer.format("parquet").saveAsTable(table)
    return load_rules(rules.sparkSession, path, table)


def load_rules(
    spark: SparkSession, path: str | None = None, table: str | None = None
) -> DataFrame:
    """Published rules, with ``Level`` as an int."""
    rules = spark.read.parquet(path) if table is None else spark.table(table)
    return rules.withColumn("Level", level_number("Level"))


def rules_schema(rules: DataFrame) -> StructType:
    """Table schema declared by rules: their columns and types, in rule order."""
    columns = [f"`{rule.column}` {rule.type}" for rule in rule_list(rules)]
    return StructType.fromDDL(", ".join(columns))
