"""SQL statements kept in text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ruleframe.functions.calls import expand_calls


def read_sql(spark: SparkSession, path: str) -> str:
    """The text of a SQL file, or of all files of a folder in name order.

    Lines are kept apart so that ``--`` comments end where they should.
    """
    files = spark.read.text(path, wholetext=True).select("value", "_metadata.file_path")
    texts = [row["value"] for row in files.orderBy("file_path").collect()]
    if not texts:
        raise ValueError(f"there is no SQL text at {path}")
    return "\n".join(texts)


def run_sql_text(spark: SparkSession, text: str) -> DataFrame:
    """Run one SQL statement, in which the library's function names may be used."""
    return spark.sql(expand_calls(text))


def source_from_sql(spark: SparkSession, path: str) -> DataFrame:
    """The result of a SQL file."""
    return run_sql_text(spark, read_sql(spark, path))
