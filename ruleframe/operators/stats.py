"""Table and column statistics, in the catalog and of any DataFrame."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ruleframe.sources.tables import quoted

# The column statistics Spark's catalog shows.
COLUMN_STATS = ("min", "max", "num_nulls", "distinct_count", "avg_col_len", "max_col_len")
MEASURES = (
    "row_count", "num_nulls", "distinct_count", "min", "max", "avg_col_len", "max_col_len"
)


def analyze(
    spark: SparkSession,
    table: str,
    partitions: Sequence[str] = (),
    columns: Sequence[str] = (),
) -> None:
    """Store statistics of a table, or of its partitions instead, and of ``columns`` as well.

    ``partitions`` are partition columns or ``name=value`` texts. ``columns`` must exist.
    """
    name = quoted(table)
    only = f" PARTITION ({', '.join(partitions)})" if partitions else ""
    spark.sql(f"ANALYZE TABLE {name}{only} COMPUTE STATISTICS")
    if columns:
        listed = ", ".join(f"`{column}`" for column in columns)
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {listed}")


def read_stats(
    spark: SparkSession, table: str, columns: Sequence[str] = (), partition: Sequence[str] = ()
) -> DataFrame:
    """Stored statistics as rows (column_name, statistic, value); the table's have no column.

    With ``partition``, ``name=value`` texts of one partition, its size instead of the table's.
    """
    name = quoted(table)
    of_partition = f" PARTITION ({', '.join(partition)})" if partition else ""
    shown = "Partition Statistics" if partition else "Statistics"
    stats = (
        spark.sql(f"DESCRIBE EXTENDED {name}{of_partition}")
        .filter(F.col("col_name") == shown)
        .selectExpr("CAST(NULL AS STRING) AS column_name", "'size' AS statistic", "data_type AS value")
    )
    for column in columns:
        described = spark.sql(f"DESCRIBE EXTENDED {name} `{column}`")
        shown = described.filter(F.col("info_name").isin(*COLUMN_STATS)).select(
            F.lit(column).alias("column_name"),
            F.col("info_name").alias("statistic"),
            F.col("info_value").alias("value"),
        )
        stats = stats.unionByName(shown)
    return stats


def profile(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """One row per column: rows, nulls, distinct values, extremes, and lengths of the text form.

    Distinct counts are exact by default: each column is read for itself and shrinks to its
    distinct values before the shuffle. ``approximate=True`` uses sketches as ANALYZE does: all
    columns in one pass, and one row per task is shuffled.
    """
    if approximate:
        return _sketched(df, columns)
    return reduce(DataFrame.unionByName, [_counted(df, column) for column in columns])


def _counted(df: DataFrame, column: str) -> DataFrame:
    values = df.groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n"))
    known = F.when(F.col("v").isNotNull(), F.col("n"))
    length = F.length(F.col("v").cast("string"))
    return values.agg(
        F.lit(column).alias("column_name"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("num_nulls"),
        F.count("v").alias("distinct_count"),
        F.min("v").cast("string").alias("min"),
        F.max("v").cast("string").alias("max"),
        (F.sum(length * known).cast("double") / F.sum(known)).alias("avg_col_len"),
        F.max(length).alias("max_col_len"),
    )


def _sketched(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    measures = []
    for i, column in enumerate(columns):
        col, length = F.col(column), F.length(F.col(column).cast("string"))
        measures += [
            F.count("*").alias(f"row_count_{i}"),
            (F.count("*") - F.count(col)).alias(f"num_nulls_{i}"),
            F.approx_count_distinct(col).alias(f"distinct_count_{i}"),
            F.min(col).cast("string").alias(f"min_{i}"),
            F.max(col).cast("string").alias(f"max_{i}"),
            F.avg(length).alias(f"avg_col_len_{i}"),
            F.max(length).alias(f"max_col_len_{i}"),
        ]
    rows = [
        F.struct(F.lit(column).alias("column_name"), *[F.col(f"{m}_{i}").alias(m) for m in MEASURES])
        for i, column in enumerate(columns)
    ]
    return df.agg(*measures).select(F.inline(F.array(*rows)))
