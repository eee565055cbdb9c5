"""Statistics that merge: one row of counts and sketches per partition and column, and histograms."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ruleframe.operators.percentiles import percentile_table

#: Two to this power are the registers of a distinct-count sketch; its relative standard error is 1.04 / sqrt(2**12).
LOG_REGISTERS = 12
DISTINCT_ERROR = 0.01625
NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal", "date", "timestamp")


def partition_statistics(df: DataFrame, partition_by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per partition and column: row_count, num_nulls, min, max (as text, in the order of the type), a sketch
    of the distinct values and, of numbers and times, one of the quantiles (``kll``).

    One pass combined map-side; a sketch is some kilobytes, whatever the size of the partition. Rows of such
    tables, of any partitions, merge by :func:`merged_statistics`.
    """
    kinds = dict(df.dtypes)
    aggregates = []
    for i, name in enumerate(columns):
        col = F.col(f"`{name}`")
        number = _number(col, kinds[name])
        quantiles = F.kll_sketch_agg_double(number) if number is not None else F.lit(None).cast("binary")
        aggregates += [
            F.count(F.lit(1)).alias(f"rows_{i}"), (F.count(F.lit(1)) - F.count(col)).alias(f"nulls_{i}"),
            F.min(col).alias(f"min_{i}"), F.max(col).alias(f"max_{i}"),
            F.hll_sketch_agg(col.cast("string"), F.lit(LOG_REGISTERS)).alias(f"distinct_{i}"), quantiles.alias(f"kll_{i}"),
        ]
    per = df.groupBy(*[F.col(f"`{name}`") for name in partition_by]).agg(*aggregates)
    entries = [
        F.struct(
            F.lit(name).alias("column_name"), F.col(f"rows_{i}").alias("row_count"), F.col(f"nulls_{i}").alias("num_nulls"),
            F.col(f"min_{i}").cast("string").alias("min"), F.col(f"max_{i}").cast("string").alias("max"),
            _sortable(F.col(f"min_{i}"), kinds[name]).alias("low"), _sortable(F.col(f"max_{i}"), kinds[name]).alias("high"),
            F.col(f"distinct_{i}").alias("distinct"), F.col(f"kll_{i}").alias("kll"),
        )
        for i, name in enumerate(columns)
    ]
    own = [F.col(f"`{name}`") for name in partition_by]
    return per.select(*own, F.explode(F.array(*entries)).alias("entry")).select(*own, "entry.*")


def _number(col: Column, kind: str) -> Column | None:
    if kind.startswith("timestamp_ntz") or not kind.startswith(NUMBERS):
        return None
    if kind == "date":
        return F.unix_date(col).cast("double")
    return F.unix_micros(col).cast("double") if kind == "timestamp" else col.cast("double")


def _sortable(col: Column, kind: str) -> Column:
    """(number, text) that sorts as the type does: numbers by value, exactly, all else by its text."""
    exact = kind.startswith(("tinyint", "smallint", "int", "bigint", "decimal"))
    number = col.cast("decimal(38,6)") if exact else F.lit(None).cast("decimal(38,6)")
    real = col.cast("double") if kind in ("float", "double") else F.lit(None).cast("double")
    return F.struct(number.alias("exact"), real.alias("real"), col.cast("string").alias("text"))


def merged_statistics(statistics: DataFrame, partition_by: Sequence[str] = (), shares: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Statistics of whole tables, or of coarser partitions, from the rows of :func:`partition_statistics` alone:
    row_count, num_nulls, min and max exact, distinct_count and quantiles as near as the sketches are."""
    least, most = F.min_by("min", F.when(F.col("min").isNotNull(), F.col("low"))), F.max_by("max", F.when(F.col("max").isNotNull(), F.col("high")))
    merged = statistics.groupBy(*partition_by, "column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("num_nulls").alias("num_nulls"), least.alias("min"), most.alias("max"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("distinct_count"), F.kll_merge_agg_double("kll").alias("kll"),
    )
    some = F.col("kll").isNotNull() & (F.kll_sketch_get_n_double("kll") > 0)
    quantiles = F.array(*[F.kll_sketch_get_quantile_double("kll", F.lit(float(share))) for share in shares])
    return merged.withColumn("quantiles", F.when(some, quantiles)).drop("kll")


def replaced_partitions(statistics: DataFrame, fresh: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """``statistics`` with the rows of the partitions in ``fresh`` instead of those they had; the table itself is not
    read, only the partitions that were analysed anew."""
    touched = fresh.select(*[F.col(f"`{name}`").alias(f"__of_{name}") for name in partition_by]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(f"`{name}`").eqNullSafe(F.col(f"__of_{name}")) for name in partition_by])
    return statistics.join(touched, same, "left_anti").unionByName(fresh)


def column_histogram(df: DataFrame, column: str, buckets: int = 10) -> DataFrame:
    """(bucket, low, high, rows, values): equi-height buckets of a numeric column, with exact counts.

    The bounds are exact percentiles, found by rank without gathering the column; a bucket holds what is above ``low``,
    up to ``high``, the first one also its ``low``. A value that fills several buckets makes them one, so that
    none is empty. Nulls are in no bucket; a column of nulls has none.
    """
    value = F.col(f"`{column}`").cast("double")
    rows = df.select(value.alias("__value")).where("__value IS NOT NULL")
    bounds = {f"b{i}": ("__value", i / buckets) for i in range(buckets + 1)}
    found = percentile_table(rows, (), bounds).first()
    if found is None or found["b0"] is None:
        return df.sparkSession.createDataFrame([], "bucket int, low double, high double, rows long, values long")
    edges = list(dict.fromkeys(found[f"b{i}"] for i in range(buckets + 1)))
    uppers = edges[1:] or edges
    upper = F.array(*[F.lit(edge) for edge in uppers])
    bucket = F.least(F.size(F.filter(upper, lambda edge: edge < F.col("__value"))), F.lit(len(uppers) - 1)) + 1
    counts = rows.groupBy(bucket.alias("bucket"), "__value").agg(F.count("*").alias("n")).groupBy("bucket")
    counts = counts.agg(F.sum("n").alias("rows"), F.count("*").alias("values"))
    lowers = F.array(*[F.lit(edge) for edge in (edges[:-1] or edges)])
    return counts.select("bucket", F.element_at(lowers, F.col("bucket")).alias("low"), F.element_at(upper, F.col("bucket")).alias("high"), "rows", "values")
