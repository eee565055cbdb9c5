"""Most common value, weighted average and joined text, as Column and DataFrame helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec


def _column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def most_common(col: Column | str) -> Column:
    """Most frequent non-null value as text; ties give the smallest text, no value gives null.

    Works in groups and windows. The state is one count per distinct value of a group, merged
    map-side, so a hot group costs no more than its distinct values. Where those are unbounded
    too, use :func:`most_common_by`, which never holds them together.
    """
    return F.mode(_column(col).cast("string"), True)


def most_common_by(
    df: DataFrame, keys: Sequence[str], col: Column | str, name: str = "most_common"
) -> DataFrame:
    """:func:`most_common` per group without any per-group map.

    Counts per (keys, value) first, so the rows of a hot key are spread over its values and
    combined before the shuffle; the second grouping keeps a single candidate per key and task.
    """
    values = df.select(*keys, _column(col).cast("string").alias("__value"))
    counts = values.groupBy(*keys, "__value").agg(F.count("__value").alias("__rows"))
    return counts.groupBy(*keys).agg(best_value("__value", F.col("__rows")).alias(name))


def best_value(value: str, rows: Column, when: Column | None = None) -> Column:
    """The value with the most rows, the smallest one on ties; aggregates pre-counted values.

    A null value must come with a count of zero, so that it only wins when it is alone.
    """
    order = F.struct((-rows).alias("n"), F.col(value).alias("v"))
    return F.min_by(value, order if when is None else F.when(when, order))


def weighted_average(
    weight: Column | str,
    value: Column | str,
    nulls: str = "zero",
    number_type: str = "double",
    over: WindowSpec | None = None,
) -> Column:
    """Sum of weight times value over the sum of weights, as a double.

    ``nulls="zero"`` counts a null weight or value as 0, so a null value still adds its weight;
    ``nulls="skip"`` leaves out rows where either is null. No rows, or zero over zero, gives null;
    another number over zero gives plus or minus infinity. With a decimal ``number_type`` the sums
    are exact and do not depend on the order in which partitions are merged.
    """
    total, weights = weighted_sums(weight, value, nulls, number_type)
    if over is not None:
        total, weights = total.over(over), weights.over(over)
    return weighted_ratio(total, weights)


def weighted_sums(
    weight: Column | str, value: Column | str, nulls: str = "zero", number_type: str = "double"
) -> tuple[Column, Column]:
    """The two sums of a weighted average; sums of such sums give the average of a whole."""
    w = _column(weight).try_cast(number_type)
    v = _column(value).try_cast(number_type)
    if nulls == "zero":
        zero = F.lit(0).cast(number_type)
        w, v = F.coalesce(w, zero), F.coalesce(v, zero)
    elif nulls == "skip":
        both = w.isNotNull() & v.isNotNull()
        w, v = F.when(both, w), F.when(both, v)
    else:
        raise ValueError(f"nulls must be 'zero' or 'skip', not {nulls!r}")
    return F.sum(w * v), F.sum(w)


def weighted_ratio(total: Column, weights: Column) -> Column:
    """The average from its two sums."""
    total, weights = total.cast("double"), weights.cast("double")
    infinity = F.lit(float("inf"))
    result = (
        F.when(weights != 0, total / weights)
        .when(F.isnan(total), F.lit(None))
        .when(total > 0, infinity)
        .when(total < 0, -infinity)
    )
    return F.when(~F.isnan(result), result)


def collect_ws(col: Column | str) -> Column:
    """The elements of an array as text, joined with commas; an empty array gives ''.

    Null elements are left out and a null array gives null.
    """
    return F.array_join(_column(col).cast("array<string>"), ",")


def register_functions(spark: SparkSession) -> None:
    """Register ``CollectWs`` for plain SQL text of this session.

    ``MostCommon`` and ``WeightedAverage`` are aggregates, which a SQL function cannot hold. Rule
    text and SQL files may still use both names: :func:`ruleframe.functions.calls.expand_calls`
    turns them into built-in aggregates, which combine map-side where a Python aggregate would
    hold a whole group in one task.
    """
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION CollectWs(items ARRAY<STRING>) "
        "RETURNS STRING RETURN array_join(items, ',')"
    )
