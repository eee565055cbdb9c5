"""Group values on every row, without gathering a group in one task.

``sum(x) OVER (PARTITION BY k)`` puts all rows of a key into one task; with a key that holds a
third of the table that task never ends. The same values come from a grouped aggregate, which is
combined map-side and has one row per key, joined back to the rows. The planner broadcasts that
table when it is small enough and otherwise uses a sort-merge join, whose skewed partitions
adaptive execution splits.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    NumericType,
    TimestampNTZType,
    TimestampType,
)

from ruleframe.functions.aggregates import (
    best_value,
    weighted_average,
    weighted_ratio,
    weighted_sums,
)
from ruleframe.functions.calls import calls_any, expand_calls, replace_calls, split_arguments
from ruleframe.operators.percentiles import (
    PERCENTILES,
    percentile_table,
    plain_percentiles,
    value_and_share,
)

# Aggregates whose value does not depend on row order and whose state does not grow with the group
# (collect_set: with its distinct values), or that are found by rank. Others stay window expressions.
AGGREGATES = frozenset(
    "any any_value approx_count_distinct avg bit_and bit_or bit_xor bool_and bool_or collect_set "
    "corr count count_if covar_pop covar_samp every kurtosis max max_by mean median min min_by mode "
    "mostcommon percentile regr_slope skewness some std stddev stddev_pop stddev_samp sum try_avg try_sum "
    "var_pop var_samp variance weightedaverage".split()
)

PARTITION = re.compile(r"^\s*PARTITION\s+BY\b(?P<keys>.*)$", re.I | re.S)
ORDERED = re.compile(r"\b(ORDER|SORT|ROWS|RANGE)\b", re.I)


# Aggregates of parts of a group that give the aggregate of the whole group
COMBINED = {
    "sum": F.sum, "count": F.sum, "count_if": F.sum, "min": F.min, "max": F.max,
    "bool_and": F.bool_and, "every": F.bool_and, "bool_or": F.bool_or, "some": F.bool_or,
    "any": F.bool_or, "bit_and": F.bit_and, "bit_or": F.bit_or, "bit_xor": F.bit_xor,
}
# Types that hash aggregation keeps in place
FIXED_WIDTH = (NumericType, BooleanType, DateType, TimestampType, TimestampNTZType)
DISTINCT = re.compile(r"^\s*DISTINCT\b", re.I)


@dataclass(frozen=True)
class GroupValue:
    """One aggregate over whole groups: ``call(args)`` per distinct ``keys``."""

    keys: tuple[str, ...]
    call: str
    args: str

    def column(self) -> Column:
        if self.call == "weightedaverage":
            return weighted_average(*self._weight_and_value())
        return F.expr(f"{self.call}({expand_calls(self.args)})")

    def mode_input(self) -> Column | None:
        """The expression whose most common value is asked for; None for other aggregates."""
        if self.call == "mostcommon":
            return F.expr(expand_calls(self.args)).cast("string")
        if self.call == "mode":
            return F.expr(expand_calls(split_arguments(self.args)[0]))
        return None

    def parts(self) -> list[Column] | None:
        """Aggregates over parts of a group that :meth:`combine` can use; None if there are none."""
        if self.call == "weightedaverage":
            return list(weighted_sums(*self._weight_and_value()))
        if self.call in COMBINED and not DISTINCT.match(self.args):
            return [self.column()]
        return None

    def combine(self, parts: Sequence[Column]) -> Column:
        if self.call == "weightedaverage":
            return weighted_ratio(*[F.sum(part) for part in parts])
        combined = COMBINED[self.call](parts[0])
        return F.coalesce(combined, F.lit(0)) if self.call.startswith("count") else combined

    def _weight_and_value(self) -> tuple[Column, Column]:
        weight, value = split_arguments(expand_calls(self.args))
        return F.expr(weight), F.expr(value)


class GroupValues:
    """Collects the whole-group windows of several rule texts and names them.

    Equal values get one name, whatever rule they occur in.
    """

    def __init__(self) -> None:
        self._names: dict[GroupValue, str] = {}

    def extract(self, text: str) -> str:
        """``text`` with every whole-group window replaced by the name of a group value."""

        def one(name: str, args: str, over: str | None) -> str | None:
            if over is None or name not in AGGREGATES:
                return None
            keys = partition_keys(over)
            if keys is None or calls_any(args, AGGREGATES, windowed=True):
                return None
            if name in PERCENTILES and value_and_share(name, args) is None:
                return None
            return self._name(GroupValue(tuple(sorted(set(keys))), name, args))

        return replace_calls(plain_percentiles(text), one)

    def extract_totals(self, text: str) -> str:
        """``text`` with every aggregate call replaced by the name of a value of the whole table."""

        def one(name: str, args: str, over: str | None) -> str | None:
            if over is not None or name not in AGGREGATES or calls_any(args, AGGREGATES):
                return None
            return self._name(GroupValue((), name, args))

        return replace_calls(text, one)

    @property
    def names(self) -> list[str]:
        return list(self._names.values())

    def _name(self, value: GroupValue) -> str:
        if "'" not in value.args and '"' not in value.args:
            value = replace(value, args=" ".join(value.args.split()))
        return self._names.setdefault(value, f"__group_value_{len(self._names)}")

    def by_keys(self) -> dict[tuple[str, ...], dict[str, GroupValue]]:
        """Group values per key set; each key set costs one grouping and one join."""
        grouped: dict[tuple[str, ...], dict[str, GroupValue]] = {}
        for value, name in self._names.items():
            grouped.setdefault(value.keys, {})[name] = value
        return grouped


def partition_keys(over: str) -> tuple[str, ...] | None:
    """Keys of a window without order or frame; None if it has one. ``OVER ()`` has no keys."""
    if not over.strip():
        return ()
    match = PARTITION.match(over)
    if match is None or ORDERED.search(match["keys"]):
        return None
    return tuple(split_arguments(match["keys"]))


def group_table(df: DataFrame, keys: Sequence[str], values: Mapping[str, GroupValue]) -> DataFrame:
    """A table with one row per distinct ``keys``: ``__key_0``, ... and the values.

    One grouping gives all values, unless most common values meet others that would spoil their
    hash aggregation; then two tables, one row per key each, are joined before they meet the rows.
    """
    key_names = [f"__key_{i}" for i in range(len(keys))]
    rows = df.select("*", *[F.expr(key).alias(name) for key, name in zip(keys, key_names)])
    by_rank = _by_rank(rows, values)
    if by_rank:
        found = percentile_table(rows, key_names, by_rank)
        others = {name: v for name, v in values.items() if name not in by_rank}
        if not others:
            return found
        own_names = {name: f"_{name}" for name in key_names}
        plain = group_table(df, keys, others).withColumnsRenamed(own_names)
        both = attach_groups(plain, list(own_names.values()), found, by_rank)
        return both.withColumnsRenamed({own: name for name, own in own_names.items()})
    modes = {name: v for name, v in values.items() if v.mode_input() is not None}
    others = {name: v for name, v in values.items() if name not in modes}
    if not modes:
        return rows.groupBy(*key_names).agg(*[v.column().alias(n) for n, v in others.items()])
    types = rows.agg(F.count("*"), *[v.column().alias(n) for n, v in others.items()]).schema
    with_counts = {
        name: types[name].dataType
        for name, v in others.items()
        if v.parts() is not None and isinstance(types[name].dataType, FIXED_WIDTH)
    }
    counted = _with_modes(rows, key_names, modes, values, with_counts)
    others = {name: v for name, v in others.items() if name not in with_counts}
    if not others:
        return counted
    plain = rows.groupBy(*key_names).agg(*[v.column().alias(n) for n, v in others.items()])
    own_names = {name: f"_{name}" for name in key_names}
    both = attach_groups(counted.withColumnsRenamed(own_names), list(own_names.values()), plain, others)
    return both.withColumnsRenamed({own: name for name, own in own_names.items()})


def group_tables(
    df: DataFrame,
    by_keys: Mapping[tuple[str, ...], Mapping[str, GroupValue]],
    keep: Callable[[DataFrame], DataFrame] | None,
) -> list[tuple[tuple[str, ...], DataFrame, Mapping[str, GroupValue]]]:
    """(keys, group table, values) of each key set, with as few passes over ``df`` as possible.

    A key set that lies inside another one is rolled up from that one's table, of the one with the fewest keys,
    if the parts of its values can be combined; the finer table carries them along. So PARTITION BY a, b, c and
    a, b and a and nothing read the rows once. ``keep`` writes a table before others read it; without it
    every key set groups the rows itself.
    """
    sets = sorted(by_keys, key=len, reverse=True)
    finer: dict[tuple[str, ...], tuple[str, ...]] = {}
    if keep is not None:
        for keys in sets:
            over = [other for other in sets if set(keys) < set(other)]
            if over and all(v.call in COMBINED and v.parts() is not None for v in by_keys[keys].values()):
                finer[keys] = over[-1]
    carried: dict[tuple[str, ...], dict[str, GroupValue]] = {keys: {} for keys in sets}
    for keys in reversed(sets):  # coarse ones first: what they need goes up to the finest
        if keys in finer:
            needed = {**by_keys[keys], **carried[keys]}
            carried[finer[keys]] |= {name: replace(value, keys=finer[keys]) for name, value in needed.items()}
    tables: dict[tuple[str, ...], DataFrame] = {}
    for keys in sets:
        values = {**by_keys[keys], **carried[keys]}
        if keys in finer:
            table = _rolled_up(df, tables[finer[keys]], finer[keys], keys, values)
        else:
            table = group_table(df, keys, values)
        tables[keys] = table if keep is None else keep(table)
    return [(keys, _only(tables[keys], keys, by_keys[keys]), by_keys[keys]) for keys in by_keys]


def _only(table: DataFrame, keys: Sequence[str], values: Iterable[str]) -> DataFrame:
    return table.select(*[f"__key_{i}" for i in range(len(keys))], *values)


def _rolled_up(
    df: DataFrame, table: DataFrame, finer: Sequence[str], keys: Sequence[str], values: Mapping[str, GroupValue]
) -> DataFrame:
    """The group table of ``keys`` from that of a finer key set. Types are those of the values over ``df``."""
    types = df.agg(F.count("*"), *[value.column().alias(name) for name, value in values.items()]).schema
    own = [F.col(f"__key_{finer.index(key)}").alias(f"__key_{i}") for i, key in enumerate(keys)]
    combined = [value.combine([F.col(name)]).cast(types[name].dataType).alias(name) for name, value in values.items()]
    return table.groupBy(*own).agg(*combined)


def _by_rank(rows: DataFrame, values: Mapping[str, GroupValue]) -> dict[str, tuple[str, float]]:
    """Percentiles of numbers, by name; those of intervals are left to Spark."""
    found = {n: value_and_share(v.call, expand_calls(v.args)) for n, v in values.items() if v.call in PERCENTILES}
    if not any(found.values()):
        return {}
    types = dict(rows.agg(F.count("*"), *[values[n].column().alias(n) for n in found]).dtypes)
    return {n: of for n, of in found.items() if of is not None and types[n] == "double"}


def _with_modes(
    rows: DataFrame,
    key_names: list[str],
    modes: Mapping[str, GroupValue],
    values: Mapping[str, GroupValue],
    others: Mapping[str, DataType],
) -> DataFrame:
    """Group table with most common values, which are counted per (keys, value) first.

    No task ever holds the values of a whole group. The ``others``, given with their types, share
    the pass: they are taken per (keys, value) as well and combined with the counts. Several modes
    become grouping sets.
    """
    mode_names = [f"__mode_{i}" for i in range(len(modes))]
    rows = rows.select("*", *[v.mode_input().alias(m) for v, m in zip(modes.values(), mode_names)])
    first_pass = [F.count("*").alias("__rows")]
    for name in others:
        parts = enumerate(values[name].parts())
        first_pass += [part.alias(f"{name}_part_{i}") for i, part in parts]
    columns = [*key_names, *mode_names]
    if len(modes) == 1:
        counts = rows.groupBy(*columns).agg(F.lit(0).alias("__set"), *first_pass)
    else:
        sets = [[*key_names, mode] for mode in mode_names]
        counts = rows.groupingSets(sets, *columns).agg(
            F.grouping_id().alias("__set"), *first_pass
        )
    # grouping_id has one bit per column, set for columns that are not part of the set
    absent = 2 ** len(mode_names) - 1
    in_set = [
        F.col("__set") == absent - 2 ** (len(mode_names) - 1 - i) for i in range(len(mode_names))
    ]
    second_pass = []
    for name, mode, of_mode in zip(modes, mode_names, in_set):
        known = F.when(F.col(mode).isNotNull(), F.col("__rows")).otherwise(0)
        second_pass.append(best_value(mode, known, of_mode).alias(name))
    for name, data_type in others.items():
        count = len(values[name].parts())
        parts = [F.when(in_set[0], F.col(f"{name}_part_{i}")) for i in range(count)]
        second_pass.append(values[name].combine(parts).cast(data_type).alias(name))
    return counts.groupBy(*key_names).agg(*second_pass)


def attach_groups(
    df: DataFrame, keys: Sequence[str], groups: DataFrame, names: Iterable[str]
) -> DataFrame:
    """``df`` with the columns ``names`` of its group table; null keys are a group as well."""
    if not keys:
        values = groups.select(F.struct(*names).alias("values")).scalar()
        whole = df.select("*", values.alias("__whole_table"))
        parts = [F.col("__whole_table")[name].alias(name) for name in names]
        return whole.select("*", *parts).drop("__whole_table")
    same = F.lit(True)
    for i, key in enumerate(keys):
        same = same & F.expr(key).eqNullSafe(F.col(f"__key_{i}"))
    joined = df.join(groups, same, "left")
    return joined.drop(*[f"__key_{i}" for i in range(len(keys))])


def with_group_values(
    df: DataFrame, keys: Sequence[str], values: Mapping[str, str]
) -> DataFrame:
    """Add ``{name: "aggregate(expression)"}`` columns computed over each group of ``keys``.

    The same rows as ``aggregate(expression) OVER (PARTITION BY keys)``.
    """
    found = GroupValues()
    over = f"PARTITION BY {', '.join(keys)}" if keys else ""
    texts = {name: found.extract(f"{text} OVER ({over})") for name, text in values.items()}
    source = df
    for group_keys, group_values in found.by_keys().items():
        df = attach_groups(df, group_keys, group_table(source, group_keys, group_values), group_values)
    return df.select("*", *[F.expr(t).alias(n) for n, t in texts.items()]).drop(*found.names)
