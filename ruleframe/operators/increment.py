"""Group values that grow with new rows: states that merge, so that old rows are not read again."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ruleframe.functions.aggregates import best_value
from ruleframe.functions.calls import expand_calls
from ruleframe.operators.groups import GroupValue, GroupValues, attach_groups
from ruleframe.operators.running import matched


@dataclass(frozen=True)
class GroupState:
    """What is known of the groups of ``keys`` (SQL expressions): ``sums`` holds one row per group, the keys as
    ``__key_0``, ... and the parts of each value; ``counts`` one row per group, most common value and value of it.

    Both are plain tables, to be stored and read as such; ``values`` and ``types`` come from :func:`group_state`.
    """

    keys: tuple[str, ...]
    values: Mapping[str, GroupValue]
    types: Mapping[str, DataType]
    sums: DataFrame
    counts: DataFrame | None

    @property
    def names(self) -> list[str]:
        return [f"__key_{i}" for i in range(len(self.keys))]

    def stored(self, sums: DataFrame, counts: DataFrame | None = None) -> GroupState:
        """The same state, read from where it was written."""
        return replace(self, sums=sums, counts=counts)


def group_state(df: DataFrame, keys: Sequence[str], values: Mapping[str, str]) -> GroupState:
    """The state of ``{name: "aggregate(expression)"}`` over the rows of ``df``, grouped by ``keys``.

    The aggregates are those that parts of a group can be combined to: sum, count, count_if, min, max, bool_and,
    bool_or, bit_and, bit_or, bit_xor, avg of other than decimals, WeightedAverage, and MostCommon or
    mode(x, true), which are kept as counts of values. Others raise.
    """
    names = {}
    for name, text in values.items():
        own = GroupValues()
        own.extract(f"{text} OVER (PARTITION BY {', '.join(keys)})")
        one = [value for by in own.by_keys().values() for value in by.values()]
        if len(one) != 1 or (_parts(one[0], df) is None and one[0].mode_input() is None):
            raise ValueError(f"{name}: {text} cannot be merged from parts of a group")
        names[name] = one[0]
    key_names = [f"__key_{i}" for i in range(len(keys))]
    rows = df.select("*", *[F.expr(key).alias(name) for key, name in zip(keys, key_names)])
    types = {f.name: f.dataType for f in df.agg(*[_whole(v).alias(n) for n, v in names.items()]).schema}
    modes = {name: value for name, value in names.items() if value.mode_input() is not None}
    parts = {f"{n}_{i}": part for n, v in names.items() if n not in modes for i, part in enumerate(_parts(v, df))}
    sums = rows.groupBy(*key_names).agg(F.count("*").alias("__rows"), *[part.alias(name) for name, part in parts.items()])
    counts = None
    if modes:
        entries = [F.struct(F.lit(n).alias("__of"), v.mode_input().cast("string").alias("__value")) for n, v in modes.items()]
        counts = rows.select(*key_names, F.explode(F.array(*entries)).alias("e")).select(*key_names, "e.*")
        counts = counts.groupBy(*key_names, "__of", "__value").agg(F.count("*").alias("__n"))
    return GroupState(tuple(keys), names, types, sums, counts)


def _whole(value: GroupValue) -> Column:
    return F.expr(expand_calls(f"{value.call}({value.args})"))


def _parts(value: GroupValue, df: DataFrame) -> list[Column] | None:
    if value.call in ("avg", "mean") and not re.match(r"\s*DISTINCT\b", value.args, re.I):
        own = F.expr(expand_calls(value.args))
        if df.select(own).dtypes[0][1].startswith(("decimal", "interval")):
            return None
        return [F.sum(own.cast("double")), F.count(own)]
    return value.parts()


def _combined(value: GroupValue, parts: list[Column]) -> Column:
    if value.call in ("avg", "mean"):
        return F.try_divide(F.sum(parts[0]), F.sum(parts[1]))
    return value.combine(parts)


#: How parts of each kind add up; those not named are sums.
_MERGE = {
    "min": F.min, "max": F.max, "bool_and": F.bool_and, "every": F.bool_and, "bool_or": F.bool_or, "some": F.bool_or,
    "any": F.bool_or, "bit_and": F.bit_and, "bit_or": F.bit_or, "bit_xor": F.bit_xor,
}


def merge_states(old: GroupState, new: GroupState) -> GroupState:
    """The state of the rows of both, from the two tables alone."""
    both = old.sums.unionByName(new.sums)
    kinds = dict(both.dtypes)
    columns = [F.sum("__rows").alias("__rows")]
    for name, value in old.values.items():
        for part in [c for c in both.columns if re.fullmatch(rf"{re.escape(name)}_\d+", c)]:
            merge = _MERGE.get(value.call, F.sum)
            columns.append(merge(f"`{part}`").cast(kinds[part]).alias(part))
    sums = both.groupBy(*old.names).agg(*columns)
    counts = None
    if old.counts is not None:
        counts = old.counts.unionByName(new.counts).groupBy(*old.names, "__of", "__value").agg(F.sum("__n").alias("__n"))
    return replace(old, sums=sums, counts=counts)


def group_values_of(state: GroupState) -> DataFrame:
    """One row per group: the keys and the values."""
    modes = [name for name, value in state.values.items() if value.mode_input() is not None]
    found = []
    for name, value in state.values.items():
        if name not in modes:
            parts = [F.col(f"`{c}`") for c in state.sums.columns if re.fullmatch(rf"{re.escape(name)}_\d+", c)]
            found.append(_combined(value, parts).cast(state.types[name]).alias(name))
    table = state.sums.groupBy(*state.names).agg(F.sum("__rows").alias("__rows"), *found).drop("__rows")
    if modes:
        known = F.when(F.col("__value").isNotNull(), F.col("__n")).otherwise(0)
        most = [best_value("__value", known, F.col("__of") == name).cast(state.types[name]).alias(name) for name in modes]
        table = matched(table, state.counts.groupBy(*state.names).agg(*most), state.names, "__of_")
    return table.select(*state.names, *state.values)


def attach_increment(rows: DataFrame, old: GroupState, new: GroupState | None = None) -> tuple[DataFrame, GroupState]:
    """New rows with their group values over old and new rows, and the merged state to be stored.

    ``new`` is the state of ``rows``, which is computed if it is not given. Only groups that the new rows touch are
    finished; old rows are not read.
    """
    if new is None:
        new = group_state(rows, old.keys, {name: f"{value.call}({value.args})" for name, value in old.values.items()})
    merged = merge_states(old, new)
    touched = new.sums.select(*[F.col(name).alias(f"__t{name}") for name in old.names])
    same = [F.col(name).eqNullSafe(F.col(f"__t{name}")) for name in old.names]
    own = merged.stored(
        merged.sums.join(touched, same, "left_semi"),
        None if merged.counts is None else merged.counts.join(touched, same, "left_semi"),
    )
    return attach_groups(rows, old.keys, group_values_of(own), list(old.values)), merged
