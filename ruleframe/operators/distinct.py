"""Running counts of distinct values: how many different values a group has had up to a row.

``count(DISTINCT x) OVER (PARTITION BY k ORDER BY t)`` is no window Spark knows. In rule text it is
``RunningDistinct(x) OVER (PARTITION BY k ORDER BY t)``.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ruleframe.functions.calls import expand_calls, replace_calls
from ruleframe.operators.running import (
    ORDER_ITEM,
    OrderedWindow,
    RunningValue,
    attach_running,
    key_names,
    matched,
    ordered_window,
)
from ruleframe.session import stage

RUNNING_DISTINCT = "runningdistinct"


class RunningDistincts:
    """Collects the running distinct counts of several rule texts and names them."""

    def __init__(self) -> None:
        self._names: dict[tuple[OrderedWindow, str], str] = {}

    def extract(self, text: str) -> str:
        """``text`` with every running distinct count replaced by its name."""

        def one(name: str, args: str, over: str | None) -> str | None:
            if name != RUNNING_DISTINCT:
                return None
            found = None if over is None else ordered_window(over)
            if found is None or found[1]:
                raise ValueError(f"RunningDistinct({args}) needs OVER (... ORDER BY ...) up to rows of equal order")
            value = (found[0], re.sub(r"\s+", " ", args.strip()) if "'" not in args and '"' not in args else args)
            return self._names.setdefault(value, f"__running_distinct_{len(self._names)}")

        return replace_calls(text, one)

    @property
    def names(self) -> list[str]:
        return list(self._names.values())

    def by_window(self) -> dict[OrderedWindow, dict[str, str]]:
        grouped: dict[OrderedWindow, dict[str, str]] = {}
        for (window, args), name in self._names.items():
            grouped.setdefault(window, {})[name] = args
        return grouped


def attach_running_distinct(
    df: DataFrame, window: OrderedWindow, values: Mapping[str, str], view: str | None = None, blocks: int = 0
) -> DataFrame:
    """``df`` with, for each expression, the number of its different values in the rows of a key up to the current
    row and those of equal order; nulls do not count.

    The different (keys, order) get places by a running count in blocks. A value begins at the smallest place it has,
    by a grouped minimum; what begins at a place is counted and summed along the places, in blocks again. So the
    tables hold one row per (keys, order) or per (keys, value) and place, and no task holds a key's rows.
    """
    keys = key_names(window)
    orders = [f"__at_{i}" for i in range(len(window.orders))]
    items = [ORDER_ITEM.match(text) for text in window.orders]
    helpers = {name: F.expr(key) for name, key in zip(keys, window.keys)}
    helpers |= {name: F.expr(item["expr"]) for name, item in zip(orders, items)}
    helpers |= {f"{name}_of": F.expr(expand_calls(text)) for name, text in values.items()}
    rows = df.select("*", *[col.alias(name) for name, col in helpers.items()])
    directions = [f"{item['way'] or ''}{' NULLS ' + item['nulls'] if item['nulls'] else ''}" for item in items]
    parts = {key: f"__part_{i}" for i, key in enumerate(keys)}
    along = OrderedWindow(tuple(parts.values()), tuple(f"{o} {d}" for o, d in zip(orders, directions)))
    places = rows.groupBy(*keys, *orders).agg(F.lit(1).alias("__one")).withColumnsRenamed(parts)
    numbered = attach_running(places, along, {"__place": RunningValue("row_number", "", True)}, blocks=blocks)
    back = {part: key for key, part in parts.items()}
    numbered = stage(numbered.drop("__one").withColumnsRenamed(back), "places")
    begun = numbered
    for name in values:
        seen = rows.filter(F.col(f"{name}_of").isNotNull()).groupBy(*keys, *orders, F.col(f"{name}_of").alias("__value"))
        seen = matched(seen.agg(F.lit(1).alias("__one")), numbered, [*keys, *orders], "__in")
        first = seen.groupBy(*keys, "__value").agg(F.min("__place").alias("__place"))
        begins = first.groupBy(*keys, "__place").agg(F.count("*").alias(f"{name}_new"))
        begun = matched(begun, begins, [*keys, "__place"], "__in")
    begun = begun.withColumnsRenamed(parts)
    along = OrderedWindow(tuple(parts.values()), ("__place",))
    sums = {name: RunningValue("sum", f"coalesce(`{name}_new`, 0)", True) for name in values}
    table = attach_running(begun, along, sums, blocks=blocks).withColumnsRenamed(back)
    table = stage(table.select(*keys, *orders, *values), "distinct")
    joined = matched(rows, table, [*keys, *orders], "__of")
    if view is not None:
        joined = joined.alias(view)
    return joined.select(*[F.col(f"`{name}`") for name in df.columns], *values)
