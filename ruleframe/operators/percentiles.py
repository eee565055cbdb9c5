"""Exact percentiles of groups, without gathering a group in one task.

``percentile(x, p)`` keeps all values of a group in one place. Here every value of a group is counted, the
counts are cut into blocks along (keys, value), and the blocks' sums tell which of them hold the asked
ranks: only those are sorted.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ruleframe.functions.calls import closing_bracket, skip_quoted, split_arguments
from ruleframe.operators.running import OrderedWindow, cut_into_blocks, matched

PERCENTILES = frozenset(("median", "percentile"))
SHARE = re.compile(r"(?:0?\.\d+|0|1|[01]\.0*)D?", re.I)
ORDERED_SET = re.compile(r"\bpercentile_cont\s*(?=\()", re.I)
WITHIN = re.compile(r"\s*WITHIN\s+GROUP\s*(?=\()", re.I)
ORDER_BY = re.compile(r"^\s*ORDER\s+BY\b(?P<value>.*?)(?P<way>\s+(?:ASC|DESC))?\s*$", re.I | re.S)


def value_and_share(call: str, args: str) -> tuple[str, float] | None:
    """What a median or percentile is taken of, and at which share; None for lists of shares and frequencies."""
    given = split_arguments(args)
    if call == "median" and len(given) == 1:
        return given[0], 0.5
    if call == "percentile" and len(given) == 2 and SHARE.fullmatch(given[1]):
        return given[0], float(given[1].rstrip("dD"))
    return None


def plain_percentiles(text: str) -> str:
    """``percentile_cont(p) WITHIN GROUP (ORDER BY x)`` written as ``percentile(x, p)``."""
    out, at = [], 0
    while at < len(text):
        end = skip_quoted(text, at)
        start = ORDERED_SET.match(text, at) if end == at and (at == 0 or not re.match(r"[\w`.]", text[at - 1])) else None
        first = closing_bracket(text, start.end()) if start else None
        group = WITHIN.match(text, first + 1) if first is not None else None
        last = closing_bracket(text, group.end()) if group else None
        order = ORDER_BY.match(text[group.end() + 1 : last]) if last is not None else None
        if order and "DESC" not in (order["way"] or "").upper() and len(split_arguments(order["value"])) == 1:
            out.append(f"percentile({order['value'].strip()}, {text[start.end() + 1 : first].strip()})")
            at = last + 1
        else:
            end = max(end, at + 1)
            out.append(text[at:end])
            at = end
    return "".join(out)


def percentile_table(
    rows: DataFrame, keys: Sequence[str], values: Mapping[str, tuple[str, float]], blocks: int = 0
) -> DataFrame:
    """One row per distinct ``keys`` (columns of ``rows``) that has values: the keys, and the percentile at a share of
    each expression ``{name: (expression, share)}``, as a double.

    Between two values it lies in proportion, as Spark's percentile does. Nulls are left out; a group of nulls only
    has no row if all its expressions are null. All shares of one expression share the passes over it.
    """
    keys = list(keys)
    tables = []
    for text in dict.fromkeys(text for text, _ in values.values()):
        shares = {name: share for name, (of, share) in values.items() if of == text}
        tables.append((_of_one(rows, keys, F.expr(text), shares, blocks), list(shares)))
    whole, _ = tables[0]
    for table, names in tables[1:]:
        if not keys:
            whole = whole.select("*", *[table.select(name).scalar().alias(name) for name in names])
            continue
        other = table.withColumnsRenamed({key: f"__of{key}" for key in keys})
        same = reduce(lambda a, b: a & b, [F.col(key).eqNullSafe(F.col(f"__of{key}")) for key in keys])
        both = [F.coalesce(key, f"__of{key}").alias(key) for key in keys]
        whole = whole.join(other, same, "full").select(*both, *[c for c in whole.columns if c not in keys], *names)
    return whole


def _of_one(rows: DataFrame, keys: list[str], value: Column, shares: Mapping[str, float], blocks: int) -> DataFrame:
    parts = {key: f"__part_{i}" for i, key in enumerate(keys)}
    named = rows.select(*[F.col(key).alias(part) for key, part in parts.items()], value.alias("__value"))
    own = list(parts.values())
    counts = named.filter("__value IS NOT NULL").groupBy(*own, "__value").agg(F.count("*").alias("__n"))
    cut = cut_into_blocks(counts, OrderedWindow(tuple(own), ("__value",)), blocks)
    sums = cut.groupBy("__block", *own).agg(F.sum("__n").alias("__own"))
    earlier = Window.partitionBy(*own).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumns({
        "__before": F.coalesce(F.sum("__own").over(earlier), F.lit(0)),
        "__all": F.sum("__own").over(Window.partitionBy(*own)),
    })
    at = {name: (F.col("__all") - 1) * F.lit(share) for name, share in shares.items()}
    ranks = F.array_distinct(F.array(*[end(place).cast("long") for place in at.values() for end in (F.floor, F.ceil)]))
    inside = F.filter(ranks, lambda r: (r >= F.col("__before")) & (r < F.col("__before") + F.col("__own")))
    wanted = sums.select("__block", *own, "__before", "__all", inside.alias("__ranks")).filter("size(__ranks) > 0")
    held = matched(cut.select("__block", *own, "__value", "__n"), wanted, ["__block", *own], "__in", "inner")
    upto = F.sum("__n").over(Window.partitionBy("__block", *own).orderBy("__value")) + F.col("__before")
    held = held.withColumn("__upto", upto)
    hit = F.filter("__ranks", lambda r: (r >= F.col("__upto") - F.col("__n")) & (r < F.col("__upto")))
    found = held.select(*own, "__all", "__value", F.explode(hit).alias("__rank"))
    columns = []
    for name, place in at.items():
        low, high = (F.max(F.when(F.col("__rank") == end(place), F.col("__value"))) for end in (F.floor, F.ceil))
        place = F.max(place)
        low_value, high_value = low.cast("double"), high.cast("double")
        between = (F.ceil(place) - place) * low_value + (place - F.floor(place)) * high_value
        columns.append(F.when(low == high, low_value).otherwise(between).alias(name))
    table = found.groupBy(*own).agg(*columns)
    return table.withColumnsRenamed({part: key for key, part in parts.items()})
