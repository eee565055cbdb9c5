"""Values of sliding frames, with large groups spread over tasks.

``sum(x) OVER (PARTITION BY k ORDER BY t ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)`` sorts all rows of a
key in one task. Here the rows are cut into blocks along (keys, order), and each block gets copies of
the rows just outside it that its own frames reach into. A frame of rows reaches as many rows as it says;
a frame of a range is laid over a table with one row per order value, so that equal rows do not add to it.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ruleframe.functions.aggregates import weighted_ratio
from ruleframe.functions.calls import expand_calls, replace_calls, split_arguments
from ruleframe.operators.groups import GroupValue
from ruleframe.operators.running import (
    ORDER_ITEM,
    OTHER_WORDS,
    OrderedWindow,
    RunningValue,
    attach_running,
    cut_into_blocks,
    key_names,
    matched,
)
from ruleframe.operators.temporal import number_of
from ruleframe.session import stage

WINDOW = re.compile(
    r"^\s*(?:PARTITION\s+BY\b(?P<keys>.*?))?\bORDER\s+BY\b(?P<orders>.*?)\b(?P<unit>ROWS|RANGE)\b(?P<frame>.*)$",
    re.I | re.S,
)
BETWEEN = re.compile(r"^\s*BETWEEN\b(?P<first>.*)\bAND\b(?P<last>.*)$", re.I | re.S)
BOUND = re.compile(r"^\s*(?:(?P<here>CURRENT\s+ROW)|(?P<far>.+?)\s+(?P<way>PRECEDING|FOLLOWING))\s*$", re.I | re.S)
# How far a range may reach: a number, or an interval of literals
DISTANCE = re.compile(r"^(?:[0-9.]+(?:E[0-9]+)?[A-Z]*|INTERVAL\s+['\"]?[-0-9.: ]+['\"]?\s+\w+(?:\s+TO\s+\w+)?|INTERVAL\s+'[^']*')$", re.I)
# How frames over chunks add up the parts of a value, and how many order values of a frame Spark may add up anew
CHUNKED = {"sum": "sum", "count": "sum", "count_if": "sum", "min": "min", "max": "max", "weightedaverage": "sum"}
FEW = 256
# Ranking functions know no frame, and a distinct count keeps no partial count
UNFIT = frozenset("row_number rank dense_rank percent_rank cume_dist ntile lag lead grouping grouping_id".split())


@dataclass(frozen=True)
class Frame:
    """A frame between two bounds: how many rows, or how far, before (negative) and after the current row.

    ``first`` and ``last`` are (sign, distance); the distance is text, "0" for the current row.
    """

    unit: str
    first: tuple[int, str]
    last: tuple[int, str]

    def text(self) -> str:
        def bound(sign: int, distance: str) -> str:
            return "CURRENT ROW" if not sign else f"{distance} {'PRECEDING' if sign < 0 else 'FOLLOWING'}"

        return f"{self.unit} BETWEEN {bound(*self.first)} AND {bound(*self.last)}"

    def reach(self, at: Column, way: int, descending: bool = False) -> Column:
        """The value that lies ``way`` (-1: the first bound, 1: the last) of the frame away from ``at``."""
        sign, distance = self.first if way < 0 else self.last
        if not sign:
            return at
        step = F.expr(distance)
        return at + step if (sign > 0) != descending else at - step


@dataclass(frozen=True)
class SlidingValue:
    call: str
    args: str


class SlidingValues:
    """Collects the windows with sliding frames of several rule texts and names them."""

    def __init__(self) -> None:
        self._names: dict[tuple[OrderedWindow, Frame, SlidingValue], str] = {}

    def extract(self, text: str) -> str:
        """``text`` with every value of a sliding frame replaced by its name."""

        def one(name: str, args: str, over: str | None) -> str | None:
            found = None if over is None or name in UNFIT else sliding_window(over)
            if found is None:
                return None
            window, frame = found
            value = SlidingValue(name, args.strip())
            if frame.unit == "RANGE" and range_parts(value) is None:
                return None
            return self._names.setdefault((window, frame, value), f"__sliding_value_{len(self._names)}")

        return replace_calls(text, one)

    @property
    def names(self) -> list[str]:
        return list(self._names.values())

    def by_frame(self) -> dict[tuple[OrderedWindow, Frame], dict[str, SlidingValue]]:
        grouped: dict[tuple[OrderedWindow, Frame], dict[str, SlidingValue]] = {}
        for (window, frame, value), name in self._names.items():
            grouped.setdefault((window, frame), {})[name] = value
        return grouped


def sliding_window(over: str) -> tuple[OrderedWindow, Frame] | None:
    """The window of an OVER text with a frame of two near bounds; None if it is of another form."""
    match = WINDOW.match(over)
    if match is None:
        return None
    keys, orders, unit = match["keys"] or "", match["orders"], match["unit"].upper()
    if OTHER_WORDS.search(keys) or OTHER_WORDS.search(orders):
        return None
    window = OrderedWindow(tuple(split_arguments(keys)), tuple(split_arguments(orders)))
    between = BETWEEN.match(match["frame"])
    first, last = (between["first"], between["last"]) if between else (match["frame"], "CURRENT ROW")
    bounds = [_bound(text, unit) for text in (first, last)]
    if None in bounds or unit == "RANGE" and len(window.orders) != 1:
        return None
    return window, Frame(unit, *bounds)


def by_sliding_sums(text: str, df: DataFrame) -> str:
    """``text`` with averages over ranges written by sums and counts; those of decimals are left alone, since
    their rounding would change."""

    def one(name: str, args: str, over: str | None) -> str | None:
        found = sliding_window(over) if over is not None and name in ("avg", "mean") else None
        if found is None or found[1].unit != "RANGE" or re.match(r"\s*DISTINCT\b", args, re.I):
            return None
        if df.select(F.expr(expand_calls(args))).dtypes[0][1].startswith(("decimal", "interval")):
            return None
        return f"(sum(CAST({args} AS DOUBLE)) OVER ({over}) / nullif(count({args}) OVER ({over}), 0))"

    return replace_calls(text, one)


def _bound(text: str, unit: str) -> tuple[int, str] | None:
    match = BOUND.match(text)
    if match is None:
        return None
    if match["here"]:
        return 0, "0"
    distance = match["far"].strip()
    if not (re.fullmatch(r"\d+", distance) if unit == "ROWS" else DISTANCE.match(distance)):
        return None
    return (-1 if match["way"].upper() == "PRECEDING" else 1), distance


def range_parts(value: SlidingValue) -> GroupValue | None:
    """The value as an aggregate that order values can be summed up for first; None if it cannot."""
    group = GroupValue((), value.call, value.args)
    try:
        return group if group.parts() is not None else None
    except ValueError:
        return None


def attach_sliding(
    df: DataFrame,
    window: OrderedWindow,
    frame: Frame,
    values: Mapping[str, SlidingValue],
    view: str | None = None,
    blocks: int = 0,
) -> DataFrame:
    """``df`` with the values of a sliding frame, computed in blocks.

    ROWS: any window function. Rows of equal order follow each other by a hash of the row.
    RANGE: aggregates of which parts can be combined, over one row per (keys, order value); rows of a null
    order see each other, as in Spark. Types are those of Spark's own windows. ``view`` is a name under
    which the values may refer to the rows, ``blocks`` the least number of blocks.
    """
    attach = _attach_rows if frame.unit == "ROWS" else _attach_range
    return attach(df, window, frame, values, view, blocks)


def _attach_rows(df, window, frame, values, view, blocks) -> DataFrame:
    place = {"__at": RunningValue("row_number", "", True)}
    placed = attach_running(df, window, place, view, blocks, keep=True)
    placed = stage(placed.withColumn("__at", F.col("__at").cast("long")), "places")
    keys = key_names(window)
    rows = _with_halo(placed, keys, frame, blocks)
    over = f"(PARTITION BY {', '.join(['__block', *keys])} ORDER BY __at {frame.text()})"
    if view is not None:
        rows = rows.alias(view)
    found = {n: F.expr(expand_calls(f"{v.call}({v.args}) OVER {over}")) for n, v in values.items()}
    columns = [F.col(f"`{name}`") for name in df.columns]
    return rows.select("*", *[v.alias(n) for n, v in found.items()]).filter("NOT __halo").select(*columns, *values)


def _attach_range(df, window, frame, values, view, blocks) -> DataFrame:
    parts = {name: range_parts(value) for name, value in values.items()}
    keys = key_names(window)
    item = ORDER_ITEM.match(window.orders[0])
    helpers = {name: F.expr(key) for name, key in zip(keys, window.keys)}
    helpers["__at"] = F.expr(item["expr"])
    named = df.select("*", *[c.alias(n) for n, c in helpers.items()])
    if view is not None:
        named = named.alias(view)
    pieces = {f"{name}_{i}": part for name, group in parts.items() for i, part in enumerate(group.parts())}
    types = named.agg(F.count("*"), *[group.column().alias(name) for name, group in parts.items()]).schema
    sums = named.groupBy(*keys, "__at").agg(*[part.alias(name) for name, part in pieces.items()])
    direction = f"{item['way'] or ''} {'NULLS ' + item['nulls'] if item['nulls'] else ''}"
    parts_of = {key: f"__part_{i}" for i, key in enumerate(keys)}
    cut = cut_into_blocks(sums.withColumnsRenamed(parts_of), OrderedWindow(tuple(parts_of.values()), (f"__at {direction}",)), blocks)
    descending = (item["way"] or "").strip().upper() == "DESC"
    table = _by_chunks(cut, parts_of, frame, parts, types, blocks, descending)
    if table is None:
        rows = _with_halo(cut, keys, frame, blocks, descending)
        over = f"(PARTITION BY {', '.join(['__block', *keys])} ORDER BY __at {direction} {frame.text()})"
        found = {}
        for name, group in parts.items():
            own = [f"{name}_{i}" for i in range(len(group.parts()))]
            found[name] = _combined(group, own, over).cast(types[name].dataType)
        table = rows.select("*", *[c.alias(n) for n, c in found.items()]).filter("NOT __halo").select(*keys, "__at", *values)
    joined = matched(named, stage(table, "frames"), [*keys, "__at"], "__of")
    return joined.select(*[F.col(f"`{name}`") for name in df.columns], *values)


def _by_chunks(cut, parts_of, frame, parts, types, blocks, descending) -> DataFrame | None:
    """The values of the frames of all order values, for frames that span many of them; None if they do not.

    Spark adds up each frame anew, which costs the rows times the frame. Here the order is cut into chunks
    somewhat narrower than a frame, so that each frame is the end of one chunk, the whole of the next if it reaches
    over it, and the beginning of the last: running values of the chunks from either side, at places that are
    put among their rows. Rows of a null or infinite order have only themselves in their frames.
    """
    calls = {name: CHUNKED.get(group.call) for name, group in parts.items()}
    kind = cut.schema["__at"].dataType
    cut = cut.withColumns(dict(zip(("__lo", "__hi"), [frame.reach(F.col("__at"), way, descending) for way in ((1, -1) if descending else (-1, 1))])))
    if None in calls.values() or any(cut.schema[name].dataType != kind for name in ("__lo", "__hi")):
        return None
    place = {name: number_of(cut, name) for name in ("__at", "__lo", "__hi")}
    near = place["__at"].isNotNull() & ~F.isnan(place["__at"]) & (F.abs(place["__at"]) < float("inf"))
    rows = cut.where(near)
    length = place["__hi"] - place["__lo"]
    least, most, low, high = rows.agg(F.min(length), F.max(length), F.min(place["__at"]), F.max(place["__at"])).first()
    if least is None or least <= 0 or most > 1.5 * least or high - low > 1e12 * least:
        return None
    chunk = {name: F.floor((col - low) / (0.99 * least)) for name, col in place.items()}
    rows = rows.select("*", *[col.alias(f"{name}_chunk") for name, col in chunk.items()])
    keys = list(parts_of.values())
    largest = rows.groupBy(*keys, "__at_chunk").count().agg(F.max("count")).first()[0]
    spans = rows.agg(F.min(F.col("__hi_chunk") - F.col("__lo_chunk")), F.max(F.col("__hi_chunk") - F.col("__lo_chunk"))).first()
    if largest <= FEW or spans[0] < 1 or spans[1] > 2:
        return None
    pieces = {f"{name}_{i}": calls[name] for name, group in parts.items() for i in range(len(group.parts()))}
    none = [F.lit(None).cast(cut.schema[piece].dataType).alias(piece) for piece in pieces]
    data = rows.select(*keys, F.col("__at_chunk").alias("__chunk"), "__at", F.lit(0).alias("__side"), F.lit(None).cast(kind).alias("__of"), *pieces)

    def running(edge: str, order: str) -> DataFrame:
        probes = rows.select(*keys, f"{edge}_chunk", edge, F.lit(1), "__at", *none)
        window = OrderedWindow((*keys, "__chunk"), (order, "__side"))
        values = {f"{piece}_run": RunningValue(call, piece, True) for piece, call in pieces.items()}
        found = attach_running(data.union(probes), window, values, blocks=blocks).where("__side = 1")
        return found.select(*keys, "__of", *[F.col(f"{piece}_run").alias(piece) for piece in pieces])

    totals = data.groupBy(*keys, "__chunk").agg(*[getattr(F, call)(piece).alias(piece) for piece, call in pieces.items()])
    over = rows.where(F.col("__hi_chunk") - F.col("__lo_chunk") == 2)
    over = over.select(*keys, F.col("__at").alias("__of"), (F.col("__lo_chunk") + 1).alias("__chunk"))
    middle = matched(over, totals, [*keys, "__chunk"], "__in").select(*keys, "__of", *pieces)
    alone = cut.where(~F.coalesce(near, F.lit(False))).select(*keys, F.col("__at").alias("__of"), *pieces)
    found = running("__lo", "__at DESC").union(running("__hi", "__at")).union(middle).union(alone)
    values = [
        group.combine([F.col(f"{name}_{i}") for i in range(len(group.parts()))]).cast(types[name].dataType).alias(name) for name, group in parts.items()
    ]
    names = {new: key for key, new in parts_of.items()}
    return found.groupBy(*keys, "__of").agg(*values).withColumnsRenamed(names | {"__of": "__at"})


def _combined(group: GroupValue, pieces: list[str], over: str) -> Column:
    """The value of a frame from the parts of its order values."""
    if group.call == "weightedaverage":
        return weighted_ratio(*[F.expr(f"sum(`{piece}`) OVER {over}") for piece in pieces])
    call = {"count": "sum", "count_if": "sum"}.get(group.call, group.call)
    value = F.expr(f"{call}(`{pieces[0]}`) OVER {over}")
    return F.coalesce(value, F.lit(0)) if group.call.startswith("count") else value


def _with_halo(
    cut: DataFrame, keys: list[str], frame: Frame, blocks: int, descending: bool = False
) -> DataFrame:
    """Rows of all blocks, and for each block copies (``__halo``) of the rows of others in reach of its frames.

    Blocks know the span of ``__at`` of each key; only keys that lie in several blocks matter, of which a
    block has two at most, its first and its last.
    """
    low, high = F.col("to.__low"), F.col("to.__high")
    ends = (high, low) if descending else (low, high)
    near = [frame.reach(ends[0], -1, descending), frame.reach(ends[1], 1, descending)]
    if descending:
        near.reverse()
    spans = cut.groupBy("__block", *keys).agg(F.min("__at").alias("__low"), F.max("__at").alias("__high"))
    # One entry per block of a key: as long as the list of blocks at most
    by_key = spans.groupBy(*keys).agg(F.collect_list(F.struct("__block", "__low", "__high")).alias("spans"))
    wanted = by_key.filter("size(spans) > 1").select(*keys, "spans", F.explode("spans").alias("to")).select(
        *keys, "spans", F.col("to.__block").alias("__to"), F.least(low, near[0]).alias("__from"), F.greatest(high, near[1]).alias("__upto")
    )
    close = F.filter("spans", lambda s: (s["__block"] != F.col("__to")) & (s["__high"] >= F.col("__from")) & (s["__low"] <= F.col("__upto")))
    named = [F.col(k).alias(f"__of{k}") for k in keys]
    pairs = wanted.select(*named, "__to", "__from", "__upto", F.explode(close["__block"]).alias("__of"))
    pairs = stage(pairs, "pairs")
    same = [F.col("__block") == F.col("__of"), *[F.col(k).eqNullSafe(F.col(f"__of{k}")) for k in keys]]
    same += [F.col("__at").between(F.col("__from"), F.col("__upto"))]
    copies = cut.join(pairs, reduce(lambda a, b: a & b, same)).withColumn("__block", F.col("__to"))
    copies = copies.select(*[F.col(f"`{name}`") for name in cut.columns], F.lit(True).alias("__halo"))
    return cut.withColumn("__halo", F.lit(False)).union(copies)
