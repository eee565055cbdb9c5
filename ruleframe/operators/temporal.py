"""Joins along time: values valid at a time, and rows inside intervals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ruleframe.operators.running import OrderedWindow, RunningValue, attach_running, matched
from ruleframe.session import stage


def join_as_of(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    columns: Sequence[str],
    *,
    direction: str = "backward",
    strict: bool = False,
    within: str | None = None,
    blocks: int = 0,
) -> DataFrame:
    """Every row of ``left`` with ``columns`` of the row of ``right`` that was valid at its time.

    That is, of those with equal ``on``, the last at or before ``left_time`` (``direction="backward"``), or the first
    at or after it (``"forward"``); ``strict`` leaves out equal times, ``within`` (an interval or number, as SQL text)
    those farther away. Of rows of equal time the one with the greatest columns counts backward, with the
    smallest forward. Without such a row, or with a null key or time, the columns are null. Rows and
    columns of ``left`` stay; a column of ``right`` that has a name of ``left`` raises.

    Both sides are put in one order and cut into blocks along (keys, time); a block carries its last match
    over to the next, so that a key may hold any share of the rows.
    """
    if direction not in ("backward", "forward"):
        raise ValueError(f"direction must be 'backward' or 'forward', not {direction!r}")
    twice = {c.lower() for c in left.columns} & {c.lower() for c in columns}
    if twice:
        raise ValueError(f"both sides have a column {', '.join(sorted(twice))}")
    keys = [f"__on_{i}" for i in range(len(on))]
    named = [F.col(name).alias(key) for name, key in zip(on, keys)]
    own = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    match = F.struct(F.col(right_time).alias("__at"), *[F.col(f"`{c}`") for c in columns])
    known = reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in [*on, right_time]])
    right = right.where(known).select(
        *named, F.col(right_time).alias("__time"), F.lit(1 if strict else 0).alias("__side"), F.lit(None).alias("__left"), match.alias("__right")
    )
    left = left.select(
        *named, F.col(left_time).alias("__time"), F.lit(0 if strict else 1).alias("__side"), own.alias("__left"), F.lit(None).alias("__right")
    )
    rows = left.union(right)
    backward = direction == "backward"
    along = OrderedWindow(tuple(keys), ("__time" if backward else "__time DESC", "__side"))
    found = attach_running(rows, along, {"__match": RunningValue("max" if backward else "min", "__right", True)}, blocks=blocks)
    valid = F.col("__time").isNotNull()
    if within is not None:
        near = F.col("__match.__at") >= F.col("__time") - F.expr(within) if backward else F.col("__match.__at") <= F.col("__time") + F.expr(within)
        valid = valid & near
    found = found.where(F.col("__side") == (0 if strict else 1))
    return found.select("__left.*", *[F.when(valid, F.col("__match")[c]).alias(c) for c in columns])


def join_intervals(
    points: DataFrame,
    intervals: DataFrame,
    on: Sequence[str],
    at: str,
    start: str,
    end: str,
    *,
    how: str = "inner",
    totals: Mapping[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """Pairs of a row of ``points`` and a row of ``intervals`` of equal ``on`` with start <= at < end.

    ``at``, ``start`` and ``end`` are numbers, dates or timestamps alike; a null start or end has no bound, a null
    ``at`` or key finds nothing, empty intervals hold nothing. ``how="left"`` keeps points without an interval. The
    result has the columns of both; a name that both have raises, but for ``on``.

    Intervals are dealt to bins at least as wide as they are, the widths being powers of four, so that each lies in
    two bins at most, long ones in coarse bins. A point is looked up in its bin of every width there is, so each pair
    meets once and the join is one of equal keys, whose large bins adaptive execution splits. Widths are merged where
    this spares more rows than it adds and does not double the comparisons (``_merged_levels``).

    The pairs grow with the product of both sides. With ``totals``, ``{name: ("count" or "sum", column of points)}`` of
    whole numbers and decimals, there is a row of each interval that holds points instead, with its columns and these
    values over its points, which are put together from running sums and need no pairs.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    on = list(on)
    twice = {c.lower() for c in points.columns} & {c.lower() for c in intervals.columns if c not in on}
    if twice:
        raise ValueError(f"both sides have a column {', '.join(sorted(twice))}")
    if totals is not None:
        if how != "inner":
            raise ValueError("totals are of intervals that hold points, how='inner'")
        return _interval_totals(points, intervals, on, at, start, end, totals)
    rows = points.withColumn("__at", number_of(points, at))
    if how == "left":
        rows = rows.withColumn("__row", F.monotonically_increasing_id())
    rows = stage(rows, "points")
    first, last, count = rows.agg(F.min("__at"), F.max("__at"), F.count("*")).first()
    spans = intervals.withColumns({"__start": number_of(intervals, start), "__end": number_of(intervals, end)})
    # Unbounded ends reach as far as there are points.
    first, last = F.lit(first).cast("double"), F.lit(last).cast("double")
    bounded = spans.withColumns({
        "__low": F.greatest(F.coalesce("__start", first), first),
        "__high": F.when(F.col("__end") <= last, F.col("__end")).otherwise(last),
    }).where(F.coalesce(F.col(start) < F.col(end), F.lit(True)) & F.expr("__low <= __high"))
    length = F.col("__high") - F.col("__low")
    level = F.when(length > 0, F.ceil(F.log2(length) / 2)).otherwise(F.lit(-1000)).cast("int")
    bounded = stage(bounded.withColumn("__level", F.greatest(level, F.lit(-500))), "intervals")
    sizes = dict(map(tuple, bounded.groupBy("__level").count().collect()))  # a thousand widths at most
    merged = _merged_levels(sizes, count)
    levels = sorted(set(merged.values()))
    if merged:
        level = F.element_at(F.create_map(*[F.lit(x) for pair in merged.items() for x in pair]), F.col("__level"))
        bounded = bounded.withColumns({"__length": F.col("__level"), "__level": level})
    else:
        bounded = bounded.withColumn("__length", F.col("__level"))
    width = F.pow(F.lit(4.0), F.col("__level").cast("double"))
    low, high = F.floor(F.col("__low") / width), F.floor(F.col("__high") / width)
    bins = F.when(F.col("__length") > F.col("__level"), F.sequence(low, high)).otherwise(F.array_distinct(F.array(low, high)))
    dealt = bounded.withColumn("__bin", F.explode(bins)).withColumnsRenamed({name: f"__of_{name}" for name in on})
    own = [F.struct(F.lit(v).alias("__level"), F.floor(F.col("__at") / 4.0**v).alias("__bin")) for v in levels]
    looked = rows.withColumn("__look", F.explode(F.array(*own))) if own else rows.withColumn("__look", F.struct(F.lit(0).alias("__level"), F.lit(0).cast("long").alias("__bin")))
    same = [F.col(name) == F.col(f"__of_{name}") for name in on]
    same += [F.col("__look.__level") == F.col("__level"), F.col("__look.__bin") == F.col("__bin")]
    same += [F.coalesce(F.col(at) >= F.col(start), F.lit(True)), F.coalesce(F.col(at) < F.col(end), F.lit(True))]
    brought = [c for c in intervals.columns if c not in on]
    found = looked.join(dealt, reduce(lambda a, b: a & b, same))
    pairs = found.select(*points.columns, *brought)
    if how == "inner":
        return pairs
    found = stage(found.select("__row", *points.columns, *brought), "pairs")
    alone = rows.join(found.select("__row").distinct(), "__row", "left_anti").select(*points.columns)
    return found.drop("__row").unionByName(alone, allowMissingColumns=True)


def _interval_totals(
    points: DataFrame, intervals: DataFrame, on: list[str], at: str, start: str, end: str, totals: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """The totals of the points before an interval's end less those before its start.

    Points of equal time are one row; these rows and the ends of intervals, each time once, are put in one order and
    cut into blocks along (keys, time), so that a key may hold any share of the rows. No end is later than all points.
    """
    kinds = dict(points.dtypes)
    parts, types = {"__all": F.count(F.lit(1))}, {}
    for i, (name, (call, column)) in enumerate(totals.items()):
        kind = kinds[column]
        parts[f"__known_{i}"] = F.count(F.col(f"`{column}`"))
        if call == "sum":
            small = kind in ("tinyint", "smallint", "int")
            if not small and kind != "bigint" and not kind.startswith("decimal"):
                raise ValueError(f"no total of {kind}: sums of whole numbers and decimals only")
            scale = kind.rstrip(")").split(",")[1] if kind.startswith("decimal") else "0"
            wide = "bigint" if small else f"decimal(38,{scale})"
            types[f"__sum_{i}"], types[name] = wide, points.agg(F.sum(F.col(f"`{column}`"))).dtypes[0][1]
            parts[f"__sum_{i}"] = F.sum(F.col(f"`{column}`").cast(wide))
        elif call != "count":
            raise ValueError(f"totals are 'count' or 'sum', not {call!r}")
    keys = [f"__on_{i}" for i in range(len(on))]
    known = [F.col(name).isNotNull() for name in on]
    whole = [F.col(name).alias(key) for name, key in zip(on, keys)]
    rows = points.where(reduce(lambda a, b: a & b, [*known, F.col(at).isNotNull()])).groupBy(*whole, F.col(at).alias("__time")).agg(*[v.alias(n) for n, v in parts.items()])
    held = intervals.where(reduce(lambda a, b: a & b, [*known, F.coalesce(F.col(start) < F.col(end), F.lit(True))]))
    starts, ends = (held.select(*whole, F.col(name).alias("__time")) for name in (start, end))
    edges = starts.where("__time IS NOT NULL").union(ends).distinct()
    both = rows.withColumn("__side", F.lit(1)).unionByName(edges.withColumn("__side", F.lit(0)), allowMissingColumns=True)
    both = both.withColumn("__last", F.col("__time").isNull())
    along = OrderedWindow(tuple(keys), ("__last", "__time", "__side"))
    before = attach_running(both, along, {f"{n}_before": RunningValue("sum", n, True) for n in parts})
    before = stage(before.where("__side = 0").select(*keys, "__time", *[F.coalesce(f"{n}_before", F.lit(0).cast(types.get(n, "bigint"))).alias(n) for n in parts]), "before")
    own = held.select("*", *whole)
    own = own.withColumns({"__start": F.col(start), "__end": F.col(end)})
    for side in ("start", "end"):
        names = {name: f"__{side}_{name}" for name in parts}
        own = matched(own, before.withColumnsRenamed({"__time": f"__{side}", **names}), [*keys, f"__{side}"], "__of")
    # Before a start that has no bound there is nothing.
    own = own.withColumns({n: F.col(f"__end_{n}") - F.when(F.col(start).isNotNull(), F.col(f"__start_{n}")).otherwise(F.lit(0)) for n in parts})
    values = [
        (F.col(f"__known_{i}") if call == "count" else F.when(F.col(f"__known_{i}") > 0, F.col(f"__sum_{i}").cast(types[name]))).alias(name)
        for i, (name, (call, _)) in enumerate(totals.items())
    ]
    return own.where("__all > 0").select(*intervals.columns, *values)


#: An interval is dealt to 4 ** 6 narrower bins and one more at most, so that its row stays small.
_NARROWER = 6


def _merged_levels(sizes: dict[int, int], points: int) -> dict[int, int]:
    """For each level of lengths the one whose bins its intervals take.

    Every level costs a row per point. Neighbouring ones are merged while the intervals that then lie in more of
    narrower bins are fewer than the points, and while bins that are wider than they need be do not double the comparisons.
    """
    top = max(sizes, default=0)

    def compared(group: list[int], level: int) -> float:
        return sum(sizes[x] * (4.0 ** (level - top) + 4.0 ** (x - top)) for x in group)

    def copies(group: list[int], level: int) -> float:
        return sum(sizes[x] * 4.0 ** (x - level) for x in group if x > level)

    groups = [([x], x) for x in sorted(sizes)]
    most = 2 * sum(compared(*g) for g in groups)
    while len(groups) > 1:
        now = sum(compared(*g) for g in groups)
        found = []
        for i, (one, two) in enumerate(zip(groups, groups[1:])):
            both = one[0] + two[0]
            for level in both:
                if both[-1] - level > _NARROWER:
                    continue
                total = now - compared(*one) - compared(*two) + compared(both, level)
                if total <= most and copies(both, level) - copies(*one) - copies(*two) < points:
                    found.append((total, i, both, level))
        if not found:
            break
        _, i, both, level = min(found)
        groups[i : i + 2] = [(both, level)]
    return {x: level for group, level in groups for x in group}


def number_of(df: DataFrame, name: str) -> Column:
    """A point in time as a number, for bins only: times in microseconds, of no time zone."""
    kind, col = df.select(name).dtypes[0][1], F.col(name)
    day = 86_400_000_000
    if kind == "date":
        return F.unix_date(col).cast("double") * day
    if kind == "timestamp_ntz":
        seconds = F.hour(col) * 3600 + F.minute(col) * 60 + F.extract(F.lit("SECOND"), col)
        return F.unix_date(col.cast("date")).cast("double") * day + seconds.cast("double") * 1_000_000
    if kind == "timestamp":
        return F.unix_micros(col).cast("double")
    return col.cast("double")
