"""Running values of ordered windows, with large groups spread over tasks.

``sum(x) OVER (PARTITION BY k ORDER BY t)`` sorts all rows of a key in one task. Here the rows are
cut into blocks along (keys, order) instead, so that a large key fills many blocks. Each block
computes its own running values, and adds what the earlier blocks of its first key amount to. Rows of
equal key and order may lie in several blocks: at most one such run crosses the border of two blocks, so
what its parts amount to is a table of two rows per block at most.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ruleframe.functions.calls import expand_calls, replace_calls, split_arguments
from ruleframe.session import stage

RANKING = ("row_number", "rank", "dense_rank")
NEIGHBOURS = ("lag", "lead")
RUNNING = frozenset([*RANKING, *NEIGHBOURS, "count", "count_if", "sum", "min", "max"])

ORDERED_WINDOW = re.compile(
    r"^\s*(?:PARTITION\s+BY\b(?P<keys>.*?))?\bORDER\s+BY\b(?P<orders>.*?)"
    r"(?:\b(?P<unit>ROWS|RANGE)\s+(?:BETWEEN\s+UNBOUNDED\s+PRECEDING\s+AND\s+CURRENT\s+ROW"
    r"|UNBOUNDED\s+PRECEDING)\s*)?$",
    re.I | re.S,
)
OTHER_WORDS = re.compile(r"['\"]|\b(?:ROWS|RANGE|ORDER|PARTITION|SORT|CLUSTER|DISTRIBUTE)\b", re.I)
ORDER_ITEM = re.compile(
    r"^(?P<expr>.*?)(?P<way>\s+(?:ASC|DESC))?(?:\s+NULLS\s+(?P<nulls>FIRST|LAST))?$", re.I | re.S
)


@dataclass(frozen=True)
class OrderedWindow:
    """PARTITION BY keys ORDER BY orders."""

    keys: tuple[str, ...]
    orders: tuple[str, ...]


@dataclass(frozen=True)
class RunningValue:
    """A value of the rows up to the current one (``rows``) or to the last of equal order."""

    call: str
    args: str
    rows: bool = False

    def local(self) -> Column:
        return F.expr(f"{self.call}({expand_calls(self.args)})")

    def total(self) -> Column:
        """What a block adds to the values of the blocks after it; dense ranks are not counted here."""
        return F.count("*") if self.call in RANKING else self.local()

    def before(self, totals: Column) -> Column:
        return {"min": F.min, "max": F.max}.get(self.call, F.sum)(totals)

    def combine(self, before: Column, local: Column) -> Column:
        if self.call == "min":
            return F.least(before, local)
        if self.call == "max":
            return F.greatest(before, local)
        return F.coalesce(before + local, before, local)


class RunningValues:
    """Collects the ordered windows of several rule texts and names them."""

    def __init__(self) -> None:
        self._names: dict[tuple[OrderedWindow, RunningValue], str] = {}

    def extract(self, text: str) -> str:
        """``text`` with every running value replaced by its name."""

        def one(name: str, args: str, over: str | None) -> str | None:
            window = None if over is None or name not in RUNNING else ordered_window(over)
            if window is None or re.match(r"\s*DISTINCT\b", args, re.I):
                return None
            if name in NEIGHBOURS and neighbour_arguments(args) is None:
                return None
            window, by_rows = window
            by_rows = name not in ("rank", "dense_rank") and (by_rows or name in ("row_number", *NEIGHBOURS))
            value = (window, RunningValue(name, args.strip(), by_rows))
            return self._names.setdefault(value, f"__running_value_{len(self._names)}")

        return replace_calls(text, one)

    @property
    def names(self) -> list[str]:
        return list(self._names.values())

    def by_window(self) -> dict[OrderedWindow, dict[str, RunningValue]]:
        grouped: dict[OrderedWindow, dict[str, RunningValue]] = {}
        for (window, value), name in self._names.items():
            grouped.setdefault(window, {})[name] = value
        return grouped


def ordered_window(over: str) -> tuple[OrderedWindow, bool] | None:
    """The window of an OVER text, and whether its frame is of rows; None if it is of another form."""
    match = ORDERED_WINDOW.match(over)
    if match is None:
        return None
    keys, orders = match["keys"] or "", match["orders"]
    if OTHER_WORDS.search(keys) or OTHER_WORDS.search(orders):
        return None
    window = OrderedWindow(tuple(split_arguments(keys)), tuple(split_arguments(orders)))
    return window, (match["unit"] or "").upper() == "ROWS"


def by_running_values(text: str, df: DataFrame) -> str:
    """``text`` with averages and relative ranks of ordered windows written by counts, sums and ranks.

    Averages of decimals are left alone, since their rounding would change.
    """

    def one(name: str, args: str, over: str | None) -> str | None:
        found = None if over is None else ordered_window(over)
        if found is None:
            return None
        keys = f"PARTITION BY {', '.join(found[0].keys)}" if found[0].keys else ""
        group = f"CAST(count(*) OVER ({keys}) AS DOUBLE)"
        ordered = f"({keys} ORDER BY {', '.join(found[0].orders)})"
        if name == "percent_rank":
            return f"coalesce((rank() OVER {ordered} - 1) / nullif({group} - 1, 0D), 0D)"
        if name == "cume_dist":
            return f"(count(*) OVER {ordered} / {group})"
        if name == "ntile" and re.fullmatch(r"\s*[1-9]\d*\s*", args):
            place, rows = f"(row_number() OVER {ordered} - 1)", f"count(*) OVER ({keys})"
            size, longer = f"({rows} div {args})", f"({rows} % {args})"
            return (
                f"CAST(CASE WHEN {place} < {longer} * ({size} + 1) THEN {place} div ({size} + 1) "
                f"ELSE ({place} - {longer}) div nullif({size}, 0) END + 1 AS INT)"
            )
        if name in ("avg", "mean") and not re.match(r"\s*DISTINCT\b", args, re.I):
            if df.select(F.expr(expand_calls(args))).dtypes[0][1].startswith(("decimal", "interval")):
                return None
            total = f"sum(CAST({args} AS DOUBLE)) OVER ({over})"
            return f"({total} / nullif(count({args}) OVER ({over}), 0))"
        return None

    return replace_calls(text, one)


def neighbour_arguments(args: str) -> tuple[str, int, str] | None:
    """Value, distance and default of a lag or lead; None if the distance is no plain number."""
    given = split_arguments(args)
    value, distance, default = given + [None, "1", "NULL"][len(given) :]
    return (value, int(distance), default) if re.fullmatch(r"-?\d+", distance) else None


def cut_into_blocks(df: DataFrame, window: OrderedWindow, blocks: int = 0, placed: bool = False) -> DataFrame:
    """``df`` cut along (keys, order), written to the shared folder.

    Adds ``__block``, numbered along the order, and the columns ``__key_0``, ``__order_0``, ...
    Rows of equal key and order follow each other by a hash of the row, and equal rows by their place in
    the sorted rows of their task; both are found again by a repeated task. So any run of rows may be cut
    apart. Writing fixes the blocks for all later steps.
    ``placed`` adds ``__in_block``, which grows along the order inside a block. The number of blocks is ``blocks``, or what adaptive execution makes of the session's shuffle
    partitions if those are more.
    """
    keys, sorting = key_names(window), _sorting(window)
    helpers = {name: F.expr(key) for name, key in zip(keys, window.keys)}
    for i, item in enumerate(window.orders):
        helpers[f"__order_{i}"] = F.expr(ORDER_ITEM.match(item)["expr"])
    hashed = [F.col(f"`{name}`") for name, kind in df.dtypes if "map<" not in kind]
    helpers["__order_row"] = F.xxhash64(*hashed)
    rows = df.select("*", *[col.alias(name) for name, col in helpers.items()])
    rows = rows.sortWithinPartitions("__order_row").withColumn("__order_tie", F.monotonically_increasing_id())
    if blocks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        ranged = rows.repartitionByRange(blocks, *keys, *sorting)
    else:
        ranged = rows.repartitionByRange(*keys, *sorting)
    ranged = ranged.withColumn("__block", F.spark_partition_id())
    if placed:
        ranged = ranged.sortWithinPartitions(*keys, *sorting).withColumn("__in_block", F.monotonically_increasing_id())
    return stage(ranged, "blocks")


def attach_running(
    df: DataFrame,
    window: OrderedWindow,
    values: Mapping[str, RunningValue],
    view: str | None = None,
    blocks: int = 0,
    keep: bool = False,
) -> DataFrame:
    """``df`` with running values over one ordered window, lag and lead included.

    Sums of floating-point numbers are added block by block, in another order than row by row.
    ``view`` is a name under which the values may refer to the rows, ``blocks`` the least number
    of blocks. With ``keep`` the columns of the cut stay (not with lag or lead).
    """
    near = {name: value for name, value in values.items() if value.call in NEIGHBOURS}
    if near:
        others = {name: value for name, value in values.items() if name not in near}
        return _attach_neighbours(df, window, near, others, view, blocks)
    by_rows = all(value.rows for value in values.values())
    rows = cut_into_blocks(df, window, blocks, placed=not by_rows)
    if view is not None:
        rows = rows.alias(view)
    keys = key_names(window)
    orders = [f"__order_{i}" for i in range(len(window.orders))]
    by_order = Window.partitionBy("__block", *keys).orderBy(*_sorting(window)[: len(orders)])
    by_row = Window.partitionBy("__block", *keys).orderBy(*_sorting(window))
    running = {}
    for name, value in values.items():
        frame = by_order
        if value.rows:
            frame = by_row if value.call in RANKING else by_row.rowsBetween(Window.unboundedPreceding, 0)
        running[name] = value.local().over(frame)
    local = rows.select("*", *[value.alias(name) for name, value in running.items()])

    dense = {name for name, value in values.items() if value.call == "dense_rank"}
    totals = rows.groupBy("__block", *keys).agg(
        *[v.total().alias(n) for n, v in values.items()]
    )
    if dense:
        # Every run counts once, in the block where it begins.
        begun = rows.groupBy(*keys, *orders).agg(F.min("__block").alias("__block"))
        begun = begun.groupBy("__block", *keys).agg(F.count("*").alias("__begun"))
        totals = matched(totals, begun, ["__block", *keys], "__of")
        totals = totals.withColumns({name: F.coalesce("__begun", F.lit(0)) for name in dense})
    earlier = Window.partitionBy(*keys).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "__block", *keys,
        *[v.before(F.col(n)).over(earlier).alias(f"{n}_before") for n, v in values.items()],
        F.count("*").over(earlier).alias("__earlier"),
    ).filter("__earlier > 0").drop("__earlier")
    # Only the first key of a block can have begun in an earlier one: one row per block at most,
    # whatever the size of the data, which is safe to broadcast.
    joined = matched(local, F.broadcast(offsets), ["__block", *keys], "__of")
    if not by_rows:
        parts = _cut_runs(rows, keys, orders, values)
        parts = stage(parts, "runs") if dense else parts  # read twice below
        joined = matched(joined, F.broadcast(parts.drop("__goes_on")), ["__block", *keys, *orders], "__cut")
        if dense:
            # A run that began in an earlier block has been counted there.
            goes_on = parts.filter("__goes_on").select("__block", *keys, "__goes_on")
            joined = matched(joined, F.broadcast(goes_on), ["__block", *keys], "__on")
            twice = F.when(F.col("__goes_on"), F.lit(-1))
            joined = joined.withColumns({f"{name}_rest": twice for name in dense})
    types, results = local.schema, []
    for name, value in values.items():
        # The type is that of Spark's own window, so that expressions around it give the same.
        result = value.combine(F.col(f"{name}_before"), F.col(name))
        if not value.rows:
            result = value.combine(F.col(f"{name}_rest"), result)
        results.append(result.cast(types[name].dataType).alias(name))
    kept = [F.col(f"`{name}`") for name in (rows if keep else df).columns if name != "__in_block"]
    return joined.select(*kept, *results)


def _cut_runs(
    rows: DataFrame,
    keys: Sequence[str],
    orders: Sequence[str],
    values: Mapping[str, RunningValue],
) -> DataFrame:
    """What the other parts of a run of equal (key, order) add to its part in a block.

    A value up to the last equal row takes the parts in later blocks as well, a rank does not
    count those in earlier blocks. Each border of two blocks cuts one run at most, the last of the one and the
    first of the other, so that two rows per block tell which runs are cut.
    """
    run = F.struct(*keys, *orders)
    edges = rows.groupBy("__block").agg(F.min_by(run, "__in_block").alias("first"), F.max_by(run, "__in_block").alias("last"))
    edges = edges.select("__block", F.explode(F.array("first", "last")).alias("run")).select("__block", "run.*")
    spread = edges.groupBy(*keys, *orders).agg(F.min("__block").alias("__first"), F.max("__block").alias("__last"))
    cut = spread.filter("__first < __last").select(*keys, *orders)
    parts = matched(rows, F.broadcast(cut.withColumn("__is_cut", F.lit(True))), [*keys, *orders], "__run")
    sums = [v.total().alias(n) for n, v in values.items() if not v.rows]
    parts = parts.filter("__is_cut").groupBy("__block", *keys, *orders).agg(*sums)
    of_run = Window.partitionBy(*keys, *orders).orderBy("__block")
    earlier = of_run.rowsBetween(Window.unboundedPreceding, -1)
    later = of_run.rowsBetween(1, Window.unboundedFollowing)
    rest = {"__goes_on": F.count("*").over(earlier) > 0}
    for name, value in values.items():
        if value.call == "rank":
            rest[f"{name}_rest"] = -F.sum(name).over(earlier)
        elif not value.rows and value.call != "dense_rank":
            rest[f"{name}_rest"] = value.before(F.col(name)).over(later)
    return parts.select("__block", *keys, *orders, *[col.alias(name) for name, col in rest.items()])


def matched(left: DataFrame, right: DataFrame, names: Sequence[str], prefix: str, how: str = "left") -> DataFrame:
    """``left`` with the other columns of ``right``, found by equal ``names``, nulls included."""
    other = right.withColumnsRenamed({name: f"{prefix}{name}" for name in names})
    same = [F.col(name).eqNullSafe(F.col(f"{prefix}{name}")) for name in names]
    joined = left.join(other, reduce(lambda a, b: a & b, same), how)
    return joined.drop(*[f"{prefix}{name}" for name in names])


def _attach_neighbours(
    df: DataFrame,
    window: OrderedWindow,
    values: Mapping[str, RunningValue],
    others: Mapping[str, RunningValue],
    view: str | None,
    blocks: int,
) -> DataFrame:
    """``df`` with values of rows some places before or after in the window, and the others.

    Rows are numbered, and each finds its neighbour by key and number: an equi-join that spreads a
    large key evenly. The numbered rows are written, so that both sides agree on them.
    """
    place = {"__place": RunningValue("row_number", "", True)}
    placed = attach_running(df, window, {**place, **others}, view, blocks)
    if view is not None:
        placed = placed.alias(view)
    keys = key_names(window)
    helpers = {name: F.expr(key) for name, key in zip(keys, window.keys)}
    steps = {}
    for name, value in values.items():
        text, distance, default = neighbour_arguments(expand_calls(value.args))
        steps[name] = distance if value.call == "lag" else -distance
        helpers[f"{name}_of"], helpers[f"{name}_else"] = F.expr(text), F.expr(default)
    order = Window.partitionBy(*keys).orderBy("__place")
    named = placed.select("*", *[col.alias(name) for name, col in helpers.items()])
    types = named.select(*[v.local().over(order).alias(n) for n, v in values.items()]).schema
    for name in values:
        kind = types[name].dataType
        for column in (f"{name}_of", f"{name}_else"):
            named = named.withColumn(column, F.col(column).cast(kind))
    rows = stage(named, "places")
    joined = rows
    for step in dict.fromkeys(steps.values()):
        of_step = [name for name in values if steps[name] == step]
        other = rows.select(
            (F.col("__place") + step).alias("__at"),
            *[F.col(key).alias(f"__at{key}") for key in keys],
            *[F.col(f"{name}_of").alias(name) for name in of_step],
            F.lit(True).alias("__found"),
        )
        same = [F.col("__place") == F.col("__at")]
        same += [F.col(key).eqNullSafe(F.col(f"__at{key}")) for key in keys]
        joined = joined.join(other, reduce(lambda a, b: a & b, same), "left")
        found = {n: F.when(F.col("__found"), F.col(n)).otherwise(F.col(f"{n}_else")) for n in of_step}
        joined = joined.withColumns(found).drop("__found", "__at", *[f"__at{key}" for key in keys])
    return joined.select(*[F.col(f"`{name}`") for name in [*df.columns, *others, *values]])


def key_names(window: OrderedWindow) -> list[str]:
    return [f"__key_{i}" for i in range(len(window.keys))]


def _sorting(window: OrderedWindow) -> list[Column]:
    """Sort orders with Spark's defaults: nulls first ascending, last descending."""
    orders = []
    for i, text in enumerate(window.orders):
        item = ORDER_ITEM.match(text)
        descending = (item["way"] or "").strip().upper() == "DESC"
        nulls = (item["nulls"] or ("LAST" if descending else "FIRST")).lower()
        direction = f"{'desc' if descending else 'asc'}_nulls_{nulls}"
        orders.append(getattr(F.col(f"__order_{i}"), direction)())
    return [*orders, F.col("__order_row").asc(), F.col("__order_tie").asc()]
