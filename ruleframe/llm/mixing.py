"""Mixing sources to target weights: repetition rates from token totals, seeded extra copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ruleframe.llm.words import free_name
from ruleframe.session import stage

#: Fixed value: a word is a run of anything but ASCII white space.
WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(text: Column | str) -> Column:
    """Number of words; null counts as none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(*parts: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on nothing but the seed and the values."""
    text = F.concat_ws(":", F.lit(str(seed)), *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def cyclic_weights(sources: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), source: str = "source") -> DataFrame:
    """(source, weight): sources by code point, null last, weigh the values of ``cycle`` in turn."""
    place = F.row_number().over(Window.orderBy(F.col(source).asc_nulls_last())) - 1
    weights = F.array(*(F.lit(float(w)) for w in cycle))
    return sources.select(source).distinct().select(
        source, F.element_at(weights, place % len(cycle) + 1).alias("weight")
    )


def source_targets(sizes: DataFrame, weights: DataFrame | None = None, most: float = 3.0) -> DataFrame:
    """(source, source_size, target) for sizes per (source, size).

    The sources share the total by weight; a target stops at ``most`` times its source's size and
    the excess is shared again by weight, until none is above. That leaves a level L with
    target = min(most * size, weight * L). The level is found in one pass over the sources in the
    order in which they reach their stop. Works on one row per source: the windows over all of them
    hold source names, never documents. A source without a weight weighs nothing and gets
    target 0; the weights default to ``cyclic_weights``. Totals are combined map-side. Because the
    table of sources is written first, the planner knows its size and decides on a broadcast.
    """
    totals = stage(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    weights = cyclic_weights(totals) if weights is None else weights
    joined = totals.alias("t").join(weights.alias("w"), F.col("t.source").eqNullSafe(F.col("w.source")), "left")
    joined = joined.select(
        "t.source", "source_size", F.coalesce(F.col("weight"), F.lit(0.0)).cast("double").alias("weight")
    ).withColumn("stop", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy(F.col("ratio"), "stop", F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    # If the sources before this one stop, the others share what is left; the highest such level is
    # the one at which nobody is above the stop any more.
    share = (F.col("total") - F.coalesce(F.sum("stop").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    levels = (
        joined.withColumns({
            "ratio": F.when(F.col("weight") > 0, F.col("stop") / F.col("weight")),
            "total": F.sum("source_size").over(every).cast("double"),
        })
        .withColumn("live", (F.col("weight") > 0) & (F.col("source_size") > 0))
    )
    live = levels.where("live").withColumn("share", share).withColumn("level", F.max("share").over(every))
    idle = levels.where("NOT live").withColumn("level", F.lit(0.0))
    columns = ["source", "source_size", F.least("stop", F.col("weight") * F.col("level")).alias("target")]
    return stage(live.select(*columns).unionByName(idle.select(*columns)), "targets")


def plan_mix(
    docs: DataFrame, weights: DataFrame | None = None, *, id: str = "doc_id", text: str = "text",
    source: str = "source", most: float = 3.0, seed: int = 7, keep: bool = False,
) -> DataFrame:
    """How often the mix takes each document: size, source_size, target, copies.

    Rate = target / source size; a document is taken floor(rate) times and once more if a number
    drawn from the seed, its id and its text is below the fraction. So reruns agree, rows that repeat
    are taken alike, and no document is taken more than ``most`` times (rounded up). Null and
    empty texts have size 0; a source with no words has target 0 and copies 0; null is a source of
    its own; an empty table gives no rows. Documents never move: only (source, size) is grouped,
    and the table of targets is joined to them. With ``keep`` all columns of ``docs`` stay; columns
    of the same name as a result are replaced by it.
    """
    sizes = docs.select(F.col(source).alias("source"), word_count(docs[text]).alias("size"))
    of, size, wanted = (free_name(docs.columns, name) for name in ("_of", "_size", "_target"))
    targets = source_targets(sizes, weights, most).select(
        F.col("source").alias(of), F.col("source_size").alias(size), F.col("target").alias(wanted)
    )
    mixed = docs.join(targets, docs[source].eqNullSafe(targets[of]), "left")
    rate = F.when(F.col(size) > 0, F.col(wanted) / F.col(size)).otherwise(0.0)
    extra = (draw(F.col(id), F.col(text), seed=seed) < rate - F.floor(rate)).cast("long")
    results = {
        "size": word_count(F.col(text)), "source_size": F.col(size), "target": F.col(wanted),
        "copies": F.floor(rate).cast("long") + extra,
    }
    if keep:
        return mixed.withColumns(results).drop(of, size, wanted)
    return mixed.select(F.col(id), *[column.alias(name) for name, column in results.items()])


def mix_sources(docs: DataFrame, weights: DataFrame | None = None, **options) -> DataFrame:
    """The mix itself: every document as many times as ``plan_mix`` takes it, numbered by ``copy``."""
    taken = plan_mix(docs, weights, keep=True, **options).where("copies > 0")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
