"""Connected components of links between long ids, in rounds of joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ruleframe.session import stage


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest id that each linked id can reach, itself included.

    Each round hangs every id's larger neighbours, and then its smaller ones, on its smallest
    neighbour, which halves distances in practice. The smallest neighbours are found by an
    aggregate that combines map-side and joined back, so that an id with very many neighbours is a
    skewed join and not a group in one task. Each round is written to the shared folder. Ends when
    every id hangs directly on a root. Self links and nulls are ignored; ids without a link do
    not appear; no links give no rows.
    """
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    edges = stage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = None
    while True:
        # Larger neighbours hang on the smallest of the neighbourhood.
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = (
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        # So do the smaller ones, and the id itself.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = edges.agg(
            F.count("*"), F.count_distinct("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == before:
            break
        before = now
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return members.union(roots).distinct()
