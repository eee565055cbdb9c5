"""Which columns a rule depends on across all levels, and the lowest level it could have."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ruleframe.operators.references import expression_references
from ruleframe.session import stage


def reference_edges(rules: DataFrame) -> DataFrame:
    """(TableName, ColumnName, reference): columns that rules of the same table define and a rule uses. Tables are in
    lower case, columns in upper case; of a name of two parts the part that is defined counts."""
    named = rules.select(F.lower("TableName").alias("TableName"), F.upper("ColumnName").alias("ColumnName"), "Expression")
    used = named.select("TableName", "ColumnName", F.explode(expression_references("Expression")).alias("name"))
    parts = F.split("name", "[.]")
    used = used.select("TableName", "ColumnName", F.explode(F.array_distinct(F.slice(parts, 1, 2))).alias("reference")).distinct()
    defined = named.select("TableName", F.col("ColumnName").alias("reference")).distinct()
    return used.join(defined, ["TableName", "reference"], "left_semi").select("TableName", "ColumnName", "reference")


def rule_lineage(rules: DataFrame) -> DataFrame:
    """(TableName, ColumnName, reference, steps): every defined column that a column depends on, directly or through
    others, with the fewest rules on the way. A column that depends on itself has a row of its own name.

    Each round joins the pairs found last with the direct ones and keeps those that are new; it is written to the
    shared folder, so that no plan grows. The rounds end with the longest chain of rules. No rules give no rows.
    """
    edges = stage(reference_edges(rules), "edges")
    onward = edges.select("TableName", F.col("ColumnName").alias("reference"), F.col("reference").alias("further"))
    fresh = edges.withColumn("steps", F.lit(1))
    known, steps = fresh, 1
    while not fresh.isEmpty():
        steps += 1
        further = fresh.join(onward, ["TableName", "reference"])
        further = further.select("TableName", "ColumnName", F.col("further").alias("reference"), F.lit(steps).alias("steps")).distinct()
        fresh = stage(further.join(known, ["TableName", "ColumnName", "reference"], "left_anti"), "lineage")
        known = known.union(fresh)
    return known


def lowest_levels(rules: DataFrame) -> DataFrame:
    """(TableName, ColumnName, lowest): 0 for a column that uses no defined one, else one more than the highest of
    those it uses; null for columns in a cycle and those that depend on one.

    Round k holds the columns with a chain of k references below them; it shrinks until only cycles feed it.
    """
    names = rules.select(F.lower("TableName").alias("TableName"), F.upper("ColumnName").alias("ColumnName")).distinct()
    edges = stage(reference_edges(rules), "edges")
    layer, size, steps = names.withColumn("lowest", F.lit(0)), None, 0
    layers = layer
    while True:
        steps += 1
        above = layer.select("TableName", F.col("ColumnName").alias("reference"))
        layer = edges.join(above, ["TableName", "reference"], "left_semi").select("TableName", "ColumnName").distinct()
        layer = stage(layer.withColumn("lowest", F.lit(steps)), "layer")
        now = layer.count()
        if now == size or not now:
            break
        layers, size = layers.union(layer), now
    endless = layer.select("TableName", "ColumnName", F.lit(True).alias("endless"))
    found = layers.groupBy("TableName", "ColumnName").agg(F.max("lowest").alias("lowest"))
    found = found.join(endless, ["TableName", "ColumnName"], "left")
    return found.select("TableName", "ColumnName", F.when(F.col("endless").isNull(), F.col("lowest")).alias("lowest"))
