"""Connected components of a link table, by stars: nothing is gathered in one task or on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landgauge.llm.common import stored


def star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours onto the smallest one: the larger neighbours of every node, or the smaller ones and the node."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("low"))
        out = both.where(F.col("v") > F.col("u")).join(lowest, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    else:
        down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        lowest = down.groupBy("u").agg(F.min("v").alias("low"))
        joined = down.join(lowest, "u")
        out = joined.select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(joined.select("u", F.col("low").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def nearby_labels(edges: DataFrame) -> DataFrame:
    """(id, label) after one turn of the stars: nodes of one label are connected, but connected ones may have several."""
    hung = star(star(edges.where(F.col("u") != F.col("v")).select("u", "v").distinct(), True), False)
    both = hung.select(F.col("u").alias("id"), F.col("v").alias("label"))
    both = both.unionByName(hung.select(F.col("v").alias("id"), F.col("v").alias("label")))
    return stored(both.groupBy("id").agg(F.min("label").alias("label")), "labels")


def components(edges: DataFrame) -> DataFrame:
    """(id, label): label is the smallest id of the component; ids without an edge are left out.

    Large and small stars take turns until the table of edges stays the same; then every node hangs on the smallest.
    """
    edges = stored(edges.where(F.col("u") != F.col("v")).select("u", "v").distinct(), "edges")
    mark = None
    while True:
        edges = stored(star(star(edges, True), False), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    hung = edges.select(F.col("u").alias("id"), F.col("v").alias("label"))
    return stored(hung.unionByName(hung.select(F.col("label").alias("id"), "label")).distinct(), "components")
