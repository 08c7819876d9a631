"""Missing-value rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landgauge.constants import ELEVATOR_YEAR
from landgauge.functions import parsing as P
from landgauge.functions.numeric import bits_value, ordered_bits
from landgauge.operators.profile import exact_quantiles
from landgauge.session import cut_lineage, measured

# Bits of a value that each round of the group medians tells apart: the first one settles whole numbers below 8,192.
MEDIAN_BITS = (24, 20, 20)


def group_stat(df: DataFrame, keys: list[str], aggs: dict) -> DataFrame:
    """Aggregate of each complete key; null keys form no group.

    Grouped and joined back rather than windowed: the aggregate is combined on the map side and
    a key with very many rows is never gathered in one task.
    """
    return df.dropna(subset=keys).groupBy(*keys).agg(*[a.alias(n) for n, a in aggs.items()])


def with_group_stat(df: DataFrame, keys: list[str], aggs: dict) -> DataFrame:
    return df.join(measured(group_stat(df, keys, aggs)), keys, "left")


def group_medians(df: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """(keys, _median_<column>): exact medians of number columns per complete key; null and NaN do not count.

    Values become whole-number keys of the same order. Rows are counted, on the map side, by group and leading bits, and the
    counts tell which cell holds the middle; only cells with more than one value are counted again by their next
    bits. So a group of any size, with however many values, is never one buffer.
    """
    named = [F.col(k).alias(f"g{j}") for j, k in enumerate(keys)]
    group = [*[f"g{j}" for j in range(len(keys))], "i"]
    entries = [F.struct(F.lit(i).alias("i"), F.col(f"k{i}").alias("k")) for i in range(len(columns))]
    rows = df.dropna(subset=keys).select(*named, *[ordered_bits(c).alias(f"k{i}") for i, c in enumerate(columns)])
    rows = rows.select(*group[:-1], F.explode(F.array(*entries)).alias("e"))
    rows = rows.select(*group[:-1], "e.i", "e.k").where(F.col("k").isNotNull())
    settled, open_cells, depth = None, None, 0
    for bits in MEDIAN_BITS:
        inside, within = rows, group
        if depth:
            within = [*group, "p"]
            cells = open_cells.select(*within).distinct()
            inside = rows.withColumn("p", F.shiftright("k", 64 - depth)).join(cells, within)
        depth += bits
        cell = F.shiftright("k", 64 - depth) if depth < 64 else F.col("k")
        counts = inside.groupBy(*within, cell.alias("cell")).agg(
            F.count(F.lit(1)).alias("n"), F.min("k").alias("low"), F.max("k").alias("high")
        )
        running = counts.withColumn("upto", F.sum("n").over(Window.partitionBy(*within).orderBy("cell")))
        if open_cells is None:
            total = running.withColumn("total", F.sum("n").over(Window.partitionBy(*within)))
            middle = (F.floor((F.col("total") - 1) / 2), F.floor(F.col("total") / 2))
            ranks = F.array(*[F.struct(F.lit(j).alias("j"), r.alias("rank")) for j, r in enumerate(middle)])
            ranked = total.withColumn("r", F.explode(ranks)).select("*", "r.j", "r.rank").drop("r", "total")
        else:
            ranked = running.join(open_cells, within)
        start = F.col("upto") - F.col("n")
        hits = ranked.where((start <= F.col("rank")) & (F.col("rank") < F.col("upto")))
        hits = hits.select(*group, "j", (F.col("rank") - start).alias("rank"), F.col("cell").alias("p"), "low", "high")
        hits = cut_lineage(hits)
        hits = hits.select(*[F.col(c).alias(c) for c in hits.columns])  # attributes of their own, as it meets ``rows`` again
        done = hits.where(F.col("low") == F.col("high")).select(*group, bits_value("low").alias("v"))
        settled = done if settled is None else settled.unionByName(done)
        open_cells = hits.where(F.col("low") != F.col("high")).select(*group, "j", "rank", "p")
        if open_cells.isEmpty():
            break
    # The two middle values, which are one where the number of rows is odd.
    medians = [F.avg(F.when(F.col("i") == i, F.col("v"))).alias(f"_median_{c}") for i, c in enumerate(columns)]
    back = [F.col(f"g{j}").alias(k) for j, k in enumerate(keys)]
    return settled.groupBy(*group[:-1]).agg(*medians).select(*back, *[f"_median_{c}" for c in columns])


def median_fill(
    df: DataFrame, columns: list[str], keys: list[str] | None = None
) -> DataFrame:
    """Fill by the median of the row's group, then by the median of the filled column.

    Group medians of all columns share their rounds.
    """
    keys = keys or ["umdNm"]
    as_double = df.withColumns({c: F.col(c).cast("double") for c in columns})
    grouped = as_double.join(group_medians(as_double, columns, keys), keys, "left")
    filled = grouped.withColumns(
        {c: F.coalesce(F.col(c), F.col(f"_median_{c}")) for c in columns}
    ).drop(*[f"_median_{c}" for c in columns])
    found = exact_quantiles(filled, columns, [0.5]).collect()
    overall = {r["column"]: r["value"] for r in found}
    return filled.withColumns(
        {c: F.coalesce(F.col(c), F.lit(overall.get(c))) for c in columns}
    ).select(*df.columns)


def parking_means(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    return group_stat(df, keys or ["umdNm"], {"_mean": F.avg("parking_ratio")})


def parking_fill(
    df: DataFrame, keys: list[str] | None = None, default: float = 0.5, means: DataFrame | None = None
) -> DataFrame:
    """parking_ratio: mean of the row's group, then a constant. ``means`` brings the group means of other rows."""
    keys = keys or ["umdNm"]
    filled = df.join(measured(parking_means(df, keys) if means is None else means), keys, "left")
    return filled.withColumn(
        "parking_ratio", F.coalesce("parking_ratio", "_mean", F.lit(default))
    ).select(*df.columns)


def elevator_fill(df: DataFrame) -> DataFrame:
    """has_elevator as a number; unknown ones by the year lifts became usual."""
    by_year = F.coalesce(F.col("buildYear") >= ELEVATOR_YEAR, F.lit(False)).cast("double")
    known = P.lenient_double("has_elevator")
    return df.withColumn("has_elevator", F.coalesce(known, by_year).cast("int"))


def floors_fill(df: DataFrame) -> DataFrame:
    """total_floors: the listing's own floor, then 1."""
    return df.withColumn("total_floors", F.coalesce("total_floors", "floor", F.lit(1)))
