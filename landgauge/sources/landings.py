"""Landed trades that may land again: the newest landing of a region's month replaces the ones before.

A month of a region is one snapshot: the service answers it as a whole, so a later answer stands for all rows of the
earlier one, and equal trades inside one answer are different trades. A landing is one write of any number of snapshots.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landgauge.sources.commits import CommitLog, read_folders

SNAPSHOT = ["sggCd", "dealYear", "dealMonth"]


def newest_snapshots(rows: DataFrame, order: list[Column | str], keys: list[str] | None = None) -> DataFrame:
    """The rows of the newest landing of each snapshot; all of them, equal ones too.

    ``order`` tells newer landings from older ones; rows of one landing agree in it. Only one small row per snapshot is
    aggregated and met again, so the rows themselves need not move.
    """
    keys = keys or SNAPSHOT
    mark = F.struct(*[F.col(c).alias(f"o{i}") if isinstance(c, str) else c.alias(f"o{i}") for i, c in enumerate(order)])
    marked = rows.withColumn("_landing", mark)
    newest = marked.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.max("_landing").alias("_newest"))
    same = F.col("_landing") == F.col("_newest")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return marked.join(newest, same, "left_semi").drop("_landing")


def land_trades(rows: DataFrame, base: str, landing: str, sequence: int) -> bool:
    """Write one landing and commit it; False if a landing of that name is there already."""
    folder = f"landing-{uuid.uuid4().hex}"
    rows.withColumn("_sequence", F.lit(sequence).cast("long")).write.parquet(f"{base}/{folder}")
    return CommitLog(rows.sparkSession, f"{base}/_commits").commit(landing, folder)


def landed_trades(spark: SparkSession, base: str, keys: list[str] | None = None) -> DataFrame | None:
    """Every trade once: the newest committed landing of each snapshot. None before the first landing."""
    rows = read_folders(spark, base, list(CommitLog(spark, f"{base}/_commits").live().values()))
    return None if rows is None else newest_snapshots(rows, ["_sequence"], keys).drop("_sequence")


def compact_landings(spark: SparkSession, base: str, keys: list[str] | None = None) -> str | None:
    """Write the newest snapshots of all landings as one folder, and let it replace them."""

    def read(folders: list[str]) -> DataFrame:
        return newest_snapshots(read_folders(spark, base, folders), ["_sequence"], keys)

    return CommitLog(spark, f"{base}/_commits").compact(read, lambda rows, folder: rows.write.parquet(f"{base}/{folder}"))
