"""Session set-up and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("landgauge")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LANDGAUGE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local session may fall back to a machine-local folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="landgauge-")
    spark.conf.set("spark.checkpoint.dir", folder)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder, so a lost executor costs no recomputation."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()


def measured(df: DataFrame) -> DataFrame:
    """Materialise a lookup table so that the planner knows its true size.

    Once every block is cached, Catalyst plans with the measured bytes: the table is broadcast
    only when it is under ``spark.sql.autoBroadcastJoinThreshold`` and is shuffled otherwise.
    Blocks spill to disk and keep their lineage, so a lost executor only costs a recompute.
    """
    kept = df.persist()
    kept.count()
    return kept


def spread(scan: DataFrame, key: str) -> DataFrame:
    """Deal out a table scan that comes in fewer splits than there are cores.

    A file with a single row group is one split, however much work follows the scan. ``key`` is
    a column of many values. Tables of many splits, as on a cluster, are returned as they are.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores, key) if scan.rdd.getNumPartitions() < cores else scan


def dealt(rows: DataFrame, per_core: int = 4) -> DataFrame:
    """Deal out rows that get much work each, however their files are cut.

    A file is cut by bytes, but its rows come by row groups, so most of its splits may be empty. The number of tasks grows with
    the splits.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(per_core * max(cores, rows.rdd.getNumPartitions()))
