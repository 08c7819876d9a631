"""Embedding tables: (id, array<float>) rows in size-bounded files."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landgauge.session import cut_lineage

# Fixed value: target size of one part.
PART_BYTES = 90 * 1024 * 1024


def part_layout(rows: int, dims: int, part_bytes: int = PART_BYTES) -> tuple[int, int]:
    """(parts, rows per part) for float32 vectors under a part-size limit."""
    parts = max(1, math.ceil(rows * dims * 4 / part_bytes))
    return parts, math.ceil(rows / parts)


def as_float32(df: DataFrame, vector: str = "embedding") -> DataFrame:
    return df.withColumn(vector, F.col(vector).cast("array<float>"))


def write_embeddings(
    df: DataFrame, path: str, vector: str = "embedding", rows_per_part: int | None = None
) -> None:
    """Write float32 vectors; ``rows_per_part`` bounds every file."""
    writer = as_float32(df, vector).write.mode("overwrite")
    if rows_per_part:
        writer = writer.option("maxRecordsPerFile", rows_per_part)
    writer.parquet(path)


def write_embedding_parts(df: DataFrame, path: str, row_id: str, parts: int, vector: str = "embedding") -> None:
    """Write exactly ``parts`` files of equal length (the last ones may be shorter or empty), in the order of ``row_id``, and a
    manifest of the first row and the number of rows of each.

    Rows are numbered without a single task seeing them all: sorted ranges are numbered on their own and shifted by the rows
    of the ranges before.
    """
    spark = df.sparkSession
    # The upper bits of the increasing id are the range, the lower ones the place in it.
    sorted_rows = as_float32(df, vector).orderBy(row_id).withColumn("_n", F.monotonically_increasing_id())
    placed = cut_lineage(sorted_rows.withColumns({"_range": F.shiftright("_n", 33), "_place": F.col("_n").bitwiseAND((1 << 33) - 1)}))
    ranges = sorted((r["_range"], r["n"]) for r in placed.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect())
    starts, total = [], 0
    for r, n in ranges:
        starts.append((r, total))
        total += n
    per_part = max(1, math.ceil(total / parts))
    shift = spark.createDataFrame(starts, "_range long, _start long")
    numbered = placed.join(F.broadcast(shift), "_range").withColumn("_row", F.col("_start") + F.col("_place"))
    dealt = numbered.withColumn("part", F.floor(F.col("_row") / per_part).cast("int"))
    ordered = dealt.repartition(parts, "part").sortWithinPartitions("part", "_row")
    ordered.drop("_n", "_range", "_place", "_start", "_row").write.mode("overwrite").partitionBy("part").parquet(path)
    held = [(k, k * per_part, max(0, min(per_part, total - k * per_part))) for k in range(parts)]
    spark.createDataFrame(held, "part int, first_row long, rows long").coalesce(1).write.mode("overwrite").json(f"{path}/_manifest")


def read_embedding_parts(spark: SparkSession, path: str) -> DataFrame:
    """All parts with the number of each row in the order of writing, as ``row``."""
    manifest = spark.read.schema("part int, first_row long, rows long").json(f"{path}/_manifest/*.json")
    rows = spark.read.parquet(path).withColumn("_index", F.col("_metadata.row_index"))
    return rows.join(F.broadcast(manifest), "part").withColumn("row", F.col("first_row") + F.col("_index")).drop("_index", "first_row", "rows")


def read_embeddings(spark: SparkSession, path: str) -> DataFrame:
    """All parts of an embedding table; reading the directory puts them together again."""
    return spark.read.parquet(path)
