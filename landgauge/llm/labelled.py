"""Labelled rows for fitting: a bounded sample, chosen by a hash of the id."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landgauge.llm.common import crc_remainder, stored


def training_rows(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, limit: int, max_bytes: int = 256 << 20
) -> DataFrame:
    """(text, other columns asked for, y): at most ``limit`` labelled documents outside the held-out fold, of at most
    ``max_bytes`` of text together.

    Rows without an id or label are left out; of repeated labels of an id the largest counts. Rows that repeat an id and
    its text count once, other rows of an id each. The sample is the one with the smallest hashes, so it is the same on every run.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (crc_remainder("doc_id", folds) != held_out))
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    named = docs.withColumn("__text", F.xxhash64("text"))
    keys = named.select("doc_id", "__text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"))
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("__text")]
    chosen = known.join(keys.distinct(), "doc_id").orderBy(*order).limit(limit)
    upto = F.sum("bytes").over(Window.orderBy(*order))  # over the ``limit`` rows chosen
    chosen = chosen.withColumn("upto", upto).where(F.col("upto") <= max_bytes)
    rows = named.join(stored(chosen.select("doc_id", "__text", "y"), "labelled"), ["doc_id", "__text"])
    return rows.dropDuplicates(["doc_id", "__text"]).drop("__text")
