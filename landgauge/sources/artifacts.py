"""Fitted mappings, models and metric rows on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from landgauge.operators.boosting import BoostedTrees


def save_mapping(df: DataFrame, folder: str, name: str) -> None:
    """A fitted encoder or scaler table, small by nature, as one Parquet table per name."""
    df.write.mode("overwrite").parquet(f"{folder}/{name}")


def load_mapping(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}")


def save_model(model: BoostedTrees, spark: SparkSession, path: str) -> None:
    model.save(spark, path)


def load_model(spark: SparkSession, path: str) -> BoostedTrees:
    return BoostedTrees.load(spark, path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Append one run's metric row to the report table."""
    metrics.write.mode("append").parquet(path)
