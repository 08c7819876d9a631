"""Registration of catalog queries."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from landgauge.session import shared_folder, spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a (spark, sf_dir) -> DataFrame function, with its SQL form where there is one."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


# Tables whose rows get much work after the scan, with a key of many values.
LARGE = {"lineitem": "l_orderkey", "orders": "o_orderkey", "documents": "doc_id"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    scan = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(scan, LARGE[name]) if name in LARGE else scan


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder for a query that writes and reads back."""
    return f"{shared_folder(spark)}/catalog/{name}-{uuid.uuid4().hex[:12]}"
