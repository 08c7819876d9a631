"""Landed answer files -> result and reject tables, each file taken in once.

The stream checkpoint remembers which files were read. Each attempt at a batch writes into folders of its own and commits them
under the checkpoint's id and the batch's; a batch is committed once, and readers see committed folders only. So a killed
batch leaves nothing half read, a restart neither loses nor doubles rows, and a new checkpoint stands beside an older one.
Trades, coordinates and buildings go the same way, each with its own parser. Compaction turns many batches into one folder.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landgauge.operators.lookups import newest_per_key, purge_retryable, still_to_ask
from landgauge.sources.commits import CommitLog
from landgauge.sources.payloads import NO_RECORD, OK, QUOTA

ACCEPTED, REJECTED = "accepted", "rejected"


def route(answers: DataFrame, settled: tuple[str, ...] = (OK, NO_RECORD)) -> dict[str, DataFrame]:
    """Split answers by status: settled ones are results, the rest is asked again."""
    fine = F.coalesce(F.col("status").isin(*settled), F.lit(False))
    return {ACCEPTED: answers.where(fine), REJECTED: answers.where(~fine)}


def quota_reached(answers: DataFrame) -> DataFrame:
    """One row: whether any answer says that the quota is used up."""
    return answers.agg(
        F.coalesce(F.bool_or(F.col("status") == QUOTA), F.lit(False)).alias("stop"),
        F.count_if(F.col("status") == QUOTA).alias("quota_answers"),
    )


def ingest(
    spark: SparkSession,
    landed: str,
    schema: T.StructType,
    parse: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    files_per_batch: int = 1_000,
    fmt: str = "json",
) -> None:
    """Take in every landed file that is new, then stop.

    ``parse`` turns the landed rows into rows with a ``status``.
    """
    log = CommitLog(spark, f"{out}/_commits")

    def write(batch: DataFrame, batch_id: int) -> None:
        # The id of the stream, made with the checkpoint and kept in it.
        run = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        folder = f"run={run}/batch_id={batch_id}/attempt={uuid.uuid4().hex}"
        answers = parse(batch).withColumn("taken_in", F.current_timestamp()).persist()
        for name, rows in route(answers).items():
            rows.write.parquet(f"{out}/{name}/{folder}")
        answers.unpersist()
        log.commit(f"{run}-{batch_id}", folder)

    query = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .format(fmt)
        .load(landed)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def committed(spark: SparkSession, out: str, name: str = ACCEPTED, folders: list[str] | None = None) -> DataFrame:
    """The rows of all committed batches, with the ``run`` and ``batch_id`` that took them in."""
    folders = list(CommitLog(spark, f"{out}/_commits").live().values()) if folders is None else folders
    batches = [f for f in folders if f.startswith("run=")]
    merged = [f for f in folders if not f.startswith("run=")]
    parts = []
    if batches:
        rows = spark.read.option("basePath", f"{out}/{name}").parquet(*[f"{out}/{name}/{f}" for f in batches])
        parts.append(rows.withColumns({"run": F.col("run").cast("string"), "batch_id": F.col("batch_id").cast("long")}).drop("attempt"))
    if merged:
        parts.append(spark.read.parquet(*[f"{out}/{name}/{f}" for f in merged]))
    if not parts:
        raise ValueError(f"nothing has been committed below {out}")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def results(
    spark: SparkSession, out: str, keys: list[str], sequence: list[str] | None = None, version: list[str] | None = None
) -> DataFrame:
    """Newest accepted row per key over all committed batches.

    ``version`` columns tell newer answers from older ones and come first, so that an old answer that is taken in again does not
    win; then come the time of intake, the batch, and ``sequence`` inside a batch.
    """
    rows = committed(spark, out)
    return newest_per_key(rows, keys, [*(version or []), "taken_in", "batch_id", *(sequence or [])])


def compact(spark: SparkSession, out: str) -> str | None:
    """Write the rows of all batches as one folder per route, and let it replace them for readers."""

    def write(_, folder: str) -> None:
        for name in (ACCEPTED, REJECTED):
            committed(spark, out, name, write.folders).write.parquet(f"{out}/{name}/{folder}")

    def read(folders: list[str]) -> None:
        write.folders = folders

    return CommitLog(spark, f"{out}/_commits").compact(read, write)


def next_requests(wanted: DataFrame, answers: DataFrame, keys: list[str]) -> DataFrame:
    """Keys to ask for next: never answered, or answered by an error worth another try."""
    return still_to_ask(wanted, purge_retryable(answers), keys)
