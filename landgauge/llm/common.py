"""What the corpus operators share: reading tables, written intermediate tables, Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landgauge.session import shared_folder

#: White space and letters as the contracts define them (ASCII only).
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Rows in an Arrow batch; long texts then stay within some tens of MB.
BATCH_ROWS = 500


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends at replicated files, and the planner
    knows the true size of the table, so it broadcasts it only below its threshold."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a ``stored`` table that nothing reads any more."""
    spark = df.sparkSession
    files = df.inputFiles()
    if files:
        path = spark._jvm.org.apache.hadoop.fs.Path(files[0].rsplit("/", 1)[0])
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def mapped(df: DataFrame, fn, schema: str, rows: int = BATCH_ROWS) -> DataFrame:
    """``mapInArrow`` with batches of bounded size (sets Spark's rows per Arrow batch for the session)."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return df.mapInArrow(fn, schema)


def crc_remainder(column: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % n, F.lit(0))


def pieces(batches: Iterator[pa.RecordBatch], limit: int = 1 << 20, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text; a row is never cut."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit - size, side="right")))
            if held and ends[stop - 1] - base + size > limit:
                yield pa.concat_batches(held)
                held, size = [], 0
                continue
            held.append(batch.slice(start, stop - start))
            size += int(ends[stop - 1] - base)
            start = stop
            if size >= limit:
                yield pa.concat_batches(held)
                held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def texts(buf: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The inverse of ``utf8``."""
    data = np.ascontiguousarray(buf)
    at = np.ascontiguousarray(offsets, np.int64)
    return pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(data)).cast(pa.string())


def lists(flat: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from the concatenated values and the length of each row."""
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind))


def table(schema: list[tuple[str, pa.DataType]], *columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, kind) for (_, kind), c in zip(schema, columns)]
    return pa.RecordBatch.from_arrays(arrays, schema=pa.schema(schema))
