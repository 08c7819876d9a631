"""CSV, JSON and Parquet tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landgauge.schemas import REGION_CODES, TRADE_RAW
from landgauge.session import measured


def read_csv(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType,
    encoding: str = "UTF-8",
) -> DataFrame:
    """CSV files (globs allowed) under one header layout; a byte-order mark is skipped.

    Columns are matched by position, so the schema names them whatever the header says.
    Legacy Korean files need ``spark.sql.legacy.javaCharsets=true`` and ``encoding='x-windows-949'``.
    """
    return spark.read.csv(
        paths,
        schema=schema,
        header=True,
        enforceSchema=True,
        encoding=encoding,
        quote='"',
        escape='"',
        mode="PERMISSIVE",
    )


def read_trades(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """All raw trade files under a glob, as text columns, with the file each row came from."""
    return read_csv(spark, paths, TRADE_RAW).withColumn("source_file", F.col("_metadata.file_name"))


def _picked(names: list[str], own: list[str]) -> Callable[[Column], Column]:
    """From a parsed line of the columns ``own`` to those asked for, null where it lacks them."""
    place = {c: i for i, c in enumerate(own)}
    none = F.lit(None).cast("string")
    return lambda r: F.struct(*[(r[f"c{place[n]}"] if n in place else none).alias(n) for n in names], r["_broken"].alias("_broken"))


def read_checked(
    spark: SparkSession, paths: str | list[str], schema: T.StructType, encoding: str = "UTF-8"
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of CSV files that each name their columns in a header of their own, whatever its order.

    A header is the first line of a file that holds most of the schema's names; columns beyond the schema are left out, and those a file
    lacks are null. Files of the same header are read together. Lines with another number of cells than their header,
    and all lines of files without one, come back as they are: (source_file, record).
    """
    text = F.col("value")
    lines = spark.read.option("encoding", encoding).text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.when(text.startswith("\ufeff"), F.substring(text, 2, 1 << 30)).otherwise(text).alias("value")
    )
    names = F.array(*[F.lit(n) for n in schema.names])
    cells = F.transform(F.split("value", ","), lambda c: F.trim(c, F.lit('" ')))
    known = F.size(F.array_intersect(cells, names))
    # A line with a name in its cells contains it; most lines contain few names and need no splitting.
    contained = sum((F.contains("value", F.lit(n)).cast("int") for n in schema.names), F.lit(0))
    header = F.when((contained * 2 > len(schema.names)) & (known * 2 > len(schema.names)), F.col("value"))
    # One row per file that has a header, kept: the lines themselves are neither sorted nor moved, and read for headers once.
    files = measured(lines.select("path", header.alias("header")).where(F.col("header").isNotNull()).groupBy("path").agg(F.max("header").alias("header")))
    heads = [r["header"] for r in files.select("header").distinct().collect()]  # the layouts, not the files
    named = lines.join(F.broadcast(files), "path", "left").withColumn("source_file", F.element_at(F.split("path", "/"), -1))
    # A line is parsed by its own layout, once, in an array: not again for the filter and for every column that is read.
    cells = F.lit(None)
    for head in sorted(heads):
        own = [c.strip('" ') for c in head.split(",")]
        layout = ", ".join([*[f"c{i} string" for i in range(len(own))], "_broken string"])
        options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
        options["inputBufferSize"] = "4096"  # made anew for each line, and by default of a million characters
        parsed = F.array(F.from_csv("value", F.lit(layout), options))
        cells = F.when(F.col("header") == head, F.transform(parsed, _picked(schema.names, own))).otherwise(cells)
    rejects = named.where(F.col("header").isNull()).select("source_file", F.col("value").alias("record"))
    if not heads:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("source_file", T.StringType())])), rejects
    body = named.where(F.col("header").isNotNull() & (F.col("value") != F.col("header")) & (F.col("value") != ""))
    read = body.select("source_file", F.explode_outer(cells).alias("r"))
    rows = read.where(F.col("r._broken").isNull()).select(*[F.col(f"r.{n}") for n in schema.names], "source_file")
    rejects = rejects.unionByName(read.where(F.col("r._broken").isNotNull()).select("source_file", F.col("r._broken").alias("record")))
    return rows, rejects


def read_wide_index(
    spark: SparkSession, paths: str | list[str], encoding: str = "UTF-8"
) -> DataFrame:
    """A wide monthly index file as text, without unnamed columns.

    The sub-header line stays in and is dropped with the other rows that hold no number when
    the table is turned long.
    """
    wide = spark.read.csv(paths, header=True, encoding=encoding, inferSchema=False)
    named = [c for c in wide.columns if c and not c.startswith(("Unnamed", "_c"))]
    return wide.select(*[F.col(f"`{c}`") for c in named])


def read_region_codes(spark: SparkSession, path: str) -> DataFrame:
    """Region-code document -> (code, name) rows."""
    doc = spark.read.schema(REGION_CODES).json(path, multiLine=True)
    return region_code_rows(doc)


def region_code_rows(doc: DataFrame) -> DataFrame:
    return doc.select(F.explode("regcodes").alias("r")).select("r.code", "r.name")


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
) -> None:
    """Parquet by default; CSV is written with a header.

    Partitioned output is rebalanced on its partition columns: adaptive execution splits a hot partition value
    over as many tasks as its size asks for, and a cold one stays one file.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        # Text keeps its outer blanks; the writer would trim them.
        writer = writer.options(
            header="true",
            escape='"',
            ignoreLeadingWhiteSpace="false",
            ignoreTrailingWhiteSpace="false",
        )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def append_results(df: DataFrame, path: str) -> None:
    """Append-only result table, one batch of files per call."""
    write_table(df, path, mode="append")
