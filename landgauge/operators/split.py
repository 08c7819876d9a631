"""Train / validation / test splits that never sort or shuffle the full table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ranges that a round of the search for a position counts.
CELLS = 16_384
# Stands for the day of rows without a date.
BEFORE_ALL = -(1 << 62)


def chronological_sort(df: DataFrame, date: str, row_id: str) -> DataFrame:
    return df.orderBy(date, row_id)


def day_order(row_id: str) -> list[Column]:
    """Order of rows inside one day: by hash, in two steps of 4096 values each."""
    h = F.xxhash64(row_id)
    return [F.pmod(h, F.lit(4096)), F.pmod(F.shiftright(h, 12), F.lit(4096))]


def nth(df: DataFrame, position: int, low: int, high: int) -> tuple[int, int]:
    """The value of the whole-number column ``k`` that holds the given position (from 1), and the position inside its rows.

    ``low`` and ``high`` are its least and largest value. Each round counts the rows in ``CELLS`` equal ranges, on the map
    side, and goes on inside the one range that holds the position.
    """
    while low < high:
        width = -(-(high - low + 1) // CELLS)
        cell = F.expr(f"(k - {low}L) div {width}L")
        counts = df.where(F.col("k").between(low, high)).groupBy(cell.alias("c")).agg(F.count(F.lit(1)).alias("m"))
        for c, m in sorted((r.c, r.m) for r in counts.collect()):  # CELLS rows at most
            if position <= m:
                low, high = low + c * width, min(high, low + (c + 1) * width - 1)
                break
            position -= m
    return low, position


def _whole(date: Column, kind: T.DataType) -> Column:
    """The day as a whole number of the same order."""
    if isinstance(kind, T.DateType):
        return F.unix_date(date).cast("long")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(date.cast("timestamp"))
    if isinstance(kind, T.StringType):
        # Digits of the first eleven characters; enough for YYYYMMDD and YYYY-MM-DD.
        return F.regexp_replace(F.substring(date, 1, 11), "[^0-9]", "").try_cast("long")
    return date.cast("long")


def chronological_split(
    df: DataFrame,
    date: str,
    row_id: str,
    fraction: float = 0.8,
    inside_day: list[Column] | None = None,
) -> DataFrame:
    """Add ``split``: the earliest ``int(n * fraction)`` rows are 'train', the rest 'test'.

    The cut is found from counts per day, then per hash step inside the one day it falls in, and last among the few ids
    left; each round is one scan of the cached keys. Labelling the rows is then a plain comparison: no row moves, however
    many deals one day has. ``row_id`` must be unique; ``date`` is a date, a timestamp, a whole number, or a text whose digits
    order it. Rows without a date come first. ``inside_day`` are whole numbers.
    """
    steps = day_order(row_id) if inside_day is None else inside_day
    day = F.coalesce(_whole(F.col(date), df.schema[date].dataType), F.lit(BEFORE_ALL))
    order = [day, *[s.cast("long") for s in steps]]
    names = [f"k{i}" for i in range(len(order))]
    keys = df.select(*[o.alias(c) for o, c in zip(order, names)], F.col(row_id).alias("id")).persist()
    edges = [f(c).alias(f"{f.__name__}_{c}") for c in names for f in (F.min, F.max)]
    dated = F.min(F.when(F.col("k0") > BEFORE_ALL, F.col("k0"))).alias("first")
    known = keys.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("k0") == BEFORE_ALL).alias("undated"), dated, *edges).first()
    position = int(known["n"] * fraction)
    if position == 0:
        keys.unpersist()
        return df.withColumn("split", F.lit("test"))
    cut, left = [], keys
    for level, c in enumerate(names):
        low, high = known[f"min_{c}"], known[f"max_{c}"]
        if level == 0 and known["undated"]:
            # Rows without a date are one value far below all others.
            if position <= known["undated"]:
                high = low
            else:
                low, position = known["first"], position - known["undated"]
        value, position = nth(left.withColumn("k", F.col(c)), position, low, high)
        cut.append(value)
        left = left.where(F.col(c) == value)
    cut.append(left.orderBy("id").offset(position - 1).first()["id"])
    keys.unpersist()
    key = F.struct(*[k.alias(f"k{i}") for i, k in enumerate([*order, F.col(row_id)])])
    last = F.struct(*[F.lit(v).cast(t).alias(f"k{i}") for i, (v, t) in enumerate(zip(cut, [*["long"] * len(order), df.schema[row_id].dataType]))])
    return df.withColumn("split", F.when(key <= last, "train").otherwise("test"))


def hash_split(
    df: DataFrame, row_id: str, train: int = 80, validation: int = 0
) -> DataFrame:
    """Add ``split`` by a stable hash of the id, in percent; the rest is 'test'."""
    slot = F.pmod(F.xxhash64(row_id), F.lit(100))
    return df.withColumn(
        "split",
        F.when(slot < train, "train")
        .when(slot < train + validation, "validation")
        .otherwise("test"),
    )
