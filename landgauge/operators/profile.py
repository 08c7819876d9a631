"""Data-quality profiles and exact quantiles."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landgauge.constants import COMPLETENESS_COLUMNS, ZERO_CHECK_COLUMNS
from landgauge.functions.numeric import ordered_bits, value_of_bits
from landgauge.operators.filters import complete_on

# Bits of a key that a round of the descent tells apart.
STEP_BITS = 14


@dataclass
class _Rank:
    """A value wanted: the ``rank``-th (from 0) of those whose key starts with ``prefix``."""

    column: int
    rank: int
    prefix: int = 0
    value: float | None = None


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float]) -> DataFrame:
    """Exact, linearly interpolated quantiles as (column, prob, value) rows; null and NaN do not count.

    Values become whole-number keys of the same order, and the keys are descended bit by bit: each round counts, on the map
    side, the rows by the next 14 bits inside the cells that still hold a wanted rank. A cell whose least and largest
    key agree is settled. So there are five rounds at most, no task holds values, and the driver
    gets counts of at most 16,384 cells for each of the two ranks of a quantile.
    """
    keys = df.select(*[ordered_bits(F.col(c)).alias(f"k{i}") for i, c in enumerate(columns)]).persist()
    entries = [F.struct(F.lit(i).alias("i"), F.col(f"k{i}").alias("k")) for i in range(len(columns))]
    rows = keys.select(F.explode(F.array(*entries)).alias("e")).select("e.*").where(F.col("k").isNotNull())
    spark = df.sparkSession
    asked: dict[tuple[int, int], _Rank] = {}
    total: dict[int, int] = {}
    depth = 0
    while True:
        wanted = [r for r in asked.values() if r.value is None]
        if depth and not wanted:
            break
        inside = rows
        if depth:
            cells = sorted({(r.column, r.prefix) for r in wanted})
            open_cells = spark.createDataFrame(cells, "i int, p long")  # two a quantile at most
            inside = rows.withColumn("p", F.shiftright("k", 64 - depth)).join(F.broadcast(open_cells), ["i", "p"])
        depth = min(64, depth + STEP_BITS)
        cell = F.shiftright("k", 64 - depth) if depth < 64 else F.col("k")
        counts = inside.groupBy("i", cell.alias("cell")).agg(
            F.count(F.lit(1)).alias("n"), F.min("k").alias("low"), F.max("k").alias("high")
        )
        found: dict[int, list] = {}
        for r in sorted(counts.collect()):
            found.setdefault(r.i, []).append(r)
        if not total:
            total = {i: sum(r.n for r in held) for i, held in found.items()}
            for i, n in total.items():
                for p in probs:
                    for rank in (int(p * (n - 1)), min(int(p * (n - 1)) + 1, n - 1)):
                        asked[i, rank] = _Rank(i, rank)
            wanted = list(asked.values())
        for want in wanted:
            _descend(want, found[want.column], depth)
    keys.unpersist()
    result = []
    for i, c in enumerate(columns):
        for p in probs if i in total else ():
            place = p * (total[i] - 1)
            low, high = asked[i, int(place)].value, asked[i, min(int(place) + 1, total[i] - 1)].value
            part = place - int(place)
            result.append((c, float(p), low if part == 0 or low == high else low + (high - low) * part))
    return spark.createDataFrame(result, "column string, prob double, value double")


def _descend(want: _Rank, cells: list, depth: int) -> None:
    """Follow a rank into the cell that holds it; ``cells`` are sorted and may belong to other prefixes as well."""
    shift, before = 64 - depth, (depth - 1) // STEP_BITS * STEP_BITS
    for r in cells:
        if before and r.low >> (64 - before) != want.prefix:
            continue
        if want.rank < r.n:
            want.prefix = r.low >> shift
            if r.low == r.high:
                want.value = value_of_bits(r.low)
            return
        want.rank -= r.n


def _long(row: DataFrame, entries: list[tuple[str, str, str]]) -> DataFrame:
    """One aggregate row -> (column, stat, value) rows."""
    structs = [
        F.struct(
            F.lit(column).alias("column"),
            F.lit(stat).alias("stat"),
            F.col(alias).cast("double").alias("value"),
        )
        for column, stat, alias in entries
    ]
    return row.select(F.explode(F.array(*structs)).alias("e")).select("e.*")


def _moments(df: DataFrame, columns: list[str], stats: dict) -> DataFrame:
    aggs, entries = [], []
    for i, c in enumerate(columns):
        for stat, fn in stats.items():
            alias = f"{stat}_{i}"
            aggs.append(fn(F.col(c)).alias(alias))
            entries.append((c, stat, alias))
    return _long(df.agg(*aggs), entries)


def _named_quantiles(df: DataFrame, columns: list[str], names: dict[float, str]) -> DataFrame:
    q = exact_quantiles(df, columns, list(names))
    label = F.lit(None).cast("string")
    for prob, stat in names.items():
        label = F.when(F.col("prob") == prob, F.lit(stat)).otherwise(label)
    return q.select("column", label.alias("stat"), "value")


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, sample std, min, exact quartiles and max, as (column, stat, value)."""
    moments = _moments(
        df,
        columns,
        {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max},
    )
    return moments.unionByName(
        _named_quantiles(df, columns, {0.25: "25%", 0.5: "50%", 0.75: "75%"})
    )


def target_profile(df: DataFrame, column: str = "dealAmount") -> DataFrame:
    """mean, median, min, max and the 2 % / 98 % bounds, as (column, stat, value)."""
    moments = _moments(df, [column], {"mean": F.avg, "min": F.min, "max": F.max})
    return moments.unionByName(
        _named_quantiles(df, [column], {0.02: "lower_2pct", 0.5: "median", 0.98: "upper_2pct"})
    )


def column_profile(df: DataFrame, zero_columns: list[str] | None = None) -> DataFrame:
    """Nulls, null share, blank texts and logical zeros per column, worst column first.

    One aggregate over all columns, then one small unpivot.
    """
    zero_columns = ZERO_CHECK_COLUMNS if zero_columns is None else zero_columns
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, field in enumerate(df.schema.fields):
        c = F.col(f"`{field.name}`")
        is_text = isinstance(field.dataType, T.StringType)
        aggs.append(F.count_if(c.isNull()).alias(f"null_{i}"))
        aggs.append((F.count_if(F.trim(c) == "") if is_text else F.lit(0)).alias(f"blank_{i}"))
        checked = field.name in zero_columns and not is_text
        aggs.append((F.count_if(c == 0) if checked else F.lit(0)).alias(f"zero_{i}"))
    structs = [
        F.struct(
            F.lit(field.name).alias("column"),
            F.col(f"null_{i}").cast("long").alias("nulls"),
            F.bround(F.try_divide(F.col(f"null_{i}") * 100.0, F.col("rows")), 2).alias("null_pct"),
            F.col(f"blank_{i}").cast("long").alias("blanks"),
            F.col(f"zero_{i}").cast("long").alias("zeros"),
        )
        for i, field in enumerate(df.schema.fields)
    ]
    report = df.agg(*aggs).select(F.explode(F.array(*structs)).alias("e")).select("e.*")
    return report.orderBy(F.desc("null_pct"), "column")


def completeness(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: nulls per key column that is present, their total, and whether all are filled."""
    wanted = COMPLETENESS_COLUMNS if columns is None else columns
    present = [c for c in wanted if c in df.columns]
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in present])
    total = F.lit(0)
    for c in present:
        total = total + F.col(f"{c}_nulls")
    return row.withColumn("total_nulls", total).withColumn("complete", F.col("total_nulls") == 0)


def drop_report(df: DataFrame, keep) -> DataFrame:
    """Row counts before and after a filter, and the dropped share, in one pass."""
    kept = F.count_if(F.coalesce(keep, F.lit(False)))
    rows = F.count(F.lit(1))
    return df.agg(
        rows.alias("rows_before"),
        kept.alias("rows_after"),
        (rows - kept).alias("dropped"),
        F.try_divide((rows - kept) * 100.0, rows).alias("dropped_pct"),
    )


def distinct_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """Exact number of complete, distinct key combinations."""
    return complete_on(df.select(*keys), keys).distinct().agg(F.count(F.lit(1)).alias("distinct_keys"))
