"""Monthly land-price index: wide -> long, one row per region and month, gaps filled, joined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landgauge.constants import INDEX_KEYS, SINGLE_REGION_LABEL
from landgauge.functions import numeric as N
from landgauge.functions import parsing as P
from landgauge.operators.filters import columns_containing
from landgauge.session import measured

MONTH = ["dealYear", "dealMonth"]


def wide_to_long(wide: DataFrame, region_prefix: str = "지역") -> DataFrame:
    """(sido, land_region, district, dealYear, dealMonth, land_index) rows that hold a number.

    Region columns are taken by position: province, then region, then district. A file without
    a second level covers one region, which gets the constant label.
    """
    months = columns_containing(wide, "년")
    levels = [c for c in wide.columns if c.startswith(region_prefix)]
    lifted = wide.select(
        F.col(f"`{levels[0]}`").alias("sido"),
        (F.col(f"`{levels[1]}`") if len(levels) > 1 else F.lit(SINGLE_REGION_LABEL)).alias(
            "land_region"
        ),
        F.col(f"`{levels[-1]}`").alias("district"),
        *[F.col(f"`{m}`").cast("string").alias(m) for m in months],
    )
    long = lifted.unpivot(
        ["sido", "land_region", "district"], [F.col(f"`{m}`") for m in months], "month", "raw"
    )
    return long.select(
        "sido",
        "land_region",
        "district",
        P.header_year("month").alias("dealYear"),
        P.header_month("month").alias("dealMonth"),
        P.lenient_double("raw").alias("land_index"),
    ).dropna(subset=["land_index"])


def union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def one_per_month(long: DataFrame) -> DataFrame:
    """Unique (sido, land_region, month): the row of the whole region wins over its districts."""
    whole_first = F.struct(
        (F.col("district") != F.col("land_region")).cast("int"), F.col("district")
    )
    return long.groupBy(*INDEX_KEYS, *MONTH).agg(
        F.min_by("land_index", whole_first).alias("land_index")
    )


def latest_index(index: DataFrame) -> DataFrame:
    """Newest index value per region."""
    return index.groupBy(*INDEX_KEYS).agg(
        F.max_by("land_index", month_no()).alias("current_land_index")
    )


def month_grid(index: DataFrame, trades: DataFrame) -> DataFrame:
    """Every (region, month) that the index or a trade mentions, with the index where known."""
    keys = [*INDEX_KEYS, *MONTH]
    asked = trades.select(*keys).dropna(subset=keys)
    grid = index.select(*keys).unionByName(asked).distinct()
    return grid.join(index, keys, "left")


def fill_months(
    grid: DataFrame, value: str = "land_index", order: list[str] | None = None
) -> DataFrame:
    """Carry the last known value forward, then the first known one back, inside each region."""
    w = Window.partitionBy(*INDEX_KEYS).orderBy(*(order or MONTH))
    before = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    filled = F.coalesce(
        F.last(value, ignorenulls=True).over(before),
        F.first(value, ignorenulls=True).over(after),
    )
    return grid.withColumn(value, filled)


def month_no(year: str = "dealYear", month: str = "dealMonth") -> Column:
    return F.col(year) * 12 + F.col(month) - 1


def calendar_grid(index: DataFrame, first: int, last: int) -> DataFrame:
    """Every region with every month number from ``first`` to ``last``, with the index where known."""
    known = index.withColumn("month_no", month_no()).drop(*MONTH)
    regions = index.select(*INDEX_KEYS).distinct()
    months = F.explode(F.sequence(F.lit(first), F.lit(last)))
    return regions.withColumn("month_no", months).join(known, [*INDEX_KEYS, "month_no"], "left")


def attach_index(trades: DataFrame, index: DataFrame) -> DataFrame:
    """land_index at the deal month, current_land_index and Time_Adjustment of each trade.

    Beyond the months of the index the filled value no longer changes, so a trade's month is moved
    to the nearest index month instead of growing the grid by the months of the trades. The trades are
    read once and meet one small table, whose size is measured before the join is planned.
    """
    first, last = index.agg(F.min(month_no()), F.max(month_no())).first()
    if first is None:
        empty = {c: F.lit(None).cast("double") for c in ("land_index", "current_land_index")}
        return trades.withColumns({**empty, "Time_Adjustment": F.lit(None).cast("double")})
    grid = fill_months(calendar_grid(index, first, last), order=["month_no"])
    grid = measured(grid.join(latest_index(index), INDEX_KEYS, "left"))
    nearest = N.at_most(N.at_least(month_no(), first), last)
    joined = trades.withColumn("month_no", nearest).join(grid, [*INDEX_KEYS, "month_no"], "left")
    return joined.drop("month_no").withColumn(
        "Time_Adjustment", N.time_adjustment("current_land_index", "land_index")
    )
