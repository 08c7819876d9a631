"""Regression quality on the original price scale."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landgauge.functions import numeric as N


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row: rows, r2, mae, mape (percent)."""
    y, p = F.col(actual), F.col(predicted)
    scored = df.where(y.isNotNull() & p.isNotNull())
    n = F.count(F.lit(1))
    residual = F.sum((y - p) * (y - p))
    return scored.agg(
        n.alias("rows"),
        (F.lit(1.0) - F.try_divide(residual, F.var_pop(y) * n)).alias("r2"),
        F.avg(F.abs(y - p)).alias("mae"),
        F.avg(N.absolute_pct_error(actual, predicted)).alias("mape"),
    )


def error_histogram(df: DataFrame, actual: str, predicted: str, bins: int = 50) -> DataFrame:
    """Equal-width histogram of the absolute percentage error: bin, lower, upper, rows."""
    errors = df.select(N.absolute_pct_error(actual, predicted).alias("e")).dropna()
    span = errors.agg(F.min("e").alias("lo"), F.max("e").alias("hi"))
    lo, hi = span.select("lo").scalar(), span.select("hi").scalar()
    width = (F.col("hi") - F.col("lo")) / bins
    placed = errors.withColumn("lo", lo).withColumn("hi", hi)
    # The last bin is closed; a single value fills the first bin.
    slot = F.least(F.floor(F.try_divide(F.col("e") - F.col("lo"), width)) + 1, F.lit(bins))
    counts = placed.groupBy(F.coalesce(slot, F.lit(1)).cast("long").alias("bin")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    frame = df.sparkSession.range(1, bins + 1).withColumnRenamed("id", "bin")
    return (
        frame.join(counts, "bin", "left")
        .withColumn("lo", lo)
        .withColumn("hi", hi)
        .select(
            "bin",
            (F.col("lo") + width * (F.col("bin") - 1)).alias("lower"),
            (F.col("lo") + width * F.col("bin")).alias("upper"),
            F.coalesce("rows", F.lit(0)).cast("long").alias("rows"),
        )
    )


def fit_line(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Least-squares line of predicted over actual, and its r2."""
    y, x = F.col(predicted).cast("double"), F.col(actual).cast("double")
    return df.agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("line_r2"),
    )
