"""Aggregates, profiles and metrics over whole tables (A*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from landgauge.catalog.filters import TYPED
from landgauge.catalog.registry import query, table
from landgauge.catalog.tables import (
    INDEX_SQL,
    PROPERTIES_SQL,
    RAW_SQL,
    REGION_SQL,
    TYPED_SQL,
    properties,
    raw_trades,
    wide_index,
)
from landgauge.operators import impute, metrics, nearest, profile
from landgauge.operators.encode import target_means
from landgauge.operators.land_index import latest_index, one_per_month, wide_to_long
from landgauge.plans.trades import typed_trades


def _typed(spark, sf):
    return typed_trades(raw_trades(spark, sf))


def rounded(df, *columns, digits=4):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query(
    "a1_station_centroids",
    f"""WITH {PROPERTIES_SQL} SELECT subway_name, round(avg(lat), 6) AS lat, round(avg(lng), 6) AS lng
    FROM props WHERE lat IS NOT NULL AND subway_name IS NOT NULL GROUP BY 1""",
)
def station_centroids(spark, sf):
    return rounded(nearest.station_centroids(properties(spark, sf)), "lat", "lng", digits=6)


@query(
    "a2_latest_index",
    f"""WITH {REGION_SQL}, {INDEX_SQL} SELECT sido, land_region,
      max_by(land_index, "dealYear" * 12 + "dealMonth") AS current_land_index FROM index_rows GROUP BY ALL""",
)
def newest_index(spark, sf):
    return latest_index(one_per_month(wide_to_long(wide_index(spark, sf))))


@query(
    "a3_group_median",
    f"""{TYPED} SELECT "umdNm", median("buildYear") AS build, median(floor) AS floor, median("Age") AS age
    FROM typed WHERE "umdNm" IS NOT NULL GROUP BY 1""",
)
def group_median(spark, sf):
    names = {"buildYear": "build", "floor": "floor", "Age": "age"}
    typed = _typed(spark, sf)
    medians = impute.group_medians(typed, list(names), ["umdNm"])
    every = typed.dropna(subset=["umdNm"]).select("umdNm").distinct().join(medians, "umdNm", "left")
    return every.select("umdNm", *[F.col(f"_median_{c}").alias(n) for c, n in names.items()])


@query(
    "a4_group_mean_back",
    f"""{TYPED} SELECT l_orderkey, l_linenumber, l_partkey,
      CASE WHEN "umdNm" IS NOT NULL THEN round(avg("excluUseAr") OVER (PARTITION BY "umdNm"), 6) END AS mean_area FROM typed""",
)
def group_mean_back(spark, sf):
    stat = {"mean_area": F.round(F.avg("excluUseAr"), 6)}
    rows = impute.with_group_stat(_typed(spark, sf), ["umdNm"], stat)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "mean_area")


@query(
    "a5_global_median",
    """SELECT c AS "column", 0.5::DOUBLE AS prob, median(v) AS value FROM (
         SELECT unnest(['l_extendedprice', 'l_quantity']) AS c, unnest([l_extendedprice, l_quantity]) AS v FROM lineitem)
       GROUP BY 1""",
)
def global_median(spark, sf):
    line = table(spark, sf, "lineitem")
    return profile.exact_quantiles(line, ["l_extendedprice", "l_quantity"], [0.5])


@query(
    "a6_target_mean",
    f"""{TYPED} SELECT "umdNm", round(avg(ln(1 + "Price_per_m2")), 6) AS "umdNm_encoded" FROM typed
    WHERE "umdNm" IS NOT NULL GROUP BY 1""",
)
def target_mean(spark, sf):
    rows = _typed(spark, sf).withColumn("logged", F.log1p("Price_per_m2"))
    return rounded(target_means(rows, "umdNm", "logged"), "umdNm_encoded", digits=6)


@query(
    "a7_describe",
    """SELECT c AS "column", unnest(['count', 'mean', 'std', 'min', 'max', '25%', '50%', '75%']) AS stat,
         round(unnest([count(v)::DOUBLE, avg(v), stddev_samp(v), min(v), max(v), quantile_cont(v, 0.25),
           quantile_cont(v, 0.5), quantile_cont(v, 0.75)]), 4) AS value
       FROM (SELECT unnest(['o_totalprice', 'logged']) AS c, unnest([o_totalprice, ln(1 + o_totalprice)]) AS v FROM orders)
       GROUP BY 1""",
)
def describe(spark, sf):
    orders = table(spark, sf, "orders").withColumn("logged", F.log1p("o_totalprice"))
    return rounded(profile.describe(orders, ["o_totalprice", "logged"]), "value")


@query(
    "a8_target_profile",
    f"""{TYPED} SELECT 'dealAmount' AS "column", unnest(['mean', 'min', 'max', 'lower_2pct', 'median', 'upper_2pct']) AS stat,
      round(unnest([avg("dealAmount"), min("dealAmount")::DOUBLE, max("dealAmount")::DOUBLE, quantile_cont("dealAmount", 0.02),
        quantile_cont("dealAmount", 0.5), quantile_cont("dealAmount", 0.98)]), 4) AS value FROM typed""",
)
def target_profile(spark, sf):
    return rounded(profile.target_profile(_typed(spark, sf)), "value")


def _profile_sql(columns: dict[str, str]) -> str:
    """``columns``: name -> kind ('text', 'zero' or 'other')."""
    parts = [
        f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE "{c}" IS NULL) AS nulls,
          round_even(count(*) FILTER (WHERE "{c}" IS NULL) * 100.0::DOUBLE / count(*), 2) AS null_pct,
          {f'''count(*) FILTER (WHERE trim("{c}") = '')''' if kind == "text" else "0::BIGINT"} AS blanks,
          {f'''count(*) FILTER (WHERE "{c}" = 0)''' if kind == "zero" else "0::BIGINT"} AS zeros FROM mixed"""
        for c, kind in columns.items()
    ]
    return " UNION ALL ".join(parts)


PROFILED = {
    "umdNm": "text", "jibun": "text", "mhouseNm": "text", "excluUseAr": "zero", "landAr": "zero",
    "dealAmount": "zero", "floor": "other", "Age": "other", "raw_year": "text",
}


@query(
    "a9_column_profile",
    f"""WITH {RAW_SQL}, {TYPED_SQL}, mixed AS (SELECT "umdNm", jibun, "mhouseNm", "excluUseAr", "landAr" - 3 AS "landAr",
      "dealAmount", floor, "Age", CASE WHEN l_partkey % 13 = 0 THEN ' ' ELSE CAST("buildYear" AS VARCHAR) END AS raw_year FROM typed)
    {_profile_sql(PROFILED)}""",
)
def column_profile(spark, sf):
    rows = _typed(spark, sf).withColumn(
        "raw_year",
        F.when(F.col("l_partkey") % 13 == 0, " ").otherwise(F.col("buildYear").cast("string")),
    )
    rows = rows.withColumn("landAr", F.col("landAr") - 3).select(*PROFILED)
    return profile.column_profile(rows)


@query(
    "a10_drop_report",
    f"""{TYPED} SELECT count(*) AS rows_before, count(*) FILTER (WHERE "dealAmount" BETWEEN 3900 AND 82000) AS rows_after,
      count(*) FILTER (WHERE NOT ("dealAmount" BETWEEN 3900 AND 82000)) AS dropped,
      round(count(*) FILTER (WHERE NOT ("dealAmount" BETWEEN 3900 AND 82000)) * 100.0::DOUBLE / count(*), 6) AS dropped_pct
    FROM typed""",
)
def drop_report(spark, sf):
    report = profile.drop_report(_typed(spark, sf), F.col("dealAmount").between(3900, 82000))
    return rounded(report, "dropped_pct", digits=6)


@query(
    "a11_distinct_count",
    f"""{TYPED} SELECT count(*) AS distinct_keys FROM (SELECT DISTINCT "sggCd", "umdNm", jibun FROM typed
    WHERE "umdNm" IS NOT NULL AND "sggCd" IS NOT NULL AND jibun IS NOT NULL)""",
)
def distinct_count(spark, sf):
    return profile.distinct_count(_typed(spark, sf), ["sggCd", "umdNm", "jibun"])


PREDICTED_SQL = """
predicted AS (
  SELECT o_orderkey, o_totalprice AS actual,
    o_totalprice * (0.8::DOUBLE + (o_orderkey * 7919 % 1009) / 1009.0::DOUBLE * 0.5::DOUBLE) + o_custkey AS predicted
  FROM orders)
"""


def predictions(spark, sf):
    noise = F.lit(0.8) + F.col("o_orderkey") * 7919 % 1009 / 1009.0 * 0.5
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").alias("actual"),
        (F.col("o_totalprice") * noise + F.col("o_custkey")).alias("predicted"),
    )


@query(
    "a12_regression_metrics",
    f"""WITH {PREDICTED_SQL} SELECT count(*) AS rows,
      round(1 - sum(power(actual - predicted, 2)) / (var_pop(actual) * count(*)), 6) AS r2,
      round(avg(abs(actual - predicted)), 4) AS mae, round(avg(abs((actual - predicted) / actual)) * 100, 6) AS mape
    FROM predicted""",
)
def regression_metrics(spark, sf):
    row = metrics.regression_metrics(predictions(spark, sf), "actual", "predicted")
    return rounded(rounded(row, "r2", "mape", digits=6), "mae")


@query(
    "a13_error_histogram",
    f"""WITH {PREDICTED_SQL}, e AS (SELECT abs((actual - predicted) / actual) * 100 AS e FROM predicted),
    s AS (SELECT min(e) AS lo, max(e) AS hi, (max(e) - min(e)) / 50 AS w FROM e),
    c AS (SELECT least(CAST(floor((e - lo) / w) AS BIGINT) + 1, 50) AS bin, count(*) AS n FROM e, s GROUP BY 1)
    SELECT CAST(b.bin AS BIGINT) AS bin, round(lo + w * (b.bin - 1), 4) AS lower, round(lo + w * b.bin, 4) AS upper,
      CAST(coalesce(n, 0) AS BIGINT) AS rows
    FROM (SELECT unnest(generate_series(1, 50)) AS bin) b CROSS JOIN s LEFT JOIN c ON b.bin = c.bin""",
)
def error_histogram(spark, sf):
    return rounded(metrics.error_histogram(predictions(spark, sf), "actual", "predicted"), "lower", "upper")


@query(
    "a14_fit_line",
    f"""WITH {PREDICTED_SQL} SELECT round(regr_slope(predicted, actual), 6) AS slope,
      round(regr_intercept(predicted, actual), 3) AS intercept, round(regr_r2(predicted, actual), 6) AS line_r2 FROM predicted""",
)
def fit_line(spark, sf):
    row = metrics.fit_line(predictions(spark, sf), "actual", "predicted")
    return rounded(rounded(row, "slope", "line_r2", digits=6), "intercept", digits=3)
