"""Filters, projections and conformance over whole tables (F*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from landgauge.catalog.parsing import LISTING_SQL, listings
from landgauge.catalog.registry import query, table
from landgauge.catalog.tables import RAW_SQL, TYPED_SQL, raw_trades
from landgauge.constants import BASE_FEATURES
from landgauge.operators import filters as O
from landgauge.operators import profile
from landgauge.operators.model import model_input
from landgauge.operators.regions import mapped_or_same
from landgauge.plans.trades import typed_trades

KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
KEYS_SQL = ", ".join(KEYS)
TYPED = f"WITH {RAW_SQL}, {TYPED_SQL}"


def _typed(spark, sf):
    return typed_trades(raw_trades(spark, sf))


@query(
    "f1_valid_deals",
    f"""WITH {RAW_SQL} SELECT {KEYS_SQL}, "dealingGbn", "cdealType" FROM raw
    WHERE ("cdealType" IS NULL OR "cdealType" <> 'O') AND ("dealingGbn" IS NULL OR "dealingGbn" <> '직거래')""",
)
def valid_deals(spark, sf):
    return O.valid_deals(raw_trades(spark, sf)).select(*KEYS, "dealingGbn", "cdealType")


@query(
    "f2_plausible_prices",
    f"""{TYPED} SELECT {KEYS_SQL}, "dealAmount" FROM typed WHERE "dealAmount" BETWEEN 3900 AND 82000""",
)
def plausible_prices(spark, sf):
    return O.plausible_prices(_typed(spark, sf)).select(*KEYS, "dealAmount")


@query(
    "f2b_within_quantiles",
    f"""{TYPED}, edge AS (SELECT quantile_cont("dealAmount", 0.02) AS lo, quantile_cont("dealAmount", 0.98) AS hi FROM typed)
    SELECT {KEYS_SQL}, "dealAmount" FROM typed, edge WHERE "dealAmount" BETWEEN lo AND hi""",
)
def within_quantiles(spark, sf):
    return O.within_quantiles(_typed(spark, sf), "dealAmount").select(*KEYS, "dealAmount")


@query(
    "f3_complete_rows",
    f"""{TYPED} SELECT {KEYS_SQL} FROM typed
    WHERE "umdNm" IS NOT NULL AND "buildYear" IS NOT NULL AND "excluUseAr" IS NOT NULL""",
)
def complete_rows(spark, sf):
    return O.complete_on(_typed(spark, sf), ["umdNm", "buildYear", "excluUseAr"]).select(*KEYS)


@query(
    "f4_needs_fill",
    f"""{TYPED} SELECT {KEYS_SQL} FROM typed WHERE "buildYear" IS NULL AND floor IS NOT NULL""",
)
def needs_fill(spark, sf):
    return O.needs_fill(_typed(spark, sf), "buildYear", "floor").select(*KEYS)


@query(
    "f5_drop_matching",
    """SELECT event_id, err FROM (SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL
         WHEN event_id % 4 = 1 THEN 'WINERROR ' || event_type ELSE event_type END AS err FROM events)
       WHERE err IS NULL OR NOT regexp_matches(err, '(?i)winerror|View')""",
)
def drop_matching(spark, sf):
    e = F.col("event_id")
    text = (
        F.when(e % 4 == 0, None)
        .when(e % 4 == 1, F.concat(F.lit("WINERROR "), F.col("event_type")))
        .otherwise(F.col("event_type"))
    )
    events = table(spark, sf, "events").select("event_id", text.alias("err"))
    return O.drop_matching(events, "err", "winerror|View")


@query(
    "f6_reshape_columns",
    f"""WITH {RAW_SQL} SELECT {KEYS_SQL}, "dealYear" AS year_of_deal, "buildYear" FROM raw""",
)
def reshape_columns(spark, sf):
    trades = O.drop_present(raw_trades(spark, sf), ["rgstDate", "not_there"])
    keep = [c for c in O.columns_containing(trades, "Year")]
    return trades.select(*KEYS, *keep).withColumnsRenamed({"dealYear": "year_of_deal"})


@query(
    "f7_model_projection",
    f"""WITH {RAW_SQL}, {TYPED_SQL}, {LISTING_SQL} SELECT {KEYS_SQL},
      "excluUseAr", "landAr", CAST(floor AS DOUBLE) AS floor, CAST("Age" AS DOUBLE) AS "Age", parking_ratio,
      CAST(has_elevator AS DOUBLE) AS has_elevator, CAST(total_floors AS DOUBLE) AS total_floors, subway_dist
    FROM listing""",
)
def model_projection(spark, sf):
    rows = listings(spark, sf)
    present = [c for c in BASE_FEATURES if c in rows.columns]
    return model_input(rows, present).select(*KEYS, *present)


@query(
    "f8_unify_house_type",
    f"""WITH {RAW_SQL} SELECT {KEYS_SQL},
      CASE WHEN "houseType" = '연립다세대' THEN '연립' ELSE "houseType" END AS "houseType" FROM raw""",
)
def unify_house_type(spark, sf):
    return O.unify_house_type(raw_trades(spark, sf)).select(*KEYS, "houseType")


@query(
    "f9_mapped_or_same",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '5-LOW' THEN 'low'
         ELSE o_orderpriority END AS priority FROM orders""",
)
def mapped(spark, sf):
    short = {"1-URGENT": "urgent", "5-LOW": "low"}
    return table(spark, sf, "orders").select(
        "o_orderkey", mapped_or_same("o_orderpriority", short).alias("priority")
    )


@query(
    "f10_blank_where_error",
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value,
         CASE WHEN event_type <> 'error' THEN user_id END AS user_id FROM events""",
)
def blank_where_error(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id", "value", "user_id",
        F.when(F.col("event_type") == "error", F.col("event_type")).alias("error"),
    )
    return O.blank_where_error(events, ["value", "user_id"]).drop("error")


@query(
    "f11_conform",
    f"""WITH {RAW_SQL} SELECT {KEYS_SQL}, TRY_CAST("excluUseAr" AS DOUBLE) AS "excluUseAr",
      TRY_CAST(floor AS DOUBLE) AS floor, CAST(replace("dealAmount", ',', '') AS DOUBLE) AS "dealAmount",
      CAST("dealYear" AS DOUBLE) - TRY_CAST("buildYear" AS DOUBLE) AS "Age", "umdNm",
      CAST("dealYear" AS INTEGER) AS "dealYear", 10 AS absent FROM raw""",
)
def conform(spark, sf):
    rows, absent = O.conform(raw_trades(spark, sf))
    columns = ["excluUseAr", "floor", "dealAmount", "Age", "umdNm", "dealYear"]
    return rows.select(*KEYS, *columns, F.lit(len(absent)).alias("absent"))


@query(
    "f12_completeness",
    f"""WITH {RAW_SQL}, {TYPED_SQL}, {LISTING_SQL}
    SELECT p AS parking_ratio_nulls, e AS has_elevator_nulls, t AS total_floors_nulls, p + e + t AS total_nulls,
      p + e + t = 0 AS complete FROM (
      SELECT count(*) FILTER (WHERE parking_ratio IS NULL) AS p, count(*) FILTER (WHERE has_elevator IS NULL) AS e,
        count(*) FILTER (WHERE total_floors IS NULL) AS t FROM listing)""",
)
def completeness(spark, sf):
    return profile.completeness(listings(spark, sf))


