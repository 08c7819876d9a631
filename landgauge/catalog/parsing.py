"""Scalar parsing and arithmetic functions over whole tables (P*, M*)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F

from landgauge.catalog.registry import query, table
from landgauge.catalog.tables import (
    PROPERTIES_SQL,
    RAW_SQL,
    TYPED_SQL,
    distance_sql,
    properties,
    raw_trades,
)
from landgauge.functions import numeric as N
from landgauge.functions import parsing as P
from landgauge.functions import text as X
from landgauge.plans.trades import typed_trades
from landgauge.session import dealt

KEYS = ["l_orderkey", "l_linenumber", "l_partkey"]
KEYS_SQL = "l_orderkey, l_linenumber, l_partkey"
RAW = f"WITH {RAW_SQL} SELECT {KEYS_SQL}, "
TYPED = f"WITH {RAW_SQL}, {TYPED_SQL} SELECT {KEYS_SQL}, "


def _raw(name: str, columns: Callable[[], dict], sql: str) -> None:
    """Register expressions over the raw text columns; they are built when the query runs."""

    def run(spark, sf):
        return raw_trades(spark, sf).select(*KEYS, *[c.alias(n) for n, c in columns().items()])

    query(name, f"{RAW}{sql}" if " FROM (" in sql else f"{RAW}{sql} FROM raw")(run)


def _typed(name: str, columns: Callable[[], dict], sql: str) -> None:
    """Register expressions over the typed columns."""

    def run(spark, sf):
        typed = typed_trades(raw_trades(spark, sf))
        return typed.select(*KEYS, *[c.alias(n) for n, c in columns().items()])

    query(name, f"{TYPED}{sql} FROM typed")(run)


def register() -> None:
    c, lit = F.col, F.lit
    _raw("p1_strict_long", lambda: {"amount": P.strict_long("dealAmount")},
         """CAST(replace("dealAmount", ',', '') AS BIGINT) AS amount""")
    _raw("p2_lenient_number",
         lambda: {"build": P.lenient_double("buildYear"), "amount": P.lenient_double("dealAmount")},
         """TRY_CAST("buildYear" AS DOUBLE) AS build,
            TRY_CAST(replace("dealAmount", ',', '') AS DOUBLE) AS amount""")
    _raw("p3_int_or_zero", lambda: {"year": P.int_or_zero("buildYear")},
         """CAST(coalesce(TRY_CAST("buildYear" AS DOUBLE), 0) AS INTEGER) AS year""")
    _raw("p4_text_or_null",
         lambda: {"name": P.text_or_null(F.when(c("l_partkey") % 4 == 0, lit("nan")).otherwise(c("jibun")))},
         """nullif(CASE WHEN l_partkey % 4 = 0 THEN 'nan' ELSE jibun END, 'nan') AS name""")
    # Days run to 31 in every month, so that some do not exist.
    day = lambda: (c("l_partkey") % 31 + 1).cast("string")
    _raw("p5_deal_date",
         lambda: {"deal_date": P.deal_date("dealYear", "dealMonth", day()).cast("string"),
          "approval": P.lenient_date(F.concat("dealYear", F.lpad("dealMonth", 2, "0"), day())).cast("string")},
         """CAST(coalesce(TRY_CAST(printf('%04d-%02d-%02d', CAST("dealYear" AS INTEGER), CAST("dealMonth" AS INTEGER),
              CAST(l_partkey % 31 + 1 AS INTEGER)) AS DATE),
              make_date(CAST("dealYear" AS BIGINT), 1, 1)) AS VARCHAR) AS deal_date,
            CASE WHEN l_partkey % 31 + 1 >= 10 THEN CAST(TRY_CAST(printf('%04d-%02d-%02d',
              CAST("dealYear" AS INTEGER), CAST("dealMonth" AS INTEGER), CAST(l_partkey % 31 + 1 AS INTEGER)) AS DATE) AS VARCHAR)
            END AS approval""")
    _raw("p6_region_code",
         lambda: {"code": P.region_code("sggCd"), "short": P.region_code(F.concat((c("l_suppkey") % 999).cast("string"), lit(".0")))},
         """lpad(CAST(CAST(CAST("sggCd" AS DOUBLE) AS INTEGER) AS VARCHAR), 5, '0') AS code,
            lpad(CAST(l_suppkey % 999 AS VARCHAR), 5, '0') AS short""")
    odd = lambda: F.when(c("l_partkey") % 29 == 0, "").when(c("l_partkey") % 29 == 1, " 산 5-1 ") \
        .when(c("l_partkey") % 29 == 2, "12345").when(c("l_partkey") % 29 == 3, "1-2-3") \
        .when(c("l_partkey") % 29 == 4, None).otherwise(c("jibun"))
    _raw("p7_lot_number", lambda: {"bun": P.lot_number(odd())["bun"], "ji": P.lot_number(odd())["ji"]},
         """CASE WHEN lot IS NULL THEN NULL WHEN length(bun) < 4 THEN lpad(bun, 4, '0') ELSE bun END AS bun,
            CASE WHEN lot IS NULL THEN NULL WHEN length(ji) < 4 THEN lpad(ji, 4, '0') ELSE ji END AS ji
            FROM (SELECT *, trim(split_part(lot, '-', 1)) AS bun, trim(split_part(lot, '-', 2)) AS ji
            FROM (SELECT *, nullif(trim(CASE l_partkey % 29 WHEN 0 THEN '' WHEN 1 THEN ' 산 5-1 ' WHEN 2 THEN '12345'
              WHEN 3 THEN '1-2-3' WHEN 4 THEN NULL ELSE jibun END), '') AS lot FROM raw) raw)""")
    header = lambda: F.concat(c("dealYear"), lit("년"), F.when(c("l_partkey") % 2 == 0, " ").otherwise(""), c("dealMonth"), lit("월"))
    _raw("p8_header_month", lambda: {"y": P.header_year(header()), "m": P.header_month(header())},
         """CAST("dealYear" AS INTEGER) AS y, CAST("dealMonth" AS INTEGER) AS m""")
    _raw("p9_building_name", lambda: {"name": P.building_name("mhouseNm")},
         """coalesce(nullif(trim(regexp_replace(regexp_replace("mhouseNm",
              '[^a-zA-Z0-9가-힣\\s(),]', '', 'g'), '\\s+', ' ', 'g')), ''), '미명명 단지') AS name""")
    path = lambda: F.concat_ws(" ", lit("prov"), c("umdNm"), c("houseType"))
    _raw("p10_name_tokens",
         lambda: {"first": P.first_token(path()), "last": P.last_token(path()), "tokens": P.token_count(path())},
         """'prov' AS first, "houseType" AS last,
            CAST(CASE WHEN "umdNm" IS NULL THEN 2 ELSE 3 END AS INTEGER) AS tokens""")
    _raw("p11_code_prefix",
         lambda: {"prefix": F.substring("sggCd", 1, 4), "is_city": c("sggCd").endswith("0"), "first_region": c("sggCd").startswith("1")},
         """substr("sggCd", 1, 4) AS prefix, ends_with("sggCd", '0') AS is_city,
            starts_with("sggCd", '1') AS first_region""")
    own = lambda: F.when(c("l_partkey") % 3 == 0, "").when(c("l_partkey") % 3 == 1, F.concat("dealYear", lit("0115103000")))
    _raw("p12_compact_date", lambda: {"approved": P.compact_date(own(), "buildYear")},
         """substr(trim(coalesce(nullif(CASE l_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN "dealYear" || '0115103000' END, ''),
              nullif("buildYear", ''), '')), 1, 8) AS approved""")
    zeros = lambda: F.when(c("l_partkey") % 3 == 0, "0").when(c("l_partkey") % 3 == 1, "")
    _raw("p13_first_filled", lambda: {"lifts": P.first_filled_number(zeros(), "floor", default=9)},
         """coalesce(TRY_CAST(floor AS DOUBLE), 9.0::DOUBLE) AS lifts""")
    _raw("p14_address", lambda: {"address": P.address("sggCd", "umdNm", "jibun")},
         """trim(concat_ws(' ', "sggCd", "umdNm", jibun)) AS address""")
    _typed("p16_amount_text",
           lambda: {"amount": X.amount_text(c("dealAmount")),
            "round_amount": X.amount_text(F.expr("dealAmount div 10000 * 10000")),
            "none": X.amount_text(F.when(c("l_partkey") % 2 == 0, c("dealAmount")))},
           """CASE WHEN "dealAmount" >= 10000 THEN ("dealAmount" // 10000) || '억 ' ELSE '' END
              || CASE WHEN "dealAmount" % 10000 > 0 THEN format('{:,}', "dealAmount" % 10000) || '만 원' ELSE '원' END AS amount,
              CASE WHEN "dealAmount" >= 10000 THEN ("dealAmount" // 10000) || '억 원' ELSE '원' END AS round_amount,
              CASE WHEN l_partkey % 2 <> 0 THEN '원' ELSE CASE WHEN "dealAmount" >= 10000 THEN ("dealAmount" // 10000) || '억 ' ELSE '' END
              || CASE WHEN "dealAmount" % 10000 > 0 THEN format('{:,}', "dealAmount" % 10000) || '만 원' ELSE '원' END END AS none""")
    ratio = lambda: c("l_orderkey") % 160 / 100.0
    _typed("p19_number_text", lambda: {"area": X.rounded_text(c("excluUseAr") + ratio()), "ratio": X.short_number_text(ratio())},
           """CAST(CAST(round_even("excluUseAr" + (l_orderkey % 160) / 100.0::DOUBLE, 1) AS DECIMAL(18, 1)) AS VARCHAR) AS area,
              CAST(round_even((l_orderkey % 160) / 100.0::DOUBLE, 2) AS VARCHAR) AS ratio""")
    _typed("m1_unit_price", lambda: {"price": N.unit_price("dealAmount", "excluUseAr"),
                             "by_zero": N.unit_price("dealAmount", c("l_partkey") % 3)},
           """"dealAmount" / "excluUseAr" AS price,
              CASE WHEN l_partkey % 3 <> 0 THEN "dealAmount" / CAST(l_partkey % 3 AS DOUBLE) END AS by_zero""")
    _typed("m2_nominal_price", lambda: {"nominal": N.nominal_price("dealAmount", "excluUseAr")},
           """"dealAmount" * 10000 / "excluUseAr" AS nominal""")
    _typed("m4_ages", lambda: {"age": N.age("dealYear", "buildYear"), "clipped": N.deal_age("dealYear", "buildYear")},
           """"dealYear" - "buildYear" AS age,
              CASE WHEN "dealYear" - "buildYear" < 0 THEN 0 ELSE "dealYear" - "buildYear" END AS clipped""")
    _typed("m5_log_price",
           lambda: {"logged": F.round(N.log_price(N.nominal_price("dealAmount", "excluUseAr")), 6),
            "restored": F.round(N.price_from_log(N.log_price(c("excluUseAr"))), 6)},
           """round(ln(1 + "dealAmount" * 10000 / "excluUseAr"), 6) AS logged, round("excluUseAr", 6) AS restored""")
    metres = lambda: F.when(c("l_partkey") % 9 != 0, (c("l_partkey") * 7 % 3000).cast("double"))
    metres_sql = "CASE WHEN l_partkey % 9 <> 0 THEN CAST(l_partkey * 7 % 3000 AS DOUBLE) END"
    _typed("m6_capped_distance", lambda: {"capped": N.capped_distance(metres())},
           f"CASE WHEN {metres_sql} > 1500 THEN 1500.0::DOUBLE ELSE {metres_sql} END AS capped")
    _typed("m7_subway_area", lambda: {"near": N.subway_area(metres())},
           f"CASE WHEN {metres_sql} <= 500 THEN 1 ELSE 0 END AS near")
    _typed("m8_high_floor", lambda: {"high": N.high_floor_without_elevator("floor", c("l_partkey") % 2)},
           "CASE WHEN floor >= 4 AND l_partkey % 2 = 0 THEN 1 ELSE 0 END AS high")
    _typed("m9_area_ratio", lambda: {"ratio": F.round(N.area_ratio("excluUseAr", "landAr"), 6)},
           """round(CASE WHEN "landAr" + 1e-5 <> 0 THEN "excluUseAr" / ("landAr" + 1e-5) END, 6) AS ratio""")
    count = lambda: F.when(c("l_partkey") % 4 == 0, "").otherwise((c("l_partkey") % 6).cast("string"))
    _raw("m11_parking_ratio",
         lambda: {"ratio": N.parking_ratio((c("l_linenumber") - 1).cast("string"), count(), count(), lit("1"), lit(None).cast("string"))},
         """CASE WHEN l_linenumber > 1 THEN (coalesce(TRY_CAST(CASE WHEN l_partkey % 4 = 0 THEN '' ELSE CAST(l_partkey % 6 AS VARCHAR) END AS DOUBLE), 0) * 2 + 1)
              / (l_linenumber - 1) ELSE 0.8::DOUBLE END AS ratio""")
    structure = lambda: F.when(c("l_partkey") % 4 == 0, "철근콘크리트구조").when(c("l_partkey") % 4 == 1, "Src").when(c("l_partkey") % 4 == 2, "목조")
    purpose = lambda: F.when(c("l_partkey") % 3 == 0, "제2종근린생활시설").when(c("l_partkey") % 3 == 1, "주택")
    _raw("m12_building_flags",
         lambda: {"elevator": N.elevator_flag(zeros(), "floor"), "concrete": N.concrete_flag(structure()),
          "mixed": N.mixed_use_flag(purpose()), "floors": N.floor_count("buildYear")},
         """CASE WHEN TRY_CAST(floor AS DOUBLE) > 0 THEN 1 ELSE 0 END AS elevator,
            CASE WHEN l_partkey % 4 IN (0, 1) THEN 1 ELSE 0 END AS concrete,
            CASE WHEN l_partkey % 3 = 0 THEN 1 ELSE 0 END AS mixed,
            CAST(coalesce(TRY_CAST("buildYear" AS DOUBLE), 4) AS INTEGER) AS floors""")
    _typed("m13_final_value", lambda: {"worth": F.round(N.final_value(c("Price_per_m2"), "excluUseAr"), 3)},
           """round("Price_per_m2" * "excluUseAr", 3) AS worth""")
    _typed("m14_percent_error", lambda: {"error": F.round(N.absolute_pct_error("dealAmount", c("l_partkey")), 6)},
           """round(abs(("dealAmount" - l_partkey) / CAST("dealAmount" AS DOUBLE)) * 100, 6) AS error""")


register()


@query(
    "p15_trailing_months",
    """SELECT o_orderkey, strftime(m, '%Y%m') AS ym FROM (
         SELECT o_orderkey, unnest(generate_series(CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) - INTERVAL 59 MONTH,
           CAST(date_trunc('month', o_orderdate) AS TIMESTAMP), INTERVAL 1 MONTH)) AS m FROM orders)""",
)
def trailing_months(spark, sf):
    months = P.trailing_months(F.col("o_orderdate").cast("date"))
    orders = dealt(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"))
    return orders.select("o_orderkey", F.explode(months).alias("ym"))


LISTING_SQL = """
listing AS (
  SELECT *, 'sido' || (l_suppkey % 5) AS sido, CASE WHEN l_suppkey % 7 <> 0 THEN 'gu' || (l_suppkey % 7) END AS region,
    CASE WHEN l_partkey % 4 <> 0 THEN 'station' || (l_partkey % 40) END AS subway_name,
    CASE WHEN l_partkey % 4 <> 0 THEN (l_partkey * 7 % 3000) / 8.0::DOUBLE END AS subway_dist,
    CASE WHEN l_partkey % 3 = 0 THEN 1 WHEN l_partkey % 3 = 1 THEN 0 END AS has_elevator,
    CASE WHEN l_partkey % 5 <> 0 THEN (l_partkey % 130) / 100.0::DOUBLE END AS parking_ratio,
    l_partkey % 6 + 1 AS total_floors
  FROM typed)
"""


def listings(spark, sf):
    """Typed trades with address, station and building columns."""
    p, s = F.col("l_partkey"), F.col("l_suppkey")
    return typed_trades(raw_trades(spark, sf)).withColumns(
        {
            "sido": F.concat(F.lit("sido"), (s % 5).cast("string")),
            "region": F.when(s % 7 != 0, F.concat(F.lit("gu"), (s % 7).cast("string"))),
            "subway_name": F.when(p % 4 != 0, F.concat(F.lit("station"), (p % 40).cast("string"))),
            "subway_dist": F.when(p % 4 != 0, (p * 7 % 3000) / 8.0),
            "has_elevator": F.when(p % 3 == 0, 1).when(p % 3 == 1, 0),
            "parking_ratio": F.when(p % 5 != 0, (p % 130) / 100.0),
            "total_floors": p % 6 + 1,
        }
    )


@query(
    "p17_listing_text",
    f"""WITH {RAW_SQL}, {TYPED_SQL}, {LISTING_SQL} SELECT {KEYS_SQL},
      sido || ' ' || coalesce(region, '') || ' ' || coalesce("umdNm", '') || '에 위치한 ' || "houseType" || ' '
      || coalesce("mhouseNm", '미명명 단지') || '입니다. ' || coalesce("buildYear", 2000) || '년에 건축되었으며, 전용면적은 '
      || CAST(CAST(round_even(coalesce("excluUseAr", 0), 1) AS DECIMAL(18, 1)) AS VARCHAR) || 'm2, 대지권면적은 '
      || CAST(CAST(round_even(coalesce("landAr", 0), 1) AS DECIMAL(18, 1)) AS VARCHAR) || 'm2입니다. 현재 '
      || coalesce(floor, 1) || '층 매물로, ' || "dealYear" || '년 ' || "dealMonth" || '월에 '
      || CASE WHEN "dealAmount" >= 10000 THEN ("dealAmount" // 10000) || '억 ' ELSE '' END
      || CASE WHEN "dealAmount" % 10000 > 0 THEN format('{{:,}}', "dealAmount" % 10000) || '만 원' ELSE '원' END
      || '에 거래되었습니다. 가장 가까운 지하철역은 ' || coalesce(subway_name, '알 수 없는 역') || '이며 거리는 '
      || CAST(trunc(coalesce(subway_dist, 0)) AS INTEGER) || 'm입니다. '
      || CASE WHEN has_elevator = 1 THEN '엘리베이터가 있으며' ELSE '엘리베이터가 없으며' END || ' '
      || CASE WHEN parking_ratio >= 1 THEN '주차 비율 조건을 충족합니다.' WHEN parking_ratio IS NULL THEN '주차 정보가 없습니다.'
         ELSE '주차 비율은 ' || CAST(round_even(parking_ratio, 2) AS VARCHAR) || '대 수준입니다.' END AS text_context
      FROM listing""",
)
def listing_text(spark, sf):
    return listings(spark, sf).select(*KEYS, X.listing_text().alias("text_context"))


@query(
    "p18_search_context",
    f"""WITH {RAW_SQL}, {TYPED_SQL}, {LISTING_SQL} SELECT {KEYS_SQL},
      coalesce("umdNm", '') || ' ' || coalesce("mhouseNm", '미명명 단지') || ' '
      || coalesce(CAST(CAST(round_even("excluUseAr", 1) AS DECIMAL(18, 1)) AS VARCHAR), '') || 'm2 '
      || coalesce("buildYear", 2000) || '년 건축 ' || total_floors || '층' AS context
      FROM listing""",
)
def search_context(spark, sf):
    return listings(spark, sf).select(*KEYS, X.search_context().alias("context"))


@query(
    "m10_haversine",
    f"""WITH {PROPERTIES_SQL} SELECT c_custkey,
      round({distance_sql('lat', 'lng', '37.5', '127.0')}, 3) AS metres FROM props""",
)
def haversine(spark, sf):
    away = N.haversine_m("lat", "lng", F.lit(37.5), F.lit(127.0))
    return properties(spark, sf).select("c_custkey", F.round(away, 3).alias("metres"))
