"""Joins over whole tables (J*, I7, F4 with F3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from landgauge.catalog.aggregates import rounded
from landgauge.catalog.registry import query, table
from landgauge.catalog.tables import (
    ADJUSTED_SQL,
    PROPERTIES_SQL,
    PROVINCE_NAMES,
    REGION_SQL,
    TRADES_SQL,
    distance_sql,
    properties,
    raw_trades,
    region_codes,
    wide_index,
)
from landgauge.functions import parsing as P
from landgauge.operators import land_index, lookups, nearest, regions, similar
from landgauge.operators.filters import valid_deals
from landgauge.plans.trades import typed_trades
from landgauge.session import measured

KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
KEYS_SQL = ", ".join(KEYS)


def _typed(spark, sf):
    return typed_trades(raw_trades(spark, sf))


def landed(spark, sf):
    """Valid trades with sido, region and land_region."""
    codes = region_codes(spark, sf)
    trades = valid_deals(_typed(spark, sf))
    trades = regions.attach_region(trades, regions.region_lookup(codes, PROVINCE_NAMES))
    return regions.attach_land_region(trades, regions.parent_lookup(codes, PROVINCE_NAMES))


def index(spark, sf):
    return measured(land_index.one_per_month(land_index.wide_to_long(wide_index(spark, sf))))


# Landed building answers: about two per lot, the later one wins.
BUILDING_SQL = """
answer AS (
  SELECT CAST((n_regionkey + 1) * 10000 + (n_nationkey + 1) * 10
      + CASE WHEN n_nationkey % 2 = 0 THEN l_suppkey % 9 + 1 ELSE 0 END AS VARCHAR) AS "sggCd",
    'dong' || (l_suppkey % 37) AS "umdNm", CAST(l_partkey % 300 + 1 AS VARCHAR) AS jibun,
    l_orderkey * 1000 + l_partkey * 10 + l_linenumber AS seq,
    CASE WHEN l_orderkey % 3 <> 0 THEN (l_orderkey % 150) / 100.0::DOUBLE END AS parking_ratio,
    CASE WHEN l_orderkey % 4 <> 0 THEN CAST(l_orderkey % 2 AS INTEGER) END AS has_elevator,
    CASE WHEN l_orderkey % 5 <> 0 THEN CAST(l_orderkey % 7 AS INTEGER) END AS total_floors
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  WHERE l_partkey % 2 = 0)
"""


def building_answers(spark, sf):
    k = F.col("l_orderkey")
    nation = table(spark, sf, "nation")
    line = table(spark, sf, "lineitem")
    supplier = table(spark, sf, "supplier")
    code = (
        (F.col("n_regionkey") + 1) * 10000
        + (F.col("n_nationkey") + 1) * 10
        + F.when(F.col("n_nationkey") % 2 == 0, F.col("l_suppkey") % 9 + 1).otherwise(0)
    )
    rows = line.join(supplier, line.l_suppkey == supplier.s_suppkey).join(
        nation, supplier.s_nationkey == nation.n_nationkey
    )
    return rows.where("l_partkey % 2 = 0").select(
        code.cast("string").alias("sggCd"),
        F.concat(F.lit("dong"), (F.col("l_suppkey") % 37).cast("string")).alias("umdNm"),
        (F.col("l_partkey") % 300 + 1).cast("string").alias("jibun"),
        (k * 1000 + F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("seq"),
        F.when(k % 3 != 0, k % 150 / 100.0).alias("parking_ratio"),
        F.when(k % 4 != 0, (k % 2).cast("int")).alias("has_elevator"),
        F.lit(None).cast("int").alias("building_structure"),
        F.lit(None).cast("int").alias("is_commercial_villa"),
        F.when(k % 5 != 0, (k % 7).cast("int")).alias("total_floors"),
        F.lit(None).cast("string").alias("approval_date"),
    )


@query(
    "j1_merge_buildings",
    f"""{TRADES_SQL}, {BUILDING_SQL},
    newest AS (SELECT "sggCd", "umdNm", jibun, max_by(struct_pack(p := parking_ratio, e := has_elevator, f := total_floors), seq) AS b
      FROM answer GROUP BY ALL)
    SELECT {KEYS_SQL}, b.p AS parking_ratio, CAST(b.e AS DOUBLE) AS has_elevator, CAST(b.f AS DOUBLE) AS total_floors
    FROM raw LEFT JOIN newest USING ("sggCd", "umdNm", jibun)""",
)
def merge_buildings(spark, sf):
    merged = lookups.merge_buildings(raw_trades(spark, sf), building_answers(spark, sf), ["seq"])
    return merged.select(
        *KEYS, "parking_ratio",
        F.col("has_elevator").cast("double").alias("has_elevator"),
        F.col("total_floors").cast("double").alias("total_floors"),
    )


GEOCODE_SQL = """
geo AS (
  SELECT sido, region, 'dong' || (l_suppkey % 37) AS "umdNm", CAST(l_partkey % 300 + 1 AS VARCHAR) AS jibun,
    l_orderkey * 1000 + l_partkey * 10 + l_linenumber AS seq,
    33 + l_orderkey % 500 / 100.0::DOUBLE AS lat, 126 + l_orderkey % 400 / 100.0::DOUBLE AS lng,
    CASE WHEN l_orderkey % 6 = 0 THEN 'ADDRESS_NOT_FOUND' END AS error
  FROM typed JOIN lookup USING ("sggCd"))
"""


def geocode_answers(spark, sf):
    k = F.col("l_orderkey")
    named = regions.attach_region(
        _typed(spark, sf), regions.region_lookup(region_codes(spark, sf), PROVINCE_NAMES)
    )
    return named.where(F.col("sido").isNotNull()).select(
        "sido", "region",
        F.concat(F.lit("dong"), (F.col("l_suppkey") % 37).cast("string")).alias("umdNm"),
        (F.col("l_partkey") % 300 + 1).cast("string").alias("jibun"),
        (k * 1000 + F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("seq"),
        (k % 500 / 100.0 + 33).alias("lat"),
        (k % 400 / 100.0 + 126).alias("lng"),
        F.lit(None).cast("string").alias("subway_name"),
        F.lit(None).cast("double").alias("subway_dist"),
        F.when(k % 6 == 0, "ADDRESS_NOT_FOUND").alias("error"),
    )


@query(
    "j2_merge_geocodes",
    f"""{ADJUSTED_SQL}, {GEOCODE_SQL},
    best AS (SELECT sido, region, "umdNm", jibun, max_by(struct_pack(a := lat, o := lng, e := error), seq) AS g FROM geo GROUP BY ALL)
    SELECT {KEYS_SQL}, CASE WHEN g.e IS NULL THEN g.a END AS lat, CASE WHEN g.e IS NULL THEN g.o END AS lng
    FROM landed LEFT JOIN best USING (sido, region, "umdNm", jibun)""",
)
def merge_geocodes(spark, sf):
    trades = landed(spark, sf).withColumns({"lat": F.lit(0.0), "lng": F.lit(0.0)})
    merged = lookups.merge_geocodes(trades, geocode_answers(spark, sf), ["seq"])
    return merged.select(*KEYS, "lat", "lng")


@query(
    "j3_month_grid",
    f"""{ADJUSTED_SQL} SELECT sido, land_region, "dealYear", "dealMonth", land_index FROM grid
    LEFT JOIN index_rows USING (sido, land_region, "dealYear", "dealMonth")""",
)
def month_grid(spark, sf):
    return land_index.month_grid(index(spark, sf), landed(spark, sf))


@query(
    "j4_j5_attach_index",
    f"""{ADJUSTED_SQL} SELECT {KEYS_SQL}, land_region, land_index, current_land_index,
      round("Time_Adjustment", 8) AS "Time_Adjustment" FROM adjusted""",
)
def attach_index(spark, sf):
    trades = land_index.attach_index(landed(spark, sf), index(spark, sf))
    columns = ["land_region", "land_index", "current_land_index", "Time_Adjustment"]
    return rounded(trades.select(*KEYS, *columns), "Time_Adjustment", digits=8)


@query(
    "j6_still_to_ask",
    f"""{TRADES_SQL}, {BUILDING_SQL} SELECT DISTINCT "sggCd", "umdNm", jibun FROM raw
    WHERE "umdNm" IS NOT NULL AND NOT EXISTS (SELECT 1 FROM answer a
      WHERE a."sggCd" = raw."sggCd" AND a."umdNm" = raw."umdNm" AND a.jibun = raw.jibun)""",
)
def still_to_ask(spark, sf):
    keys = ["sggCd", "umdNm", "jibun"]
    return lookups.still_to_ask(raw_trades(spark, sf), building_answers(spark, sf), keys)


@query(
    "j7_collection_tasks",
    f"""WITH {REGION_SQL}, leaf AS (SELECT left(code, 5) AS code5, name FROM codes c
      WHERE NOT ends_with(left(code, 5), '000') AND NOT EXISTS (SELECT 1 FROM codes d WHERE starts_with(d.name, c.name || ' '))),
    months AS (SELECT strftime(m, '%Y%m') AS deal_ymd FROM (
      SELECT unnest(generate_series(TIMESTAMP '1996-09-01', TIMESTAMP '2001-08-01', INTERVAL 1 MONTH)) AS m)),
    done AS (SELECT DISTINCT code5 || '_' || strftime(o_orderdate, '%Y%m') AS task FROM orders JOIN leaf ON true
      WHERE o_orderkey % 40 = 0 AND CAST(code5 AS INTEGER) % 7 = o_custkey % 7)
    SELECT code5 || '_' || deal_ymd AS task, code5, name, deal_ymd FROM leaf CROSS JOIN months
    WHERE code5 || '_' || deal_ymd NOT IN (SELECT task FROM done)""",
)
def collection_tasks(spark, sf):
    leaf = regions.leaf_regions(region_codes(spark, sf))
    asked = table(spark, sf, "orders").where("o_orderkey % 40 = 0").select(
        F.date_format("o_orderdate", "yyyyMM").alias("ym"), (F.col("o_custkey") % 7).alias("slot")
    ).distinct()
    keyed = leaf.withColumn("slot", F.col("code5").cast("int") % 7)
    done = keyed.join(asked, "slot").select(F.concat_ws("_", "code5", "ym").alias("task")).distinct()
    end = F.date_trunc("month", F.lit("2001-08-15").cast("timestamp")).cast("date")
    return lookups.collection_tasks(leaf, P.trailing_months(end, 60), done)


@query(
    "j8_leaf_regions",
    f"""WITH {REGION_SQL} SELECT left(code, 5) AS code5, name FROM codes c
    WHERE NOT ends_with(left(code, 5), '000') AND NOT EXISTS (SELECT 1 FROM codes d WHERE starts_with(d.name, c.name || ' '))""",
)
def leaf_regions(spark, sf):
    return regions.leaf_regions(region_codes(spark, sf))


@query(
    "j8_leaf_regions_by_prefix",
    f"""WITH {REGION_SQL}, r AS (SELECT left(code, 5) AS code5, name FROM codes WHERE NOT ends_with(left(code, 5), '000'))
    SELECT code5, name FROM r WHERE NOT (ends_with(code5, '0') AND EXISTS (
      SELECT 1 FROM r o WHERE o.code5 <> r.code5 AND left(o.code5, 4) = left(r.code5, 4)))""",
)
def leaf_regions_by_prefix(spark, sf):
    return regions.leaf_regions(region_codes(spark, sf), rule="prefix")


@query(
    "j9_attach_region",
    f"""{TRADES_SQL} SELECT {KEYS_SQL}, "sggCd", sido, region FROM typed LEFT JOIN lookup USING ("sggCd")""",
)
def attach_region(spark, sf):
    lookup = regions.region_lookup(region_codes(spark, sf), PROVINCE_NAMES)
    return regions.attach_region(_typed(spark, sf), lookup).select(*KEYS, "sggCd", "sido", "region")


@query(
    "j10_attach_land_region",
    f"""{ADJUSTED_SQL} SELECT {KEYS_SQL}, sido, region, land_region FROM landed""",
)
def attach_land_region(spark, sf):
    return landed(spark, sf).select(*KEYS, "sido", "region", "land_region")


@query(
    "j11_attach_dong_code",
    f"""{TRADES_SQL}, dong AS (SELECT DISTINCT CAST(city AS VARCHAR) AS sgg, 'dong' || (s_suppkey % 37) AS "umdNm",
      lpad(CAST(s_suppkey % 37 * 100 AS VARCHAR), 5, '0') AS bjdong FROM supplier JOIN city ON s_nationkey = n_nationkey)
    SELECT {KEYS_SQL}, bjdong, coalesce(bjdong, raw."umdNm") AS ask_by
    FROM raw LEFT JOIN dong ON raw."sggCd" = dong.sgg AND raw."umdNm" = dong."umdNm" """,
)
def attach_dong_code(spark, sf):
    nation = table(spark, sf, "nation")
    slot = F.col("s_suppkey") % 37
    city = (F.col("n_regionkey") + 1) * 10000 + (F.col("n_nationkey") + 1) * 10
    dongs = table(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    dongs = dongs.select(
        city.cast("string").alias("sgg"),
        F.concat(F.lit("dong"), slot.cast("string")).alias("umdNm"),
        P.zero_pad((slot * 100).cast("string"), 5).alias("bjdong"),
    ).distinct()
    return regions.attach_dong_code(raw_trades(spark, sf), dongs).select(*KEYS, "bjdong", "ask_by")


STATION_SQL = """
stations AS (
  SELECT s_name AS name, 33.0::DOUBLE + ((s_suppkey * 61927) % 100003) / 100003.0::DOUBLE * 5.0::DOUBLE AS slat,
    126.0::DOUBLE + ((s_suppkey * 28411) % 100003) / 100003.0::DOUBLE * 4.0::DOUBLE AS slng FROM supplier)
"""


def stations(spark, sf):
    def spread(factor, low, span):
        return F.lit(low) + F.col("s_suppkey") * factor % 100_003 / 100_003.0 * span

    return table(spark, sf, "supplier").select(
        F.col("s_name").alias("subway_name"),
        spread(61_927, 33.0, 5.0).alias("lat"),
        spread(28_411, 126.0, 4.0).alias("lng"),
    )


@query(
    "j12_nearest_station",
    f"""WITH {PROPERTIES_SQL}, {STATION_SQL}, d AS (
      SELECT c_custkey, name, {distance_sql("lat", "lng", "slat", "slng")} AS m FROM props CROSS JOIN stations WHERE lat IS NOT NULL),
    best AS (SELECT c_custkey, arg_min(name, struct_pack(m := m, name := name)) AS nearest_name, round(min(m), 3) AS nearest_m FROM d GROUP BY 1)
    SELECT c_custkey, nearest_name, nearest_m FROM props LEFT JOIN best USING (c_custkey)""",
)
def nearest_station(spark, sf):
    found = nearest.nearest_station(properties(spark, sf).select("c_custkey", "lat", "lng"), stations(spark, sf))
    return rounded(found.select("c_custkey", "nearest_name", "nearest_m"), "nearest_m", digits=3)


@query(
    "i7_fill_nearest_station",
    f"""WITH {PROPERTIES_SQL}, hub AS (SELECT subway_name AS name, avg(lat) AS slat, avg(lng) AS slng FROM props
      WHERE lat IS NOT NULL AND subway_name IS NOT NULL GROUP BY 1),
    d AS (SELECT c_custkey, name, {distance_sql("lat", "lng", "slat", "slng")} AS m FROM props CROSS JOIN hub
      WHERE subway_name IS NULL AND lat IS NOT NULL),
    best AS (SELECT c_custkey, arg_min(name, struct_pack(m := m, name := name)) AS name, min(m) AS m FROM d GROUP BY 1)
    SELECT c_custkey, coalesce(subway_name, name) AS subway_name, round(coalesce(m, subway_dist), 3) AS subway_dist,
      CASE WHEN subway_name IS NOT NULL THEN 'service' WHEN name IS NOT NULL THEN 'centroid' END AS subway_source
    FROM props LEFT JOIN best USING (c_custkey)""",
)
def fill_nearest_station(spark, sf):
    filled = nearest.fill_nearest_station(properties(spark, sf))
    columns = ["c_custkey", "subway_name", "subway_dist", "subway_source"]
    return rounded(filled.select(*columns), "subway_dist", digits=3)


def vectors(spark, sf):
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding")


@query(
    "j13_comparables",
    """WITH v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    q AS (SELECT e FROM v WHERE id = 100),
    s AS (SELECT id, list_cosine_similarity(v.e, q.e) AS similarity FROM v, q WHERE id <> 100)
    SELECT id, round(similarity, 6) AS similarity FROM s ORDER BY s.similarity DESC, id LIMIT 10""",
)
def comparables(spark, sf):
    return rounded(similar.comparables(vectors(spark, sf), 100, n=10), "similarity", digits=6)


BATCH_SQL = """WITH v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    s AS (SELECT q.id AS query_id, c.id, list_cosine_similarity(q.e, c.e) AS similarity FROM v q JOIN v c ON q.id <> c.id),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, id) AS rank FROM s)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, id, round(similarity, 6) AS similarity FROM r WHERE rank <= 3"""


@query("j14_batch_comparables", BATCH_SQL)
def batch_comparables(spark, sf):
    return rounded(similar.batch_comparables(vectors(spark, sf), vectors(spark, sf)), "similarity", digits=6)


@query("j14_batch_comparables_by_blocks", BATCH_SQL)
def batch_comparables_by_blocks(spark, sf):
    """In blocks of 50 rows: ten pivots and more blocks at the smallest scale."""
    v = vectors(spark, sf)
    return rounded(similar.batch_comparables(v, v, block_rows=50), "similarity", digits=6)
