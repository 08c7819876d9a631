"""Driver tables seen as trades, regions, index, addresses and landed answers.

Each frame has a SQL twin. Both are plain arithmetic on keys, which is also how nulls, blanks,
gaps and duplicates get in: the driver tables themselves have none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landgauge.catalog.registry import table
from landgauge.operators.regions import mapped_or_same
from landgauge.session import dealt

# --- regions -----------------------------------------------------------------------------

def region_codes(spark: SparkSession, sf: str) -> DataFrame:
    """(code, name): provinces, their cities and, for even nations, the districts of a city."""
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    named = region.withColumn("prov", F.concat(F.replace("r_name", F.lit(" "), F.lit("_")), F.lit("_LONG")))
    provinces = named.select(
        F.concat(((F.col("r_regionkey") + 1) * 10000).cast("string"), F.lit("00000")).alias("code"),
        F.col("prov").alias("name"),
    )
    cities = nation.join(named, nation.n_regionkey == named.r_regionkey).withColumn(
        "city", (F.col("n_regionkey") + 1) * 10000 + (F.col("n_nationkey") + 1) * 10
    )
    city_rows = cities.select(
        F.concat(F.col("city").cast("string"), F.lit("00000")).alias("code"),
        F.concat_ws(" ", "prov", "n_name").alias("name"),
    )
    seats = table(spark, sf, "supplier").select(
        F.col("s_nationkey"), (F.col("s_suppkey") % 9 + 1).cast("int").alias("d")
    ).where("s_nationkey % 2 = 0").distinct()
    districts = seats.join(cities, seats.s_nationkey == cities.n_nationkey).select(
        F.concat((F.col("city") + F.col("d")).cast("string"), F.lit("00000")).alias("code"),
        F.concat_ws(" ", "prov", "n_name", F.concat(F.lit("GU"), F.col("d").cast("string"))).alias("name"),
    )
    return provinces.unionByName(city_rows).unionByName(districts)


PROVINCE_NAMES = {
    "AFRICA_LONG": "AFR",
    "AMERICA_LONG": "AME",
    "ASIA_LONG": "ASI",
    "EUROPE_LONG": "EUR",
}

REGION_SQL = """
prov AS (
  SELECT r_regionkey, replace(r_name, ' ', '_') || '_LONG' AS prov,
         CASE r_name WHEN 'AFRICA' THEN 'AFR' WHEN 'AMERICA' THEN 'AME' WHEN 'ASIA' THEN 'ASI'
              WHEN 'EUROPE' THEN 'EUR' ELSE replace(r_name, ' ', '_') || '_LONG' END AS sido
  FROM region),
city AS (
  SELECT n_nationkey, n_name, prov, sido, (n_regionkey + 1) * 10000 + (n_nationkey + 1) * 10 AS city
  FROM nation JOIN prov ON n_regionkey = r_regionkey),
seat AS (
  SELECT DISTINCT s_nationkey, CAST(s_suppkey % 9 + 1 AS INTEGER) AS d
  FROM supplier WHERE s_nationkey % 2 = 0),
codes AS (
  SELECT CAST((r_regionkey + 1) * 10000 AS VARCHAR) || '00000' AS code, prov AS name FROM prov
  UNION ALL SELECT CAST(city AS VARCHAR) || '00000', prov || ' ' || n_name FROM city
  UNION ALL SELECT CAST(city + d AS VARCHAR) || '00000', prov || ' ' || n_name || ' GU' || d
  FROM seat JOIN city ON s_nationkey = n_nationkey),
lookup AS (
  SELECT CAST(r_regionkey + 1 AS INTEGER) * 10000 AS "sggCd", sido, prov AS region FROM prov
  UNION ALL SELECT CAST(city AS INTEGER), sido, n_name FROM city
  UNION ALL SELECT CAST(city + d AS INTEGER), sido, 'GU' || d
  FROM seat JOIN city ON s_nationkey = n_nationkey),
parents AS (
  SELECT sido, 'GU' || d AS region, max_by(n_name, city + d) AS parent
  FROM seat JOIN city ON s_nationkey = n_nationkey GROUP BY ALL)
"""


# --- trades ------------------------------------------------------------------------------

def raw_trades(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem as raw trade text, with the keys it came from."""
    line = table(spark, sf, "lineitem")
    supplier, nation = table(spark, sf, "supplier"), table(spark, sf, "nation")
    rows = line.join(supplier, line.l_suppkey == supplier.s_suppkey).join(
        nation, supplier.s_nationkey == nation.n_nationkey
    )
    k, p, s = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    code = (
        (F.col("n_regionkey") + 1) * 10000
        + (F.col("n_nationkey") + 1) * 10
        + F.when(F.col("n_nationkey") % 2 == 0, s % 9 + 1).otherwise(0)
    )
    lot = (p % 300 + 1).cast("string")
    year = F.year("l_shipdate")
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(k % 101 == 0, "99999").otherwise(code.cast("string")).alias("sggCd"),
        F.when(p % 89 != 0, F.concat(F.lit("dong"), (s % 37).cast("string"))).alias("umdNm"),
        F.when(p % 5 == 0, lot).otherwise(F.concat_ws("-", lot, F.col("l_linenumber").cast("string"))).alias("jibun"),
        F.when(p % 19 == 0, None).when(p % 19 == 1, "★★")
        .otherwise(F.concat(F.lit(" ★빌라  #"), (p % 50).cast("string"), F.lit("동 (A), ☆"))).alias("mhouseNm"),
        F.when(p % 13 == 0, "").when(p % 17 == 0, "unknown")
        .otherwise((F.lit(1970) + p % 30).cast("string")).alias("buildYear"),
        F.when(F.col("l_returnflag") == "A", "다세대").when(F.col("l_returnflag") == "N", "연립")
        .otherwise("연립다세대").alias("houseType"),
        F.when(k % 97 == 0, "").otherwise(F.col("l_quantity").cast("string")).alias("excluUseAr"),
        (F.col("l_quantity") * 2 - F.col("l_linenumber")).cast("string").alias("landAr"),
        F.when(p % 11 == 0, None).otherwise(F.col("l_linenumber").cast("string")).alias("floor"),
        year.cast("string").alias("dealYear"),
        F.month("l_shipdate").cast("string").alias("dealMonth"),
        F.dayofmonth("l_shipdate").cast("string").alias("dealDay"),
        F.format_number(F.floor("l_extendedprice"), 0).alias("dealAmount"),
        F.lit("").alias("buyerGbn"),
        F.lit("").alias("slerGbn"),
        F.when(p % 7 == 0, "직거래").when(p % 7 != 1, "중개거래").alias("dealingGbn"),
        F.lit("").alias("estateAgentSggNm"),
        F.when((F.col("l_linestatus") == "O") & (k % 5 == 0), "O").alias("cdealType"),
        F.lit("").alias("cdealDay"),
        F.lit("").alias("rgstDate"),
    )


RAW_SQL = """
raw AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CASE WHEN l_orderkey % 101 = 0 THEN '99999' ELSE CAST((n_regionkey + 1) * 10000 + (n_nationkey + 1) * 10
      + CASE WHEN n_nationkey % 2 = 0 THEN l_suppkey % 9 + 1 ELSE 0 END AS VARCHAR) END AS "sggCd",
    CASE WHEN l_partkey % 89 <> 0 THEN 'dong' || (l_suppkey % 37) END AS "umdNm",
    CASE WHEN l_partkey % 5 = 0 THEN CAST(l_partkey % 300 + 1 AS VARCHAR)
      ELSE (l_partkey % 300 + 1) || '-' || l_linenumber END AS jibun,
    CASE WHEN l_partkey % 19 = 0 THEN NULL WHEN l_partkey % 19 = 1 THEN '★★'
      ELSE ' ★빌라  #' || (l_partkey % 50) || '동 (A), ☆' END AS "mhouseNm",
    CASE WHEN l_partkey % 13 = 0 THEN '' WHEN l_partkey % 17 = 0 THEN 'unknown'
      ELSE CAST(1970 + l_partkey % 30 AS VARCHAR) END AS "buildYear",
    CASE l_returnflag WHEN 'A' THEN '다세대' WHEN 'N' THEN '연립' ELSE '연립다세대' END AS "houseType",
    CASE WHEN l_orderkey % 97 = 0 THEN '' ELSE CAST(l_quantity AS VARCHAR) END AS "excluUseAr",
    CAST(l_quantity * 2 - l_linenumber AS VARCHAR) AS "landAr",
    CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE CAST(l_linenumber AS VARCHAR) END AS floor,
    CAST(year(l_shipdate) AS VARCHAR) AS "dealYear",
    CAST(month(l_shipdate) AS VARCHAR) AS "dealMonth",
    CAST(day(l_shipdate) AS VARCHAR) AS "dealDay",
    format('{:,}', CAST(floor(l_extendedprice) AS BIGINT)) AS "dealAmount",
    '' AS "buyerGbn", '' AS "slerGbn",
    CASE WHEN l_partkey % 7 = 0 THEN '직거래' WHEN l_partkey % 7 <> 1 THEN '중개거래' END AS "dealingGbn",
    '' AS "estateAgentSggNm",
    CASE WHEN l_linestatus = 'O' AND l_orderkey % 5 = 0 THEN 'O' END AS "cdealType",
    '' AS "cdealDay", '' AS "rgstDate"
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)
"""

TYPED_SQL = """
typed AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "umdNm", jibun, "mhouseNm", "houseType",
    "dealingGbn", "cdealType",
    TRY_CAST("sggCd" AS INTEGER) AS "sggCd", TRY_CAST("buildYear" AS INTEGER) AS "buildYear",
    TRY_CAST("excluUseAr" AS DOUBLE) AS "excluUseAr", TRY_CAST("landAr" AS DOUBLE) AS "landAr",
    TRY_CAST(floor AS INTEGER) AS floor, CAST("dealYear" AS INTEGER) AS "dealYear",
    CAST("dealMonth" AS INTEGER) AS "dealMonth", CAST("dealDay" AS INTEGER) AS "dealDay",
    CAST(replace("dealAmount", ',', '') AS BIGINT) AS "dealAmount",
    CAST("dealYear" AS INTEGER) - TRY_CAST("buildYear" AS INTEGER) AS "Age",
    CAST(replace("dealAmount", ',', '') AS BIGINT) / TRY_CAST("excluUseAr" AS DOUBLE) AS "Price_per_m2"
  FROM raw)
"""


# --- land index --------------------------------------------------------------------------

def wide_index(spark: SparkSession, sf: str) -> DataFrame:
    """Order values per nation and month as a wide index table with gaps and district rows."""
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    monthly = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .groupBy(
            F.col("c_nationkey"),
            F.year("o_orderdate").alias("y"),
            F.month("o_orderdate").alias("m"),
        )
        .agg(F.sum(cents).alias("c"), F.count(F.lit(1)).alias("n"))
    )
    index = F.expr("c div (n * 10000)")
    gap = (
        ((F.col("c_nationkey") * 7 + F.col("y") * 12 + F.col("m")) % 5 == 0)
        | (F.col("c_nationkey") == 3)
        | ((F.col("c_nationkey") == 4) & (F.col("y") < 1997))
    )
    shown = F.when(~gap, F.format_number(index, 0)).otherwise("")
    label = F.concat(F.col("y").cast("string"), F.lit("년 "), F.col("m").cast("string"), F.lit("월"))
    # From the first month with orders to the last; an empty table has no rows, but some month.
    month = F.year("o_orderdate") * 12 + F.month("o_orderdate") - 1
    first, last = orders.agg(*[F.coalesce(f(month), F.lit(1995 * 12)) for f in (F.min, F.max)]).first()
    labels = [f"{k // 12}년 {k % 12 + 1}월" for k in range(first, last + 1)]
    # Even nations get a second row, for a district, half a point higher.
    level = F.explode(
        F.when(F.col("c_nationkey") % 2 == 0, F.array(F.lit(None).cast("string"), F.lit("GU1"))).otherwise(
            F.array(F.lit(None).cast("string"))
        )
    )
    rows = monthly.select("c_nationkey", level.alias("gu"), label.alias("label"), shown.alias("shown"))
    rows = rows.withColumn(
        "shown",
        F.when(F.col("gu").isNotNull() & (F.col("shown") != ""), F.concat("shown", F.lit(".5"))).otherwise(F.col("shown")),
    )
    wide = rows.groupBy("c_nationkey", "gu").pivot("label", labels).agg(F.first("shown"))
    named = wide.join(nation, wide.c_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey
    )
    long_name = F.concat(F.replace("r_name", F.lit(" "), F.lit("_")), F.lit("_LONG"))
    return named.select(
        mapped_or_same(long_name, PROVINCE_NAMES).alias("지역"),
        F.col("n_name").alias("지역1"),
        F.coalesce("gu", "n_name").alias("지역2"),
        *[F.col(f"`{m}`") for m in labels],
    )


INDEX_SQL = """
idx AS (
  SELECT sido, n_name AS land_region, y AS "dealYear", m AS "dealMonth",
    CAST(CASE WHEN (n_nationkey * 7 + y * 12 + m) % 5 = 0 OR n_nationkey = 3
      OR (n_nationkey = 4 AND y < 1997) THEN NULL ELSE c // (n * 10000) END AS DOUBLE) AS land_index
  FROM (
    SELECT c_nationkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
      CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS c, count(*) AS n
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
  JOIN city ON c_nationkey = n_nationkey),
index_rows AS (SELECT * FROM idx WHERE land_index IS NOT NULL)
"""

GRID_SQL = """
landed AS (
  SELECT t.*, l.sido, l.region, coalesce(p.parent, l.region) AS land_region
  FROM typed t LEFT JOIN lookup l USING ("sggCd") LEFT JOIN parents p ON l.sido = p.sido AND l.region = p.region
  WHERE coalesce("cdealType", '') <> 'O' AND coalesce("dealingGbn", '') <> '직거래'),
grid AS (
  SELECT sido, land_region, "dealYear", "dealMonth" FROM index_rows
  UNION SELECT sido, land_region, "dealYear", "dealMonth" FROM landed
  WHERE sido IS NOT NULL AND land_region IS NOT NULL),
filled AS (
  SELECT sido, land_region, "dealYear", "dealMonth",
    coalesce(
      last_value(land_index IGNORE NULLS) OVER (PARTITION BY sido, land_region ORDER BY "dealYear", "dealMonth"
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
      first_value(land_index IGNORE NULLS) OVER (PARTITION BY sido, land_region ORDER BY "dealYear", "dealMonth"
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS land_index
  FROM grid LEFT JOIN index_rows USING (sido, land_region, "dealYear", "dealMonth")),
newest AS (
  SELECT sido, land_region, max_by(land_index, "dealYear" * 12 + "dealMonth") AS current_land_index
  FROM index_rows GROUP BY ALL),
adjusted AS (
  SELECT t.*, f.land_index, n.current_land_index, n.current_land_index / f.land_index AS "Time_Adjustment"
  FROM landed t LEFT JOIN filled f USING (sido, land_region, "dealYear", "dealMonth")
  LEFT JOIN newest n USING (sido, land_region))
"""

TRADES_SQL = f"WITH {REGION_SQL}, {RAW_SQL}, {TYPED_SQL}"
ADJUSTED_SQL = f"{TRADES_SQL}, {INDEX_SQL}, {GRID_SQL}"


# --- places ------------------------------------------------------------------------------

def _spread(key: str, factor: int, low: float, span: float):
    """Irregular coordinate from a key: no two lie in a symmetric pattern."""
    return F.lit(low) + F.pmod(F.col(key) * factor, F.lit(100_003)) / 100_003.0 * span


def properties(spark: SparkSession, sf: str) -> DataFrame:
    """customer as located listings; some know their station, some have no coordinates."""
    k = F.col("c_custkey")
    located = k % 23 != 0
    return dealt(table(spark, sf, "customer").select("c_custkey")).select(
        "c_custkey",
        F.when(located, _spread("c_custkey", 37_199, 33.0, 5.0)).alias("lat"),
        F.when(located, _spread("c_custkey", 53_077, 126.0, 4.0)).alias("lng"),
        F.when(k % 3 == 0, F.concat(F.lit("station"), (k % 211).cast("string"))).alias("subway_name"),
        F.when(k % 3 == 0, (k % 997).cast("double")).alias("subway_dist"),
    )


PROPERTIES_SQL = """
props AS (
  SELECT c_custkey,
    CASE WHEN c_custkey % 23 <> 0 THEN 33.0::DOUBLE + ((c_custkey * 37199) % 100003) / 100003.0::DOUBLE * 5.0::DOUBLE END AS lat,
    CASE WHEN c_custkey % 23 <> 0 THEN 126.0::DOUBLE + ((c_custkey * 53077) % 100003) / 100003.0::DOUBLE * 4.0::DOUBLE END AS lng,
    CASE WHEN c_custkey % 3 = 0 THEN 'station' || (c_custkey % 211) END AS subway_name,
    CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey % 997 AS DOUBLE) END AS subway_dist
  FROM customer)
"""


def distance_sql(lat1: str, lng1: str, lat2: str, lng2: str) -> str:
    """Great-circle metres in SQL."""
    return (
        f"(2.0 * 6371000.0 * asin(sqrt(power(sin((radians({lat2}) - radians({lat1})) / 2), 2) "
        f"+ cos(radians({lat1})) * cos(radians({lat2})) "
        f"* power(sin((radians({lng2}) - radians({lng1})) / 2), 2))))"
    )
