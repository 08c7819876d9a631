"""Windows, sorts, splits, set operations and unpivots over whole tables (W*, O*, U*)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from landgauge.catalog.aggregates import rounded
from landgauge.catalog.joins import index, landed
from landgauge.catalog.registry import query, table
from landgauge.catalog.tables import ADJUSTED_SQL, INDEX_SQL, REGION_SQL, TRADES_SQL, raw_trades, wide_index
from landgauge.operators import filters, land_index, lookups, similar, split
from landgauge.plans.trades import typed_trades


@query(
    "w1_w2_fill_months",
    f"""{ADJUSTED_SQL} SELECT sido, land_region, "dealYear", "dealMonth", land_index FROM filled""",
)
def fill_months(spark, sf):
    grid = land_index.month_grid(index(spark, sf), landed(spark, sf))
    return land_index.fill_months(grid)


@query(
    "w3_newest_per_key",
    """SELECT user_id, event_type, event_id, value FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events)
       WHERE r = 1""",
)
def newest_per_key(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_type", "event_id", "value", "ts")
    return lookups.newest_per_key(events, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query(
    "w4_partition_transform",
    """SELECT o_orderkey, round(avg(o_totalprice) OVER (PARTITION BY o_orderpriority), 4) AS mean_price,
         median(year(o_orderdate)) OVER (PARTITION BY o_orderpriority) AS median_year FROM orders""",
)
def partition_transform(spark, sf):
    from landgauge.operators.impute import with_group_stat

    orders = table(spark, sf, "orders")
    stats = {
        "mean_price": F.round(F.avg("o_totalprice"), 4),
        "median_year": F.median(F.year("o_orderdate")),
    }
    rows = with_group_stat(orders, ["o_orderpriority"], stats)
    return rows.select("o_orderkey", "mean_price", "median_year")


@query(
    "o1_multi_key_sort",
    """SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderdate, o_orderkey) AS place
       FROM orders""",
)
def multi_key_sort(spark, sf):
    w = Window.partitionBy("o_custkey").orderBy("o_orderpriority", "o_orderdate", "o_orderkey")
    return table(spark, sf, "orders").select("o_orderkey", F.row_number().over(w).cast("long").alias("place"))


@query(
    "o2_chronological_sort",
    "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS deal_date FROM orders ORDER BY o_orderdate, o_orderkey",
)
def chronological_sort(spark, sf):
    dated = table(spark, sf, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").cast("string").alias("deal_date")
    )
    return split.chronological_sort(dated, "deal_date", "o_orderkey")


@query(
    "o3_chronological_split",
    """SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY CAST(o_orderdate AS DATE), o_orderkey % 64, o_orderkey)
         <= (SELECT CAST(floor(count(*) * 0.8) AS BIGINT) FROM orders) THEN 'train' ELSE 'test' END AS split FROM orders""",
)
def chronological_split(spark, sf):
    dated = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("deal_date"))
    inside = [F.pmod("o_orderkey", F.lit(64))]
    return split.chronological_split(dated, "deal_date", "o_orderkey", inside_day=inside).select("o_orderkey", "split")


@query("o4_hash_split")
def hash_split(spark, sf):
    rows = split.hash_split(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 70, 10)
    return rows.groupBy("split").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "o5_top_n",
    """WITH v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    q AS (SELECT e FROM v WHERE id = 7),
    s AS (SELECT id, list_cosine_similarity(v.e, q.e) AS similarity FROM v, q WHERE id <> 7)
    SELECT id, round(similarity, 6) AS similarity FROM s ORDER BY s.similarity DESC, id LIMIT 3""",
)
def top_n(spark, sf):
    vectors = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return rounded(similar.comparables(vectors, 7, n=3), "similarity", digits=6)


@query(
    "o6_row_by_id",
    """SELECT o.o_orderkey, o.o_totalprice, o.o_custkey FROM orders o
       WHERE o.o_orderkey = (SELECT max(l_orderkey) FROM lineitem)""",
)
def row_by_id(spark, sf):
    wanted = table(spark, sf, "lineitem").agg(F.max("l_orderkey")).scalar()
    orders = table(spark, sf, "orders")
    return filters.row_by_id(orders, "o_orderkey", wanted).select("o_orderkey", "o_totalprice", "o_custkey")


def _long_sql(extra: str = "") -> str:
    return f"""WITH {REGION_SQL}, {INDEX_SQL}
    SELECT sido, land_region, land_region AS district, "dealYear", "dealMonth", land_index FROM index_rows
    UNION ALL SELECT sido, land_region, 'GU1', "dealYear", "dealMonth", land_index + 0.5 FROM index_rows
    WHERE CAST(replace(land_region, 'NATION_', '') AS INTEGER) % 2 = 0{extra}"""


@query(
    "u1_union_all",
    _long_sql(""" UNION ALL SELECT sido, land_region, land_region, "dealYear" + 10, "dealMonth", land_index FROM index_rows"""),
)
def union_all(spark, sf):
    long = land_index.wide_to_long(wide_index(spark, sf))
    later = long.where("district = land_region").withColumn("dealYear", F.col("dealYear") + 10)
    return land_index.union_all([long, later])


@query(
    "u2_union_distinct",
    f"""{ADJUSTED_SQL} SELECT sido, land_region, "dealYear", "dealMonth" FROM grid""",
)
def union_distinct(spark, sf):
    return land_index.month_grid(index(spark, sf), landed(spark, sf)).drop("land_index")


@query(
    "u3_distinct_keys",
    f"""{TRADES_SQL} SELECT DISTINCT "sggCd", "umdNm", jibun FROM typed WHERE "umdNm" IS NOT NULL""",
)
def distinct_keys(spark, sf):
    trades = typed_trades(raw_trades(spark, sf))
    return lookups.distinct_keys(trades, ["sggCd", "umdNm", "jibun"])


@query("u4_wide_to_long", _long_sql())
def wide_to_long(spark, sf):
    return land_index.wide_to_long(wide_index(spark, sf))


@query(
    "u5_single_region",
    f"""WITH {REGION_SQL}, {INDEX_SQL} SELECT sido, '세종특별자치시' AS land_region, "dealYear", "dealMonth", land_index FROM index_rows""",
)
def single_region(spark, sf):
    wide = wide_index(spark, sf).where(F.col("지역1") == F.col("지역2")).drop("지역1", "지역2")
    return land_index.wide_to_long(wide).drop("district")


@query(
    "d1_one_per_month",
    f"""WITH {REGION_SQL}, {INDEX_SQL} SELECT sido, land_region, "dealYear", "dealMonth", land_index FROM index_rows""",
)
def one_per_month(spark, sf):
    return index(spark, sf)


@query(
    "m3_time_adjustment",
    f"""{ADJUSTED_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
      round("dealAmount" * 10000 / "excluUseAr" * ("Time_Adjustment"), 2) AS adjusted FROM adjusted""",
)
def time_adjustment(spark, sf):
    from landgauge.functions import numeric as N

    trades = land_index.attach_index(landed(spark, sf), index(spark, sf))
    adjusted = N.nominal_price("dealAmount", "excluUseAr") * F.col("Time_Adjustment")
    return trades.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(adjusted, 2).alias("adjusted")
    )
