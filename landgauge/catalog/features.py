"""Imputation and encoders over whole tables (I*, ML1-ML5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from landgauge.catalog.aggregates import rounded
from landgauge.catalog.parsing import LISTING_SQL, listings
from landgauge.catalog.registry import query, table
from landgauge.catalog.tables import RAW_SQL, TYPED_SQL, raw_trades
from landgauge.operators import encode, impute, lookups, lsa, split
from landgauge.plans.trades import typed_trades

KEYS = ["l_orderkey", "l_linenumber", "l_partkey"]
KEYS_SQL = ", ".join(KEYS)
TYPED = f"WITH {RAW_SQL}, {TYPED_SQL}"
LISTED = f"{TYPED}, {LISTING_SQL}"


def _typed(spark, sf):
    return typed_trades(raw_trades(spark, sf))


@query(
    "i1_building_defaults",
    f"""{LISTED} SELECT {KEYS_SQL}, coalesce(parking_ratio, 0.8) AS parking_ratio,
      CAST(coalesce(has_elevator, 0) AS INTEGER) AS has_elevator, CAST(1 AS INTEGER) AS building_structure,
      CAST(coalesce(CASE WHEN l_partkey % 2 = 0 THEN 1 END, 0) AS INTEGER) AS is_commercial_villa,
      CAST(coalesce(CASE WHEN l_partkey % 4 > 0 THEN total_floors END, 4) AS INTEGER) AS total_floors FROM listing""",
)
def building_defaults(spark, sf):
    p = F.col("l_partkey")
    rows = listings(spark, sf).withColumns(
        {
            "building_structure": F.lit(None).cast("int"),
            "is_commercial_villa": F.when(p % 2 == 0, 1),
            "total_floors": F.when(p % 4 > 0, F.col("total_floors")),
        }
    )
    columns = ["parking_ratio", "has_elevator", "building_structure", "is_commercial_villa", "total_floors"]
    return lookups.building_defaults(rows).select(*KEYS, *columns)


@query(
    "i2_approval_date",
    f"""{TYPED} SELECT {KEYS_SQL}, CASE WHEN length(own) >= 4 THEN own
      ELSE coalesce("buildYear" || '0101', '20100101') END AS approval_date
    FROM (SELECT *, CASE l_partkey % 4 WHEN 0 THEN "dealYear" || '0305' WHEN 1 THEN '199' WHEN 2 THEN '' END AS own FROM typed)""",
)
def approval_date(spark, sf):
    p = F.col("l_partkey")
    own = (
        F.when(p % 4 == 0, F.concat(F.col("dealYear").cast("string"), F.lit("0305")))
        .when(p % 4 == 1, "199")
        .when(p % 4 == 2, "")
    )
    rows = _typed(spark, sf).withColumn("approval_date", own)
    return lookups.approval_date_fallback(rows).select(*KEYS, "approval_date")


@query(
    "i3_median_fill",
    f"""{TYPED}, g AS (SELECT "umdNm", median("buildYear") AS b, median("Age") AS a, median(floor) AS f FROM typed
      WHERE "umdNm" IS NOT NULL GROUP BY 1),
    once AS (SELECT {KEYS_SQL}, coalesce("buildYear", b) AS b, coalesce("Age", a) AS a, coalesce(floor, f) AS f
      FROM typed LEFT JOIN g USING ("umdNm"))
    SELECT {KEYS_SQL}, coalesce(b, (SELECT median(b) FROM once)) AS "buildYear",
      coalesce(a, (SELECT median(a) FROM once)) AS "Age", coalesce(f, (SELECT median(f) FROM once)) AS floor FROM once""",
)
def median_fill(spark, sf):
    columns = ["buildYear", "Age", "floor"]
    return impute.median_fill(_typed(spark, sf), columns).select(*KEYS, *columns)


@query(
    "i4_parking_fill",
    f"""{LISTED}, m AS (SELECT "umdNm", avg(parking_ratio) AS mean FROM listing WHERE "umdNm" IS NOT NULL GROUP BY 1)
    SELECT {KEYS_SQL}, round(coalesce(parking_ratio, mean, 0.5), 6) AS parking_ratio FROM listing LEFT JOIN m USING ("umdNm")""",
)
def parking_fill(spark, sf):
    rows = impute.parking_fill(listings(spark, sf)).select(*KEYS, "parking_ratio")
    return rounded(rows, "parking_ratio", digits=6)


@query(
    "i5_elevator_fill",
    f"""{LISTED} SELECT {KEYS_SQL}, CAST(coalesce(has_elevator, CASE WHEN "buildYear" + 20 >= 2015 THEN 1 ELSE 0 END) AS INTEGER)
      AS has_elevator FROM listing""",
)
def elevator_fill(spark, sf):
    rows = listings(spark, sf).withColumn("buildYear", F.col("buildYear") + 20)
    return impute.elevator_fill(rows).select(*KEYS, "has_elevator")


@query(
    "i6_floors_fill",
    f"""{TYPED} SELECT {KEYS_SQL}, CAST(coalesce(CASE WHEN l_partkey % 2 = 0 THEN 5 END, floor, 1) AS BIGINT) AS total_floors FROM typed""",
)
def floors_fill(spark, sf):
    rows = _typed(spark, sf).withColumn(
        "total_floors", F.when(F.col("l_partkey") % 2 == 0, F.lit(5).cast("long"))
    )
    return impute.floors_fill(rows).select(*KEYS, "total_floors")


SPLIT_SQL = """
dated AS (
  SELECT o_orderkey, o_orderdate, o_totalprice, o_custkey,
    CASE WHEN o_orderdate >= TIMESTAMP '2000-12-01' AND o_orderkey % 5 = 0 THEN 'LATE' || (o_orderkey % 3)
      WHEN o_orderkey % 31 = 0 THEN NULL ELSE o_orderpriority END AS kind FROM orders),
cut AS (
  SELECT *, row_number() OVER (ORDER BY CAST(o_orderdate AS DATE), o_orderkey % 64, o_orderkey)
    <= (SELECT CAST(floor(count(*) * 0.8) AS BIGINT) FROM orders) AS is_train FROM dated)
"""


def split_orders(spark, sf):
    """Orders with a category that is new in the test slice, and the chronological split."""
    k = F.col("o_orderkey")
    kind = (
        F.when((F.col("o_orderdate") >= "2000-12-01") & (k % 5 == 0), F.concat(F.lit("LATE"), (k % 3).cast("string")))
        .when(k % 31 == 0, None)
        .otherwise(F.col("o_orderpriority"))
    )
    rows = table(spark, sf, "orders").withColumn("kind", kind)
    rows = rows.withColumn("deal_date", F.to_date("o_orderdate"))
    return split.chronological_split(rows, "deal_date", "o_orderkey", inside_day=[F.pmod("o_orderkey", F.lit(64))])


@query(
    "ml1_label_codes",
    f"""WITH {SPLIT_SQL}, lv AS (SELECT DISTINCT coalesce(kind, 'UNKNOWN') AS v FROM cut WHERE is_train UNION SELECT 'UNKNOWN'),
    codes AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM lv)
    SELECT o_orderkey, CAST(coalesce(code, (SELECT code FROM codes WHERE v = 'UNKNOWN')) AS INTEGER) AS kind_encoded
    FROM cut LEFT JOIN codes ON kind = v""",
)
def label_codes(spark, sf):
    rows = split_orders(spark, sf)
    encoder = encode.LabelEncoder.fit(rows.where(F.col("split") == "train"), ["kind"])
    return encoder.transform(rows).select("o_orderkey", "kind_encoded")


@query(
    "ml2_robust_scaler",
    f"""WITH {SPLIT_SQL}, f AS (SELECT *, CASE WHEN o_orderkey % 9 = 0 THEN 0 ELSE o_totalprice END AS x, 1.0::DOUBLE AS one FROM cut),
    s AS (SELECT median(x) AS m, quantile_cont(x, 0.75) - quantile_cont(x, 0.25) AS w, median(o_custkey) AS cm,
      quantile_cont(o_custkey, 0.75) - quantile_cont(o_custkey, 0.25) AS cw FROM f WHERE is_train)
    SELECT o_orderkey, round((x - m) / w, 6) AS x_scaled, round((o_custkey - cm) / cw, 6) AS o_custkey_scaled,
      (one - 1) / 1 AS one_scaled FROM f, s""",
)
def robust_scaler(spark, sf):
    rows = split_orders(spark, sf).withColumns(
        {"x": F.when(F.col("o_orderkey") % 9 != 0, F.col("o_totalprice")), "one": F.lit(1.0)}
    )
    scaler = encode.RobustScaler.fit(rows.where(F.col("split") == "train"), ["x", "o_custkey", "one"])
    scaled = scaler.transform(rows).select("o_orderkey", "x_scaled", "o_custkey_scaled", "one_scaled")
    return rounded(scaled, "x_scaled", "o_custkey_scaled", digits=6)


@query(
    "ml3_one_hot",
    f"""{TYPED} SELECT {KEYS_SQL}, CASE WHEN "houseType" = '연립' THEN 1 ELSE 0 END AS "houseType_연립",
      CASE WHEN "houseType" = '연립다세대' THEN 1 ELSE 0 END AS "houseType_연립다세대" FROM typed""",
)
def one_hot(spark, sf):
    rows = _typed(spark, sf)
    levels = encode.one_hot_levels(rows, "houseType")
    return encode.one_hot(rows, "houseType", levels).select(*KEYS, *[f"houseType_{v}" for v in levels])


@query(
    "ml4_target_encode",
    f"""WITH {SPLIT_SQL}, m AS (SELECT kind, avg(o_totalprice) AS e FROM cut WHERE is_train AND kind IS NOT NULL GROUP BY 1)
    SELECT o_orderkey, round(e, 3) AS kind_encoded FROM cut LEFT JOIN m USING (kind)""",
)
def target_encode(spark, sf):
    rows = split_orders(spark, sf)
    means = encode.target_means(rows.where(F.col("split") == "train"), "kind", "o_totalprice")
    encoded = encode.target_encode(rows, means, "kind").select("o_orderkey", "kind_encoded")
    return rounded(encoded, "kind_encoded", digits=3)


TERMS_SQL = """
tok AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}') AS t FROM documents),
terms AS (SELECT doc_id, unnest(list_concat(t, list_transform(list_zip(t[:len(t)-1], t[2:]), lambda p: p[1] || ' ' || p[2]))) AS term FROM tok),
tf AS (SELECT doc_id, term, count(*) AS n FROM terms GROUP BY ALL),
vocab AS (SELECT term, uses, docs, ln((1.0::DOUBLE + (SELECT count(*) FROM documents)) / (1.0::DOUBLE + docs)) + 1 AS idf,
    row_number() OVER (ORDER BY term) - 1 AS idx
  FROM (SELECT term, CAST(sum(n) AS BIGINT) AS uses, count(*) AS docs FROM tf GROUP BY 1 ORDER BY uses DESC, term LIMIT 5000))
"""


@query(
    "ml5_vocabulary",
    f"""WITH {TERMS_SQL} SELECT CAST(idx AS INTEGER) AS idx, term, uses, docs, round(idf, 8) AS idf FROM vocab""",
)
def vocabulary(spark, sf):
    return rounded(lsa.vocabulary(table(spark, sf, "documents"), "text"), "idf", digits=8)


@query(
    "ml5_tfidf_weights",
    f"""WITH {TERMS_SQL}, w AS (SELECT doc_id, idx, term, n * idf AS w FROM tf JOIN vocab USING (term))
    SELECT doc_id, CAST(idx AS INTEGER) AS idx, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w""",
)
def tfidf_weights(spark, sf):
    documents = table(spark, sf, "documents")
    weights = lsa.TermWeights.fit(documents, "text")
    return rounded(weights.entries(documents, "doc_id", "text"), "weight", digits=6)


@query(
    "st2_purge_retryable",
    """SELECT event_id, err FROM (SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'ADDRESS_NOT_FOUND'
         WHEN 1 THEN 'EXCEPTION_CONN: ' || event_type WHEN 2 THEN 'API_FORBIDDEN_403' WHEN 3 THEN 'MAX_RETRIES_EXCEEDED'
         WHEN 4 THEN 'EXCEPTION_PARSE: ' || event_type END AS err FROM events)
       WHERE err IS NULL OR err = 'ADDRESS_NOT_FOUND' OR starts_with(err, 'EXCEPTION_PARSE')""",
)
def purge_retryable(spark, sf):
    e = F.col("event_id") % 6
    text = (
        F.when(e == 0, "ADDRESS_NOT_FOUND")
        .when(e == 1, F.concat(F.lit("EXCEPTION_CONN: "), F.col("event_type")))
        .when(e == 2, "API_FORBIDDEN_403")
        .when(e == 3, "MAX_RETRIES_EXCEEDED")
        .when(e == 4, F.concat(F.lit("EXCEPTION_PARSE: "), F.col("event_type")))
    )
    answers = table(spark, sf, "events").select("event_id", text.alias("err"))
    return lookups.purge_retryable(answers, "err")


@query(
    "st2_purge_by_text",
    """SELECT event_id, err FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'address_not_found'
         WHEN 1 THEN 'api_error_400' WHEN 2 THEN 'EXCEPTION_CONN: winerror ' || event_type END AS err FROM events)
       WHERE err IS NULL OR err = 'address_not_found'""",
)
def purge_by_text(spark, sf):
    e = F.col("event_id") % 4
    text = (
        F.when(e == 0, "address_not_found")
        .when(e == 1, "api_error_400")
        .when(e == 2, F.concat(F.lit("EXCEPTION_CONN: winerror "), F.col("event_type")))
    )
    answers = table(spark, sf, "events").select("event_id", text.alias("err"))
    return lookups.purge_by_text(answers, "err")
