"""Files written from the driver tables and read back, and landed answers (S*)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from landgauge.catalog.registry import query, scratch, table
from landgauge.catalog.reshaping import _long_sql
from landgauge.catalog.tables import RAW_SQL, REGION_SQL, raw_trades, region_codes, wide_index
from landgauge.constants import TRADE_COLUMNS
from landgauge.operators.encode import LabelEncoder
from landgauge.operators.land_index import wide_to_long
from landgauge.operators.metrics import regression_metrics
from landgauge.session import dealt
from landgauge.sources import artifacts, landings, payloads, tabular, vectors

RAW_COLUMNS_SQL = ", ".join(f"nullif(\"{c}\", '') AS \"{c}\"" for c in TRADE_COLUMNS)


@query("s1_read_csv", f"WITH {RAW_SQL} SELECT {RAW_COLUMNS_SQL} FROM raw")
def read_csv(spark, sf):
    path = scratch(spark, "s1")
    tabular.write_table(raw_trades(spark, sf).select(*TRADE_COLUMNS), path, fmt="csv")
    rows = tabular.read_trades(spark, f"{path}/*.csv")
    # CSV has no difference between an empty text and none.
    return rows.select(*[F.nullif(F.col(c), F.lit("")).alias(c) for c in TRADE_COLUMNS])


@query(
    "s2_read_many_files",
    f"""WITH {RAW_SQL} SELECT "dealYear", count(*) AS rows, 1::BIGINT AS folders FROM raw GROUP BY 1""",
)
def read_many_files(spark, sf):
    path = scratch(spark, "s2")
    raw = raw_trades(spark, sf).select(*TRADE_COLUMNS)
    parted = raw.withColumn("year", F.col("dealYear"))
    tabular.write_table(parted, path, fmt="csv", partition_by=["year"])
    rows = tabular.read_csv(spark, f"{path}/year=*/*.csv", raw.schema).withColumn(
        "folder", F.regexp_extract(F.col("_metadata.file_path"), r"year=(\d+)", 1)
    )
    return rows.groupBy("dealYear").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("folder").alias("folders")
    )


@query(
    "s2_landed_again",
    f"""WITH {RAW_SQL} SELECT "sggCd", "dealYear", "dealMonth", count(*) AS rows,
          CASE WHEN CAST("dealMonth" AS INTEGER) % 3 = 0 THEN 'third' WHEN CAST("dealMonth" AS INTEGER) % 2 = 0 THEN 'second' ELSE 'first' END AS landing
        FROM raw GROUP BY ALL""",
)
def landed_again(spark, sf):
    """Three landings that overlap, with an old one landing again, a landing without commit, and a compaction between them."""
    base = scratch(spark, "s2-landings")
    raw = raw_trades(spark, sf).select(*TRADE_COLUMNS)
    month = F.col("dealMonth").cast("int")

    def land(name: str, sequence: int, rows):
        landings.land_trades(rows.withColumn("landing", F.lit(name)), base, name, sequence)

    land("first", 1, raw)
    # Parts of what the first landing had, so that rows of it that are left would show.
    land("second", 2, raw.where(month % 2 == 0))
    landings.compact_landings(spark, base)
    land("third", 3, raw.where(month % 3 == 0))
    land("first", 9, raw)
    raw.withColumn("landing", F.lit("lost")).withColumn("_sequence", F.lit(99).cast("long")).write.parquet(f"{base}/landing-killed")
    rows = landings.landed_trades(spark, base)
    return rows.groupBy("sggCd", "dealYear", "dealMonth", "landing").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "s1_reject_broken_lines",
    f"""WITH {RAW_SQL} SELECT count(*) AS rows, CAST(sum(TRY_CAST("dealYear" AS INTEGER)) AS BIGINT) AS years,
          count(nullif(jibun, '')) AS lots, 3 * 2 + 2 AS rejected, 4 AS files FROM raw""",
)
def reject_broken_lines(spark, sf):
    """Files with columns in another order, with one more and one less column, with broken lines, and without a header."""
    path = scratch(spark, "s1-mixed")
    raw = raw_trades(spark, sf)
    part = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(3))
    layouts = [TRADE_COLUMNS, TRADE_COLUMNS[::-1], ["note", *TRADE_COLUMNS]]
    for k, names in enumerate(layouts):
        rows = raw.where(part == k).withColumn("note", F.lit("more, and quoted")).select(*names)
        # Every task writes a file of its own, with the header; one more file of the layout has the broken lines.
        rows.write.csv(f"{path}/layout={k}", header=True, quoteAll=True, escape='"')
        lines = [",".join(names), '"half a line"', '"a","line","of","five","cells"']
        spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.mode("append").text(f"{path}/layout={k}")
    spark.createDataFrame([("no header",), ("1,2,3",)], "value string").coalesce(1).write.text(f"{path}/layout=none")
    rows, rejects = tabular.read_checked(spark, f"{path}/*/*.*", tabular.TRADE_RAW)
    kept = rows.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("dealYear").try_cast("int")).alias("years"),
        F.count(F.nullif("jibun", F.lit(""))).alias("lots"),
    )
    lost = rejects.agg(F.count(F.lit(1)).cast("int").alias("rejected"), F.count_distinct("source_file").cast("int").alias("files"))
    return kept.crossJoin(lost)


@query("s3_read_wide_index", _long_sql())
def read_wide_index(spark, sf):
    path = scratch(spark, "s3")
    wide = wide_index(spark, sf).withColumn("Unnamed: 99", F.lit("x"))
    wide.write.option("header", "true").csv(path)
    return wide_to_long(tabular.read_wide_index(spark, path))


@query("s4_region_codes", f"WITH {REGION_SQL} SELECT code, name FROM codes")
def read_region_codes(spark, sf):
    # One document per province and per file, as the listing service answers them.
    path = scratch(spark, "s4")
    docs = region_codes(spark, sf).groupBy(F.left("code", F.lit(1)).alias("p")).agg(
        F.collect_list(F.struct("code", "name")).alias("regcodes")
    )
    docs.select("regcodes").write.option("maxRecordsPerFile", 1).json(path)
    return tabular.read_region_codes(spark, path)


def _node(name: str, value) -> F.Column:
    return F.coalesce(F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>")), F.lit(""))


def trade_answers(spark, sf):
    """One XML answer per order, with the trades of its lines; some answers are errors."""
    raw = raw_trades(spark, sf)
    item = F.concat(
        F.lit("<item>"),
        *[
            _node(c, F.concat(F.lit(" "), F.col(c), F.lit(" ")))
            for c in ["sggCd", "jibun", "houseType", "excluUseAr", "dealYear", "dealMonth", "dealAmount", "floor"]
        ],
        F.lit("</item>"),
    )
    per_order = raw.groupBy("l_orderkey").agg(F.concat_ws("", F.collect_list(item)).alias("items"))
    slot = F.col("l_orderkey") % 50
    head = (
        F.when(slot == 0, "<header><resultCode>22</resultCode><resultMsg>LIMITED NUMBER</resultMsg></header>")
        .when(slot == 1, "<header><resultCode>99</resultCode><resultMsg>DB ERROR</resultMsg></header>")
        .when(slot == 3, "<header></header>")
        .otherwise("<header><resultCode>000</resultCode><resultMsg>OK</resultMsg></header>")
    )
    body = F.concat(F.lit("<body><items>"), "items", F.lit("</items></body>"))
    whole = F.concat(F.lit("<response>"), head, body, F.lit("</response>"))
    payload = (
        F.when(slot == 2, "service is down")
        .when(slot == 4, F.concat(F.lit("<response>"), head, F.lit("<body><items>"), "items", F.lit("<item>")))
        .when(slot == 5, "<html><body>bad gateway</body></html>")
        .when(
            slot == 6,
            "<OpenAPI_ServiceResponse><cmmMsgHeader><errMsg>SERVICE ERROR</errMsg><returnAuthMsg>LIMITED NUMBER OF SERVICE"
            " REQUESTS EXCEEDS ERROR</returnAuthMsg><returnReasonCode>22</returnReasonCode></cmmMsgHeader></OpenAPI_ServiceResponse>",
        )
        .when(slot == 7, "<response><header><resultCode>000</resultCode></header></response>")
        .otherwise(whole)
    )
    return per_order.select("l_orderkey", payload.alias("payload"))


@query(
    "s5_trade_payload",
    f"""WITH {RAW_SQL} SELECT l_orderkey, "sggCd", jibun, "houseType", "excluUseAr", "dealYear", "dealMonth", "dealAmount",
      coalesce(floor, '') AS floor, '' AS "umdNm", '' AS "rgstDate" FROM raw WHERE l_orderkey % 50 NOT IN (0, 1, 2, 4, 5, 6, 7)""",
)
def trade_payload(spark, sf):
    answers = payloads.parse_trade_answers(trade_answers(spark, sf))
    rows = payloads.trade_rows(answers, keep=["l_orderkey"])
    return rows.select(
        "l_orderkey", "sggCd", "jibun", "houseType", "excluUseAr", "dealYear", "dealMonth",
        "dealAmount", "floor", "umdNm", "rgstDate",
    )


@query(
    "st3_trade_status",
    """SELECT CASE WHEN l_orderkey % 50 IN (0, 6) THEN 'quota' WHEN l_orderkey % 50 = 1 THEN 'service_error'
         WHEN l_orderkey % 50 IN (2, 4, 5, 7) THEN 'parse_error' ELSE 'ok' END AS status,
         count(*) AS answers, CAST(sum(CASE WHEN l_orderkey % 50 IN (0, 1, 2, 4, 5, 6, 7) THEN 0 ELSE n END) AS BIGINT) AS items
       FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) GROUP BY 1""",
)
def trade_status(spark, sf):
    answers = payloads.parse_trade_answers(trade_answers(spark, sf))
    return answers.groupBy("status").agg(
        F.count(F.lit(1)).alias("answers"), F.sum("item_count").cast("long").alias("items")
    )


def building_answers(spark, sf):
    """One JSON answer per customer: object or list items, empty and failed answers."""
    k = F.col("c_custkey")
    item = F.concat(
        F.lit('{"indrMechUtcnt": 1, "indrAutoUtcnt": "'), (k % 7).cast("string"),
        F.lit('", "oudrMechUtcnt": "", "hhldCnt": '), (k % 4).cast("string"),
        F.lit(', "rideLftCnt": '), (k % 2).cast("string"),
        F.lit(', "rideUseElvtCnt": "'), (k % 3).cast("string"),
        F.lit('", "strctCdNm": "'), F.when(k % 2 == 0, "철근콘크리트구조").otherwise("목구조"),
        F.lit('", "mainPurpsCdNm": "'), F.when(k % 5 == 0, "제1종근린생활시설").otherwise("공동주택"),
        F.lit('", "grndFlrCnt": "'), F.when(k % 6 == 0, "").otherwise((k % 6).cast("string")),
        F.lit('", "useAprDay": "19'), F.lpad((k % 100).cast("string"), 2, "0"), F.lit('0102 00:00"}'),
    )
    ok = F.lit('{"response": {"header": {"resultCode": "00", "resultMsg": "OK"}, "body": {"items": ')
    slot = k % 20
    payload = (
        F.when(slot == 0, F.concat(ok, F.lit('""}}}')))
        .when(slot == 1, "API TRAFFIC exceeded")
        .when(slot == 2, "<html>oops</html>")
        .when(slot == 3, '{"response": {"header": {"resultCode": "22", "resultMsg": "limited requests"}}}')
        .when(slot == 4, '{"response": {"header": {"resultCode": "04", "resultMsg": "HTTP ERROR"}}}')
        .when(slot % 2 == 0, F.concat(ok, F.lit('{"item": '), item, F.lit("}}}}")))
        .otherwise(F.concat(ok, F.lit('{"item": ['), item, F.lit(', {"hhldCnt": 999}]}}}}')))
    )
    return dealt(table(spark, sf, "customer").select("c_custkey")).select("c_custkey", payload.alias("payload"))


@query(
    "s6_building_payload",
    """SELECT c_custkey, CASE c_custkey % 20 WHEN 0 THEN 'no_record' WHEN 1 THEN 'quota' WHEN 2 THEN 'parse_error' WHEN 3 THEN 'quota'
         WHEN 4 THEN 'service_error' ELSE 'ok' END AS status,
         CASE WHEN ok THEN CASE WHEN c_custkey % 4 > 0 THEN round((1 + c_custkey % 7) / CAST(c_custkey % 4 AS DOUBLE), 6) ELSE 0.8 END END AS parking_ratio,
         CASE WHEN ok THEN CASE WHEN c_custkey % 2 > 0 OR c_custkey % 3 > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END END AS has_elevator,
         CASE WHEN ok THEN CASE WHEN c_custkey % 2 = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END END AS building_structure,
         CASE WHEN ok THEN CASE WHEN c_custkey % 5 = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END END AS is_commercial_villa,
         CASE WHEN ok THEN CASE WHEN c_custkey % 6 = 0 THEN 4.0::DOUBLE ELSE CAST(c_custkey % 6 AS DOUBLE) END END AS total_floors,
         CASE WHEN ok THEN '19' || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') || '0102' END AS approval_date
       FROM (SELECT *, c_custkey % 20 > 4 AS ok FROM customer)""",
)
def building_payload(spark, sf):
    facts = payloads.parse_building_answers(building_answers(spark, sf))
    whole = ["has_elevator", "building_structure", "is_commercial_villa", "total_floors"]
    return facts.select(
        "c_custkey", "status", F.round("parking_ratio", 6).alias("parking_ratio"), "approval_date",
        *[F.col(c).cast("double").alias(c) for c in whole],
    )


def geocode_answers(spark, sf):
    k = F.col("c_custkey")
    slot = k % 10
    lng, lat = (k % 400 + 12600).cast("string"), (k % 500 + 3300).cast("string")
    address = (
        F.when(slot == 0, '{"documents": []}')
        .when(slot == 1, "gateway timeout")
        .when(slot == 2, '{"documents": [{"x": "east", "y": "north"}]}')
        .otherwise(F.concat(F.lit('{"documents": [{"x": "'), lng, F.lit('", "y": "'), lat, F.lit('"}, {"x": "0", "y": "0"}]}')))
    )
    place = (
        F.when(k % 3 == 0, '{"documents": []}')
        .when(k % 3 == 1, "oops")
        .otherwise(F.concat(F.lit('{"documents": [{"place_name": "역'), (k % 9).cast("string"), F.lit('", "distance": "'), (k % 1000).cast("string"), F.lit('"}]}')))
    )
    return dealt(table(spark, sf, "customer").select("c_custkey")).select(
        "c_custkey", address.alias("payload"), place.alias("place"),
        F.when(slot == 3, "API_LIMIT_REACHED").alias("call_error"),
    )


GEOCODE_SQL = """
answers AS (SELECT c_custkey, CASE c_custkey % 10 WHEN 0 THEN 'ADDRESS_NOT_FOUND' WHEN 1 THEN 'EXCEPTION_PARSE'
    WHEN 2 THEN 'EXCEPTION_PARSE' WHEN 3 THEN 'API_LIMIT_REACHED' END AS error FROM customer)
"""


@query(
    "s7_geocode_payload",
    f"""WITH {GEOCODE_SQL} SELECT c_custkey, error, CASE WHEN error IS NULL THEN CAST(c_custkey % 500 + 3300 AS DOUBLE) END AS lat,
      CASE WHEN error IS NULL THEN CAST(c_custkey % 400 + 12600 AS DOUBLE) END AS lng FROM answers""",
)
def geocode_payload(spark, sf):
    return payloads.parse_geocode_answers(
        geocode_answers(spark, sf), call_error="call_error"
    ).select("c_custkey", "error", "lat", "lng")


@query(
    "s8_place_payload",
    f"""WITH {GEOCODE_SQL} SELECT c_custkey, CASE WHEN error IS NULL AND c_custkey % 3 = 2 THEN '역' || (c_custkey % 9) END AS subway_name,
      CASE WHEN error IS NULL AND c_custkey % 3 = 2 THEN CAST(c_custkey % 1000 AS DOUBLE) END AS subway_dist FROM answers""",
)
def place_payload(spark, sf):
    return payloads.parse_geocode_answers(
        geocode_answers(spark, sf), place_payload="place", call_error="call_error"
    ).select("c_custkey", "subway_name", "subway_dist")


@query(
    "s8_place_quota",
    f"""WITH {GEOCODE_SQL} SELECT c_custkey, error IS NULL AS located,
      CASE WHEN error IS NULL AND c_custkey % 7 = 3 THEN 'API_LIMIT_REACHED' ELSE error END AS error FROM answers""",
)
def place_quota(spark, sf):
    """A used-up quota of the place call is the row's error; other failures of it are not. Coordinates stay."""
    failed = F.when(F.col("c_custkey") % 7 == 3, "API_LIMIT_REACHED").when(F.col("c_custkey") % 7 == 4, "API_ERROR_500")
    answers = geocode_answers(spark, sf).withColumn("place_error", failed)
    answers = answers.withColumn("place", F.when(failed.isNull(), F.col("place")))
    found = payloads.parse_geocode_answers(answers, place_payload="place", call_error="call_error", place_error="place_error")
    return found.select("c_custkey", F.col("lat").isNotNull().alias("located"), "error")


@query(
    "s9_legal_dong_payload",
    """SELECT sgg, "umdNm", max(bjdong) AS bjdong FROM (
         SELECT CAST(10000 + s_nationkey AS VARCHAR) AS sgg, 'dong' || (s_suppkey % 37) AS "umdNm",
           lpad(CAST(s_suppkey % 1000 AS VARCHAR), 5, '0') AS bjdong FROM supplier) GROUP BY 1, 2""",
)
def legal_dong_payload(spark, sf):
    s = F.col("s_suppkey")
    sgg = (F.col("s_nationkey") + 10000).cast("string")
    payload = F.concat(
        F.lit('{"regcodes": [{"code": "'), sgg, F.lit('00000", "name": "one"}, {"code": "'), sgg,
        F.lpad((s % 1000).cast("string"), 5, "0"), F.lit('", "name": "prov city dong'),
        (s % 37).cast("string"), F.lit('"}]}'),
    )
    landed = table(spark, sf, "supplier").select(sgg.alias("sgg"), payload.alias("payload"))
    return payloads.legal_dong_codes(landed)


@query("s10_overwrite_sink", "SELECT o_orderkey, o_totalprice FROM orders")
def overwrite_sink(spark, sf):
    path = scratch(spark, "s10")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    tabular.write_table(orders.withColumn("o_totalprice", F.lit(0.0)), path)
    tabular.write_table(orders, path)
    return spark.read.parquet(path)


@query("s11_append_sink", "SELECT event_id, event_type FROM events")
def append_sink(spark, sf):
    path = scratch(spark, "s11")
    events = table(spark, sf, "events").select("event_id", "event_type")
    clicks = F.col("event_type") == "click"
    tabular.append_results(events.where(clicks), path)
    tabular.append_results(events.where(~clicks), path)
    return spark.read.parquet(path)


@query(
    "s12_partitioned_parquet",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS "dealYear", count(*) AS rows FROM orders GROUP BY 1""",
)
def partitioned_parquet(spark, sf):
    path = scratch(spark, "s12")
    orders = table(spark, sf, "orders").withColumn("dealYear", F.year("o_orderdate"))
    tabular.write_table(orders, path, partition_by=["dealYear"])
    return spark.read.parquet(path).groupBy("dealYear").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "s13_embedding_table",
    """SELECT vec_id AS id, len(embedding) AS dims, round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS total FROM embeddings""",
)
def embedding_table(spark, sf):
    path = scratch(spark, "s13")
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    vectors.write_embeddings(rows, path)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return vectors.read_embeddings(spark, path).select(
        "id", F.size("embedding").cast("long").alias("dims"), F.round(total, 6).alias("total")
    )


@query(
    "s14_bounded_parts",
    """SELECT count(*) AS rows, CAST(sum(vec_id) AS BIGINT) AS ids, true AS bounded, count(*) AS in_order,
         CAST(ceil(count(*) * 64 * 4 / 40000.0::DOUBLE) AS BIGINT) AS parts FROM embeddings""",
)
def bounded_parts(spark, sf):
    """The files written, their rows, and the rows that come back at the place of their id."""
    path = scratch(spark, "s14")
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    parts, per_part = vectors.part_layout(rows.count(), 64, part_bytes=40_000)
    vectors.write_embedding_parts(rows, path, "id", parts)
    files = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    files = files.agg(F.count("file").alias("parts"), F.max("n").alias("longest"))
    again = vectors.read_embedding_parts(spark, path).select("id", "row")
    placed = again.withColumn("wanted", F.row_number().over(Window.orderBy("id")) - 1)
    back = placed.agg(
        F.count(F.lit(1)).alias("rows"), F.sum("id").alias("ids"), F.count_if(F.col("row") == F.col("wanted")).alias("in_order")
    )
    return back.withColumns(
        {
            "bounded": files.select(F.col("longest") <= per_part).scalar(),
            "parts": files.select(F.col("parts").cast("long")).scalar(),
        }
    )


@query(
    "s15_saved_encoder",
    """SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS code FROM orders""",
)
def saved_encoder(spark, sf):
    folder = scratch(spark, "s15")
    orders = table(spark, sf, "orders")
    artifacts.save_mapping(LabelEncoder.fit(orders, ["o_orderpriority"]).table(), folder, "labels")
    again = LabelEncoder.from_table(artifacts.load_mapping(spark, folder, "labels"))
    return again.transform(orders).select("o_orderkey", F.col("o_orderpriority_encoded").alias("code"))


@query(
    "s16_metric_rows",
    """WITH p AS (SELECT CAST(o_totalprice AS DOUBLE) AS y, CAST(o_totalprice AS DOUBLE) * (90 + o_orderkey % 20) / 100 AS p,
         o_orderkey % 2 AS run FROM orders)
       SELECT 'run' || run AS run, count(*) AS rows, round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2,
         round(avg(abs(y - p)), 4) AS mae, round(avg(abs((y - p) / y)) * 100, 6) AS mape FROM p GROUP BY run""",
)
def metric_rows(spark, sf):
    """The metric rows of two runs, appended to one report table and read back."""
    path = scratch(spark, "s16")
    y = F.col("o_totalprice").cast("double")
    scored = table(spark, sf, "orders").select(
        "o_orderkey", y.alias("y"), (y * (90 + F.col("o_orderkey") % 20) / 100).alias("p")
    )
    for run in (0, 1):
        row = regression_metrics(scored.where(F.col("o_orderkey") % 2 == run), "y", "p")
        artifacts.write_metrics(row.withColumn("run", F.lit(f"run{run}")), path)
    rows = spark.read.parquet(path)
    return rows.select("run", "rows", F.round("r2", 6).alias("r2"), F.round("mae", 4).alias("mae"), F.round("mape", 6).alias("mape"))
