"""Files, landed answers and incremental ingestion."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from landgauge.constants import TRADE_COLUMNS
from landgauge.operators.land_index import wide_to_long
from landgauge.sources import commits, landings, payloads, tabular, vectors
from landgauge.streaming import ingest


def test_trade_csv_with_byte_order_mark(spark, tmp_path):
    header = ",".join(TRADE_COLUMNS)
    row = ["11110", "이화동", "5-10", "빌라, \"A\""] + [""] * 16
    row[12] = "12,500"
    quoted = ",".join('"' + v.replace('"', '""') + '"' for v in row)
    for name in ("a.csv", "b.csv"):
        (tmp_path / name).write_text("﻿" + header + "\n" + quoted + "\n", encoding="utf-8")
    rows = tabular.read_trades(spark, str(tmp_path / "*.csv")).collect()
    assert len(rows) == 2 and {r.source_file for r in rows} == {"a.csv", "b.csv"}
    assert rows[0].sggCd == "11110" and rows[0].mhouseNm == '빌라, "A"' and rows[0].dealAmount == "12,500"


def test_wide_index_with_repeated_headers(spark, tmp_path):
    lines = ["No,지역,지역,지역,2021년 5월,", "No,지역,지역,지역,지수,", "1,경기,수원시,수원시,\"1,000.5\","]
    (tmp_path / "i.csv").write_text("\n".join(lines), encoding="utf-8")
    rows = wide_to_long(tabular.read_wide_index(spark, str(tmp_path / "i.csv"))).collect()
    assert [(r.sido, r.land_region, r.dealYear, r.dealMonth, r.land_index) for r in rows] == [("경기", "수원시", 2021, 5, 1000.5)]


def test_legacy_korean_charset(spark, tmp_path):
    (tmp_path / "i.csv").write_bytes("No,지역,지역,2021년 5월\n1,경기,수원시,99.5\n".encode("cp949"))
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    try:
        wide = tabular.read_wide_index(spark, str(tmp_path / "i.csv"), encoding="x-windows-949")
        assert wide_to_long(wide).first().land_region == "수원시"
    finally:
        spark.conf.unset("spark.sql.legacy.javaCharsets")


def test_region_codes(spark, tmp_path):
    doc = {"regcodes": [{"code": "1111000000", "name": "서울특별시 종로구"}]}
    (tmp_path / "r.json").write_text(json.dumps(doc, indent=1, ensure_ascii=False), encoding="utf-8")
    assert tabular.read_region_codes(spark, str(tmp_path / "r.json")).first().code == "1111000000"


def test_part_layout():
    assert vectors.part_layout(468_423, 128) == (3, 156_141)
    assert vectors.part_layout(0, 128) == (1, 0)


def answer(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "i int, payload string")


def test_trade_answers(spark):
    item = "<item><sggCd> 11110 </sggCd><umdNm/></item>"
    df = answer(
        spark,
        f"<response><header><resultCode>000</resultCode></header><body><items>{item}{item}</items></body></response>",
        f"<response><body><items>{item}</items></body></response>",
        "<response><header><resultCode>22</resultCode><resultMsg>limited number</resultMsg></header></response>",
        "<response><header><resultCode>30</resultCode><resultMsg>KEY</resultMsg></header></response>",
        "<response><header><resultCode>00</resultCode></header><body><items/></body></response>",
        "gateway",
    )
    parsed = payloads.parse_trade_answers(df)
    assert [(r.status, r.item_count) for r in parsed.orderBy("i").collect()] == [
        ("ok", 2), ("ok", 1), ("quota", 0), ("service_error", 0), ("ok", 0), ("parse_error", 0),
    ]
    rows = payloads.trade_rows(parsed, keep=["i"]).collect()
    assert len(rows) == 3 and {(r.sggCd, r.umdNm, r.jibun) for r in rows} == {("11110", "", "")}
    assert payloads.rejected_answers(parsed).count() == 3


def register(item, code="00", msg=""):
    return json.dumps({"response": {"header": {"resultCode": code, "resultMsg": msg}, "body": {"items": item}}})


def test_building_answers(spark):
    item = {"hhldCnt": "4", "indrAutoUtcnt": 3, "rideLftCnt": 0, "rideUseElvtCnt": "1", "strctCdNm": "철근콘크리트구조",
            "mainPurpsCdNm": "다세대주택", "grndFlrCnt": "5", "useAprDay": "20150304 "}
    df = answer(
        spark, register({"item": item}), register({"item": [item, {}]}), register(""), register({"item": []}),
        register("", "22", "LIMITED"), register("", "10", "x"), "TRAFFIC over", "<oops>",
    )
    rows = payloads.parse_building_answers(df).orderBy("i").collect()
    assert [r.status for r in rows] == ["ok", "ok", "no_record", "no_record", "quota", "service_error", "quota", "parse_error"]
    for r in rows[:2]:
        assert (r.parking_ratio, r.has_elevator, r.building_structure, r.is_commercial_villa, r.total_floors, r.approval_date) == (
            0.75, 1, 1, 0, 5, "20150304")
    assert rows[2].parking_ratio is None


def test_geocode_answers(spark):
    df = answer(spark, '{"documents": [{"x": "127.5", "y": "37.5"}]}', '{"documents": []}', "{}", "oops").withColumn(
        "place", F.when(F.col("i") == 0, '{"documents": [{"place_name": "역", "distance": "320"}]}')
    )
    rows = payloads.parse_geocode_answers(df, place_payload="place").orderBy("i").collect()
    assert (rows[0].lat, rows[0].lng, rows[0].subway_name, rows[0].subway_dist, rows[0].error) == (37.5, 127.5, "역", 320.0, None)
    assert [r.error for r in rows[1:]] == ["ADDRESS_NOT_FOUND", "ADDRESS_NOT_FOUND", "EXCEPTION_PARSE"]


def test_legal_dong_codes(spark):
    text = json.dumps({"regcodes": [
        {"code": "1111000000", "name": "서울특별시"}, {"code": "1111010100", "name": "서울특별시 종로구 청운동"},
        {"code": "1111010200", "name": "서울특별시 종로구 청운동"},
    ]})
    df = spark.createDataFrame([("11110", text)], "sgg string, payload string")
    assert [tuple(r) for r in payloads.legal_dong_codes(df).collect()] == [("11110", "청운동", "10200")]


SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("status", T.StringType()), T.StructField("v", T.LongType())])


def test_ingest_resumes_and_keeps_the_newest(spark, tmp_path):
    landed, out, checkpoint = (str(tmp_path / n) for n in ("landed", "out", "cp"))

    def land(name, rows):
        (tmp_path / "landed").mkdir(exist_ok=True)
        (tmp_path / "landed" / name).write_text("\n".join(json.dumps(r) for r in rows))

    def run():
        ingest.ingest(spark, landed, SCHEMA, lambda df: df, out, checkpoint)
        return {r.k: r.v for r in ingest.results(spark, out, ["k"], ["v"]).collect()}

    land("1.json", [{"k": "a", "status": "ok", "v": 1}, {"k": "b", "status": "quota", "v": 1}])
    assert run() == {"a": 1}
    assert run() == {"a": 1}
    land("2.json", [{"k": "a", "status": "ok", "v": 0}, {"k": "b", "status": "ok", "v": 2}])
    assert run() == {"a": 0, "b": 2}
    assert spark.read.parquet(f"{out}/accepted").count() == 3
    assert spark.read.parquet(f"{out}/rejected").count() == 1


def test_next_requests(spark):
    wanted = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int")
    answers = spark.createDataFrame([("1", None), ("2", "API_ERROR_500")], "k string, error string")
    assert {r.k for r in ingest.next_requests(wanted, answers, ["k"]).collect()} == {"2", "3"}


def test_quota_stops(spark):
    df = spark.createDataFrame([("ok",), ("quota",)], "status string")
    assert ingest.quota_reached(df).first().stop is True
    assert ingest.quota_reached(df.where("status = 'ok'")).first().stop is False


def test_broken_trade_answers_are_asked_again(spark):
    from landgauge.sources.payloads import parse_trade_answers, trade_rows

    item = "<item><dealAmount>1</dealAmount></item>"
    fine = f"<response><header><resultCode>00</resultCode></header><body><items>{item}</items></body></response>"
    answers = {
        "ok": fine,
        "cut": fine[: fine.index("</items>")] + "<item>",
        "html": "<html><p>bad gateway</html>",
        "malformed": fine.replace("</item>", ""),
        "no body": "<response><header><resultCode>00</resultCode></header></response>",
        "gateway": "<OpenAPI_ServiceResponse><cmmMsgHeader><returnAuthMsg>LIMITED NUMBER</returnAuthMsg></cmmMsgHeader></OpenAPI_ServiceResponse>",
        "null": None,
    }
    df = spark.createDataFrame(list(answers.items()), "name string, payload string")
    parsed = parse_trade_answers(df)
    status = {r["name"]: r["status"] for r in parsed.select("name", "status").collect()}
    broken = dict.fromkeys(["cut", "html", "malformed", "no body", "null"], "parse_error")
    assert status == {"ok": "ok", "gateway": "quota", **broken}
    assert trade_rows(parsed).count() == 1


def test_blank_deal_day_is_null(spark):
    from landgauge.plans.trades import typed_trades

    names = "sggCd buildYear excluUseAr landAr floor dealYear dealMonth dealDay dealAmount".split()
    rows = spark.createDataFrame([("11110", "2001", "10.5", "", "3", "2020", "", "", "1,000")], names)
    got = typed_trades(rows).first()
    assert (got["dealYear"], got["dealMonth"], got["dealDay"], got["dealAmount"]) == (2020, None, None, 1000)


def test_killed_batches_are_not_read_and_compaction_changes_nothing(spark, tmp_path):
    landed, out, checkpoint = (str(tmp_path / n) for n in ("landed", "out", "cp"))
    (tmp_path / "landed").mkdir()

    def land(name, rows):
        (tmp_path / "landed" / name).write_text("\n".join(json.dumps(r) for r in rows))

    def rows():
        return {(r.k, r.v) for r in ingest.results(spark, out, ["k"], version=["v"]).collect()}

    land("1.json", [{"k": "a", "status": "ok", "v": 5}, {"k": "b", "status": "quota", "v": 1}])
    ingest.ingest(spark, landed, SCHEMA, lambda df: df, out, checkpoint)
    # An attempt that wrote and never came to its commit.
    half = spark.createDataFrame([("a", "ok", 99)], SCHEMA).withColumn("taken_in", F.current_timestamp())
    half.write.parquet(f"{out}/accepted/run=x/batch_id=7/attempt=killed")
    assert rows() == {("a", 5)}
    # An older answer that lands later does not win where versions tell.
    land("2.json", [{"k": "a", "status": "ok", "v": 3}, {"k": "c", "status": "ok", "v": 1}])
    ingest.ingest(spark, landed, SCHEMA, lambda df: df, out, checkpoint)
    assert rows() == {("a", 5), ("c", 1)}
    log = commits.CommitLog(spark, f"{out}/_commits")
    assert len(log.live()) == 2
    before = sorted(map(str, ingest.committed(spark, out).select("k", "v", "run", "batch_id").collect()))
    assert ingest.compact(spark, out) in log.live() and len(log.live()) == 1
    assert sorted(map(str, ingest.committed(spark, out).select("k", "v", "run", "batch_id").collect())) == before
    assert ingest.committed(spark, out, "rejected").count() == 1
    land("3.json", [{"k": "c", "status": "ok", "v": 2}])
    ingest.ingest(spark, landed, SCHEMA, lambda df: df, out, checkpoint)
    assert rows() == {("a", 5), ("c", 2)}
    assert ingest.compact(spark, out) is not None and rows() == {("a", 5), ("c", 2)}


def test_a_name_is_committed_once(spark, tmp_path):
    log = commits.CommitLog(spark, str(tmp_path / "log"))
    assert log.live() == {}
    assert log.commit("one", "f1") and not log.commit("one", "f2")
    assert log.commit("two", "f3", ["one"])
    assert log.live() == {"two": "f3"}


def test_the_newest_landing_replaces_a_month(spark, tmp_path):
    kind = "sggCd string, dealYear string, dealMonth string, price int"
    base = str(tmp_path / "trades")
    assert landings.landed_trades(spark, base) is None
    first = [("1", "2024", "1", 10), ("1", "2024", "1", 10), ("1", "2024", "2", 20), (None, "2024", "1", 5)]
    assert landings.land_trades(spark.createDataFrame(first, kind), base, "a", 1)
    assert not landings.land_trades(spark.createDataFrame(first, kind), base, "a", 7)
    again = [("1", "2024", "1", 11), ("1", "2024", "1", 11), ("1", "2024", "1", 12)]
    assert landings.land_trades(spark.createDataFrame(again, kind), base, "b", 2)
    want = sorted(map(str, [("1", "2024", "1", 11), ("1", "2024", "1", 11), ("1", "2024", "1", 12), ("1", "2024", "2", 20), (None, "2024", "1", 5)]))

    def held():
        return sorted(str(tuple(r)) for r in landings.landed_trades(spark, base).collect())

    assert held() == want
    landings.compact_landings(spark, base)
    assert held() == want
    log = commits.CommitLog(spark, f"{base}/_commits")
    assert len(log.live()) == 1 and log.vacuum(base) == 2 and held() == want


def test_embedding_parts_keep_the_order(spark, tmp_path):
    for n, parts in ((10, 3), (7, 7), (5, 8), (1000, 4)):
        path = str(tmp_path / f"e{n}")
        rows = spark.range(n).select((F.col("id") * 7 % n * 3).alias("id"), F.array(F.col("id").cast("float")).alias("embedding"))
        vectors.write_embedding_parts(rows.repartition(5), path, "id", parts)
        back = vectors.read_embedding_parts(spark, path).orderBy("row").collect()
        assert [r.row for r in back] == list(range(n))
        assert [r.id for r in back] == sorted(r.id for r in back) and len({r.part for r in back}) == min(parts, -(-n // -(-n // parts)))
        assert len(list((tmp_path / f"e{n}").glob("part=*/*.parquet"))) == len({r.part for r in back})
