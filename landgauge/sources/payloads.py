"""Landed service answers (XML and JSON text columns) -> typed rows with a status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landgauge.constants import BUILDING_COLUMNS, TRADE_COLUMNS
from landgauge.functions import numeric as N
from landgauge.functions import parsing as P
from landgauge.schemas import (
    BUILDING_ITEM,
    BUILDING_PAYLOAD,
    GEOCODE_PAYLOAD,
    PLACE_PAYLOAD,
    REGION_CODES,
    TRADE_PAYLOAD,
)

# Status of one answer.
OK = "ok"
NO_RECORD = "no_record"
QUOTA = "quota"
SERVICE_ERROR = "service_error"
PARSE_ERROR = "parse_error"

# Result codes that mean success, words that mean an exhausted quota.
SUCCESS_CODES = ("00", "000")
QUOTA_WORDS = ("LIMITED", "TRAFFIC")
# The root of an answer, and of the envelope in which the gateway turns a request down.
ANSWER_ROOT, GATEWAY_ROOT = "response", "OpenAPI_ServiceResponse"
# Fixed value: rows asked for per request; a full answer may have been cut.
REQUEST_ROWS = 9_999

# Fixed value: the error of a call beyond the day's quota.
LIMIT_REACHED = "API_LIMIT_REACHED"


def _has_root(c: Column, name: str) -> Column:
    """Whether a text is one whole element of this name, behind an XML declaration at most."""
    return F.coalesce(c.rlike(rf"(?s)^\s*(<\?xml.*?\?>\s*)?<{name}[\s>].*</{name}>\s*$"), F.lit(False))


def parse_trade_answers(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Add ``items`` (array of 20-field structs), ``status`` and ``item_count`` per answer.

    An answer without a result code is accepted if it has a body. Text that is cut off, malformed or of another root
    is a parse error, so that it is asked again; the gateway's own envelope is an exhausted quota or a service error.
    """
    text = F.col(payload)
    schema = T.StructType([*TRADE_PAYLOAD.fields, T.StructField("_broken", T.StringType())])
    parsed = F.from_xml(text, schema.simpleString(), {"columnNameOfCorruptRecord": "_broken"})
    code = F.col("_answer.header.resultCode")
    message = F.col("_answer.header.resultMsg")
    fine = code.isNull() | code.isin(*SUCCESS_CODES)
    turned_down = F.regexp_extract(text, r"(?s)<cmmMsgHeader>(.*)</cmmMsgHeader>", 1)
    status = (
        F.when(_has_root(text, GATEWAY_ROOT), F.when(P.matches_any(turned_down, "LIMITED"), QUOTA).otherwise(SERVICE_ERROR))
        .when(~_has_root(text, ANSWER_ROOT) | F.col("_answer._broken").isNotNull(), PARSE_ERROR)
        .when(fine & F.col("_answer.body").isNull(), PARSE_ERROR)
        .when(fine, OK)
        .when(P.matches_any(message, "LIMITED"), QUOTA)
        .otherwise(SERVICE_ERROR)
    )
    empty = F.array().cast(TRADE_PAYLOAD["body"].dataType["items"].dataType["item"].dataType)
    items = F.coalesce(F.col("_answer.body.items.item"), empty)
    return (
        df.withColumn("_answer", parsed)
        .withColumn("status", status)
        .withColumn("items", F.when(F.col("status") == OK, items).otherwise(empty))
        .withColumn("item_count", F.size("items"))
        .withColumn("maybe_cut", F.col("item_count") >= REQUEST_ROWS)
        .drop("_answer")
    )


def trade_rows(answers: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per trade of the accepted answers; missing nodes become ''.

    Only accepted answers hold items. The outer explode keeps the planner from parsing an answer once
    more in a guarding filter.
    """
    kept = [F.col(c) for c in keep or []]
    rows = answers.select(*kept, F.explode_outer("items").alias("t")).where(F.col("t").isNotNull())
    fields = [F.coalesce(F.trim(F.col(f"t.{c}")), F.lit("")).alias(c) for c in TRADE_COLUMNS]
    return rows.select(*kept, *fields)


def rejected_answers(answers: DataFrame) -> DataFrame:
    return answers.where(F.col("status") != OK).drop("items")


def parse_building_answers(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Building facts of the first register item, with the status of the answer.

    Failed and empty answers keep null facts; defaults are applied once, after the merge.
    """
    text = F.col(payload)
    answer = df.withColumn("_answer", F.from_json(text, BUILDING_PAYLOAD))
    answer = answer.withColumn(
        "_holder", F.from_json(F.col("_answer.response.body.items"), "struct<item:string>")
    ).withColumn(
        "_item",
        F.get(F.from_json(F.col("_holder.item"), T.ArrayType(BUILDING_ITEM)), F.lit(0)),
    )
    code = F.col("_answer.response.header.resultCode")
    message = F.col("_answer.response.header.resultMsg")
    readable = F.coalesce(F.try_parse_json(text).isNotNull(), F.lit(False))
    status = (
        F.when(~readable & P.matches_any(text, *QUOTA_WORDS), QUOTA)
        .when(~readable, PARSE_ERROR)
        .when(F.coalesce(code.isin(*SUCCESS_CODES), F.lit(False)),
              F.when(F.col("_item").isNull(), NO_RECORD).otherwise(OK))
        .when(P.matches_any(message, *QUOTA_WORDS), QUOTA)
        .otherwise(SERVICE_ERROR)
    )
    i = {f.name: F.col(f"_item.{f.name}") for f in BUILDING_ITEM.fields}
    facts = {
        "parking_ratio": N.parking_ratio(
            i["hhldCnt"],
            i["indrMechUtcnt"], i["indrAutoUtcnt"], i["oudrMechUtcnt"], i["oudrAutoUtcnt"],
        ),
        "has_elevator": N.elevator_flag(i["rideLftCnt"], i["rideUseElvtCnt"]),
        "building_structure": N.concrete_flag(i["strctCdNm"]),
        "is_commercial_villa": N.mixed_use_flag(i["mainPurpsCdNm"]),
        "total_floors": N.floor_count(i["grndFlrCnt"]),
        "approval_date": P.compact_date(i["useAprvDt"], i["useAprDay"]),
    }
    answer = answer.withColumn("status", status)
    return answer.select(
        *[F.col(c) for c in df.columns],
        "status",
        *[F.when(F.col("status") == OK, facts[c]).alias(c) for c in BUILDING_COLUMNS],
    )


def parse_geocode_answers(
    df: DataFrame,
    payload: str = "payload",
    place_payload: str | None = None,
    call_error: str | None = None,
    place_error: str | None = None,
) -> DataFrame:
    """lat, lng and ``error`` of the first document, plus the nearest place when given.

    ``call_error`` and ``place_error`` name columns with the error of a call that brought no answer. Failures of the place answer are
    swallowed: they never cost a row its coordinates. Only a used-up quota is reported, beside the coordinates, so that the
    row is asked for again.
    """
    first = F.get(F.col("_answer.documents"), F.lit(0))
    out = df.withColumn("_answer", F.from_json(F.col(payload), GEOCODE_PAYLOAD))
    out = out.withColumn("_lat", P.lenient_double(first["y"])).withColumn(
        "_lng", P.lenient_double(first["x"])
    )
    documents = F.coalesce(F.size(F.col("_answer.documents")), F.lit(0))
    called = F.col(call_error) if call_error else F.lit(None).cast("string")
    error = (
        F.when(called.isNotNull(), called)
        .when(F.try_parse_json(F.col(payload)).isNull(), "EXCEPTION_PARSE")
        .when(documents <= 0, "ADDRESS_NOT_FOUND")
        .when(F.col("_lat").isNull() | F.col("_lng").isNull(), "EXCEPTION_PARSE")
    )
    out = out.withColumn("error", error)
    good = F.col("error").isNull()
    columns = [
        *[F.col(c) for c in df.columns],
        F.when(good, F.col("_lat")).alias("lat"),
        F.when(good, F.col("_lng")).alias("lng"),
    ]
    if place_payload:
        place = F.get(F.from_json(F.col(place_payload), PLACE_PAYLOAD)["documents"], F.lit(0))
        columns += [
            F.when(good, place["place_name"]).alias("subway_name"),
            F.when(good, P.lenient_double(place["distance"])).alias("subway_dist"),
        ]
    reported = F.col("error")
    if place_error:
        reported = F.when(good & (F.col(place_error) == LIMIT_REACHED), LIMIT_REACHED).otherwise(reported)
    return out.select(*columns, reported.alias("error"))


def legal_dong_codes(df: DataFrame, sgg: str = "sgg", payload: str = "payload") -> DataFrame:
    """(sgg, dong name) -> five-digit dong code; the highest code wins for a repeated name."""
    entries = df.select(
        F.col(sgg).alias("sgg"),
        F.explode_outer(F.from_json(F.col(payload), REGION_CODES)["regcodes"]).alias("r"),
    )
    return (
        entries.where(F.col("r").isNotNull() & (P.token_count("r.name") >= 2))
        .select(
            "sgg",
            P.last_token("r.name").alias("umdNm"),
            F.substring("r.code", 6, 5).alias("bjdong"),
            F.col("r.code").alias("code"),
        )
        .groupBy("sgg", "umdNm")
        .agg(F.max_by("bjdong", "code").alias("bjdong"))
    )
