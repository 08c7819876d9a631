"""Explicit schemas; nothing is inferred from data."""

from pyspark.sql import types as T

from landgauge.constants import TRADE_COLUMNS


def _strings(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


TRADE_RAW = _strings(TRADE_COLUMNS)

REGION_CODES = T.StructType(
    [T.StructField("regcodes", T.ArrayType(_strings(["code", "name"])))]
)

TRADE_PAYLOAD = T.StructType(
    [
        T.StructField("header", _strings(["resultCode", "resultMsg"])),
        T.StructField(
            "body",
            T.StructType(
                [
                    T.StructField(
                        "items",
                        T.StructType([T.StructField("item", T.ArrayType(TRADE_RAW))]),
                    )
                ]
            ),
        ),
    ]
)

# ``items`` stays text: it is an object, an array holder or '' depending on the answer.
BUILDING_PAYLOAD = T.StructType(
    [
        T.StructField(
            "response",
            T.StructType(
                [
                    T.StructField("header", _strings(["resultCode", "resultMsg"])),
                    T.StructField("body", _strings(["items"])),
                ]
            ),
        )
    ]
)

BUILDING_ITEM = _strings(
    [
        "indrMechUtcnt", "indrAutoUtcnt", "oudrMechUtcnt", "oudrAutoUtcnt",
        "hhldCnt", "rideLftCnt", "rideUseElvtCnt", "strctCdNm", "mainPurpsCdNm",
        "grndFlrCnt", "useAprvDt", "useAprDay",
    ]
)

GEOCODE_PAYLOAD = T.StructType(
    [T.StructField("documents", T.ArrayType(_strings(["x", "y"])))]
)

PLACE_PAYLOAD = T.StructType(
    [T.StructField("documents", T.ArrayType(_strings(["place_name", "distance"])))]
)

GEOCODE_MAP = T.StructType(
    [T.StructField(c, T.StringType()) for c in ["sido", "region", "umdNm", "jibun"]]
    + [
        T.StructField("lat", T.DoubleType()),
        T.StructField("lng", T.DoubleType()),
        T.StructField("subway_name", T.StringType()),
        T.StructField("subway_dist", T.DoubleType()),
        T.StructField("error", T.StringType()),
    ]
)

BUILDING_MAP = T.StructType(
    [T.StructField(c, T.StringType()) for c in ["sggCd", "umdNm", "jibun"]]
    + [
        T.StructField("parking_ratio", T.DoubleType()),
        T.StructField("has_elevator", T.IntegerType()),
        T.StructField("building_structure", T.IntegerType()),
        T.StructField("is_commercial_villa", T.IntegerType()),
        T.StructField("total_floors", T.IntegerType()),
        T.StructField("approval_date", T.StringType()),
    ]
)
