"""Column functions on literal edge rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from landgauge.functions import numeric as N
from landgauge.functions import parsing as P
from landgauge.functions import text as X


def one(spark, column, **values):
    schema = ", ".join(
        f"{k} {'string' if v is None or isinstance(v, str) else 'double' if isinstance(v, float) else 'long'}"
        for k, v in values.items()
    )
    row = spark.createDataFrame([tuple(values.values())], schema) if values else spark.range(1)
    return row.select(column.alias("r")).first()["r"]


def test_strict_long(spark):
    assert one(spark, P.strict_long("a"), a="12,500") == 12500
    with pytest.raises(Exception):
        one(spark, P.strict_long("a"), a="12a")


@pytest.mark.parametrize(
    "text, want", [("1,234.5", 1234.5), ("", None), ("x", None), (None, None), ("NaN", None), (" 7 ", 7.0)]
)
def test_lenient_double(spark, text, want):
    assert one(spark, P.lenient_double("a"), a=text) == want


def test_int_and_text(spark):
    assert one(spark, P.int_or_zero("a"), a="3.7") == 3
    assert one(spark, P.int_or_zero("a"), a="?") == 0
    assert one(spark, P.text_or_null("a"), a="nan") is None


def test_deal_date_falls_back_to_new_year(spark):
    day = P.deal_date(F.lit(2021), F.lit(2), F.col("d"))
    assert one(spark, day, d=28) == dt.date(2021, 2, 28)
    assert one(spark, day, d=31) == dt.date(2021, 1, 1)


def test_zero_pad_never_cuts(spark):
    assert one(spark, P.zero_pad(F.col("a"), 4), a="12345") == "12345"
    assert one(spark, P.zero_pad(F.col("a"), 4), a="7") == "0007"
    assert one(spark, P.region_code("a"), a="4110.0") == "04110"


@pytest.mark.parametrize(
    "lot, want",
    [
        ("5-10", ("0005", "0010")), ("112", ("0112", "0000")), ("산 5-1", ("0산 5", "0001")),
        ("12345", ("12345", "0000")), ("1-2-3", ("0001", "0002")), (" ", (None, None)), (None, (None, None)),
    ],
)
def test_lot_number(spark, lot, want):
    assert tuple(one(spark, P.lot_number("a"), a=lot)) == want


@pytest.mark.parametrize(
    "name, want",
    [(" ★빌라  #1동 (A), ☆", "빌라 1동 (A),"), ("★", "미명명 단지"), (None, "미명명 단지"), ("a　b", "a b")],
)
def test_building_name(spark, name, want):
    assert one(spark, P.building_name("a"), a=name) == want


def test_header_and_tokens(spark):
    assert one(spark, P.header_year("a"), a="2021년 5월") == 2021
    assert one(spark, P.header_month("a"), a="2021년12월") == 12
    assert one(spark, P.header_month("a"), a="No") is None
    assert one(spark, P.last_token("a"), a="경기도 수원시  장안구") == "장안구"


def test_first_filled_and_dates(spark):
    assert one(spark, P.first_filled_number("a", "b"), a="0", b="3") == 3.0
    assert one(spark, P.first_filled_number("a", default=4), a="") == 4.0
    assert one(spark, P.compact_date("a", "b"), a="", b="20150304101112") == "20150304"
    assert one(spark, P.compact_date("a"), a=None) == ""


def test_trailing_months(spark):
    months = one(spark, P.trailing_months(F.lit("2026-03-15").cast("date"), 60))
    assert (len(months), months[0], months[-1]) == (60, "202104", "202603")


@pytest.mark.parametrize(
    "amount, want", [(25000, "2억 5,000만 원"), (10000, "1억 원"), (9500, "9,500만 원"), (0, "원")]
)
def test_amount_text(spark, amount, want):
    assert one(spark, X.amount_text("a"), a=amount) == want


def test_amount_text_of_null(spark):
    assert one(spark, X.amount_text(F.lit(None))) == "원"


def test_number_text(spark):
    assert one(spark, X.rounded_text("a"), a=59.0) == "59.0"
    assert one(spark, X.rounded_text("a"), a=0.25) == "0.2"
    assert one(spark, X.short_number_text("a"), a=0.75) == "0.75"


def test_terms(spark):
    row = spark.createDataFrame([("A bb CC dd",), ("",), ("x",)], "t string")
    tokens = row.select(X.unigrams("t").alias("k")).select(X.with_bigrams("k").alias("k"))
    assert [r["k"] for r in tokens.collect()] == [["bb", "cc", "dd", "bb cc", "cc dd"], [], []]


def test_clips_keep_null(spark):
    null = F.lit(None).cast("double")
    assert one(spark, N.at_most(null, 1500)) is None
    assert one(spark, N.at_least(null, 0)) is None
    assert one(spark, N.at_least(F.lit(-3), 0)) == 0
    assert one(spark, N.capped_distance(F.lit(2000.0))) == 1500


def test_unknown_comparison_is_zero(spark):
    null = F.lit(None).cast("double")
    assert one(spark, N.subway_area(null)) == 0
    assert one(spark, N.high_floor_without_elevator(null, F.lit(0))) == 0
    assert one(spark, N.high_floor_without_elevator(F.lit(4), F.lit(0))) == 1


def test_division_by_zero_is_null(spark):
    assert one(spark, N.unit_price(F.lit(5), F.lit(0.0))) is None
    assert one(spark, N.time_adjustment(F.lit(1.0), F.lit(0.0))) is None


def test_building_facts(spark):
    s = lambda v: F.lit(v).cast("string")
    assert one(spark, N.parking_ratio(s("4"), s("1"), s(""), s(None), s("5"))) == 1.5
    assert one(spark, N.parking_ratio(s("0"), s("9"))) == 0.8
    assert one(spark, N.elevator_flag(s("0"), s("2"))) == 1
    assert one(spark, N.concrete_flag(s("src조"))) == 1
    assert one(spark, N.concrete_flag(s(None))) == 0
    assert one(spark, N.mixed_use_flag(s("제2종근린생활시설"))) == 1
    assert one(spark, N.floor_count(s(""))) == 4


def test_haversine(spark):
    # A quarter of a meridian.
    metres = one(spark, N.haversine_m(F.lit(0.0), F.lit(0.0), F.lit(90.0), F.lit(0.0)))
    assert metres == pytest.approx(6_371_000 * 3.141592653589793 / 2)


def test_bits_of_a_value_are_worked_out_once(spark):
    """One logarithm and one power a value, however often the parts of the key are used."""
    df = spark.range(10).select((F.col("id") / 7).alias("x"), (F.col("id") / 3).alias("y")).persist()
    keys = df.select(N.ordered_bits("x").alias("a"), N.ordered_bits("y").alias("b"))
    code = spark._jvm.PythonSQLUtils.explainString(keys._jdf.queryExecution(), "codegen")
    assert code.count("StrictMath.pow(") == 2 and code.count("StrictMath.log(") == 2 * 2  # a logarithm and that of two
