"""Listing sentences and search terms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from landgauge.constants import UNNAMED_COMPLEX
from landgauge.functions.parsing import ColumnLike, _col

# Token pattern of two or more word characters.
TERM_PATTERN = r"[\p{L}\p{N}_]{2,}"


def rounded_text(c: ColumnLike, digits: int = 1) -> Column:
    """Half-even rounded number as plain text, '59.0' style."""
    return F.bround(_col(c), digits).cast(f"decimal(18,{digits})").cast("string")


def short_number_text(c: ColumnLike, digits: int = 2) -> Column:
    """Half-even rounded number without padded zeros ('0.8', '0.75')."""
    return F.bround(_col(c), digits).cast("string")


def amount_text(c: ColumnLike) -> Column:
    """25000 -> '2억 5,000만 원', 10000 -> '1억 원'; null -> '원'."""
    amount = F.coalesce(_col(c).cast("long"), F.lit(0).cast("long"))
    eok = F.floor(amount / 10000).cast("long")
    rest = F.pmod(amount, F.lit(10000).cast("long"))
    head = F.when(eok > 0, F.concat(eok.cast("string"), F.lit("억 "))).otherwise("")
    tail = F.when(rest > 0, F.concat(F.format_number(rest, 0), F.lit("만 원"))).otherwise("원")
    return F.concat(head, tail)


def _text(c: ColumnLike, default: str = "") -> Column:
    return F.coalesce(_col(c).cast("string"), F.lit(default))


def _whole(c: ColumnLike, default: int) -> Column:
    return F.coalesce(_col(c), F.lit(default)).cast("int").cast("string")


def listing_text() -> Column:
    """Description of one listing from the trade columns (unknown parking is left out)."""
    lit = F.lit
    elevator = F.when(F.col("has_elevator") == 1, "엘리베이터가 있으며").otherwise("엘리베이터가 없으며")
    ratio = F.col("parking_ratio")
    parking = (
        F.when(ratio >= 1.0, lit("주차 비율 조건을 충족합니다."))
        .when(ratio.isNull(), lit("주차 정보가 없습니다."))
        .otherwise(F.concat(lit("주차 비율은 "), short_number_text(ratio), lit("대 수준입니다.")))
    )
    zero = lit(0.0)
    return F.concat(
        _text("sido"), lit(" "), _text("region"), lit(" "), _text("umdNm"), lit("에 위치한 "),
        _text("houseType", "주택"), lit(" "), _text("mhouseNm", UNNAMED_COMPLEX), lit("입니다. "),
        _whole("buildYear", 2000), lit("년에 건축되었으며, 전용면적은 "),
        rounded_text(F.coalesce(F.col("excluUseAr"), zero)), lit("m2, 대지권면적은 "),
        rounded_text(F.coalesce(F.col("landAr"), zero)), lit("m2입니다. 현재 "),
        _whole("floor", 1), lit("층 매물로, "),
        _text("dealYear"), lit("년 "), _text("dealMonth"), lit("월에 "),
        amount_text("dealAmount"), lit("에 거래되었습니다. 가장 가까운 지하철역은 "),
        _text("subway_name", "알 수 없는 역"), lit("이며 거리는 "),
        _whole("subway_dist", 0), lit("m입니다. "),
        elevator, lit(" "), parking,
    )


def search_context() -> Column:
    """Short text of the features that make two listings comparable."""
    lit = F.lit
    return F.concat(
        _text("umdNm"), lit(" "), _text("mhouseNm", UNNAMED_COMPLEX), lit(" "),
        F.coalesce(rounded_text("excluUseAr"), lit("")), lit("m2 "),
        _whole("buildYear", 2000), lit("년 건축 "),
        _text(F.col("total_floors").cast("int")), lit("층"),
    )


def unigrams(c: ColumnLike) -> Column:
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(TERM_PATTERN), F.lit(0))


def with_bigrams(tokens: ColumnLike) -> Column:
    """Tokens of a text followed by its adjacent pairs.

    Pass a computed column: the tokens are read four times.
    """
    words = _col(tokens)
    pairs = F.greatest(F.size(words) - 1, F.lit(0))
    joined = F.zip_with(
        F.slice(words, F.lit(1), pairs),
        F.slice(words, F.lit(2), pairs),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )
    return F.concat(words, joined)
