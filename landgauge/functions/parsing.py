"""Lenient and strict parsing of trade, address and date text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from landgauge.constants import UNNAMED_COMPLEX

ColumnLike = Column | str


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict_long(c: ColumnLike) -> Column:
    """Thousands-separated integer; text that is no number fails the job."""
    return F.replace(_col(c), F.lit(","), F.lit("")).cast("long")


def lenient_double(c: ColumnLike) -> Column:
    """Number with or without separators; anything else, NaN included, becomes null."""
    parsed = F.replace(_col(c).cast("string"), F.lit(","), F.lit("")).try_cast("double")
    return F.nanvl(parsed, F.lit(None).cast("double"))


def int_or_zero(c: ColumnLike) -> Column:
    return F.coalesce(lenient_double(c), F.lit(0.0)).cast("int")


def text_or_null(c: ColumnLike) -> Column:
    return F.nullif(_col(c).cast("string"), F.lit("nan"))


def lenient_date(c: ColumnLike, fmt: str = "yyyyMMdd") -> Column:
    return F.try_to_date(_col(c).cast("string"), fmt)


def deal_date(year: ColumnLike, month: ColumnLike, day: ColumnLike) -> Column:
    """Calendar date of a deal; an impossible day falls back to 1 January of its year."""
    y, m, d = (_col(c).cast("int") for c in (year, month, day))
    zero = F.lit(0)
    exact = F.try_make_timestamp_ntz(y, m, d, zero, zero, zero.cast("double")).cast("date")
    return F.coalesce(exact, F.make_date(y, F.lit(1), F.lit(1)))


def zero_pad(c: ColumnLike, width: int) -> Column:
    """Left-pad with zeros and never cut text that is already longer."""
    text = _col(c)
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def region_code(c: ColumnLike) -> Column:
    """Five-digit region code from text or number ('11110', 11110.0)."""
    return zero_pad(_col(c).cast("double").cast("int").cast("string"), 5)


def lot_number(c: ColumnLike) -> Column:
    """'5-10' -> ('0005', '0010'), '112' -> ('0112', '0000'); blank -> nulls."""
    text = F.nullif(F.trim(_col(c).cast("string")), F.lit(""))
    parts = F.split(text, "-", -1)
    main = zero_pad(F.trim(F.get(parts, F.lit(0))), 4)
    sub = zero_pad(F.trim(F.coalesce(F.get(parts, F.lit(1)), F.lit(""))), 4)
    return F.struct(main.alias("bun"), F.when(text.isNotNull(), sub).alias("ji"))


def header_year(c: ColumnLike) -> Column:
    return F.regexp_extract(_col(c), r"(\d+)년\s*(\d+)월", 1).try_cast("int")


def header_month(c: ColumnLike) -> Column:
    return F.regexp_extract(_col(c), r"(\d+)년\s*(\d+)월", 2).try_cast("int")


def building_name(c: ColumnLike) -> Column:
    """Keep letters, digits, Hangul, brackets and commas; squeeze spaces; name the unnamed."""
    kept = F.regexp_replace(_col(c), r"(?U)[^a-zA-Z0-9가-힣\s(),]", "")
    squeezed = F.trim(F.regexp_replace(kept, r"(?U)\s+", " "))
    return F.coalesce(F.nullif(squeezed, F.lit("")), F.lit(UNNAMED_COMPLEX))


def name_tokens(c: ColumnLike) -> Column:
    """Tokens of a space-separated region path."""
    return F.split(F.trim(_col(c)), r"\s+")


def first_token(c: ColumnLike) -> Column:
    return F.get(name_tokens(c), F.lit(0))


def last_token(c: ColumnLike) -> Column:
    return F.element_at(name_tokens(c), -1)


def token_count(c: ColumnLike) -> Column:
    return F.size(name_tokens(c))


def compact_date(*fields: ColumnLike) -> Column:
    """First non-empty of several date fields, cut to yyyyMMdd length; '' when none."""
    filled = [F.nullif(_col(f).cast("string"), F.lit("")) for f in fields]
    return F.left(F.trim(F.coalesce(*filled, F.lit(""))), F.lit(8))


def first_filled_number(*fields: ColumnLike, default: float = 0.0) -> Column:
    """First field that is a number other than 0; blanks and zeros fall through."""
    numbers = [F.nullif(lenient_double(f), F.lit(0.0)) for f in fields]
    return F.coalesce(*numbers, F.lit(float(default)))


def address(*parts: ColumnLike) -> Column:
    return F.trim(F.concat_ws(" ", *[_col(p) for p in parts]))


def trailing_months(end: ColumnLike, months: int = 60) -> Column:
    """Ascending 'yyyyMM' labels of the ``months`` months that end with ``end``'s month."""
    last = F.trunc(_col(end), "MM")
    days = F.sequence(F.add_months(last, 1 - months), last, F.expr("interval 1 month"))
    # Years that have four digits throughout are written once for their twelve months.
    n = F.year(last) * 12 + F.month(last) - 1
    first = n - (months - 1)
    years = F.transform(F.sequence(F.floor(first / 12).cast("int"), F.year(last)), lambda y: y.cast("string"))
    labels = F.flatten(F.transform(years, lambda y: F.array(*[F.concat(y, F.lit(f"{m:02}")) for m in range(1, 13)])))
    labels = F.slice(labels, first % 12 + 1, F.lit(months))
    plain = (first >= 12_000) & (n < 120_000)
    return F.when(plain, labels).otherwise(F.transform(days, lambda d: F.date_format(d, "yyyyMM")))


def matches_any(c: ColumnLike, *needles: str) -> Column:
    """Case-insensitive containment of any needle; null counts as no match."""
    upper = F.upper(_col(c))
    hit = F.lit(False)
    for needle in needles:
        hit = hit | upper.contains(needle.upper())
    return F.coalesce(hit, F.lit(False))
