"""Row filters, projections and schema conformance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landgauge.constants import (
    CANCELLED,
    COUNT_COLUMNS,
    DATE_COLUMNS,
    DIRECT_DEAL,
    MIXED_HOUSE_TYPE,
    NUMERIC_COLUMNS,
    PRICE_LOWER,
    PRICE_UPPER,
    ROW_HOUSE,
    TEXT_COLUMNS,
)
from landgauge.functions import parsing as P


def drop_value(df: DataFrame, column: str, value: str) -> DataFrame:
    """Drop rows equal to ``value``; null rows stay."""
    return df.where(F.coalesce(F.col(column), F.lit("")) != value)


def valid_deals(df: DataFrame) -> DataFrame:
    """Without cancelled contracts and direct deals."""
    return drop_value(drop_value(df, "cdealType", CANCELLED), "dealingGbn", DIRECT_DEAL)


def within(df: DataFrame, column: str, lower: float, upper: float) -> DataFrame:
    """Closed range; null rows are dropped."""
    return df.where(F.col(column).between(lower, upper))


def plausible_prices(df: DataFrame) -> DataFrame:
    return within(df, "dealAmount", PRICE_LOWER, PRICE_UPPER)


def within_quantiles(
    df: DataFrame, column: str, lower: float = 0.02, upper: float = 0.98
) -> DataFrame:
    """Closed range between two exact quantiles of the column itself."""
    from landgauge.operators.profile import exact_quantiles

    found = exact_quantiles(df, [column], [lower, upper]).collect()
    edge = {r["prob"]: r["value"] for r in found}
    return df.where(F.col(column).between(edge.get(lower), edge.get(upper)))


def row_by_id(df: DataFrame, row_id: str, value) -> DataFrame:
    """The rows of one id, a literal or a one-value subquery; a null id has none."""
    return df.where(F.col(row_id) == value)


def complete_on(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(subset=columns)


def needs_fill(df: DataFrame, missing: str, present: str) -> DataFrame:
    return df.where(F.col(missing).isNull() & F.col(present).isNotNull())


def drop_matching(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Drop rows whose text matches a case-insensitive pattern; null rows stay."""
    return df.where(~F.coalesce(F.col(column).rlike(f"(?i){pattern}"), F.lit(False)))


def drop_present(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.drop(*[c for c in columns if c in df.columns])


def columns_containing(df: DataFrame, part: str) -> list[str]:
    return [c for c in df.columns if part in c]


def unify_house_type(df: DataFrame, column: str = "houseType") -> DataFrame:
    return df.replace(MIXED_HOUSE_TYPE, ROW_HOUSE, subset=[column])


def blank_where_error(df: DataFrame, columns: list[str], error: str = "error") -> DataFrame:
    """Null out result columns of rows that carry an error."""
    fine = F.col(error).isNull()
    return df.withColumns({c: F.when(fine, F.col(c)) for c in columns})


def conform(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Coerce the profiled columns leniently; also name the ones that are absent.

    ``Age`` is derived when it is missing and both of its parents are there.
    """
    casts = {c: P.lenient_double(c) for c in NUMERIC_COLUMNS if c in df.columns}
    casts |= {c: P.text_or_null(c) for c in TEXT_COLUMNS if c in df.columns}
    casts |= {c: P.int_or_zero(c) for c in COUNT_COLUMNS if c in df.columns}
    casts |= {c: P.lenient_date(c) for c in DATE_COLUMNS if c in df.columns}
    absent = [c for c in NUMERIC_COLUMNS + TEXT_COLUMNS if c not in df.columns]
    if "Age" in absent and {"buildYear", "dealYear"} <= set(df.columns):
        casts["Age"] = P.lenient_double("dealYear") - P.lenient_double("buildYear")
        absent.remove("Age")
    return df.withColumns(casts), absent
