"""Address lookups: what is still to ask, newest answer per key, merge and defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landgauge.constants import (
    BUILDING_COLUMNS,
    BUILDING_DEFAULTS,
    BUILDING_KEYS,
    DEFAULT_APPROVAL_DATE,
    GEO_COLUMNS,
    GEO_KEYS,
)
from landgauge.functions import parsing as P
from landgauge.operators.filters import (
    blank_where_error,
    complete_on,
    drop_matching,
    drop_present,
)


def distinct_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Complete, distinct lookup keys."""
    return complete_on(df.select(*keys), keys).distinct()


def still_to_ask(df: DataFrame, answered: DataFrame, keys: list[str]) -> DataFrame:
    """Keys without an answer yet. Both sides are compared as text."""
    as_text = [F.col(k).cast("string").alias(k) for k in keys]
    return distinct_keys(df.select(*as_text), keys).join(
        complete_on(answered.select(*as_text), keys), keys, "left_anti"
    )


def collection_tasks(regions: DataFrame, months: Column, done: DataFrame) -> DataFrame:
    """Region x trailing month tasks that are not completed, as (code5, name, deal_ymd, task).

    Months are exploded next to each region: the grid grows with the regions and is no join.
    """
    grid = regions.withColumn("deal_ymd", F.explode(months))
    grid = grid.withColumn("task", F.concat_ws("_", "code5", "deal_ymd"))
    return grid.join(done.select("task"), "task", "left_anti")


def newest_per_key(df: DataFrame, keys: list[str], sequence: list[str]) -> DataFrame:
    """Keep the last answer per key by an explicit sequence.

    ``max_by`` combines on the map side, so a key asked very often costs no large group. Rows of equal sequence are
    ordered by a hash of their content, so the winner is the same on every run.
    """
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*sequence, F.xxhash64(*rest))).alias("_newest")
    )
    return best.select(*keys, *[F.col(f"_newest.{c}").alias(c) for c in rest])


def merge_geocodes(
    trades: DataFrame, answers: DataFrame, sequence: list[str], keys: list[str] | None = None
) -> DataFrame:
    """Refresh coordinates and station of each trade from the newest answer per address."""
    keys = keys or GEO_KEYS
    newest = blank_where_error(newest_per_key(answers, keys, sequence), GEO_COLUMNS)
    return drop_present(trades, GEO_COLUMNS).join(
        newest.select(*keys, *GEO_COLUMNS), keys, "left"
    )


def merge_buildings(
    trades: DataFrame, answers: DataFrame, sequence: list[str], keys: list[str] | None = None
) -> DataFrame:
    """Refresh building facts of each trade from the newest answer per address."""
    keys = keys or BUILDING_KEYS
    newest = newest_per_key(answers, keys, sequence)
    return drop_present(trades, BUILDING_COLUMNS).join(
        newest.select(*keys, *BUILDING_COLUMNS), keys, "left"
    )


def building_defaults(df: DataFrame) -> DataFrame:
    """Default facts where no register answered; flags and floors become whole numbers."""
    filled = {
        c: F.coalesce(F.col(c), F.lit(v)).cast("double" if isinstance(v, float) else "int")
        for c, v in BUILDING_DEFAULTS.items()
    }
    return df.withColumns(filled)


def approval_date_fallback(df: DataFrame) -> DataFrame:
    """Own date of four or more characters, else 1 January of buildYear, else the default."""
    own = F.trim(F.col("approval_date").cast("string"))
    year = P.lenient_double("buildYear").cast("int").cast("string")
    return df.withColumn(
        "approval_date",
        F.when(F.length(own) >= 4, own).otherwise(
            F.coalesce(F.concat(year, F.lit("0101")), F.lit(DEFAULT_APPROVAL_DATE))
        ),
    )


# Error codes that asking again cannot change.
PERMANENT_ERRORS = ("ADDRESS_NOT_FOUND", "EXCEPTION_PARSE")
# Fixed value: error texts that the text rule purges.
TRANSIENT_PATTERN = (
    "EXCEPTION_ADDR|WinError|Connection|API_ERROR_400|ADDR_API_ERROR_400|API_FORBIDDEN_401"
)


def classify_errors(answers: DataFrame, error: str = "error") -> DataFrame:
    """Add ``retryable``: every error that is not known to be permanent."""
    code = F.trim(F.substring_index(F.col(error), ":", 1))
    return answers.withColumn(
        "retryable", F.coalesce(~code.isin(*PERMANENT_ERRORS), F.lit(False))
    )


def purge_retryable(answers: DataFrame, error: str = "error") -> DataFrame:
    """Drop answers that should be asked for again; successes and permanent failures stay."""
    return classify_errors(answers, error).where(~F.col("retryable")).drop("retryable")


def purge_by_text(answers: DataFrame, error: str = "error") -> DataFrame:
    """The narrower text rule: drop only errors that match the known transient texts."""
    return drop_matching(answers, error, TRANSIENT_PATTERN)
