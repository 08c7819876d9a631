"""Trades + landed lookup answers -> enriched trades."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landgauge.constants import BUILDING_COLUMNS, BUILDING_KEYS, GEO_COLUMNS, GEO_KEYS
from landgauge.operators.filters import drop_present
from landgauge.operators.lookups import (
    approval_date_fallback,
    building_defaults,
    merge_buildings,
    merge_geocodes,
)
from landgauge.operators.nearest import fill_nearest_station
from landgauge.session import cut_lineage

ADDRESS_KEYS = ["sggCd", "sido", "region", "umdNm", "jibun"]


def address_facts(
    trades: DataFrame, geocodes: DataFrame, buildings: DataFrame, sequence: list[str]
) -> DataFrame:
    """One row per traded address with its coordinates, station and building facts.

    ``trades`` counts how often an address was traded, which weights station positions.
    """
    keys = trades.groupBy(*ADDRESS_KEYS).agg(F.count(F.lit(1)).alias("trades"))
    known = keys.withColumn("sggCd", F.col("sggCd").cast("string"))
    known = merge_geocodes(known, geocodes, sequence, GEO_KEYS)
    return merge_buildings(known, buildings, sequence, BUILDING_KEYS)


def weighted_stations(addresses: DataFrame) -> DataFrame:
    """Mean position of the trades near each station, from address rows and their counts."""
    n = F.col("trades")
    complete = addresses.dropna(subset=["lat", "lng", "subway_name"])
    return complete.groupBy("subway_name").agg(
        (F.sum(F.col("lat") * n) / F.sum(n)).alias("lat"),
        (F.sum(F.col("lng") * n) / F.sum(n)).alias("lng"),
    )


def enrich_trades(
    trades: DataFrame,
    geocodes: DataFrame,
    buildings: DataFrame,
    sequence: list[str],
    defaults: bool = True,
) -> DataFrame:
    """Every trade with the facts of its address.

    Lookups, duplicates and the station search are settled per address, which are far fewer than
    trades. The trades themselves are then joined once. ``defaults=False`` keeps
    unknown building facts null for a later imputation.
    """
    addresses = address_facts(trades, geocodes, buildings, sequence)
    addresses = cut_lineage(addresses)
    facts = fill_nearest_station(addresses, weighted_stations(addresses)).drop("trades")
    if defaults:
        facts = building_defaults(facts)
    old = [*GEO_COLUMNS, "subway_source", *BUILDING_COLUMNS]
    plain = drop_present(trades, old)
    # Null-safe on every key: an address with an unknown region still has a row of its own.
    right = facts.select(*[F.col(k).alias(f"_{k}") for k in ADDRESS_KEYS], *old)
    match = F.lit(True)
    for k in ADDRESS_KEYS:
        left = F.col(k).cast("string")
        match = match & left.eqNullSafe(F.col(f"_{k}"))
    joined = plain.join(right, match, "left").drop(*[f"_{k}" for k in ADDRESS_KEYS])
    return approval_date_fallback(joined) if defaults else joined
