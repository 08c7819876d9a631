"""Region-code lookups: province and district names, parent cities, leaf regions, dong codes."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landgauge.constants import PROVINCE_SHORT_NAMES
from landgauge.functions import parsing as P
from landgauge.functions.parsing import ColumnLike, _col


def mapped_or_same(c: ColumnLike, mapping: dict[str, str]) -> Column:
    """Dictionary lookup that passes unknown values through."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.coalesce(F.try_element_at(table, _col(c)), _col(c))


def province_short(c: ColumnLike) -> Column:
    return mapped_or_same(c, PROVINCE_SHORT_NAMES)


def region_lookup(codes: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """(code, name) rows -> one row (sggCd, sido, region) per five-digit code."""
    mapping = PROVINCE_SHORT_NAMES if mapping is None else mapping
    names = codes.select(
        F.left("code", F.lit(5)).cast("int").alias("sggCd"),
        F.col("code"),
        mapped_or_same(P.first_token("name"), mapping).alias("sido"),
        P.last_token("name").alias("region"),
    )
    best = names.groupBy("sggCd").agg(F.max_by(F.struct("sido", "region"), "code").alias("r"))
    return best.select("sggCd", "r.sido", "r.region")


def parent_lookup(codes: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """District of a city -> that city, from the three-token names."""
    mapping = PROVINCE_SHORT_NAMES if mapping is None else mapping
    tokens = P.name_tokens("name")
    return (
        codes.where(P.token_count("name") == 3)
        .select(
            mapped_or_same(F.get(tokens, F.lit(0)), mapping).alias("sido"),
            F.get(tokens, F.lit(2)).alias("region"),
            F.get(tokens, F.lit(1)).alias("parent"),
            F.col("code"),
        )
        .groupBy("sido", "region")
        .agg(F.max_by("parent", "code").alias("parent"))
    )


def attach_region(trades: DataFrame, lookup: DataFrame) -> DataFrame:
    """sido and region of each trade by its region code; unknown codes keep null."""
    return trades.join(lookup, "sggCd", "left")


def attach_land_region(trades: DataFrame, parents: DataFrame) -> DataFrame:
    """The region the land-price index uses: the parent city, else the region itself."""
    joined = trades.join(parents, ["sido", "region"], "left")
    return joined.withColumn("land_region", F.coalesce("parent", "region")).drop("parent")


def leaf_regions(codes: DataFrame, rule: str = "name") -> DataFrame:
    """Regions to collect: no provinces and no cities that are split into districts.

    ``rule='name'`` calls a code a parent when another name continues its name. The
    ``'prefix'`` rule compares the first four digits of codes that end with 0 instead, and so
    also drops a county whose neighbour shares its prefix.
    """
    regions = codes.select(F.left("code", F.lit(5)).alias("code5"), "name").where(
        ~F.endswith("code5", F.lit("000"))
    )
    if rule == "prefix":
        shared = (
            regions.groupBy(F.left("code5", F.lit(4)).alias("prefix"))
            .agg(F.count_distinct("code5").alias("n"))
            .where("n > 1")
        )
        keyed = regions.withColumn("prefix", F.left("code5", F.lit(4)))
        suspects = keyed.where(F.endswith("code5", F.lit("0"))).join(shared, "prefix", "left_semi")
        return regions.join(suspects, "code5", "left_anti")
    tokens = P.name_tokens("name")
    parents = regions.where(F.size(tokens) >= 2).select(
        F.array_join(F.slice(tokens, F.lit(1), F.size(tokens) - 1), " ").alias("name")
    )
    return regions.join(parents.distinct(), "name", "left_anti").select("code5", "name")


def attach_dong_code(addresses: DataFrame, dongs: DataFrame) -> DataFrame:
    """Dong code of each address; where there is none, the dong name is what a lookup asks by."""
    out = addresses.withColumn("sgg", P.region_code("sggCd")).join(dongs, ["sgg", "umdNm"], "left")
    return out.withColumn("ask_by", F.coalesce("bjdong", "umdNm"))
