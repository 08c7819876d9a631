"""Raw trades -> filtered trades with unit prices and the land-index time adjustment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landgauge.constants import PROVINCE_SHORT_NAMES
from landgauge.functions import numeric as N
from landgauge.functions import parsing as P
from landgauge.operators.filters import valid_deals
from landgauge.operators.land_index import attach_index, one_per_month, union_all, wide_to_long
from landgauge.operators.regions import (
    attach_land_region,
    attach_region,
    parent_lookup,
    region_lookup,
)
from landgauge.session import measured


def typed_trades(raw: DataFrame) -> DataFrame:
    """Text columns of raw trades as numbers, with Age and unit price. A blank date part is null; a blank amount is an error."""
    numbers = {
        "sggCd": P.lenient_double("sggCd").cast("int"),
        "buildYear": P.lenient_double("buildYear").cast("int"),
        "excluUseAr": P.lenient_double("excluUseAr"),
        "landAr": P.lenient_double("landAr"),
        "floor": P.lenient_double("floor").cast("int"),
        "dealYear": P.lenient_double("dealYear").cast("int"),
        "dealMonth": P.lenient_double("dealMonth").cast("int"),
        "dealDay": P.lenient_double("dealDay").cast("int"),
        "dealAmount": P.strict_long("dealAmount"),
    }
    typed = raw.withColumns(numbers)
    return typed.withColumns(
        {
            "Age": N.age("dealYear", "buildYear"),
            "Price_per_m2": N.unit_price("dealAmount", "excluUseAr"),
        }
    )


def prepare_trades(
    raw: DataFrame,
    region_codes: DataFrame,
    wide_indexes: list[DataFrame],
    province_names: dict[str, str] | None = None,
) -> DataFrame:
    """Valid trades with region names, index values and Time_Adjustment.

    Row count in, row count out: each lookup has one row per key.
    """
    names = PROVINCE_SHORT_NAMES if province_names is None else province_names
    codes = measured(region_codes)
    trades = typed_trades(valid_deals(raw))
    trades = attach_region(trades, region_lookup(codes, names))
    trades = attach_land_region(trades, parent_lookup(codes, names))
    index = measured(one_per_month(union_all([wide_to_long(w) for w in wide_indexes])))
    return attach_index(trades, index).drop("land_region")
