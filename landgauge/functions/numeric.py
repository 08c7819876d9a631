"""Price, area, age and distance arithmetic with explicit null rules."""

from __future__ import annotations

import struct
import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

from landgauge.constants import (
    BUILDING_DEFAULTS,
    EARTH_RADIUS_M,
    HIGH_FLOOR,
    SUBWAY_AREA_M,
    SUBWAY_CAP_M,
)
from landgauge.functions.parsing import ColumnLike, _col, first_filled_number, lenient_double


def unit_price(amount: ColumnLike, area: ColumnLike) -> Column:
    """10,000 KRW per square metre; a zero area gives null, not infinity."""
    return F.try_divide(_col(amount), _col(area))


def nominal_price(amount: ColumnLike, area: ColumnLike) -> Column:
    """KRW per square metre."""
    return F.try_divide(_col(amount) * 10000, _col(area))


def time_adjustment(current: ColumnLike, at_deal: ColumnLike) -> Column:
    return F.try_divide(_col(current), _col(at_deal))


def age(deal_year: ColumnLike, build_year: ColumnLike) -> Column:
    """Years between construction and deal; negative for pre-sales."""
    return _col(deal_year) - _col(build_year)


def at_least(c: ColumnLike, floor: float) -> Column:
    """Lower clip that keeps null (``greatest`` would replace it)."""
    return F.when(_col(c) < floor, F.lit(floor)).otherwise(_col(c))


def at_most(c: ColumnLike, cap: float) -> Column:
    """Upper clip that keeps null (``least`` would replace it)."""
    return F.when(_col(c) > cap, F.lit(cap)).otherwise(_col(c))


def deal_age(deal_year: ColumnLike, build_year: ColumnLike) -> Column:
    return at_least(age(deal_year, build_year), 0)


def capped_distance(c: ColumnLike) -> Column:
    return at_most(c, float(SUBWAY_CAP_M))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it fails or is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def subway_area(distance: ColumnLike) -> Column:
    return flag(_col(distance) <= SUBWAY_AREA_M)


def high_floor_without_elevator(floor: ColumnLike, elevator: ColumnLike) -> Column:
    return flag((_col(floor) >= HIGH_FLOOR) & (_col(elevator) == 0))


def area_ratio(area: ColumnLike, land: ColumnLike) -> Column:
    return F.try_divide(_col(area), _col(land) + F.lit(1e-5))


def log_price(c: ColumnLike) -> Column:
    return F.log1p(_col(c))


def price_from_log(c: ColumnLike) -> Column:
    return F.expm1(_col(c))


def final_value(price_per_m2: ColumnLike, area: ColumnLike) -> Column:
    return _col(price_per_m2) * _col(area)


def absolute_pct_error(actual: ColumnLike, predicted: ColumnLike) -> Column:
    return F.abs(F.try_divide(_col(actual) - _col(predicted), _col(actual))) * 100


def haversine_m(lat1: ColumnLike, lng1: ColumnLike, lat2: ColumnLike, lng2: ColumnLike) -> Column:
    """Great-circle metres between two points in degrees."""
    a1, o1, a2, o2 = (F.radians(_col(c)) for c in (lat1, lng1, lat2, lng2))
    half_lat = F.sin((a2 - a1) / 2)
    half_lng = F.sin((o2 - o1) / 2)
    h = half_lat * half_lat + F.cos(a1) * F.cos(a2) * half_lng * half_lng
    return F.asin(F.sqrt(h)) * 2.0 * EARTH_RADIUS_M


def parking_ratio(households: ColumnLike, *spaces: ColumnLike) -> Column:
    """Parking spaces per household; the default where there are no households."""
    total = F.lit(0.0)
    for space in spaces:
        total = total + F.coalesce(lenient_double(space), F.lit(0.0))
    homes = F.coalesce(lenient_double(households), F.lit(0.0))
    default = F.lit(BUILDING_DEFAULTS["parking_ratio"])
    return F.when(homes > 0, F.try_divide(total, homes)).otherwise(default)


def elevator_flag(*lift_fields: ColumnLike) -> Column:
    return flag(first_filled_number(*lift_fields) > 0)


def concrete_flag(structure: ColumnLike) -> Column:
    name = _col(structure)
    return flag(name.contains("철근콘크리트") | F.upper(name).contains("RC"))


def mixed_use_flag(purpose: ColumnLike) -> Column:
    return flag(_col(purpose).contains("근린생활시설"))


def floor_count(c: ColumnLike) -> Column:
    return first_filled_number(c, default=BUILDING_DEFAULTS["total_floors"]).cast("int")


def ordered_bits(value: ColumnLike) -> Column:
    """A long that orders like the double value: its sign, exponent and mantissa bits. Null and NaN give null; -0.0 is 0.0."""
    x = F.nanvl(_col(value).cast("double"), F.lit(None).cast("double"))
    # No part stands inside a condition, so that each is worked out once.
    a = F.least(F.abs(x), F.lit(sys.float_info.max))
    guess = F.least(F.floor(F.log2(a)).cast("int"), F.lit(1023))
    power = F.pow(F.lit(2.0), guess)
    # The logarithm may round to the next power of two.
    over, under = (a / power >= 2).cast("int"), (a / power < 1).cast("int")
    exponent = F.greatest(guess + over - under, F.lit(-1022))
    power = F.greatest(power * (F.lit(1.0) + over) * (F.lit(1.0) - F.lit(0.5) * under), F.lit(sys.float_info.min))
    mantissa = (a / power * F.lit(2.0**52)).cast("long")
    bits = F.shiftleft((exponent + 1022).cast("long"), 52) + mantissa
    # Zero has no logarithm; infinity follows the largest number.
    size = F.coalesce(bits, F.lit(0).cast("long")) + (F.abs(x) == float("inf")).cast("long")
    return size * F.signum(x).cast("long")


def bits_value(bits: ColumnLike) -> Column:
    """The double that :func:`ordered_bits` gave the long for."""
    k = _col(bits)
    size = F.abs(k)
    exponent, rest = F.shiftright(size, 52), size.bitwiseAND(F.lit((1 << 52) - 1))
    normal = (rest + F.lit(1 << 52)).cast("double") * F.pow(F.lit(2.0), exponent - 1075)
    small = rest.cast("double") * F.pow(F.lit(2.0), F.lit(-1074))
    whole = F.when(exponent == 0, small).when(exponent == 2047, F.lit(float("inf"))).otherwise(normal)
    return F.when(k < 0, -whole).otherwise(whole)


def value_of_bits(bits: int) -> float:
    """The double that :func:`ordered_bits` gave the long for."""
    size = struct.unpack(">d", abs(bits).to_bytes(8, "big"))[0]
    return -size if bits < 0 else size
