"""Exact nearest-station search and fill.

Two plans give the same answer. Few stations: their list travels to every row as one scalar, and
the search is a map without any shuffle. Many stations: points and stations meet on cells of a
multi-level grid over the unit sphere, so each point is compared only with stations that can
still win. Neither plan pairs every point with every station through a join.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landgauge.constants import EARTH_RADIUS_M
from landgauge.functions import numeric as N
from landgauge.operators.filters import complete_on
from landgauge.session import measured, spread

# Above this many stations the grid plan is cheaper than scanning the list on every row.
LIST_LIMIT = 256


def station_centroids(df: DataFrame, name: str = "subway_name") -> DataFrame:
    """Mean position of the rows near each station, over rows that are complete."""
    return (
        complete_on(df, ["lat", "lng", name])
        .groupBy(name)
        .agg(F.avg("lat").alias("lat"), F.avg("lng").alias("lng"))
    )


def _metres(h: Column) -> Column:
    return F.asin(F.sqrt(h)) * 2.0 * EARTH_RADIUS_M


def _half_chord(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """The haversine term, which orders points as the distance does."""
    half_lat = F.sin((lat2 - lat1) / 2)
    half_lng = F.sin((lng2 - lng1) / 2)
    return half_lat * half_lat + F.cos(lat1) * F.cos(lat2) * half_lng * half_lng


def nearest_by_list(points: DataFrame, stations: DataFrame, name: str) -> DataFrame:
    """Add ``_near`` (h, name) by scanning the whole station list on each row."""
    a, o = F.radians("lat"), F.radians("lng")
    row = F.struct(a.alias("a"), o.alias("o"), F.cos(a).alias("c"), F.col(name).alias("name"))
    listed = stations.select(row.alias("s")).agg(F.collect_list("s").alias("all")).scalar()

    def scored(s: Column) -> Column:
        half_lat, half_lng = F.sin((s["a"] - F.col("_a")) / 2), F.sin((s["o"] - F.col("_o")) / 2)
        h = half_lat * half_lat + F.col("_c") * s["c"] * half_lng * half_lng
        return F.struct(h.alias("h"), s["name"].alias("name"))

    return (
        points.withColumns({"_a": a, "_o": o, "_c": F.cos(a)})
        .withColumn("_all", listed)
        .withColumn("_near", F.array_min(F.transform(F.col("_all"), scored)))
        .drop("_a", "_o", "_c", "_all")
    )


def _on_sphere(df: DataFrame) -> DataFrame:
    a, o = F.radians("lat"), F.radians("lng")
    return (
        df.withColumn("_a", a)
        .withColumn("_o", o)
        .withColumn("_x", F.cos(a) * F.cos(o))
        .withColumn("_y", F.cos(a) * F.sin(o))
        .withColumn("_z", F.sin(a))
    )


def _finest_edge(stations: DataFrame) -> float:
    """Cell edge at which the 27 cells around a point hold about one station."""
    axes = [F.max(c) - F.min(c) for c in ("_x", "_y", "_z")]
    n, dx, dy, dz = stations.agg(F.count(F.lit(1)), *axes).first()
    area = dx * dy + dy * dz + dz * dx
    return min(2.0, max(math.sqrt(area / n) / 4, 1e-7))


def nearest_by_grid(points: DataFrame, stations: DataFrame, name: str) -> DataFrame:
    """(lat, lng, _near) per distinct point, by way of a grid with doubling cell edges.

    A point's cell takes the finest level at which the 27 cells around it hold a station; that
    station is at most 2*sqrt(3) edges away. Two levels up an edge is four times as long, so the
    27 cells there hold every station that is as near or nearer, the answer and its ties included.
    Of these a cell keeps the stations that are nearest to some place inside it, and its points are
    compared with those alone.
    """
    # Entered 27 times at every level, so dealt out first; no join below may broadcast what the planner takes for small.
    located = _on_sphere(spread(stations.select("lat", "lng", F.col(name).alias("name")), "name"))
    edge = _finest_edge(located)
    top = max(0, math.ceil(math.log2(2.0 / edge)))
    axes = ("_x", "_y", "_z")
    own = [f"c{a}" for a in axes]
    keys = ["level", *[f"k{a}" for a in axes]]

    def with_cell(df: DataFrame) -> DataFrame:
        return df.withColumns({f"c{a}": F.floor((F.col(a) + 1) / edge) for a in axes})

    def at_level(df: DataFrame) -> DataFrame:
        return df.withColumns({f"k{a}": F.expr(f"shiftright(c{a}, level)") for a in axes})

    levels = F.explode(F.sequence(F.lit(0), F.lit(top)))

    # Every station is entered, at each level, in the 27 cells it can be seen from.
    reach = at_level(with_cell(located).withColumn("level", levels))
    for a in axes:
        step = F.explode(F.array(*[F.lit(d) for d in (-1, 0, 1)]))
        reach = reach.withColumn("_d", step).withColumn(f"k{a}", F.col(f"k{a}") + F.col("_d"))
    reach = reach.select(*keys, "name", *axes, F.col("_a").alias("_sa"), F.col("_o").alias("_so"))

    spots = with_cell(_on_sphere(points.select("lat", "lng").distinct()))
    spots = spots.select("lat", "lng", "_a", "_o", *own)
    cells = spots.select(*own).distinct()
    seen = at_level(cells.withColumn("level", levels)).join(
        reach.select(*keys).distinct().hint("merge"), keys, "left_semi"
    )
    search = seen.groupBy(*own).agg(F.least(F.min("level") + 2, F.lit(top)).alias("level"))

    away = F.lit(0.0)
    for a in axes:
        gap = (F.col(f"c{a}") + 0.5) * edge - 1 - F.col(a)
        away = away + gap * gap
    around = at_level(search).join(reach.hint("merge"), keys).withColumn("_away", F.sqrt(away))
    closest = around.groupBy(*own).agg(F.min("_away").alias("_least"))
    # A cell's centre is sqrt(3)/2 edges from its corners; the margin covers rounding.
    limit = (F.col("_least") + math.sqrt(3) * edge) * (1 + 1e-9) + 1e-12
    rivals = around.join(closest, own).where(F.col("_away") <= limit)
    pairs = spots.hint("merge").join(rivals.select(*own, "name", "_sa", "_so"), own)
    h = _half_chord(F.col("_a"), F.col("_o"), F.col("_sa"), F.col("_so"))
    return pairs.groupBy("lat", "lng").agg(
        F.min(F.struct(h.alias("h"), F.col("name").alias("name"))).alias("_near")
    )


def nearest_station(
    points: DataFrame,
    stations: DataFrame,
    name: str = "subway_name",
    list_limit: int = LIST_LIMIT,
) -> DataFrame:
    """``points`` with ``nearest_name`` and ``nearest_m``; ties go to the first name.

    Points without coordinates keep null.
    """
    known = measured(complete_on(stations, ["lat", "lng", name]).select(name, "lat", "lng"))
    size = known.limit(list_limit + 1).count()
    if size == 0:
        found = points.withColumn("_near", F.lit(None).cast("struct<h:double,name:string>"))
    elif size <= list_limit:
        found = nearest_by_list(points, known, name)
    else:
        located = complete_on(points.select("lat", "lng"), ["lat", "lng"])
        found = points.join(nearest_by_grid(located, known, name), ["lat", "lng"], "left")
    has_point = F.col("lat").isNotNull() & F.col("lng").isNotNull()
    return found.withColumns(
        {
            "nearest_name": F.when(has_point, F.col("_near.name")),
            "nearest_m": F.when(has_point, _metres(F.col("_near.h"))),
        }
    ).drop("_near")


def fill_nearest_station(
    df: DataFrame, stations: DataFrame | None = None, list_limit: int = LIST_LIMIT
) -> DataFrame:
    """Fill station and distance of rows that have coordinates but no station.

    Stations default to the centroids of the rows themselves. Rows that already know their
    station take no part in the search. ``subway_source`` tells the two measures apart:
    'service' distances come from a lookup, 'centroid' ones from here.
    """
    if stations is None:
        stations = station_centroids(df)
    name = F.col("subway_name")
    open_row = name.isNull() & F.col("lat").isNotNull() & F.col("lng").isNotNull()
    done = df.where(~open_row).withColumn("subway_source", F.when(name.isNotNull(), "service"))
    filled = nearest_station(df.where(open_row), stations, list_limit=list_limit)
    filled = filled.withColumns(
        {
            "subway_name": F.col("nearest_name"),
            "subway_dist": F.coalesce("nearest_m", "subway_dist"),
            "subway_source": F.when(F.col("nearest_name").isNotNull(), "centroid"),
        }
    )
    return done.unionByName(filled.select(*done.columns))


def distance_m(df: DataFrame, lat1: str, lng1: str, lat2: str, lng2: str, out: str) -> DataFrame:
    return df.withColumn(out, N.haversine_m(lat1, lng1, lat2, lng2))
