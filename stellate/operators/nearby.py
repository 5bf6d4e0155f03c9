"""Counts of points within a great-circle distance, by a grid and quad trees.

The earth is cut into bands of latitude as high as the radius and each band
into cells; a place meets the cells that its circle can reach, over the date
line and the poles too. The points of a (cell, key) are the root of a quad
tree: a node knows how many points it holds and a circle around them. A node
that lies inside a place's circle counts as a whole, one outside is left, and
only one on the edge is opened, a level a round, down to single places. So a
crowded cell costs the nodes along the circle's edge, not all its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir

EARTH_KM = 6371.0088
LEVELS = 10


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance of two points in degrees."""
    a = (F.sin(F.radians(lat2 - lat1) / 2) ** 2
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(F.radians(lon2 - lon1) / 2) ** 2)
    return F.lit(2 * EARTH_KM) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def _band_height(radius_km: float) -> float:
    return min(180.0, math.degrees(radius_km / EARTH_KM) * 1.000001)


def _cells_of(band: Column, height: float) -> Column:
    """Cells in a band: as wide as the radius where the band is widest."""
    low, high = band * height - 90.0, (band + 1) * height - 90.0
    widest = F.when((low <= 0) & (high >= 0), F.lit(0.0)).otherwise(F.least(F.abs(low), F.abs(high)))
    return F.greatest(F.lit(1), F.floor(F.lit(360.0 / height) * F.cos(F.radians(F.least(widest, F.lit(90.0)))))).cast("int")


def _turn(lon: Column) -> Column:
    """Longitude in [0, 360)."""
    return F.pmod(lon + 180.0, F.lit(360.0))


def _with_cell(points: DataFrame, height: float) -> DataFrame:
    band = F.floor((F.col("lat") + 90.0) / height).cast("int")
    n = _cells_of(F.col("_band"), height)
    return points.withColumn("_band", band).withColumn(
        "_cell", F.least(F.floor(_turn(F.col("lon")) * n / 360.0).cast("int"), n - 1))


def _with_reach(places: DataFrame, radius_km: float, height: float) -> DataFrame:
    """A row for each (band, cell) that a place's circle can reach."""
    angle = math.degrees(radius_km / EARTH_KM) * 1.000001
    low, high = F.col("lat") - angle, F.col("lat") + angle
    # widest spread in longitude of a circle; all of it if it holds a pole
    spread = F.when((low <= -90.0) | (high >= 90.0), F.lit(180.0)).otherwise(
        F.degrees(F.asin(F.least(F.lit(1.0), F.sin(F.radians(F.lit(angle))) / F.cos(F.radians(F.col("lat")))))) * 1.000001 + 1e-9)
    first = F.floor((F.greatest(low, F.lit(-90.0)) + 90.0) / height).cast("int")
    last = F.floor((F.least(high, F.lit(90.0)) + 90.0) / height).cast("int")
    n = F.col("_n")
    west, east = _turn(F.col("lon")) - F.col("_spread"), _turn(F.col("lon")) + F.col("_spread")
    begin = F.floor(west * n / 360.0).cast("int")
    end = F.least(F.floor(east * n / 360.0).cast("int"), begin + n - 1)
    banded = (places.withColumn("_spread", spread).withColumn("_band", F.explode(F.sequence(first, last)))
              .withColumn("_n", _cells_of(F.col("_band"), height)))
    # a turn too far is the same cell; the last cell also takes in the rounding at 360 degrees
    return (banded.withColumn("_cell", F.explode(F.array_distinct(F.transform(F.sequence(begin, end), lambda c: F.pmod(c, n)))))
            .drop("_spread", "_n"))


def _stored(df: DataFrame) -> DataFrame:
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def within_distance(places: DataFrame, points: DataFrame, key: Sequence[str], radius_km: float, levels: int = LEVELS,
                    store: Callable[[DataFrame], DataFrame] = _stored) -> DataFrame:
    """(lat, lon, *key, n): for each different place the number of points of
    the same key (null matches nothing) within ``radius_km``; places without
    any are left out.

    Both have lat, lon (degrees, as doubles) and the key's columns; latitudes
    beyond 90 degrees and nulls are no places. Points of one place count
    together before anything is joined.
    """
    height = _band_height(radius_km)
    good = "lat BETWEEN -90 AND 90 AND lon IS NOT NULL AND NOT isnan(lon) AND abs(lon) <= 540"
    spots = _with_cell(points.where(good).groupBy("lat", "lon", *key).agg(F.count(F.lit(1)).alias("n")), height)
    nodes = store(_leaves(spots, height, levels))
    asked = places.where(good).select("lat", "lon", *key).distinct()
    home = ["_band", "_cell", *key]
    found, open_ = None, _with_reach(asked, radius_km, height).withColumn("_node", F.lit(""))
    for level in range(levels + 1):
        tree = _nodes(nodes, key, level)
        meets = open_.join(tree, [*home, "_node"])
        away = haversine_km(F.col("lat"), F.col("lon"), F.col("_lat"), F.col("_lon"))
        judged = meets.withColumn("_away", away).where(F.col("_away") - F.col("_wide") <= F.lit(radius_km + 1e-9))
        whole = (F.col("_away") + F.col("_wide") <= F.lit(radius_km - 1e-9))
        judged = store(judged.withColumn("_whole", whole).select("lat", "lon", *home, "_node", "_n_node", "_spots", "_whole"))
        counted = judged.where("_whole").select("lat", "lon", *key, F.col("_n_node").alias("n"))
        found = counted if found is None else found.unionByName(counted)
        edge = judged.where("NOT _whole")
        if level == levels:
            # a node that cannot be opened further: its places one by one
            single = edge
        else:
            single = edge.where("_spots = 1")
            digits = F.array(*[F.lit(str(d)) for d in range(4)])
            open_ = edge.where("_spots > 1").select("lat", "lon", *home, "_node", F.explode(digits).alias("_digit")).select(
                "lat", "lon", *home, F.concat("_node", "_digit").alias("_node"))
        one = single.select("lat", "lon", *home, "_node").join(
            nodes.select(*home, F.substring("_leaf", 1, level).alias("_node"), F.col("lat").alias("_plat"), F.col("lon").alias("_plon"), F.col("n").alias("_pn")),
            [*home, "_node"])
        near = haversine_km(F.col("lat"), F.col("lon"), F.col("_plat"), F.col("_plon")) <= F.lit(float(radius_km))
        found = found.unionByName(one.where(near).select("lat", "lon", *key, F.col("_pn").alias("n")))
        if edge.where("_spots > 1").isEmpty():
            break
    return found.groupBy("lat", "lon", *key).agg(F.sum("n").alias("n"))


def _leaves(spots: DataFrame, height: float, levels: int) -> DataFrame:
    """Each spot with the path of digits that leads to it from its cell."""
    cells = _cells_of(F.col("_band"), height)
    y = F.col("lat") + 90.0 - F.col("_band") * height
    x = _turn(F.col("lon")) - F.col("_cell") * 360.0 / cells
    top = (1 << levels) - 1
    row = F.least(F.floor(y / height * (1 << levels)), F.lit(top)).cast("int")
    column = F.least(F.floor(x / (360.0 / cells) * (1 << levels)), F.lit(top)).cast("int")
    digits = [(2 * F.getbit(F.col("_row"), F.lit(b)).cast("int") + F.getbit(F.col("_column"), F.lit(b)).cast("int")).cast("string")
              for b in reversed(range(levels))]
    return (spots.withColumn("_row", F.greatest(row, F.lit(0))).withColumn("_column", F.greatest(column, F.lit(0)))
            .withColumn("_leaf", F.concat(*digits) if digits else F.lit("")).drop("_row", "_column"))


def _nodes(leaves: DataFrame, key: Sequence[str], level: int) -> DataFrame:
    """The trees' nodes of a level: points, different spots, and a circle
    (middle, radius in km) that holds them."""
    own = leaves.withColumn("_node", F.substring("_leaf", 1, level)).withColumn("_x", _turn(F.col("lon")))
    box = own.groupBy("_band", "_cell", *key, "_node").agg(
        F.sum("n").alias("_n_node"), F.count(F.lit(1)).alias("_spots"), F.min("lat").alias("_s"), F.max("lat").alias("_t"),
        F.min("_x").alias("_w"), F.max("_x").alias("_e"))
    middle = box.withColumn("_lat", (F.col("_s") + F.col("_t")) / 2).withColumn("_lon", (F.col("_w") + F.col("_e")) / 2 - 180.0)
    # a corner may be nearer than the middle of an edge: half the box's height and its widest width
    widest = F.when((F.col("_s") <= 0) & (F.col("_t") >= 0), F.lit(0.0)).otherwise(F.least(F.abs("_s"), F.abs("_t")))
    half_up = F.radians(F.col("_t") - F.col("_s")) / 2
    half_across = F.radians(F.col("_e") - F.col("_w")) / 2 * F.cos(F.radians(widest))
    return middle.withColumn("_wide", (half_up + half_across) * EARTH_KM * 1.000001 + 1e-9).drop("_s", "_t", "_w", "_e")
