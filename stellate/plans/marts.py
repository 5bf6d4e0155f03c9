"""Marts and analyses the lake is meant to serve: cube / grouping-set marts,
containment efficiency per agency, overlay of the two facts on coordinates and
days with correlation, k-means cells. Ordinary aggregations and joins; every group-by aggregates
partially on the map side before its shuffle, so hot groups shrink first."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.asof import asof_join
from ..operators.nearby import within_distance
from ..specs import DATES_KEY, REPORTERS


def cube_mart(df: DataFrame, dims: Sequence[str], measures: dict) -> DataFrame:
    """CUBE over ``dims`` with a grouping id (which dims are rolled up)."""
    return df.cube(*dims).agg(*[e.alias(n) for n, e in measures.items()],
                              F.grouping_id().cast("int").alias("gid"))


def grouping_sets_mart(df: DataFrame, sets: Sequence[Sequence[str]], cols: Sequence[str],
                       measures: dict) -> DataFrame:
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *cols).agg(
        *[e.alias(n) for n, e in measures.items()], F.grouping_id().cast("int").alias("gid"))


def containment_efficiency(fires: DataFrame, reporters: DataFrame) -> DataFrame:
    """Per responsible agency: fires, fires whose discovery or containment
    time is unknown, and average hours and most seconds from one to the other.

    ``fires`` is the fact with its two stored timestamps. It is reduced to a
    row per reporter before the join (partial aggregation), so neither a hot
    agency nor a large fact is shuffled.
    """
    found, held = F.col("discovery_timestamp").cast("timestamp_ntz"), F.col("cont_timestamp").cast("timestamp_ntz")
    secs = F.timestamp_diff("SECOND", found, held)
    per_reporter = fires.select(REPORTERS.key, secs.alias("_secs")).groupBy(REPORTERS.key).agg(
        F.count(F.lit(1)).alias("_n"), F.count("_secs").alias("_known"), F.sum("_secs").alias("_sum"), F.max("_secs").alias("_max"))
    return (per_reporter.join(reporters.select(REPORTERS.key, F.col("nwcg_reporting_agency").alias("agency")), REPORTERS.key)
            .groupBy("agency").agg(
                F.sum("_n").alias("n_events"), F.sum(F.col("_n") - F.col("_known")).alias("n_unknown"),
                F.round(F.try_divide(F.sum("_sum"), F.sum("_known")) / F.lit(3600.0), 2).alias("avg_hours"),
                F.max("_max").alias("max_seconds")))


def _cell(column: str, size: int) -> Column:
    """Grid cell of a coordinate, stored as number or text; NULL if neither."""
    return F.floor(F.col(column).try_cast("double") / F.lit(size)).cast("bigint")


def cells_by_day(fact: DataFrame, day_key: str, size: int, count: str) -> DataFrame:
    """Rows per (latitude cell, longitude cell, day key)."""
    cells = fact.select(_cell("latitude", size).alias("lat_cell"), _cell("longitude", size).alias("lon_cell"),
                        F.col(day_key).alias("_day"))
    return (cells.where("lat_cell IS NOT NULL AND lon_cell IS NOT NULL")
            .groupBy("lat_cell", "lon_cell", "_day").agg(F.count(F.lit(1)).alias(count)))


def coordinate_overlay(fires: DataFrame, weather: DataFrame, dates: DataFrame, size: int = 10) -> DataFrame:
    """Fires over weather outliers by place and day: both facts on a grid of
    ``size`` degrees, per cell the days both have, their totals and the
    correlation of the daily counts. Rows of the unknown date are left out.

    Each side is reduced to a row per cell and day before the join (partial
    aggregation), so a hot place or day costs a few map-side rows only; the
    calendar, of bounded size, is broadcast.
    """
    known = F.broadcast(dates.where("date_type = 'date'").select(F.col(DATES_KEY).alias("_day")))
    a = cells_by_day(fires, "discovery_date_id", size, "a_n").join(known, "_day", "left_semi")
    both = a.join(cells_by_day(weather, "weather_date_dim_id", size, "b_n"), ["lat_cell", "lon_cell", "_day"])
    a_n, b_n = F.col("a_n").cast("double"), F.col("b_n").cast("double")
    # Pearson correlation; NULL (not an ANSI divide-by-zero) when a series is constant
    corr = F.try_divide(F.covar_pop(a_n, b_n), F.stddev_pop(a_n) * F.stddev_pop(b_n))
    return both.groupBy("lat_cell", "lon_cell").agg(
        F.count(F.lit(1)).alias("shared_days"), F.sum("a_n").alias("a_total"), F.sum("b_n").alias("b_total"),
        F.round(corr, 6).alias("corr_ab"))


def _days(fact: DataFrame, dates: DataFrame, key: str, day: str) -> DataFrame:
    """The fact with the day that a calendar key stands for; unknown dates
    drop. The calendar, of bounded size, is broadcast."""
    known = F.broadcast(dates.where("date_type = 'date'").select(F.col(DATES_KEY).alias(key), F.col("date_actual").alias(day)))
    return fact.join(known, key)


def _degrees(column: str) -> Column:
    """A coordinate stored as number or text; NULL if neither."""
    return F.col(column).cast("string").try_cast("double")


def distance_overlay(fires: DataFrame, weather: DataFrame, dates: DataFrame, radius_km: float = 150.0, days: int = 3) -> DataFrame:
    """For each fire of a known day and place the number of weather outliers
    within ``radius_km`` on its day or up to ``days`` days before."""
    places = _days(fires.select("fire_id", "discovery_date_id", _degrees("latitude").alias("lat"), _degrees("longitude").alias("lon")),
                   dates, "discovery_date_id", "day").where("lat IS NOT NULL AND lon IS NOT NULL").drop("discovery_date_id")
    points = _days(weather.select("weather_date_dim_id", _degrees("latitude").alias("lat"), _degrees("longitude").alias("lon")),
                   dates, "weather_date_dim_id", "_day")
    # an outlier counts on its own day and the days after it
    points = points.select("lat", "lon", F.explode(F.sequence("_day", F.date_add("_day", days))).alias("day"))
    near = within_distance(places, points, ["day"], radius_km)
    return places.join(near, ["lat", "lon", "day"], "left").select("fire_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_outliers"))


def time_between(fires: DataFrame, weather: DataFrame, dates: DataFrame, size: int = 10, days: int = 7) -> DataFrame:
    """For each fire the latest earlier fire of its reporting unit and the
    exact seconds from that to this, and the latest weather outlier of its
    cell of ``size`` degrees on its day or up to ``days`` days before."""
    found = F.col("discovery_timestamp").cast("timestamp_ntz")
    own = fires.select("fire_id", REPORTERS.key, found.alias("found"), _cell("latitude", size).alias("lat_cell"),
                       _cell("longitude", size).alias("lon_cell")).withColumn("day", F.col("found").cast("date"))
    since = asof_join(own, own.select(REPORTERS.key, "fire_id", F.col("found").alias("at")), [REPORTERS.key], "found", "at", ["fire_id"],
                      strict=True, prefix="previous_")
    outliers = _days(weather.select("weather_outlier_id", "weather_date_dim_id", _cell("latitude", size).alias("lat_cell"),
                                    _cell("longitude", size).alias("lon_cell")), dates, "weather_date_dim_id", "on_day")
    both = asof_join(since, outliers.where("lat_cell IS NOT NULL AND lon_cell IS NOT NULL"), ["lat_cell", "lon_cell"], "day", "on_day",
                     ["weather_outlier_id"], bucket_seconds=365 * 86400)
    ago = F.datediff("day", F.col("last_on_day").cast("date"))
    return both.select(
        "fire_id", F.col("previous_fire_id"), F.timestamp_diff("SECOND", F.col("previous_at"), F.col("found")).alias("seconds_since"),
        F.when(ago <= days, F.col("last_weather_outlier_id")).alias("weather_outlier_id"),
        F.when(ago <= days, ago).cast("int").alias("days_since_outlier"))


@dataclass
class Cells:
    points: DataFrame                     # the input's columns and ``cell``
    centres: list[tuple[float, ...]]      # of each cell, k of them at most
    iterations: int
    converged: bool                       # False: stopped at max_iter


def kmeans_cells(df: DataFrame, columns: Sequence[str] = ("latitude", "longitude"), k: int = 4,
                 max_iter: int = 100, seed: int = 42) -> Cells:
    """K-means of the rows' coordinates with Spark ML (distributed Lloyd
    iterations over persisted vectors); rows without coordinates are left out."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    known = df.select("*", *[F.col(c).try_cast("double").alias(f"_x{i}") for i, c in enumerate(columns)]).dropna(
        subset=[f"_x{i}" for i in range(len(columns))])
    points = VectorAssembler(inputCols=[f"_x{i}" for i in range(len(columns))], outputCol="_features").transform(known)
    model = KMeans(k=k, seed=seed, featuresCol="_features", predictionCol="cell", maxIter=max_iter).fit(points)
    n = model.summary.numIter
    return Cells(model.transform(points).select(*df.columns, F.col("cell").cast("int").alias("cell")),
                 [tuple(map(float, c)) for c in model.clusterCenters()], n, n < max_iter)


def cell_check(cells: Cells, columns: Sequence[str] = ("latitude", "longitude")) -> DataFrame:
    """One row: points, cells, points that another centre is nearer to than
    their own, and whether the iteration converged."""
    def distance(centre: Sequence[float]) -> Column:
        return reduce(lambda a, b: a + b, [(F.col(c).cast("double") - F.lit(x)) ** 2 for c, x in zip(columns, centre)])

    distances = F.array(*[distance(c) for c in cells.centres])
    # a tie, up to rounding, belongs to either
    wrong = F.element_at(distances, F.col("cell") + 1) > F.array_min(distances) + 1e-6
    return cells.points.agg(F.count("cell").alias("n_points"), F.countDistinct("cell").alias("n_cells"),
                            F.count_if(wrong).alias("n_misplaced")).withColumn("converged", F.lit(cells.converged))
