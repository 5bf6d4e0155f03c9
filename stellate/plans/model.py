"""The wildfire / weather star model as a composition of the generic
operators: stage -> dimensions (one pass) -> calendar -> facts."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators.dims import build_dates, build_dims_with_stats, dim_table, with_size_bands
from ..operators.facts import build_fact
from ..specs import (CALENDAR_END, CALENDAR_START, FIRES_FACT, WEATHER_FACT, WEATHER_LOWER_BOUND,
                     with_dims, without_missing_dims)
from .stage import stage_fires, stage_weather


@dataclass
class FireModel:
    staged: DataFrame
    dims: dict[str, DataFrame]     # keyed members, with the _rows planning column
    dates: DataFrame
    fact: DataFrame
    stats: dict | None = None

    def tables(self) -> dict[str, DataFrame]:
        out = {"dates": self.dates}
        out.update({k: dim_table(v) for k, v in self.dims.items()})
        out["fires_fact"] = self.fact
        return out


@dataclass
class WeatherModel:
    staged: DataFrame
    dims: dict[str, DataFrame]
    dates: DataFrame
    fact: DataFrame
    stats: dict | None = None

    def tables(self) -> dict[str, DataFrame]:
        return {"weather_types": dim_table(self.dims["weather_types"]), "weather_fact": self.fact}


def fire_model(spark: SparkSession, raw: DataFrame | None, dates: DataFrame | None = None,
               strategies: dict[str, str] | None = None,
               start: str = CALENDAR_START, end: str = CALENDAR_END,
               staged: DataFrame | None = None, only: Collection[str] | None = None) -> FireModel:
    """Staged frame (from ``raw`` unless given) -> dimensions -> fact; with
    ``only``, the keys of the named dimensions, for readers that need no more."""
    staged = staged if staged is not None else stage_fires(raw)
    spec = without_missing_dims(FIRES_FACT, staged.columns)
    spec = spec if only is None else with_dims(spec, only)
    dims, stats = build_dims_with_stats(staged, spec.dims) if spec.dims else ({}, {})
    if "fire_sizes" in dims:
        dims["fire_sizes"] = with_size_bands(dims["fire_sizes"])
    dates = dates if dates is not None else build_dates(spark, start, end)
    fact = build_fact(staged, spec, dims, dates, strategies, stats)
    return FireModel(staged, dims, dates, fact, stats)


def weather_model(spark: SparkSession, raw: DataFrame | None, lower_bound: str = WEATHER_LOWER_BOUND,
                  dates: DataFrame | None = None, staged: DataFrame | None = None,
                  only: Collection[str] | None = None) -> WeatherModel:
    staged = staged if staged is not None else stage_weather(raw, lower_bound)
    spec = WEATHER_FACT if only is None else with_dims(WEATHER_FACT, only)
    dims, stats = build_dims_with_stats(staged, spec.dims) if spec.dims else ({}, {})
    dates = dates if dates is not None else build_dates(spark)
    fact = build_fact(staged, spec, dims, dates, stats=stats)
    return WeatherModel(staged, dims, dates, fact, stats)
