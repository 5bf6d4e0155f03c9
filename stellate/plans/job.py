"""The whole batch job: raw sources -> staged -> dimensions -> facts ->
versioned Parquet lake -> catalog -> quality reports.

Each fact's dimensions are numbered in one pass over its staged rows. A lake
that exists keeps every key it has: unseen members are appended, the facts are
joined to the stored dimensions, and the years of the given extract replace
those years; other years and their keys stay. So an extract must hold whole
years; ``streaming.refresh`` adds single rows. Rows of days that the calendar
lacks go to the quarantine beside their fact. A run is one commit: readers see
all of it or nothing.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..operators.dims import dim_table
from ..operators.facts import calendar_misses, role_date_report
from ..operators.quality import (duplicate_key_report, null_key_report, orphan_report,
                                 row_count_report)
from ..specs import (CALENDAR_END, CALENDAR_START, DATES_KEY, DATES_TABLE, FIRE_DIMS, FIRES_FACT,
                     WEATHER_FACT, WEATHER_LOWER_BOUND, WEATHER_TYPES, FactSpec, fact_column, without_missing_dims)
from .stage import stage_fires, stage_weather
from .upkeep import calendar_range, extend_dates, replace_years, replay_quarantine
from .versions import Change, Version, commit_with, publish_version, read_lake

KEYS = {DATES_TABLE: DATES_KEY, **{d.name: d.key for d in FIRE_DIMS}, WEATHER_TYPES.name: WEATHER_TYPES.key,
        FIRES_FACT.name: fact_column(FIRES_FACT, FIRES_FACT.row_id[0]),
        WEATHER_FACT.name: fact_column(WEATHER_FACT, WEATHER_FACT.row_id[0])}


@dataclass
class LakeBuild:
    root: str
    version: Version
    tables: dict[str, DataFrame]     # of that version
    database: str | None
    reports: dict[str, DataFrame] = field(default_factory=dict)


def foreign_keys(spec: FactSpec, lake: dict[str, DataFrame]) -> dict[str, tuple[DataFrame, str, str]]:
    """For ``orphan_report``: each dimension and calendar role of a fact."""
    fks = {d.name: (lake[d.name], d.key, d.key) for d in spec.dims}
    fks.update({f"{DATES_TABLE}_{r.key_out}": (lake[DATES_TABLE], DATES_KEY, r.key_out) for r in spec.roles})
    return fks


def lake_reports(fires: DataFrame, weather: DataFrame, lake: dict[str, DataFrame], start: str = CALENDAR_START,
                 end: str = CALENDAR_END) -> dict[str, DataFrame]:
    """Quality reports on the stored tables, and on the staged rows that the
    calendar, [start, end), drops."""
    fire_spec = without_missing_dims(FIRES_FACT, fires.columns)
    return {
        "null_keys": null_key_report({t: (lake[t], KEYS[t]) for t in lake}),
        "row_counts": row_count_report(lake),
        "duplicate_keys": duplicate_key_report({t: (lake[t], KEYS[t]) for t in lake}),
        "fire_orphans": orphan_report(lake[FIRES_FACT.name], foreign_keys(fire_spec, lake)),
        "weather_orphans": orphan_report(lake[WEATHER_FACT.name], foreign_keys(WEATHER_FACT, lake)),
        "fires_dropped": calendar_misses(fires, FIRES_FACT, start, end),
        "weather_dropped": calendar_misses(weather, WEATHER_FACT, start, end),
        "calendar_roles": role_date_report(fires, FIRES_FACT, start, end).unionByName(
            role_date_report(weather, WEATHER_FACT, start, end)),
    }


def build_lake(spark: SparkSession, raw_fires: DataFrame, raw_weather: DataFrame, root: str,
               database: str | None = None, weather_lower_bound: str = WEATHER_LOWER_BOUND,
               stage_root: str | None = None, calendar_end: str | None = None) -> LakeBuild:
    """Build the 11-table star under ``root``, or bring the star that is there
    up to date, as one version.

    ``stage_root``: where the raw source is expensive to read again or may
    change between reads (JDBC, CSV), the staged frames are written there
    once as Parquet; every later pass reads that typed, pruned copy.
    ``calendar_end`` (exclusive): where it is after that of the stored
    calendar, the calendar grows, and quarantined rows that it then holds
    become facts.
    """
    fires, weather = stage_fires(raw_fires), stage_weather(raw_weather, weather_lower_bound)
    if stage_root:
        fires.write.mode("overwrite").parquet(f"{stage_root}/fires")
        weather.write.mode("overwrite").parquet(f"{stage_root}/weather")
        fires, weather = spark.read.parquet(f"{stage_root}/fires"), spark.read.parquet(f"{stage_root}/weather")

    def work(change: Change) -> None:
        if calendar_end is not None:
            extend_dates(change, end=calendar_end)
        for staged, spec in ((fires, FIRES_FACT), (weather, WEATHER_FACT)):
            if calendar_end is not None:
                replay_quarantine(change, spec)
            replace_years(change, staged, spec, is_stored=stage_root is not None)

    made = commit_with(spark, root, work)
    if database:
        made = publish_version(spark, database, root, made)
    every = read_lake(spark, root, made)
    lake = {name: df for name, df in every.items() if name in KEYS}
    return LakeBuild(root, made, every, database, lake_reports(fires, weather, lake, *calendar_range(Change(spark, root, made))))


__all__ = ["KEYS", "LakeBuild", "build_lake", "dim_table", "foreign_keys", "lake_reports"]
