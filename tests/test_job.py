from stellate.plans.fixtures import FX_WEATHER_LOWER_BOUND, raw_fires, raw_weather
from stellate.plans.job import build_lake
from stellate.plans.versions import read_version
from stellate.session import fresh_path

from conftest import SF_SMOKE


N_WEATHER = f"try_cast(date_str AS DATE) >= DATE'{FX_WEATHER_LOWER_BOUND}'"


def test_rerun_keeps_keys_and_other_years(spark):
    """A second run over a later extract, which lacks members of the first,
    on a session that does not ask for dynamic overwrite."""
    raw_f, raw_w, root = raw_fires(spark, SF_SMOKE), raw_weather(spark, SF_SMOKE).drop("id", "station_name"), fresh_path(spark, "rerun")
    spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    try:
        for years in ("FIRE_YEAR <= 1997", "FIRE_YEAR >= 1997", "FIRE_YEAR = 1999"):
            b = build_lake(spark, raw_f.where(years), raw_w, root, weather_lower_bound=FX_WEATHER_LOWER_BOUND)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    assert all(x["orphans"] == 0 for x in b.reports["fire_orphans"].collect())
    assert all(x["duplicate_keys"] == 0 for x in b.reports["duplicate_keys"].collect())
    whole = build_lake(spark, raw_f, raw_w, fresh_path(spark, "whole"), weather_lower_bound=FX_WEATHER_LOWER_BOUND)
    for table in ("fires_fact", "weather_fact"):
        assert read_version(spark, root, table).count() == read_version(spark, whole.root, table).count()
    def places(r):
        f = read_version(spark, r, "fires_fact").join(read_version(spark, r, "locations"), "location_id")
        return {tuple(x) for x in f.select("fire_id", "state", "fips_name").collect()}
    assert places(root) == places(whole.root)


def _check(spark, build, n_fires, n_weather):
    r = build.reports
    assert all(x["null_keys"] == 0 for x in r["null_keys"].collect())
    assert all(x["duplicate_keys"] == 0 for x in r["duplicate_keys"].collect())
    assert all(x["orphans"] == 0 for x in r["fire_orphans"].collect())
    assert all(x["orphans"] == 0 for x in r["weather_orphans"].collect())
    counts = {x["table_name"]: x["row_count"] for x in r["row_counts"].collect()}
    assert len(counts) == 11
    assert counts["fires_fact"] + r["fires_dropped"].count() == n_fires
    assert counts["weather_fact"] + r["weather_dropped"].count() == n_weather
    assert counts["dates"] == 18263


def test_build_lake_end_to_end(spark):
    raw_f = raw_fires(spark, SF_SMOKE)
    raw_w = raw_weather(spark, SF_SMOKE).drop("id", "station_name")
    n_w = raw_w.where(N_WEATHER).count()
    b = build_lake(spark, raw_f, raw_w, fresh_path(spark, "job"), database="stellate_job_db",
                   weather_lower_bound=FX_WEATHER_LOWER_BOUND)
    _check(spark, b, raw_f.count(), n_w)
    assert spark.table("stellate_job_db.weather_fact").count() + b.reports["weather_dropped"].count() == n_w


def test_build_lake_with_staged_copy(spark):
    raw_f = raw_fires(spark, SF_SMOKE)
    raw_w = raw_weather(spark, SF_SMOKE).drop("id", "station_name")
    n_w = raw_w.where(N_WEATHER).count()
    b = build_lake(spark, raw_f, raw_w, fresh_path(spark, "job2"), weather_lower_bound=FX_WEATHER_LOWER_BOUND,
                   stage_root=fresh_path(spark, "staged"))
    _check(spark, b, raw_f.count(), n_w)
