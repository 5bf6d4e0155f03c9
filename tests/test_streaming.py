import pytest
from pyspark.sql import functions as F

from stellate.operators.quality import duplicate_key_report, orphan_report
from stellate.plans.fixtures import FX_WEATHER_LOWER_BOUND, raw_fires, raw_weather
from stellate.plans.job import KEYS, build_lake, foreign_keys
from stellate.plans.versions import read_version
from stellate.session import fresh_path
from stellate.specs import FIRE_DIMS, FIRES_FACT, WEATHER_FACT
from stellate.streaming import FIRES, apply_batch, start_fire_refresh, start_weather_refresh

from conftest import SF_SMOKE


@pytest.fixture(autouse=True)
def plain_session(spark):
    """No write may rely on the session's overwrite mode."""
    spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    yield
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")


def _lake(spark, root, names):
    return {n: read_version(spark, root, n) for n in names}


def _check(spark, root):
    lake = _lake(spark, root, ["dates", "fires_fact", *(d.name for d in FIRE_DIMS)])
    assert all(r["orphans"] == 0 for r in orphan_report(lake["fires_fact"], foreign_keys(FIRES_FACT, lake)).collect())
    assert all(r["duplicate_keys"] == 0 for r in duplicate_key_report({t: (lake[t], KEYS[t]) for t in lake}).collect())
    for d in FIRE_DIMS:
        keys = sorted(r[0] for r in lake[d.name].select(d.key).collect())
        assert keys == list(range(len(keys)))
    return lake["fires_fact"]


def _members(spark, root):
    """Facts by id, each with the text attributes its keys lead to."""
    f = read_version(spark, root, "fires_fact")
    for d in FIRE_DIMS:
        f = f.join(read_version(spark, root, d.name), d.key)
    return {r["fire_id"]: tuple(r[a] for d in FIRE_DIMS for a in d.attrs) for r in f.collect()}


def test_streams_started_anew_lose_no_facts(spark):
    """Two streams with checkpoints of their own, both from batch id 0, over
    rows that share years."""
    raw = raw_fires(spark, SF_SMOKE)
    src, root = fresh_path(spark, "src"), fresh_path(spark, "stream-lake")
    first = {}
    for part, rows in enumerate(("OBJECTID % 2 = 0", "OBJECTID % 2 = 1")):
        raw.where(rows).write.parquet(f"{src}/part={part}")
        start_fire_refresh(spark, f"{src}/part={part}", raw.schema, root,
                           checkpoint_location=fresh_path(spark, "stream-ck")).awaitTermination()
        now = {d.name: {tuple(r) for r in read_version(spark, root, d.name).collect()} for d in FIRE_DIMS}
        assert all(first[n] <= now[n] for n in first)          # old keys unchanged
        first = now
    whole = fresh_path(spark, "whole")
    apply_batch(raw, whole, FIRES)
    assert _members(spark, root) == _members(spark, whole)
    _check(spark, root)


def test_stream_into_a_lake_that_the_job_built(spark):
    raw, weather = raw_fires(spark, SF_SMOKE), raw_weather(spark, SF_SMOKE).drop("id", "station_name")
    src, root = fresh_path(spark, "src"), fresh_path(spark, "job-lake")
    build_lake(spark, raw.where("FIRE_YEAR <= 1998"), weather, root, weather_lower_bound=FX_WEATHER_LOWER_BOUND)
    n = read_version(spark, root, "fires_fact").count()
    raw.where("FIRE_YEAR >= 1998").write.parquet(src)
    start_fire_refresh(spark, src, raw.schema, root, checkpoint_location=fresh_path(spark, "ck")).awaitTermination()
    fact = _check(spark, root)
    whole = fresh_path(spark, "whole")
    apply_batch(raw, whole, FIRES)
    assert n < fact.count() == read_version(spark, whole, "fires_fact").count()
    assert _members(spark, root) == _members(spark, whole)


def test_a_row_that_changes_its_year_is_stored_once(spark):
    raw, root = raw_fires(spark, SF_SMOKE), fresh_path(spark, "moved")
    apply_batch(raw.where("FIRE_YEAR IN (1996, 1997)"), root, FIRES)
    n = read_version(spark, root, "fires_fact").count()
    kind = raw.schema["FIRE_YEAR"].dataType
    apply_batch(raw.where("FIRE_YEAR = 1996").withColumn("FIRE_YEAR", F.lit(1999).cast(kind)), root, FIRES)
    fact = _check(spark, root)
    assert fact.count() == n and {r.year for r in fact.select("year").distinct().collect()} == {1997, 1999}


def test_weather_stream(spark):
    raw = raw_weather(spark, SF_SMOKE).drop("id", "station_name")
    src, root = fresh_path(spark, "wsrc"), fresh_path(spark, "weather-lake")
    for part, rows in enumerate(("CAST(serialid AS INT) % 3 < 2", "CAST(serialid AS INT) % 3 > 0")):
        raw.where(rows).write.parquet(f"{src}/part={part}")
        start_weather_refresh(spark, f"{src}/part={part}", raw.schema, root,
                              checkpoint_location=fresh_path(spark, "ck")).awaitTermination()
    lake = _lake(spark, root, ["dates", "weather_types", "weather_fact"])
    assert all(r["orphans"] == 0 for r in orphan_report(lake["weather_fact"], foreign_keys(WEATHER_FACT, lake)).collect())
    want = raw.where(f"try_cast(date_str AS DATE) >= DATE'{FX_WEATHER_LOWER_BOUND}' AND date_str < '2040'").count()
    assert lake["weather_fact"].count() == lake["weather_fact"].select("weather_outlier_id").distinct().count() == want
