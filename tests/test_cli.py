import pytest
from pyspark.sql import functions as F

from stellate.__main__ import main
from stellate.plans.fixtures import FX_WEATHER_LOWER_BOUND, raw_fires, raw_weather
from stellate.session import fresh_path

from conftest import SF_SMOKE


def test_cli_builds_the_lake(spark):
    fires, csv = fresh_path(spark, "cli-fires"), fresh_path(spark, "cli-weather")
    raw_fires(spark, SF_SMOKE).withColumn("photo", F.lit(b"not asked for")).write.parquet(fires)
    raw_weather(spark, SF_SMOKE).write.option("header", True).csv(csv)
    root = fresh_path(spark, "cli-lake")
    report = main(["--fires-parquet", fires, "--weather-csv", csv, "--root", root,
                   "--database", "stellate_cli_db", "--weather-lower-bound", FX_WEATHER_LOWER_BOUND])
    counts = {r["table_name"]: r["row_count"] for r in report["row_counts"]}
    dropped = report["dropped_rows"]
    assert counts["fires_fact"] + dropped["fires_dropped"] == raw_fires(spark, SF_SMOKE).count()
    staged = spark.read.parquet(f"{root}/_staged/fires")
    assert staged.count() == raw_fires(spark, SF_SMOKE).count() and "photo" not in staged.columns
    assert all(r["orphans"] == 0 for r in report["fire_orphans"])
    assert dropped["fires_dropped"] > 0 and dropped["weather_dropped"] > 0
    assert spark.table("stellate_cli_db.dates").count() == 18263


@pytest.mark.parametrize("argv", [
    [],
    ["--weather-csv", "w.csv", "--fires-parquet", "f"],
    ["--root", "r", "--fires-parquet", "f"],
    ["--root", "r", "--weather-csv", "w.csv"],
    ["--root", "r", "--weather-csv", "w.csv", "--fires-url", "jdbc:x"],
    ["--root", "r", "--weather-csv", "w.csv", "--fires-url", "jdbc:x", "--fires-table", "t", "--fires-partition-column", "id"],
    ["--root", "r", "--weather-csv", "w.csv", "--fires-url", "jdbc:x", "--fires-table", "t", "--fires-partitions", "8"],
])
def test_cli_refuses_missing_settings(spark, argv):
    with pytest.raises(SystemExit):
        main(argv)


def test_cli_takes_settings_from_the_session(spark):
    csv = fresh_path(spark, "cli-weather")
    raw_weather(spark, SF_SMOKE).write.option("header", True).csv(csv)
    fires = fresh_path(spark, "cli-fires")
    raw_fires(spark, SF_SMOKE).write.parquet(fires)
    given = {"stellate.root": fresh_path(spark, "cli-lake"), "stellate.fires.parquet": fires, "stellate.weather.csv": csv}
    for k, v in given.items():
        spark.conf.set(k, v)
    try:
        assert {r["table_name"] for r in main([])["row_counts"]} >= {"fires_fact", "weather_fact", "dates"}
    finally:
        for k in given:
            spark.conf.unset(k)
