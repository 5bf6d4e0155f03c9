"""Run the batch job from the command line (or spark-submit):

    spark-submit -m stellate --fires-url jdbc:... --fires-table Fires \\
        --fires-partition-column OBJECTID --fires-lower 1 --fires-upper 1880465 \\
        --fires-partitions 64 --weather-csv s3a://bucket/weather.csv \\
        --root s3a://bucket/lake --database wildfires

Every option can also come from the session as ``stellate.<option>`` (for a
properties file passed to spark-submit), e.g. ``stellate.root``. The staged
copy of the sources goes to ``--stage-root``, or below the root: JDBC and CSV
sources are read once, however many passes follow.
"""

from __future__ import annotations

import argparse
import json

from .plans.job import build_lake
from .session import build_session
from .sources.readers import read_csv, read_jdbc, select_query
from .specs import FIRE_SOURCE_COLS, WEATHER_DROP_COLS, WEATHER_LOWER_BOUND

_OPTS = ("fires-parquet", "fires-url", "fires-table", "fires-driver", "fires-partition-column", "fires-lower",
         "fires-upper", "fires-partitions", "weather-csv", "root", "database", "stage-root",
         "weather-lower-bound")


def main(argv: list[str] | None = None) -> dict:
    p = argparse.ArgumentParser(prog="stellate", description="build the star-schema lake, or bring it up to date")
    for o in _OPTS:
        p.add_argument(f"--{o}")
    args = vars(p.parse_args(argv))
    spark = build_session(app="stellate-build")

    def opt(name: str, default=None):
        v = args.get(name.replace("-", "_"))
        if v is None:
            v = spark.conf.get(f"stellate.{name.replace('-', '.')}", None)
        return default if v is None else v

    def need(*names: str) -> None:
        missing = [n for n in names if opt(n) is None]
        if missing:
            p.error("missing: " + ", ".join(f"--{n}" for n in missing))

    need("root", "weather-csv")
    if opt("fires-parquet"):
        fires = spark.read.parquet(opt("fires-parquet"))
        fires = fires.select(*[c for c in FIRE_SOURCE_COLS if c in fires.columns])
    else:
        need("fires-url", "fires-table")
        split = {}
        if any(opt(f"fires-{n}") is not None for n in ("partition-column", "lower", "upper", "partitions")):
            need("fires-partition-column", "fires-lower", "fires-upper", "fires-partitions")
            split = {"partition_column": opt("fires-partition-column"), "lower": int(opt("fires-lower")),
                     "upper": int(opt("fires-upper")), "partitions": int(opt("fires-partitions"))}
        fires = read_jdbc(spark, opt("fires-url"), select_query(opt("fires-table"), FIRE_SOURCE_COLS, "fires"),
                          driver=opt("fires-driver"), **split)
    weather = read_csv(spark, opt("weather-csv"), drop=WEATHER_DROP_COLS)
    build = build_lake(spark, fires, weather, opt("root"), database=opt("database"),
                       weather_lower_bound=opt("weather-lower-bound", WEATHER_LOWER_BOUND),
                       stage_root=opt("stage-root", f"{opt('root').rstrip('/')}/_staged"))
    report = {name: [r.asDict() for r in df.collect()] for name, df in build.reports.items()
              if not name.endswith("_dropped")}
    report["dropped_rows"] = {n: build.reports[n].count() for n in ("fires_dropped", "weather_dropped")}
    print(json.dumps(report, default=str))
    return report


if __name__ == "__main__":
    main()
