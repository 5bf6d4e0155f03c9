"""Benchmark of the headline queries.

Runs each query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] (default 8): one warm-up, then the median of
$BENCH_REPEAT runs (default 3). Each run executes the whole plan through a
``noop`` write (every row computed, nothing collected to the driver). The
lake that the quality reports read is built once and timed apart
(``lake_build``). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from stellate.operators.keys import dense_key, dense_key_single_task  # noqa: E402
from stellate.plans.registry import QUERIES, null_keys_of, orphans_of, stored_lake  # noqa: E402
from stellate.session import build_session  # noqa: E402
from stellate.sources.readers import read_table  # noqa: E402

HEADLINE = ("fact_star", "dim_build", "surrogate_key", "lake_build", "dq_null_keys", "dq_orphans", "mart_cube", "fact_events",
            "containment_by_agency", "geo_day_overlay")
FURTHER = ("fire_asof", "geo_distance_overlay", "join_shuffle")   # not in the total


def surrogate_key_single(spark, sf_dir):
    """Baseline: the reference's single-task key (one partition, global sort)."""
    part = read_table(spark, sf_dir, "part")
    members = part.select(F.expr("nullif(p_brand, 'Brand#13')").alias("a"),
                          F.expr("nullif(p_type, 'ECONOMY')").alias("b"),
                          F.col("p_size").alias("s")).distinct()
    return dense_key_single_task(members, ["a", "b", "s"], "id")


def _lines(spark, sf_dir):
    """About as many members as rows: the order lines' keys and dates."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select("l_partkey", "l_suppkey", "l_orderkey", "l_shipdate").distinct()


def many_keys(spark, sf_dir):
    return dense_key(_lines(spark, sf_dir), ["l_partkey", "l_suppkey", "l_orderkey", "l_shipdate"], "id")


def many_keys_single(spark, sf_dir):
    return dense_key_single_task(_lines(spark, sf_dir), ["l_partkey", "l_suppkey", "l_orderkey", "l_shipdate"], "id")


def run_once(spark, fn, sf_dir) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session(f"local[{cpus}]", app="stellate-bench", shuffle_partitions=2 * cpus,
                          extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    lake: dict = {}

    def lake_build(spark, sf_dir):
        lake.update(stored_lake(spark, sf_dir))
        return lake["dates"]

    on_lake = {"lake_build": lake_build, "dq_null_keys": lambda spark, sf_dir: null_keys_of(lake), "dq_orphans": lambda spark, sf_dir: orphans_of(lake)}
    todo = {k: on_lake.get(k) or QUERIES[k] for k in HEADLINE}
    todo["surrogate_key_single_task"] = surrogate_key_single   # baseline, not in the total
    todo["many_keys"] = many_keys                              # where the parallel form pays, not in the total
    todo["many_keys_single_task"] = many_keys_single
    todo.update({k: QUERIES[k] for k in FURTHER})
    times = {}
    for name, fn in todo.items():
        run_once(spark, fn, sf_dir)   # warm-up
        times[name] = round(statistics.median(run_once(spark, fn, sf_dir) for _ in range(repeat)), 3)
    total = round(sum(v for k, v in times.items() if k in HEADLINE), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": total, "unit": "sec", "queries": times,
                      "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf, "cpus": cpus,
                      "repeat": repeat, "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
