"""Plan-shape regressions: the properties the scale design relies on."""
import re

import __spark_entry__ as E
from stellate.plans.fixtures import raw_fires
from stellate.plans.stage import stage_fires
from stellate.specs import FIRE_DIMS

from conftest import SF_SMOKE


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_star_join_is_one_broadcast_pipeline(spark):
    plan = _plan(E.queries()["fact_star"](spark, SF_SMOKE))
    assert plan.count("BroadcastHashJoin") >= 2 + len(FIRE_DIMS)     # 2 calendar roles + 7 dims
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_aggregations_combine_map_side(spark):
    plan = _plan(E.queries()["containment_by_agency"](spark, SF_SMOKE))
    assert "partial_max" in plan and "partial_count" in plan
    plan = _plan(E.queries()["geo_day_overlay"](spark, SF_SMOKE))
    assert "partial_count" in plan


def test_scans_read_only_needed_columns(spark):
    plan = _plan(E.queries()["mart_cube"](spark, SF_SMOKE))
    schema = re.search(r"ReadSchema: (struct<[^>]*>)", plan).group(1)
    assert "o_orderkey" not in schema and "o_custkey" not in schema and "o_totalprice" in schema


def test_year_filter_prunes_partitions(spark):
    plan = _plan(E.queries()["scan_year_pruned"](spark, SF_SMOKE))
    assert re.search(r"PartitionFilters: \[[^\]]*year[^\]]*= 1997", plan)


def test_dimensions_come_from_one_expand(spark):
    from pyspark.sql import functions as F
    staged = stage_fires(raw_fires(spark, SF_SMOKE))
    cols = []
    for d in FIRE_DIMS:
        cols += [a for a in d.attrs if a not in cols]
    members = staged.groupingSets([[F.col(a) for a in d.attrs] for d in FIRE_DIMS], *cols).agg(
        F.expr("count(1) AS n"))
    plan = _plan(members)
    assert plan.count("Expand") == 1 and plan.count("FileScan parquet") <= 4   # fixture tables, read once


def test_fact_write_rebalances_on_year(spark):
    from stellate.plans.lake import fact_for_write
    df = fact_for_write(E.queries()["fact_star"](spark, SF_SMOKE))
    assert re.search(r"RebalancePartitions \[year", df._jdf.queryExecution().optimizedPlan().toString())


def test_a_dimension_is_read_without_the_others(spark):
    """Every member scan is pruned to one group and to that group's columns."""
    plan = _plan(E.queries()["fact_star"](spark, SF_SMOKE))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*keyed-[^\n]*PartitionFilters: \[([^\]]*)\]", plan)
    assert len(scans) == len(FIRE_DIMS) and "ExistingRDD" not in plan.replace("Scan ExistingRDD[_pid", "")
    assert all("_gid" in filters for _, filters in scans)
    owners = [cols for cols, _ in scans if "owner_code" in cols]
    assert len(owners) == 1 and "fire_name" not in owners[0]


def test_orphan_report_reads_the_fact_once(spark):
    from stellate.operators.quality import orphan_report
    from stellate.session import fresh_path
    path = fresh_path(spark, "fact")
    spark.range(100).selectExpr("id AS a", "id % 7 AS b", "id % 5 AS c").write.parquet(path)
    dim = spark.range(50).toDF("k")
    plan = _plan(orphan_report(spark.read.parquet(path), {n: (dim, "k", n) for n in "abc"}))
    assert plan.count("FileScan parquet") == 1 and "partial_count" in plan
