"""Steps whose cost is to follow the rows: staging, newest rows, small files."""

import datetime as dt
import re

from pyspark.sql import functions as F

from stellate.operators import layout as L
from stellate.plans import upkeep as U
from stellate.plans import versions as V
from stellate.plans.fixtures import raw_fires
from stellate.plans.stage import stage_fires
from stellate.session import fresh_path
from stellate.specs import FIRES_FACT
from stellate.streaming import FIRES
from stellate.streaming import newest as N

from conftest import SF_SMOKE


def test_many_small_files_need_few_tasks(spark, monkeypatch):
    monkeypatch.setattr(L, "MIN_TASKS", 4)
    monkeypatch.setattr(L, "ROWS_PER_TASK", 1000)
    df, path = spark.range(4000).selectExpr("id", "CAST(id % 63 AS DOUBLE) AS x", "CAST(id % 65 AS DOUBLE) AS y"), fresh_path(spark, "clustered")
    L.write_clustered(df, path, ["x", "y"], rows_per_file=50)
    index = spark.read.parquet(path + L.INDEX).collect()
    assert sum(r.n for r in index) == 4000 and max(r.n for r in index) <= 50
    assert len({re.search(r"part-(\d+)", r.file).group(1) for r in index}) <= 4 < 80 <= len(index)
    assert L.read_clustered(spark, path, df.schema, {"x": (5, 9), "y": (None, 7)}).count() == df.where("x BETWEEN 5 AND 9 AND y <= 7").count()


def test_rows_are_staged_once(spark, monkeypatch):
    seen, modelled = [], U._modelled

    def noted(change, staged, spec, batch):
        seen.extend(staged.inputFiles())
        return modelled(change, staged, spec, batch)

    monkeypatch.setattr(U, "_modelled", noted)
    staged = stage_fires(raw_fires(spark, SF_SMOKE))
    for work in (U.apply_staged, U.replace_years):
        V.commit_with(spark, fresh_path(spark, "lake"), lambda c, f=work: f(c, staged, FIRES_FACT))
    assert seen and all("/staged-" in f for f in seen)


def test_newest_rows_are_shuffled_as_staged_rows(spark):
    raw = raw_fires(spark, SF_SMOKE).where("OBJECTID % 50 = 0")
    kind = raw.schema["FIRE_SIZE"].dataType
    at = lambda day, plus: raw.withColumn("FIRE_SIZE", (F.col("FIRE_SIZE") + plus).cast(kind)).withColumn("SEEN_AT", F.lit(dt.datetime(2020, 1, day)))
    path, tied = fresh_path(spark, "src"), fresh_path(spark, "src")
    at(1, 1).unionByName(at(2, 2)).write.parquet(path)
    at(1, 1).unionByName(at(2, 2)).unionByName(at(2, 3)).unionByName(at(2, 3)).write.parquet(tied)
    for folder, plus, n in ((path, 2, 1), (tied, 3, 3)):
        batch = spark.read.parquet(folder)
        newer = N.newer_times(V.Change(spark, fresh_path(spark, "lake")), batch, "t", "OBJECTID", "SEEN_AT")
        assert {(r.newest.day, r.n) for r in newer.collect()} == {(2, n)}
        rows = N.newer_rows(batch, newer, FIRES, "OBJECTID", "SEEN_AT")
        if n == 1:
            assert "SortAggregate" not in rows._jdf.queryExecution().executedPlan().toString()
        want = stage_fires(raw.withColumn("FIRE_SIZE", (F.col("FIRE_SIZE") + plus).cast(kind)))
        assert rows.columns == want.columns
        assert sorted(map(repr, rows.collect())) == sorted(map(repr, want.collect()))
