import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stellate.operators.layout import INDEX, read_clustered, write_clustered
from stellate.plans.cells import CellMart
from stellate.plans.versions import Change, commit_with, read_lake
from stellate.session import fresh_path
from stellate.sources.readers import even_ranges, read_jdbc_ranges


def test_only_files_of_the_box_are_read(spark):
    rnd = random.Random(3)
    data = [(i, rnd.uniform(-90, 90), rnd.uniform(-180, 180), dt.date(2000, 1, 1) + dt.timedelta(days=rnd.randrange(3000))) for i in range(4000)]
    data += [(5000 + i, None, None, None) for i in range(50)] + [(6000 + i, 1.0, 2.0, dt.date(2001, 1, 1)) for i in range(900)]
    df, path = spark.createDataFrame(data, "id int, lat double, lon double, day date"), fresh_path(spark, "clustered")
    write_clustered(df, path, ["lat", "lon", "day"], rows_per_file=150)
    files = spark.read.parquet(path + INDEX).count()
    assert 20 <= files <= 40 and spark.read.parquet(path).count() == len(data)
    box = {"lat": (10, 35), "lon": (-60, -20), "day": (dt.date(2002, 1, 1), None)}
    got = read_clustered(spark, path, df.schema, box)
    assert {r.id for r in got.collect()} == {i for i, a, o, d in data if a is not None and 10 <= a <= 35 and -60 <= o <= -20 and d >= dt.date(2002, 1, 1)}
    assert len(got.inputFiles()) < files / 3
    assert read_clustered(spark, path, df.schema, {"lat": (95, None)}).count() == 0
    with pytest.raises(ValueError):
        write_clustered(df, path + "-x", ["lat", "lon", "day", "id"])


def test_ranges_are_even_disjoint_and_whole(spark):
    rnd = random.Random(2)
    keys = [rnd.randrange(1000) if rnd.random() < 0.7 else rnd.randrange(10 ** 12) for _ in range(5000)] + [None] * 40
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    ranges = even_ranges(df, "k", 10)
    sizes = [df.where(r).count() for r in ranges]
    assert len(ranges) == 10 and sum(sizes) == len(keys)
    assert max(sizes) <= 1.2 * len(keys) / 10 and min(sizes) >= 0.8 * len(keys) / 10
    assert even_ranges(df.limit(0), "k", 10) == ["1 = 1"] == even_ranges(df, "k", 1)
    days = spark.createDataFrame([(dt.date(2000, 1, i),) for i in range(1, 29)] + [(None,)], "k date")
    assert [days.where(r).count() for r in even_ranges(days, "k", 4)] == [8, 7, 7, 7]
    with pytest.raises(ValueError):
        even_ranges(spark.createDataFrame([("a",)], "k string"), "k", 2)
    with pytest.raises(ValueError):
        even_ranges(df, "k", 0)
    assert read_jdbc_ranges.__doc__


def test_cells_follow_signed_rows(spark):
    """Random batches of insertions and deletions, with null dimensions, ties
    of the largest value, cells that vanish, and null members."""
    rnd, root = random.Random(9), fresh_path(spark, "cells")
    mart = CellMart("m", ("a", "b"), "v", "k")
    kind = "id int, a string, b int, v decimal(10,2), k bigint"
    make = lambda i: (i, rnd.choice(["x", "y", None]), rnd.choice([1, None]), rnd.choice([None, rnd.randrange(5)]), rnd.choice([None, rnd.randrange(70_000)]))
    rows = {i: make(i) for i in range(60)}
    frame = lambda data: spark.createDataFrame([(i, a, b, None if v is None else Decimal(v), k) for i, a, b, v, k in data], kind)
    commit_with(spark, root, lambda c: mart.build(c, frame(rows.values())))
    for step in range(3):
        gone = rnd.sample(sorted(rows), 15 if step < 2 else len(rows) - 3)
        fresh = [make(1000 * (step + 1) + i) for i in range(12)]
        signed = frame([rows[i] for i in gone]).withColumn("sign", F.lit(-1)).unionByName(frame(fresh).withColumn("sign", F.lit(1)))
        rows = {i: r for i, r in rows.items() if i not in gone} | {r[0]: r for r in fresh}
        commit_with(spark, root, lambda c: mart.apply(c, signed, frame(rows.values())))
        lake = read_lake(spark, root)
        got = sorted(map(tuple, mart.cube(lake["m"], lake["m_members"]).collect()), key=repr)
        want = frame(rows.values()).cube("a", "b").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("v"), F.lit(0)).cast("decimal(28,2)").alias("total"), F.max("v").alias("largest"),
                                                       F.countDistinct("k").alias("members"), F.grouping_id().cast("int").alias("gid"))
        assert got == sorted(map(tuple, want.collect()), key=repr)
    assert Change(spark, root).base.number == 4
