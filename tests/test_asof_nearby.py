"""As-of joins and distance counts against plain versions."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from stellate.operators.asof import asof_join
from stellate.operators.nearby import within_distance


@pytest.mark.parametrize("strict", [True, False])
def test_asof(spark, strict):
    rnd = random.Random(4)
    t0 = dt.datetime(2001, 1, 1)
    when = lambda: None if rnd.random() < 0.05 else t0 + dt.timedelta(seconds=rnd.randrange(300) * 97_001)
    left = [(i, rnd.choice(["a", "b", None]), when()) for i in range(500)] + [(900 + i, "hot", t0) for i in range(50)]
    right = [(rnd.choice(["a", "b", None, "c"]), when(), rnd.randrange(1000)) for i in range(400)] + [("hot", t0, i) for i in range(50)]
    df = asof_join(spark.createDataFrame(left, "id int, g string, t timestamp_ntz"),
                   spark.createDataFrame(right, "g string, at timestamp_ntz, v int"), ["g"], "t", "at", ["v"], strict=strict, bucket_seconds=86400 * 20)
    assert df.columns == ["id", "g", "t", "last_v", "last_at"]
    want = []
    for i, g, t in left:
        own = [(at, v) for h, at, v in right if h == g and at is not None and t is not None and (at < t or not strict and at == t)]
        at, v = max(own) if own else (None, None)
        want.append((i, g, t, v, at))
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(want, key=repr)


def test_asof_of_days_and_of_nothing(spark):
    left = spark.createDataFrame([(1, dt.date(2000, 1, 5)), (2, dt.date(1999, 1, 1))], "id int, day date")
    right = spark.createDataFrame([(7, dt.date(2000, 1, 5)), (8, dt.date(2000, 1, 1))], "v int, d date")
    assert {r.id: r.last_v for r in asof_join(left, right, [], "day", "d", ["v"]).collect()} == {1: 7, 2: None}
    assert {r.id: r.last_v for r in asof_join(left, right, [], "day", "d", ["v"], strict=True).collect()} == {1: 8, 2: None}
    assert [r.last_v for r in asof_join(left, right.limit(0), [], "day", "d", ["v"]).collect()] == [None, None]
    assert asof_join(left.limit(0), right, [], "day", "d", ["v"]).count() == 0


def test_asof_has_no_theta_join(spark):
    left = spark.createDataFrame([(1, "a", dt.date(2000, 1, 5))], "id int, g string, day date")
    right = spark.createDataFrame([(7, "a", dt.date(2000, 1, 5))], "v int, g string, d date")
    plan = asof_join(left, right, ["g"], "day", "d", ["v"])._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def km(a, b):
    x = (math.sin(math.radians(b[0] - a[0]) / 2) ** 2
         + math.cos(math.radians(a[0])) * math.cos(math.radians(b[0])) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2)
    return 2 * 6371.0088 * math.asin(min(1.0, math.sqrt(x)))


@pytest.mark.parametrize("radius", [80.0, 700.0, 9000.0])
def test_within_distance(spark, radius):
    """Random places, a crowd, both poles and both sides of the date line."""
    rnd = random.Random(8)
    def place():
        kind = rnd.randrange(4)
        if kind == 0:
            return rnd.uniform(-90, 90), rnd.uniform(-180, 180)
        if kind == 1:
            return 40 + rnd.gauss(0, 2), -100 + rnd.gauss(0, 2)
        if kind == 2:
            return rnd.choice([-1, 1]) * rnd.uniform(85, 90), rnd.uniform(-180, 180)
        return rnd.uniform(-5, 5), rnd.choice([-1, 1]) * rnd.uniform(175, 180)
    fires = [(*place(), rnd.choice("ab")) for _ in range(150)] + [(90.0, 0.0, "a"), (-90.0, 10.0, "a"), (0.0, 180.0, "a"), (0.0, -180.0, "b")]
    points = [(*place(), rnd.choice("abc")) for _ in range(400)] + [(40.0, -100.0, "a")] * 60 + [(90.0, 77.0, "a"), (0.0, 180.0, "b"), (0.0, -180.0, "a")]
    odd = [(None, 1.0, "a"), (91.0, 1.0, "a"), (1.0, None, "b"), (float("nan"), 1.0, "a"), (1.0, float("nan"), "a"), (1.0, 1.0, None)]
    kind = "lat double, lon double, k string"
    got = {(r.lat, r.lon, r.k): r.n for r in within_distance(
        spark.createDataFrame(fires + odd, kind), spark.createDataFrame(points + odd, kind), ["k"], radius, levels=4).collect()}
    want = {f: sum(p[2] == f[2] and km(f, p) <= radius for p in points) for f in fires}
    # the odd point (1, 1) has no key; all others are no places
    assert got == {f: n for f, n in want.items() if n}


def test_a_crowd_is_counted_by_nodes(spark):
    """Places well inside a crowd's circle meet nodes, not all its pairs."""
    points = spark.createDataFrame([(40 + (i % 141) / 300, -100 + (i // 141) / 300, 1) for i in range(20_000)], "lat double, lon double, k int")
    places = spark.createDataFrame([(40 + i / 100, -99.9, 1) for i in range(20)], "lat double, lon double, k int")
    rounds = []
    def store(df):
        out = df.checkpoint(eager=True)
        rounds.append(out.count())
        return out
    got = within_distance(places, points, ["k"], 500.0, store=store).collect()
    assert len(got) == 20 and all(r.n == 20_000 for r in got)
    assert sum(rounds[1:]) < 400      # the cells around, no pairs
