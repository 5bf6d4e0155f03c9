import contextlib
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from stellate.operators.dims import build_dim, build_dims_with_stats
from stellate.operators.joins import fits_broadcast, null_safe_join, side_bytes
from stellate.plans.stage import stage_fires, stage_weather
from stellate.specs import DimSpec

SPEC = DimSpec("names", "name_id", ("name", "code"))


def _skewed_fact(spark, n=3000):
    # a third of all rows share one member (NULL name, NULL code)
    rows = []
    for i in range(n):
        if i % 3 == 0:
            rows.append((i, None, None))
        else:
            rows.append((i, f"n{i % 97}", None if i % 5 == 0 else f"c{i % 7}"))
    return spark.createDataFrame(rows, "id long, name string, code string")


def _pairs(df):
    return {(r["id"], r["name_id"]) for r in df.select("id", "name_id").collect()}


def test_null_safe_join_strategies_agree(spark):
    fact = _skewed_fact(spark)
    dims, stats = build_dims_with_stats(fact, [SPEC])
    dim = dims["names"]
    results = {}
    for strat in ("broadcast", "shuffle", "salted", "auto"):
        out = null_safe_join(fact, dim, SPEC.attrs, SPEC.key, strategy=strat, salt_cols=["id"],
                             stats=stats["names"])
        results[strat] = _pairs(out)
        assert len(results[strat]) == 3000, strat
    assert results["broadcast"] == results["shuffle"] == results["salted"] == results["auto"]
    null_member = dim.filter(F.col("name").isNull() & F.col("code").isNull()).first()
    assert all(k == null_member["name_id"] for i, k in results["salted"] if i % 3 == 0)


def test_salted_join_spreads_the_hot_member(spark):
    with _shuffled_joins(spark):
        _check_spread(spark)


@contextlib.contextmanager
def _shuffled_joins(spark):
    """Neither merged partitions nor joins that turn to broadcasts at runtime."""
    fixed = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    for k, v in fixed.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in fixed:
            spark.conf.unset(k)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def _check_spread(spark):
    fact = _skewed_fact(spark)
    dims, stats = build_dims_with_stats(fact, [SPEC])
    out = null_safe_join(fact, dims["names"], SPEC.attrs, SPEC.key, strategy="salted", salt_cols=["id"],
                         stats=stats["names"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    # the hot member's 1000 rows land in several shuffle partitions
    parts = (out.filter(F.col("id") % 3 == 0)
                .select(F.spark_partition_id().alias("p")).distinct().count())
    assert parts > 1


def test_size_check_refuses_broadcast(spark):
    df = spark.range(1000)
    assert fits_broadcast(df)
    spark.conf.set("stellate.broadcast.maxBytes", "1024")
    try:
        assert not fits_broadcast(df)
        fact = _skewed_fact(spark, 300)
        dim = build_dim(fact, SPEC)
        out = null_safe_join(fact, dim, SPEC.attrs, SPEC.key)
        assert out.count() == 300
    finally:
        spark.conf.unset("stellate.broadcast.maxBytes")


def test_wide_text_is_measured_and_refused(spark):
    """2,000 rows of 4 KB are 8 MB, whatever a guess by type would say."""
    wide = spark.range(2000).selectExpr("id", "repeat('x', 4096) AS name")
    assert side_bytes(wide) > 2000 * 4096
    spark.conf.set("stellate.broadcast.maxBytes", str(1 << 20))
    try:
        assert not fits_broadcast(wide) and fits_broadcast(wide.select("id"))
        dim = wide.selectExpr("id AS k", "concat(name, id) AS name")
        fact = dim.selectExpr("name", "k AS id").union(dim.limit(1).selectExpr("name", "k AS id"))
        out = null_safe_join(fact, dim, ("name",), "k", strategy="broadcast")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
        assert out.count() == 2001
    finally:
        spark.conf.unset("stellate.broadcast.maxBytes")


def test_dimension_without_counts_is_salted(spark):
    """A dimension read back has no member counts: they are taken from the
    fact, and the hot member's rows still spread."""
    fact = _skewed_fact(spark)
    dim = build_dim(fact, SPEC).drop("_rows")
    spark.conf.set("stellate.broadcast.maxBytes", "64")
    try:
        with _shuffled_joins(spark):
            out = null_safe_join(fact, dim, SPEC.attrs, SPEC.key, salt_cols=["id"])
            parts = out.filter(F.col("id") % 3 == 0).select(F.spark_partition_id().alias("p")).distinct().count()
            got = _pairs(out)
    finally:
        spark.conf.unset("stellate.broadcast.maxBytes")
    assert parts > 1 and len(got) == 3000
    assert got == _pairs(null_safe_join(fact, dim, SPEC.attrs, SPEC.key, strategy="shuffle"))


def _raw(spark, rows):
    schema = ("OBJECTID long, FIRE_YEAR decimal(38,18), DISCOVERY_DATE decimal(38,18), DISCOVERY_DOY decimal(38,18), "
              "DISCOVERY_TIME string, CONT_DATE decimal(38,18), CONT_DOY decimal(38,18), CONT_TIME string, "
              "FIRE_SIZE decimal(38,18), LATITUDE decimal(38,18), LONGITUDE decimal(38,18), STATE string")
    return spark.createDataFrame(rows, schema)


def test_stage_fires_edge_rows(spark):
    d = Decimal
    jd92 = d("2448622.5")                                       # 1992-01-01
    rows = [
        (1, d(1992), jd92, d(1), "1305", None, None, None, d("12.345"), d("45.123456789"), d("-120.12345678"), "CA"),
        (2, d(1992), jd92, d(1), None, jd92, d(1), "905", d("0.004"), d("1"), d("-1"), None),
        (3, d(1992), jd92, d(1), "2400", jd92, d(1), "5", d("123456789.99"), d("1"), d("-1"), "OR"),
        (4, d(1992), jd92, d(1), "130559", jd92, d(1), "", d("1"), d("1"), d("-1"), "WA"),
    ]
    st = {r["objectid"]: r for r in stage_fires(_raw(spark, rows)).collect()}
    cols = stage_fires(_raw(spark, rows)).columns
    assert "discovery_date" not in cols and "cont_doy" not in cols and "state" in cols
    assert st[1]["discovery_timestamp"] == dt.datetime(1992, 1, 1, 13, 5)
    assert st[1]["cont_timestamp"] is None                       # NULL containment date
    assert st[1]["fire_size"] == d("12.35")                      # HALF_UP to (10,2)
    assert st[1]["latitude"] == d("45.12345679") and st[1]["longitude"] == d("-120.12345678")
    assert st[2]["discovery_timestamp"] == dt.datetime(1992, 1, 1, 0, 0)   # NULL time -> 0000
    assert st[2]["cont_timestamp"] is None                       # "905" is no clock time
    assert st[3]["discovery_timestamp"] is None and st[3]["cont_timestamp"] == dt.datetime(1992, 1, 1, 5, 0)
    assert st[3]["fire_size"] is None                            # overflow of (10,2) -> NULL, no failure
    assert st[4]["discovery_timestamp"] is None and st[4]["cont_timestamp"] is None
    assert st[1]["fire_year"] == 1992


def test_stage_weather_bounds(spark):
    raw = spark.createDataFrame([("1", "1991-12-31"), ("2", "1992-01-01"), ("3", None), ("4", "bad text"),
                                 ("5", "2013-06-30")], "serialid string, date_str string")
    out = stage_weather(raw)
    assert dict(out.dtypes)["date_str"] == "date"
    assert sorted(r["serialid"] for r in out.collect()) == ["2", "5"]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" in plan


def test_broadcast_budget_moves_dims_to_shuffle(spark):
    from stellate.operators.dims import build_dates
    from stellate.operators.facts import build_fact
    from stellate.specs import FactSpec, RoleSpec
    rows = [(i, f"a{i % 5}", f"b{i % 300}", "2001-02-03") for i in range(900)]
    staged = spark.createDataFrame(rows, "id long, a string, b string, d string")
    da, db = DimSpec("da", "a_id", ("a",)), DimSpec("db", "b_id", ("b",))
    spec = FactSpec("f", (RoleSpec("d_", "d", "d_id"),), (da, db),
                    (("id", "id"), ("a_id", "a_id"), ("b_id", "b_id"), ("d_id", "d_id")), row_id=("id",))
    dims, stats = build_dims_with_stats(staged, [da, db])
    dates = build_dates(spark)
    want = {tuple(r) for r in build_fact(staged, spec, dims, dates, stats=stats).collect()}
    spark.conf.set("stellate.broadcast.totalBytes", "2000")   # fits da only
    try:
        f = build_fact(staged, spec, dims, dates, stats=stats)
        plan = f._jdf.queryExecution().executedPlan().toString()
        got = {tuple(r) for r in f.collect()}
    finally:
        spark.conf.unset("stellate.broadcast.totalBytes")
    assert got == want and len(got) == 900
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
