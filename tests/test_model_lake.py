import os

from pyspark.sql import functions as F

from stellate.operators.facts import calendar_misses
from stellate.operators.quality import (duplicate_key_report, null_key_report, null_profile,
                                        orphan_report, schema_profile)
from stellate.plans.fixtures import raw_fires
from stellate.plans.lake import publish, write_fact, write_tables
from stellate.plans.model import fire_model
from stellate.session import fresh_path, local_path
from stellate.specs import CALENDAR_END, CALENDAR_START, DATES_KEY, FIRE_DIMS, FIRES_FACT

from conftest import SF_SMOKE


def _model(spark):
    return fire_model(spark, raw_fires(spark, SF_SMOKE))


def test_star_invariants(spark):
    m = _model(spark)
    staged_n = m.staged.count()
    fact_n = m.fact.count()
    dropped = calendar_misses(m.staged, FIRES_FACT, CALENDAR_START, CALENDAR_END).count()
    assert fact_n + dropped == staged_n and dropped > 0
    tables = m.tables()
    keys = {d.name: d.key for d in FIRE_DIMS}
    keys["dates"] = DATES_KEY
    for name, key in keys.items():
        t = tables[name]
        n = t.count()
        stats = t.agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.countDistinct(key).alias("d")).first()
        base = 1 if name == "dates" else 0
        assert (stats["lo"], stats["hi"], stats["d"]) == (base, n - 1 + base, n), name
    assert all(r["duplicate_keys"] == 0 for r in duplicate_key_report(
        {k: (tables[k], v) for k, v in keys.items()}).collect())
    assert all(r["null_keys"] == 0 for r in null_key_report(
        {k: (tables[k], v) for k, v in keys.items()}).collect())
    fks = {d.name: (tables[d.name], d.key, d.key) for d in FIRE_DIMS}
    fks["disc"] = (tables["dates"], DATES_KEY, "discovery_date_id")
    fks["cont"] = (tables["dates"], DATES_KEY, "cont_date_id")
    assert all(r["orphans"] == 0 for r in orphan_report(m.fact, fks).collect())


def test_build_is_deterministic_across_partitionings(spark):
    a = {tuple(r) for r in _model(spark).fact.collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        b = {tuple(r) for r in _model(spark).fact.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert a == b


def test_out_of_calendar_rows_are_counted(spark):
    m = _model(spark)
    narrow_end = "1996-01-01"
    misses = calendar_misses(m.staged, FIRES_FACT, CALENDAR_START, narrow_end).count()
    short = fire_model(spark, raw_fires(spark, SF_SMOKE), start=CALENDAR_START, end=narrow_end)
    assert 0 < misses < m.staged.count()
    assert short.fact.count() + misses == m.staged.count()


def test_write_publish_and_prune(spark):
    m = _model(spark)
    tables = m.tables()
    root = fresh_path(spark, "lake")
    paths = write_tables(tables, root)
    years = sorted(p for p in os.listdir(local_path(paths["fires_fact"])) if p.startswith("year="))
    assert years and all(p.startswith("year=") for p in years)
    publish(spark, "stellate_test_db", paths, root + "/_catalog")
    assert spark.table("stellate_test_db.fires_fact").count() == m.fact.count()
    assert spark.table("stellate_test_db.locations").count() == tables["locations"].count()
    pruned = spark.table("stellate_test_db.fires_fact").filter(F.col("year") == 1997)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "= 1997" in plan
    # re-run of one year: dynamic overwrite replaces 1997 only
    before = spark.read.parquet(paths["fires_fact"]).count()
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")   # the write asks for what it needs
    write_fact(m.fact.filter(F.col("year") == 1997), paths["fires_fact"])
    assert spark.read.parquet(paths["fires_fact"]).count() == before
    n97 = m.fact.filter(F.col("year") == 1997).count()
    write_fact(m.fact.filter(F.col("year") == 1997).limit(1), paths["fires_fact"])
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    assert spark.read.parquet(paths["fires_fact"]).count() == before - n97 + 1


def test_orphans_and_duplicates_are_found(spark):
    fact = spark.createDataFrame([(1, 10, 5), (2, 11, 5), (3, None, 6), (3, 10, 7)], "id long, a long, b int")
    dim_a = spark.createDataFrame([(10,)], "k long")
    dim_b = spark.createDataFrame([(5,), (6,), (6,), (7,)], "k int")
    out = {r.dimension: r.orphans for r in orphan_report(fact, {"a": (dim_a, "k", "a"), "b": (dim_b, "k", "b")}).collect()}
    assert out == {"a": 2, "b": 0}
    assert {r.dimension: r.orphans for r in orphan_report(fact.limit(0), {"a": (dim_a, "k", "a")}).collect()} == {"a": 0}
    dup = {r.table_name: r.duplicate_keys for r in duplicate_key_report({"f": (fact, "id"), "b": (dim_b, "k"), "a": (dim_a, "k")}).collect()}
    assert dup == {"f": 1, "b": 1, "a": 0}


def test_profiles_one_pass(spark):
    df = spark.createDataFrame([(1, None, 2.0), (None, None, 3.0), (3, "x", None)], "a int, b string, c double")
    prof = {r["column_name"]: r["countna"] for r in null_profile(df).collect()}
    assert prof == {"a": 1, "b": 2, "c": 1}
    sch = {r["column_name"]: (r["data_type"], r["countna"]) for r in schema_profile(df).collect()}
    assert sch == {"a": ("int", 1), "b": ("string", 2), "c": ("double", 1)}
