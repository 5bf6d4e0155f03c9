"""Versioned lakes: commits that happen whole or not at all, merges, and what
a batch does to several tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stellate.operators.dims import build_dates
from stellate.plans import versions as V
from stellate.plans.evolve import Narrowing, append_evolving, reconcile, wider
from stellate.plans.fixtures import raw_fires
from stellate.plans.stage import stage_fires
from stellate.plans.upkeep import apply_staged, extend_dates, merge_fact, refresh_dates, refresh_dimensions, replay_quarantine
from stellate.session import fresh_path
from stellate.specs import FIRE_DIMS, FIRES_FACT
from stellate.streaming import FIRES, apply_batch

from conftest import SF_SMOKE

KIND = "id bigint, v string, year int"


def rows(spark, *data):
    return spark.createDataFrame(list(data), KIND)


def stored(spark, root, name="t", at=None):
    df = V.read_version(spark, root, name, at)
    return None if df is None else sorted(map(tuple, df.collect()), key=repr)


def put(spark, root, df, name="t"):
    return V.commit_with(spark, root, lambda c: merge_fact(c, df, name, "id"))


def test_put_if_absent(spark):
    folder = fresh_path(spark, "put")
    assert V.put_if_absent(spark, f"{folder}/1.json", "first")
    assert not V.put_if_absent(spark, f"{folder}/1.json", "second")
    assert V._read_text(spark, f"{folder}/1.json") == "first"
    assert [n for n, _, _ in V._names(spark, folder) if not n.endswith(".crc")] == ["1.json"]


def test_readers_keep_their_version(spark):
    root = fresh_path(spark, "lake")
    assert V.version(spark, root).number == 0 and stored(spark, root) is None
    one = put(spark, root, rows(spark, (1, "a", 1990), (2, "b", 1991)))
    held = V.read_version(spark, root, "t", one)
    two = put(spark, root, rows(spark, (1, "z", 1992), (3, "c", None)))
    assert sorted(map(tuple, held.collect())) == [(1, "a", 1990), (2, "b", 1991)]
    assert stored(spark, root) == [(1, "z", 1992), (2, "b", 1991), (3, "c", None)]
    assert stored(spark, root, at=V.version(spark, root, one.number)) == [(1, "a", 1990), (2, "b", 1991)]
    assert (one.number, two.number) == (1, 2) and V.history(spark, root) == [1, 2]
    assert set(two.tables["t"].parts) == {"1991", "1992", V.NULL_PARTITION}     # 1990 lost its only row


def test_a_merge_that_stops_before_its_commit_changes_nothing(spark):
    root = fresh_path(spark, "lake")
    put(spark, root, rows(spark, (1, "a", 1990), (2, "b", 1990)))
    before = stored(spark, root)
    change = V.Change(spark, root)
    merge_fact(change, rows(spark, (1, "lost", 1990)), "t", "id")      # its driver dies here
    assert stored(spark, root) == before
    put(spark, root, rows(spark, (1, "again", 1990)))                  # the batch is sent again
    assert stored(spark, root) == [(1, "again", 1990), (2, "b", 1990)]
    used = V.version(spark, root).folders()
    assert V.vacuum(spark, root, keep=1, older_than=3600.0) == []      # it may still be at work
    gone = V.vacuum(spark, root, keep=1, older_than=-1.0)
    assert len(gone) == 2 and not any(f in u for f in gone for u in used)
    assert stored(spark, root) == [(1, "again", 1990), (2, "b", 1990)] and V.history(spark, root) == [2]


def test_the_second_of_two_writers_does_its_work_again(spark):
    root = fresh_path(spark, "lake")
    put(spark, root, rows(spark, (1, "a", 1990)))
    slow = V.Change(spark, root)
    merge_fact(slow, rows(spark, (2, "b", 1990)), "t", "id")
    put(spark, root, rows(spark, (3, "c", 1990)))
    with pytest.raises(V.Conflict):
        slow.commit()
    tries = []

    def work(change):
        tries.append(change.base.number)
        if len(tries) == 1:
            put(spark, root, rows(spark, (4, "d", 1991)))
        merge_fact(change, rows(spark, (2, "b", 1990)), "t", "id")

    V.commit_with(spark, root, work)
    assert tries == [2, 3] and [r[0] for r in stored(spark, root)] == [1, 2, 3, 4]


def test_writers_of_different_tables_do_not_wait(spark):
    root = fresh_path(spark, "lake")
    a, b = V.Change(spark, root), V.Change(spark, root)
    merge_fact(a, rows(spark, (1, "a", 1990)), "ta", "id")
    merge_fact(b, rows(spark, (2, "b", 1990)), "tb", "id")
    a.commit()
    b.commit()
    assert stored(spark, root, "ta") == [(1, "a", 1990)] and stored(spark, root, "tb") == [(2, "b", 1990)]


def test_rows_without_an_id(spark):
    root = fresh_path(spark, "lake")
    put(spark, root, rows(spark, (1, "a", 1990), (None, "x", 1990)))
    only = rows(spark, (None, "y", 1990), (None, "y", 1990), (None, None, None))
    for _ in range(2):      # a batch of null ids is kept, and the same when it is sent again
        put(spark, root, only)
    want = sorted([(1, "a", 1990), (None, "x", 1990), (None, "y", 1990), (None, "y", 1990), (None, None, None)], key=repr)
    assert stored(spark, root) == want
    put(spark, root, rows(spark))
    assert stored(spark, root) == want


def test_ids_that_leave_a_fact(spark):
    root = fresh_path(spark, "lake")
    put(spark, root, rows(spark, (1, "a", 1990), (2, "b", 1991), (3, "c", 1991)))
    V.commit_with(spark, root, lambda c: merge_fact(c, rows(spark), "t", "id", ids=rows(spark, (2, "", 0), (1, "", 0), (None, "", 0)).select("id")))
    assert stored(spark, root) == [(3, "c", 1991)] and set(V.version(spark, root).tables["t"].parts) == {"1991"}


def test_dimensions_are_refreshed_in_one_pass(spark):
    staged, root = stage_fires(raw_fires(spark, SF_SMOKE)), fresh_path(spark, "lake")
    staged.where("fire_year < 1997").write.parquet(f"{root}-a")
    staged.write.parquet(f"{root}-b")
    V.commit_with(spark, root, lambda c: refresh_dimensions(c, spark.read.parquet(f"{root}-a"), FIRE_DIMS))
    scans = []
    one = spark.read.parquet(f"{root}-b")
    from stellate.operators import dims as D
    seen = D.dense_key_with_stats

    def counted(members, *args, **kwargs):
        scans.append(members._jdf.queryExecution().executedPlan().toString())
        return seen(members, *args, **kwargs)

    D.dense_key_with_stats = counted
    try:
        V.commit_with(spark, root, lambda c: refresh_dimensions(c, one, FIRE_DIMS))
    finally:
        D.dense_key_with_stats = seen
    assert len(scans) == 1 and scans[0].count(f"{root.rsplit('/', 1)[1]}-b") == 1 and "Expand" in scans[0]
    at = V.version(spark, root)
    for d in FIRE_DIMS:
        keys = sorted(r[0] for r in V.read_version(spark, root, d.name, at).select(d.key).collect())
        assert keys == list(range(len(keys))) and at.tables[d.name].facts["next_key"] == len(keys)
    again = V.commit_with(spark, root, lambda c: refresh_dimensions(c, one, FIRE_DIMS))
    assert again.number == at.number        # nothing new: no version


def test_next_key_without_a_ledger(spark):
    """Dimensions that were stored without a next key go on after their largest."""
    root, spec = fresh_path(spark, "lake"), FIRE_DIMS[-1]
    staged = spark.createDataFrame([("b", "x"), ("a", None)], "state string, fips_name string")
    V.commit_with(spark, root, lambda c: c.replace(spec.name, spark.createDataFrame([(7, "b", "x")], f"{spec.key} bigint, state string, fips_name string")))
    V.commit_with(spark, root, lambda c: refresh_dimensions(c, staged, [spec]))
    assert stored(spark, root, spec.name) == [(7, "b", "x"), (8, "a", None)]


def test_a_calendar_grows_both_ways(spark):
    root = fresh_path(spark, "lake")
    V.commit_with(spark, root, lambda c: refresh_dates(c, "2000-01-01", "2000-01-11"))
    before = {r.date_dim_id: r.date_actual for r in V.read_version(spark, root, "dates").collect()}
    assert before[11] is None
    for _ in range(2):
        V.commit_with(spark, root, lambda c: extend_dates(c, "1999-12-30", "2000-01-14"))
    V.commit_with(spark, root, lambda c: extend_dates(c, None, "2000-01-15"))
    after = {r.date_dim_id: r.date_actual for r in V.read_version(spark, root, "dates").collect()}
    assert all(after[k] == d for k, d in before.items()) and len(after) == 17
    assert after[12] == dt.date(2000, 1, 11) and after[15] == dt.date(2000, 1, 14) and after[-1] == dt.date(1999, 12, 30) and after[0] == dt.date(1999, 12, 31)
    want = {tuple(r) for r in build_dates(spark, "2000-01-11", "2000-01-12").drop("date_dim_id").collect()}
    assert want <= {tuple(r) for r in V.read_version(spark, root, "dates").drop("date_dim_id").collect()}


def test_facts_and_quarantine_are_all_rows(spark):
    raw, root = raw_fires(spark, SF_SMOKE), fresh_path(spark, "lake")
    n = raw.count()

    def counts():
        lake = V.read_lake(spark, root)
        return lake["fires_fact"].count(), lake["fires_fact_quarantine"].count()

    for _ in range(2):
        apply_batch(raw, root, FIRES, "b1")
    facts, held = counts()
    assert facts + held == n and held > 0
    moved = []
    V.commit_with(spark, root, lambda c: (extend_dates(c, start="1980-01-01"), moved.append(replay_quarantine(c, FIRES_FACT))))
    assert moved == [held] and counts() == (n, 0)
    V.commit_with(spark, root, lambda c: moved.append(replay_quarantine(c, FIRES_FACT)))
    assert moved[1] == 0 and counts() == (n, 0)
    # rows whose day is moved out of the calendar leave the fact
    kind = raw.schema["DISCOVERY_DATE"].dataType
    early = raw.where("OBJECTID % 50 = 0").withColumn("DISCOVERY_DATE", F.lit(2415020.5).cast(kind))
    out = stage_fires(early).where("CAST(discovery_timestamp AS DATE) < DATE'1980-01-01'").count()   # others have no time, and so no date
    apply_batch(early, root, FIRES, "b2")
    assert 0 < out and counts() == (n - out, out)
    apply_batch(raw, root, FIRES, "b3")
    assert counts() == (n, 0)


def test_a_batch_that_stops_leaves_no_table_changed(spark, monkeypatch):
    """Dimensions, facts and quarantine are one commit."""
    raw, root = raw_fires(spark, SF_SMOKE), fresh_path(spark, "lake")
    apply_batch(raw.where("FIRE_YEAR <= 1997"), root, FIRES)
    before = {n: t.parts for n, t in V.version(spark, root).tables.items()}

    def lost(self):
        raise RuntimeError("the driver is lost")

    monkeypatch.setattr(V.Change, "commit", lost)
    with pytest.raises(RuntimeError):
        apply_batch(raw, root, FIRES)
    monkeypatch.undo()
    assert {n: t.parts for n, t in V.version(spark, root).tables.items()} == before
    apply_batch(raw, root, FIRES)
    whole = fresh_path(spark, "whole")
    apply_batch(raw, whole, FIRES)
    assert V.read_version(spark, root, "fires_fact").count() == V.read_version(spark, whole, "fires_fact").count()


def test_published_versions_stay_until_published_again(spark):
    root, db = fresh_path(spark, "lake"), "stellate_versions_db"
    put(spark, root, rows(spark, (1, "a", 1990), (2, "b", None)))
    V.commit_with(spark, root, lambda c: c.append("d", spark.createDataFrame([(1,)], "k int")))
    V.commit_with(spark, root, lambda c: c.append("d", spark.createDataFrame([(2,)], "k int")))
    V.publish_version(spark, db, root)
    try:
        put(spark, root, rows(spark, (1, "z", 1990), (5, "e", 1994)))
        assert sorted(map(tuple, spark.table(f"{db}.t").collect()), key=repr) == [(1, "a", 1990), (2, "b", None)]
        assert sorted(r.k for r in spark.table(f"{db}.d").collect()) == [1, 2]
        plan = spark.table(f"{db}.t").where("year = 1990")._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(year" in plan
        V.publish_version(spark, db, root)
        spark.catalog.refreshTable(f"{db}.t")
        assert sorted(map(tuple, spark.table(f"{db}.t").collect()), key=repr) == [(1, "z", 1990), (2, "b", None), (5, "e", 1994)]
    finally:
        spark.sql(f"DROP DATABASE `{db}` CASCADE")


def test_appends_of_many_folders_are_written_as_one(spark, monkeypatch):
    monkeypatch.setattr(V, "MANY_FOLDERS", 3)
    root = fresh_path(spark, "lake")
    for i in range(5):
        V.commit_with(spark, root, lambda c, i=i: c.append("d", spark.createDataFrame([(i,)], "k int")))
    assert sorted(r[0] for r in stored(spark, root, "d")) == list(range(5))
    assert len(V.version(spark, root).tables["d"].parts[V.WHOLE]) == 2


@pytest.mark.parametrize("a, b, want", [
    ("int", "bigint", "bigint"), ("bigint", "int", "bigint"), ("float", "double", "double"), ("int", "double", "double"), ("bigint", "double", None),
    ("decimal(10,2)", "decimal(12,1)", "decimal(13,2)"), ("int", "decimal(5,2)", "decimal(12,2)"), ("decimal(38,0)", "decimal(38,10)", None),
    ("string", "int", None), ("date", "timestamp_ntz", "timestamp_ntz"), ("string", "string", "string"), ("smallint", "float", "float"),
])
def test_wider_types(spark, a, b, want):
    x, y = (spark.createDataFrame([], f"c {t}").schema[0].dataType for t in (a, b))
    for p, q in ((x, y), (y, x)):
        got = wider(p, q)
        assert (got and got.simpleString()) == want


def test_schemas_that_drift(spark):
    root = fresh_path(spark, "lake")
    make = lambda data, kind: spark.createDataFrame(data, kind)
    step = lambda df: V.commit_with(spark, root, lambda c: append_evolving(c, "d", df))
    step(make([(1, "a")], "k int, v string"))
    step(make([(2, "b", 0.5)], "k int, v string, w double"))
    step(make([(1 << 40, "c")], "K bigint, v string"))
    assert stored(spark, root, "d") == sorted([(1, "a", None), (2, "b", 0.5), (1 << 40, "c", None)], key=repr)
    at = V.version(spark, root).number
    with pytest.raises(Narrowing):
        step(make([(1, 5)], "k int, v int"))
    assert V.version(spark, root).number == at
    _, drifts = reconcile("d", V.version(spark, root).tables["d"].struct(), make([(1,)], "k int").schema)
    assert [(d.column, d.change) for d in drifts] == [("k", "cast"), ("v", "missing"), ("w", "missing")]


def test_apply_staged_of_an_empty_batch(spark):
    staged, root = stage_fires(raw_fires(spark, SF_SMOKE)), fresh_path(spark, "lake")
    V.commit_with(spark, root, lambda c: apply_staged(c, staged, FIRES_FACT))
    n = V.read_version(spark, root, "fires_fact").count()
    V.commit_with(spark, root, lambda c: apply_staged(c, staged.limit(0), FIRES_FACT))
    assert V.read_version(spark, root, "fires_fact").count() == n
