import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from stellate.operators.dims import (build_dim, build_dims, build_dims_with_stats, dim_table,
                                     refresh_dim, with_size_bands)
from stellate.operators.keys import dense_key
from stellate.specs import FIRE_SIZES, DimSpec


def _members(spark, n=500, seed=7):
    rnd = random.Random(seed)
    rows = set()
    while len(rows) < n:
        rows.add((rnd.choice([None, "a", "b", "c", "é", "Z"]), rnd.choice([None, 1, 2, 3, -5]),
                  rnd.choice([None, "x", "y"]) if rnd.random() < 0.8 else str(rnd.randint(0, 99))))
    return spark.createDataFrame(sorted(rows, key=str), "a string, b int, c string")


def _expected(df, cols, start=0):
    w = Window.orderBy(*[F.col(c).asc_nulls_first() for c in cols])
    return {tuple(r) for r in df.select((F.row_number().over(w) - 1 + start).alias("k"), *cols).collect()}


def test_dense_key_equals_row_number_for_any_partitioning(spark):
    df = _members(spark, 300)
    want = _expected(df, ["a", "b", "c"])
    for parts in (1, 3, 8, 17):
        got = {tuple(r) for r in dense_key(df, ["a", "b", "c"], "k", num_partitions=parts).collect()}
        assert got == want, parts


def test_dense_key_start_one(spark):
    df = _members(spark, 50)
    got = sorted(r["k"] for r in dense_key(df, ["a", "b", "c"], "k", start=1).collect())
    assert got == list(range(1, 51))


def test_grouped_dims_equal_separate_builds(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice([None, "s1", "s2"]), rnd.choice([None, "t1", "t2", "t3"]), rnd.choice([1, 2, None]),
             rnd.choice(["u", "v", None])) for _ in range(2000)]
    staged = spark.createDataFrame(rows, "s string, t string, n int, u string")
    specs = [DimSpec("d1", "k1", ("s", "t")), DimSpec("d2", "k2", ("n",)), DimSpec("d3", "k3", ("t", "u")),
             DimSpec("d4", "k4", ("s", "t", "n", "u"))]
    together, stats = build_dims_with_stats(staged, specs)
    for s in specs:
        alone = {tuple(r) for r in dim_table(build_dim(staged, s)).collect()}
        got = {tuple(r) for r in dim_table(together[s.name]).collect()}
        want = _expected(staged.select(*s.attrs).distinct(), list(s.attrs))
        assert got == alone == want, s.name
        assert stats[s.name].members == len(want)
        assert stats[s.name].weight == 2000
        rows_sum = together[s.name].agg(F.sum("_rows")).first()[0]
        assert rows_sum == 2000


def test_dims_with_conflicting_attribute_order(spark):
    staged = spark.createDataFrame([("a", "x"), ("b", "x"), ("a", "y"), (None, "y")], "p string, q string")
    specs = [DimSpec("pq", "k1", ("p", "q")), DimSpec("qp", "k2", ("q", "p"))]
    out = build_dims(staged, specs)
    assert {tuple(r) for r in dim_table(out["qp"]).collect()} == _expected(staged, ["q", "p"])
    assert {tuple(r) for r in dim_table(out["pq"]).collect()} == _expected(staged, ["p", "q"])


def test_size_bands_lookup_and_unknown_class(spark):
    staged = spark.createDataFrame([(c,) for c in "ABCDEFGX"] + [(None,)], "fire_size_class string")
    dim = {r["fire_size_class"]: (r["lower_bound"], r["upper_bound"])
           for r in dim_table(with_size_bands(build_dim(staged, FIRE_SIZES))).collect()}
    assert dim["A"] == (0.0, 0.25) and dim["B"] == (0.26, 9.9) and dim["C"] == (10.0, 99.9)
    assert dim["D"] == (100.0, 299.0) and dim["E"] == (300.0, 999.0) and dim["F"] == (1000.0, 4999.0)
    assert dim["G"] == (5000.0, None)
    assert dim["X"] == (None, None) and dim[None] == (None, None)


def test_refresh_keeps_old_keys_and_appends(spark):
    spec = DimSpec("m", "k", ("a", "b"))
    old_rows = spark.createDataFrame([("x", 1), ("y", None), (None, 2)], "a string, b int")
    first = dim_table(build_dim(old_rows, spec))
    new_rows = spark.createDataFrame([("x", 1), ("a", 5), (None, 2), (None, None), ("y", None)], "a string, b int")
    refreshed = {tuple(r) for r in refresh_dim(first, new_rows, spec).collect()}
    old = {tuple(r) for r in first.collect()}
    assert old <= refreshed
    added = sorted(refreshed - old)
    assert [k for k, _, _ in added] == [3, 4]
    assert {(a, b) for _, a, b in added} == {("a", 5), (None, None)}
    # NULLs first: (None, None) sorts before ("a", 5)
    assert dict(((a, b), k) for k, a, b in added)[(None, None)] == 3


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "a string, b int")
    spec = DimSpec("m", "k", ("a", "b"))
    dims, stats = build_dims_with_stats(empty, [spec, DimSpec("n", "j", ("b",))])
    assert dims["m"].count() == 0 and stats["m"].members == 0
    assert dense_key(empty, ["a", "b"], "k").count() == 0
    first = dim_table(build_dim(spark.createDataFrame([("x", 1)], "a string, b int"), spec))
    same = refresh_dim(first, spark.createDataFrame([("x", 1)], "a string, b int"), spec)
    assert [tuple(r) for r in same.collect()] == [(0, "x", 1)]
    assert refresh_dim(first, empty, spec).count() == 1


def test_stats_measure_text_bytes(spark):
    staged = spark.createDataFrame([("ab", 1), ("é", 2), (None, 3), ("ab", 4)], "s string, n int")
    dims, stats = build_dims_with_stats(staged, [DimSpec("ds", "k", ("s",)), DimSpec("dn", "j", ("n",))])
    assert stats["ds"].members == 3 and stats["ds"].text_bytes == 2 + 2   # 'ab' + 'é' (2 UTF-8 bytes)
    assert stats["dn"].members == 4 and stats["dn"].text_bytes == 0
