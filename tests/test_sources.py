import pytest

import __spark_entry__ as E
from stellate import session
from stellate.plans.lake import stored_table
from stellate.session import SESSION_CONF, fresh_path
from stellate.sources import jdbc_bounds_options, read_csv, read_jdbc, read_table, select_query
from stellate.specs import FIRE_SOURCE_COLS

from conftest import SF_SMOKE


def test_jdbc_bounds_options():
    o = jdbc_bounds_options("OBJECTID", 1, 1_880_465, 16)
    assert o == {"partitionColumn": "OBJECTID", "lowerBound": "1", "upperBound": "1880465", "numPartitions": "16"}
    with pytest.raises(ValueError):
        jdbc_bounds_options("x", 5, 1, 4)
    with pytest.raises(ValueError):
        jdbc_bounds_options("x", 1, 5, 0)


def test_read_csv_all_text_and_drop(spark):
    path = fresh_path(spark, "csv")
    spark.createDataFrame([("1", "st", "7", "1992-01-01", "weak hot")], "id string, station_name string, "
                          "serialid string, date_str string, type string").write.option("header", True).csv(path)
    df = read_csv(spark, path, drop=("id", "station_name"))
    assert df.columns == ["serialid", "date_str", "type"]
    assert all(t == "string" for _, t in df.dtypes)
    df2 = read_csv(spark, path, columns=["id", "station_name", "serialid", "date_str", "type"], drop=("id",))
    assert df2.first()["serialid"] == "7"


def test_partitioned_jdbc_read_needs_all_of_its_options(spark):
    for options in ({"lower": 1, "upper": 9}, {"lower": 1, "partitions": 4}, {"upper": 9, "partitions": 4}):
        with pytest.raises(ValueError):
            read_jdbc(spark, "jdbc:x", "t", partition_column="id", **options)


def test_select_query_names_the_source_columns():
    q = select_query("Fires", FIRE_SOURCE_COLS, "fires")
    assert len(FIRE_SOURCE_COLS) == 38 and q.startswith("(SELECT OBJECTID, ") and q.endswith(" FROM Fires) fires")


def test_read_table_sees_files_that_are_added(spark):
    root = fresh_path(spark, "grows")
    spark.range(10).write.parquet(f"{root}/t.parquet")
    assert read_table(spark, root, "t").count() == 10
    spark.range(10).write.mode("append").parquet(f"{root}/t.parquet")
    assert read_table(spark, root, "t").count() == 20


def test_queries_leave_the_callers_views_and_settings(spark):
    spark.range(3).createOrReplaceTempView("orders")
    before = {k: spark.conf.get(k, None) for k in SESSION_CONF}
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        assert E.queries()["rename_lower"](spark, SF_SMOKE).count() > 0
        assert spark.table("orders").count() == 3
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "static"
    finally:
        spark.catalog.dropTempView("orders")
        for k, v in before.items():
            if v is not None and spark.conf.isModifiable(k):
                spark.conf.set(k, v)


def test_clean_run_deletes_what_the_run_made_and_nothing_else(spark):
    made, other = fresh_path(spark, "made"), fresh_path(spark, "x").rsplit("/", 1)[0] + "/kept-by-hand"
    spark.range(3).write.parquet(made)
    spark.range(3).write.mode("overwrite").parquet(other)
    session._made[:] = [made]
    assert session.clean_run(spark) == 1
    assert stored_table(spark, made) is None and stored_table(spark, other).count() == 3


def test_only_a_missing_path_counts_as_no_table(spark):
    path = fresh_path(spark, "broken")
    assert stored_table(spark, path) is None
    spark.range(3).write.csv(path)       # files, but no Parquet
    with pytest.raises(Exception):
        stored_table(spark, path).count()
