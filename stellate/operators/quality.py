"""Data-quality and profiling reports, each a single aggregation pass per
table (the reference ran one job per column)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def null_key_report(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """(table_name, null_keys): rows whose key column is NULL, per table,
    combined with UNION (distinct) as the original check did."""
    parts = [df.agg(F.count_if(F.col(key).isNull()).alias("null_keys"))
               .select(F.lit(name).alias("table_name"), "null_keys")
             for name, (df, key) in tables.items()]
    return _union(parts).distinct()


def row_count_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) per table."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return _union(parts)


def duplicate_key_report(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """(table_name, duplicate_keys): keys that appear more than once."""
    parts = [df.groupBy(key).count().filter(F.col("count") > 1)
               .agg(F.count(F.lit(1)).alias("duplicate_keys"))
               .select(F.lit(name).alias("table_name"), "duplicate_keys")
             for name, (df, key) in tables.items()]
    return _union(parts)


def orphan_report(fact: DataFrame, fks: Mapping[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """(dimension, orphans): fact rows whose foreign key finds no dimension
    row, all keys in one read of the fact. A fact row gives one (key column,
    value) pair a dimension; pairs are counted with partial aggregation, so a
    value that holds a third of the fact costs one row per task, and the
    counts meet the dimensions' keys in one join."""
    spark = fact.sparkSession
    pairs = F.explode(F.array(*[F.struct(F.lit(name).alias("dimension"), F.col(fk).cast("bigint").alias("_f"))
                                for name, (_, _, fk) in fks.items()]))
    found = (fact.select(pairs.alias("_p")).select("_p.*")
             .groupBy("dimension", "_f").agg(F.count(F.lit(1)).alias("_n")))
    keys = _union([dim.select(F.lit(name).alias("_d"), F.col(key).cast("bigint").alias("_k"))
                   for name, (dim, key, _) in fks.items()]).distinct()
    lost = found.join(keys, F.expr("dimension = _d AND _f <=> _k"), "left_anti")
    names = spark.createDataFrame([(name,) for name in fks], "dimension string")
    return (names.join(lost, "dimension", "left").groupBy("dimension")
            .agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("orphans")))


def null_profile(df: DataFrame) -> DataFrame:
    """(column_name, countna) for every column in ONE aggregation, then
    unpivoted: one scan whatever the column count."""
    agg = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    return agg.unpivot([], df.columns, "column_name", "countna")


def max_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with max_<col> per column."""
    return df.agg(*[F.max(c).alias(f"{c.lower()}_max") for c in cols])


def schema_profile(df: DataFrame) -> DataFrame:
    """(column_name, data_type, countna): the printed schema plus null counts,
    in one pass over the data."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    prof = null_profile(df)
    mapping = F.create_map(*[x for c in df.columns for x in (F.lit(c), F.lit(types[c]))])
    return prof.select("column_name", mapping[F.col("column_name")].alias("data_type"), "countna")

