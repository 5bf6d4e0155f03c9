"""Persisting the star as Parquet and publishing it in the Spark catalog.

Facts are partitioned by year. Every fact write names dynamic partition
overwrite itself, whatever the session says, so that it replaces the years it
writes and leaves the others. The rebalance hint lets AQE cut a hot year into
several tasks and merge small ones, instead of one task per year
(``repartition(year)``) or a fixed ``coalesce(10)`` that would also throttle
the join stage feeding the write.

These are plain folders for tables that are written once or by one writer;
the job and the streams write versions (``versions``, ``upkeep``).
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FACT_SUFFIX = "fact"


def write_dim(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def fact_for_write(df: DataFrame, partition_col: str = "year") -> DataFrame:
    """The fact as it goes to the writer: a rebalance on the partition column
    (AQE splits hot years, merges small ones)."""
    return df.hint("rebalance", F.col(partition_col))


def write_fact(df: DataFrame, path: str, partition_col: str = "year",
               max_records_per_file: int = 5_000_000) -> None:
    (fact_for_write(df, partition_col)
       .write.mode("overwrite")
       .option("maxRecordsPerFile", max_records_per_file)
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(partition_col)
       .parquet(path))


def write_tables(tables: Mapping[str, DataFrame], root: str, partition_col: str = "year") -> dict[str, str]:
    """Dimensions first, then facts (facts read keys the dims already hold);
    the jobs of each kind run side by side."""
    paths = {name: f"{root}/{name}" for name in tables}
    facts = [name for name in tables if name.endswith(FACT_SUFFIX)]
    with ThreadPoolExecutor(max_workers=4) as pool:
        list(pool.map(lambda name: write_dim(tables[name], paths[name]), [n for n in tables if n not in facts]))
        list(pool.map(lambda name: write_fact(tables[name], paths[name], partition_col), facts))
    return paths


def stored_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``; None only if there is no such path. Any other
    trouble with it is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def ddl_columns(df: DataFrame) -> str:
    """Column list for CREATE TABLE, derived from the written schema (the
    reference kept a hand-written copy that drifted from what it wrote)."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def publish_table(spark: SparkSession, database: str, name: str, path: str,
                  partition_col: str | None = None) -> None:
    """Replace the catalog table ``database.name`` over the Parquet folder;
    partitioned tables get their partitions registered by a repair."""
    df = spark.read.parquet(path)
    spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
    part = f" PARTITIONED BY (`{partition_col}`)" if partition_col and partition_col in df.columns else ""
    spark.sql(f"CREATE TABLE `{database}`.`{name}` ({ddl_columns(df)}) USING PARQUET"
              f"{part} LOCATION '{path}'")
    if part:
        spark.sql(f"MSCK REPAIR TABLE `{database}`.`{name}`")


def publish(spark: SparkSession, database: str, paths: Mapping[str, str], location: str,
            partition_col: str = "year") -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{location}'")
    for name, path in paths.items():
        publish_table(spark, database, name, path,
                      partition_col if name.endswith(FACT_SUFFIX) else None)
