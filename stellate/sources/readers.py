"""Sources: Parquet tables, header CSV, partitioned JDBC."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Parquet table ``root/name.parquet`` with the files it has now."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def run_sql(spark: SparkSession, template: str, root: str, names: Iterable[str]) -> DataFrame:
    """A query text with ``{table}`` in place of table names, over the Parquet
    tables. No temp view of the caller's is touched."""
    return spark.sql(template, **{n: read_table(spark, root, n) for n in names})


def read_csv(spark: SparkSession, path: str, columns: Iterable[str] | None = None,
             drop: Iterable[str] = ()) -> DataFrame:
    """Header CSV with every column as STRING (no inference pass). With
    ``columns`` the schema is given up front; otherwise it comes from the
    header line. ``drop`` columns are pruned from the scan."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if columns is not None:
        reader = reader.schema(StructType([StructField(c, StringType()) for c in columns]))
    df = reader.csv(path)
    return df.drop(*drop)


def jdbc_bounds_options(column: str, lower: int, upper: int, partitions: int) -> dict[str, str]:
    """Options that make the JDBC scan run as ``partitions`` parallel range
    queries on ``column`` (the reference read one partition)."""
    if partitions < 1:
        raise ValueError("partitions must be >= 1")
    if upper < lower:
        raise ValueError("upper < lower")
    return {"partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper),
            "numPartitions": str(partitions)}


def even_ranges(keys: DataFrame, column: str, n: int, accuracy: int = 10_000) -> list[str]:
    """Up to ``n`` predicates on ``column`` that every row meets exactly one
    of, each by about as many rows as the others whatever gaps the values
    have: ranges cut at quantiles of ``keys`` (the table, or a sample of it),
    NULLs with the first."""
    if n < 1:
        raise ValueError("n must be >= 1")
    if keys.schema[column].dataType.simpleString() == "string":
        raise ValueError("quantiles need a column of numbers, dates or timestamps")
    if n == 1:
        return ["1 = 1"]
    at = [i / n for i in range(1, n)]
    cuts = keys.agg(F.percentile_approx(column, at, max(accuracy, 20 * n)).alias("c")).first().c or []
    cuts = sorted(set(cuts))
    if not cuts:
        return ["1 = 1"]
    def text(v) -> str:
        return str(v) if isinstance(v, (int, float)) or hasattr(v, "as_tuple") else f"'{v}'"
    first = f"({column} <= {text(cuts[0])} OR {column} IS NULL)"
    return [first, *[f"({column} > {text(a)} AND {column} <= {text(b)})" for a, b in zip(cuts, cuts[1:])], f"({column} > {text(cuts[-1])})"]


def read_jdbc_ranges(spark: SparkSession, url: str, table: str, predicates: list[str], *, driver: str | None = None,
                     fetchsize: int = 10000, properties: dict[str, str] | None = None) -> DataFrame:
    """JDBC table or ``(subquery) alias`` as one partition a predicate (see
    ``even_ranges``)."""
    props = {"fetchsize": str(fetchsize), **({"driver": driver} if driver else {}), **(properties or {})}
    return spark.read.jdbc(url, table, predicates=predicates, properties=props)


def read_jdbc(spark: SparkSession, url: str, table: str, *, driver: str | None = None,
              partition_column: str | None = None, lower: int | None = None,
              upper: int | None = None, partitions: int = 1, fetchsize: int = 10000,
              properties: dict[str, str] | None = None) -> DataFrame:
    """JDBC table or ``(subquery) alias``. With a numeric ``partition_column``
    and its bounds, the read is split into ``partitions`` range queries that
    executors run in parallel; rows outside the bounds still land in the
    first/last range (bounds only set the stride)."""
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetchsize)}
    if driver:
        opts["driver"] = driver
    if partition_column is not None:
        if lower is None or upper is None or partitions < 2:
            raise ValueError("partitioned JDBC read needs lower and upper bounds and at least 2 partitions")
        opts.update(jdbc_bounds_options(partition_column, lower, upper, partitions))
    opts.update(properties or {})
    return spark.read.format("jdbc").options(**opts).load()


def select_query(table: str, columns: Iterable[str], alias: str = "source") -> str:
    """A subquery for ``read_jdbc`` that reads only the named columns."""
    return f"(SELECT {', '.join(columns)} FROM {table}) {alias}"
