"""Clustered files with an index of what each holds.

Rows are laid out along a Z curve: the columns, scaled to 16 bits each between
the table's smallest and largest value, are interleaved bit by bit, and the
table is range-partitioned and sorted by the result, so that a file covers a
small box. The index has a row a file with the smallest and largest value of
each column; a reader picks the files whose box meets its own before the scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITS = 16
INDEX = "-index"           # a folder beside that of the data
MIN_TASKS = 256            # up to so many files, a task each
ROWS_PER_TASK = 200_000    # beyond, a task writes so many rows, in several files


def _number(column: str) -> Column:
    """A number, date or number as text, as a double; NULL if none."""
    return F.coalesce(F.col(column).cast("string").try_cast("double"), F.unix_date(F.col(column).cast("string").try_cast("date")).cast("double"))


def z_key(columns: Sequence[str], bounds: Mapping[str, tuple[float, float]]) -> Column:
    """Position on the Z curve; a NULL counts as the smallest value."""
    key = F.lit(0).cast("bigint")
    top = (1 << BITS) - 1
    for i, c in enumerate(columns):
        low, high = bounds[c]
        scaled = F.lit(0) if high <= low else F.floor((_number(c) - F.lit(low)) / F.lit(high - low) * F.lit(top))
        cell = F.greatest(F.lit(0), F.least(F.lit(top), F.coalesce(scaled, F.lit(0)))).cast("bigint")
        for b in range(BITS):
            key = key.bitwiseOR(F.shiftleft(F.getbit(cell, F.lit(b)).cast("bigint"), b * len(columns) + i))
    return key


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], rows_per_file: int = 2_000_000) -> None:
    """Write ``df`` in files of about ``rows_per_file`` rows along the curve
    over ``columns`` (three at most), and their index. Where files are small and
    very many, a task writes several: what tasks report to the driver follows
    the rows, not the files."""
    if not 1 <= len(columns) <= 63 // BITS:
        raise ValueError(f"from 1 to {63 // BITS} columns can be interleaved")
    edge = df.agg(F.count(F.lit(1)).alias("n"), *[f(_number(c)).alias(f"{n}{i}") for i, c in enumerate(columns) for f, n in ((F.min, "low"), (F.max, "high"))]).first()
    bounds = {c: (edge[f"low{i}"] or 0.0, edge[f"high{i}"] or 0.0) for i, c in enumerate(columns)}
    files = max(1, -(-edge.n // rows_per_file))
    # rows of one place are many: a hash of the row deals them out as well
    keyed = df.withColumn("_z", z_key(columns, bounds)).withColumn("_h", F.xxhash64(*df.columns))
    tasks = min(files, max(MIN_TASKS, -(-edge.n // max(rows_per_file, ROWS_PER_TASK))))
    dealt = keyed.repartitionByRange(tasks, "_z", "_h").sortWithinPartitions("_z", "_h").drop("_z", "_h")
    # as many files as tasks: ranges are even but for sampling, and none is cut
    (dealt.write.option("maxRecordsPerFile", rows_per_file) if tasks < files else dealt.write).parquet(path)
    spark = df.sparkSession
    seen = spark.read.schema(df.schema).parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("n"), *[f(_number(c)).alias(f"{n}_{c}") for c in columns for f, n in ((F.min, "low"), (F.max, "high"))])
    seen.write.parquet(path + INDEX)


def read_clustered(spark: SparkSession, path: str, schema, box: Mapping[str, tuple]) -> DataFrame:
    """The rows whose columns lie in ``box`` (inclusive lower and upper end;
    None is open), from the files that can have any."""
    index = spark.read.parquet(path + INDEX)
    ends = {c: tuple(None if v is None else _literal(v) for v in span) for c, span in box.items()}
    for c, (low, high) in ends.items():
        if low is not None:
            index = index.where(F.col(f"high_{c}") >= F.lit(low))
        if high is not None:
            index = index.where(F.col(f"low_{c}") <= F.lit(high))
    files = [r.file for r in index.select("file").collect()]    # names only
    rows = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    for c, (low, high) in ends.items():
        if low is not None:
            rows = rows.where(_number(c) >= F.lit(low))
        if high is not None:
            rows = rows.where(_number(c) <= F.lit(high))
    return rows


def _literal(value) -> float:
    """A bound on the scale of ``_number``."""
    return float(value.toordinal() - 719163) if hasattr(value, "toordinal") else float(value)
