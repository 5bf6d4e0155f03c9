"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, note_folder

SLICE_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def run_folder(spark: SparkSession, name: str) -> str:
    """A folder of this run below ``spark.checkpoint.dir`` (shared storage);
    ``session.clean_run`` deletes it."""
    return note_folder(f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts the
    lineage and survives lost executors."""
    path = run_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def package_on_workers(spark: SparkSession) -> None:
    """Python workers find this package where the driver found it, unless the
    cluster already installs it or ships it with --py-files."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), root]))


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``limit`` bytes of text (one row at
    least), so that work arrays stay bounded whatever a batch holds."""
    if not batch.num_rows:
        return
    col = batch.column(column).cast(pa.large_string()).cast(pa.large_binary())
    size = np.diff(np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, 8 * col.offset))
    ends = np.cumsum(size)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def text_list(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return batch.column(column).fill_null("").to_pylist()


def utf8(batch: pa.RecordBatch, column: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """All texts of the batch as one byte array, and where each begins (and
    the last ends). Null counts as empty."""
    col = batch.column(column).fill_null("").cast(pa.large_binary())
    cuts = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, 8 * col.offset)
    data = np.frombuffer(col.buffers()[2] or b"", np.uint8)[cuts[0]:cuts[-1]]
    return data, cuts - cuts[0]


def range_bounds(df: DataFrame, key: str, n: int) -> tuple[list[int], int | None, bool]:
    """Up to ``n - 1`` values of an integer column that cut it into ranges of
    about equal row counts, its smallest value, and if it has nulls. The
    driver gets n numbers, whatever the size."""
    cuts = F.lit(None).cast("array<bigint>") if n < 2 else F.percentile_approx(
        F.col(key).cast("bigint"), [i / n for i in range(1, n)], max(10_000, 10 * n))
    got = df.agg(cuts.alias("cuts"), F.min(key).cast("bigint").alias("low"),
                 F.count(F.when(F.col(key).isNull(), 1)).alias("nulls")).first()
    return sorted({c for c in got.cuts or [] if c != got.low}), got.low, got.nulls > 0


def range_bucket(key: str, bounds: list[int]) -> Column:
    """Number of the range a key is in: how many bounds are at or below it;
    null is in the first. Found by binary search in a sorted literal."""
    if not bounds:
        return F.lit(0)
    table = F.array(*[F.lit(b).cast("bigint") for b in bounds])
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))])

    def further(at: Column, step: Column) -> Column:
        inside = (at + step <= len(bounds)) & (F.get(table, at + step - 1) <= F.col(key))
        return F.when(inside, at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), further)


def unused_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores after it until no column is called so
    (column names don't tell cases apart)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


_powers: dict[int, np.ndarray] = {}
_BYTE_BASE = 0x9E3779B97F4A7C15


def powers(base: int, n: int) -> np.ndarray:
    """Powers of an odd number modulo 2^64, kept and grown by doubling."""
    got = _powers.get(base)
    if got is None:
        got = np.ones(1, np.uint64)
    while len(got) < n:
        got = np.concatenate([got, got * np.uint64(pow(base, len(got), 2**64))])
    _powers[base] = got
    return got[:n]


def byte_runs(kinds: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the runs of equal nonzero kind; none crosses a cut."""
    edge = np.zeros(len(kinds) + 1, bool)
    edge[1:-1] = kinds[1:] != kinds[:-1]
    edge[cuts] = edge[0] = True
    edges = np.flatnonzero(edge)
    begin, end = edges[:-1], edges[1:]
    used = kinds[begin] != 0 if len(begin) else np.zeros(0, bool)
    return begin[used], end[used]


def run_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte runs [begin, end), equal for equal runs."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_BYTE_BASE, len(data)), out=sums[1:])
    value = (sums[end] - sums[begin]) * powers(pow(_BYTE_BASE, -1, 2**64), len(data) + 1)[begin]
    value ^= value >> np.uint64(29)
    value *= np.uint64(0xBF58476D1CE4E5B9)
    return value ^ value >> np.uint64(32)
