"""Shuffled shards by a two-pass external shuffle.

Pass one scatters rows by seeded hashes: the shard by the highest of one hash
a shard (a further shard takes rows only into itself), inside it a bucket of
about ``bucket_bytes``. Pass two shuffles each bucket (Fisher-Yates, seeded by
shard and bucket) and writes it. A row's slot is its place in the shard.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import run_folder, stored

SEED = 17
BUCKET_BYTES = 16 << 20   # of a bucket, which one task holds
MOST_TASKS = 100_000      # beyond as many buckets a task shuffles several in turn
LAW = "key"


def shard_of(key: Column, shards: int, seed: int = SEED) -> Column:
    """Shard whose seeded hash of the key is highest, the lower shard on a
    tie. Depends on nothing but the key, the number of shards and the seed."""
    best = F.array_max(F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.struct(
        F.xxhash64(F.lit(seed), s, key).alias("hash"), (-s).alias("shard"))))
    return -best["shard"]


def fisher_yates(n: int, rng: np.random.Generator) -> np.ndarray:
    """A uniform order of n rows: from the last place down, each place swaps
    with one drawn from those up to itself."""
    order = list(range(n))
    drawn = rng.integers(0, np.arange(n, 0, -1)).tolist() if n else []
    for place, other in zip(range(n - 1, 0, -1), drawn):
        order[place], order[other] = order[other], order[place]
    return np.array(order, np.int64)


def _shuffled(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        own = None

        def done() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            order = fisher_yates(table.num_rows, np.random.default_rng([seed, *own]))
            places = np.empty(len(order), np.int64)
            places[order] = np.arange(len(order))
            table = table.append_column("place", pa.array(places)).take(pa.array(order))
            yield from table.combine_chunks().to_batches()

        for batch in batches:
            at = np.stack([batch.column("shard").to_numpy(), batch.column("bucket").to_numpy()], 1)
            cuts = [0, *(np.flatnonzero((at[1:] != at[:-1]).any(1)) + 1).tolist(), len(at)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if own is not None and own != tuple(at[a].tolist()):
                    yield from done()
                    held.clear()
                own = tuple(at[a].tolist())
                held.append(batch.slice(a, b - a))
        if held:
            yield from done()

    return run


def write_shards(docs: DataFrame, folder: str, shards: int, seed: int = SEED,
                 bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Write the shuffled shards below ``folder`` (Parquet, a folder a shard)
    and return them: doc_id, text, size, shard, bucket, place in the bucket.

    Rows of a null doc_id share a shard. A repeated doc_id stays in its shard
    but its rows spread over the buckets, so that no key makes a bucket large.
    A null text stays null and has size 1.
    """
    rows = _settled(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")).select(
        "doc_id", "text", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"))
    rows = rows.withColumn("shard", shard_of(F.col("doc_id"), shards, seed))
    sizes = {r.shard: r.size for r in rows.groupBy("shard").agg(F.sum("size").alias("size")).collect()}
    buckets = [max(1, math.ceil(sizes.get(s, 0) / bucket_bytes)) for s in range(shards)]
    count = F.get(F.array(*map(F.lit, buckets)), F.col("shard"))
    # the row's number among the rows of its input split tells repeated rows apart
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(
        F.lit(seed + 1), "doc_id", F.monotonically_increasing_id()), count).cast("int"))
    tasks = min(sum(buckets), MOST_TASKS)
    first = F.get(F.array(*map(F.lit, [sum(buckets[:s]) for s in range(shards)])), F.col("shard"))   # a shard's first task
    spread = rows.repartitionById(tasks, F.pmod(first + F.col("bucket"), F.lit(tasks)).cast("int"))
    (spread.sortWithinPartitions("shard", "bucket", "doc_id", "text")
           .mapInArrow(_shuffled(seed), "doc_id bigint, text string, size bigint, shard int, bucket int, place bigint")
           .write.partitionBy("shard").parquet(folder))
    return docs.sparkSession.read.schema(
        "doc_id bigint, text string, size bigint, bucket int, place bigint, shard int").parquet(folder)


def rows_before(counts: DataFrame, block: int = 1_024) -> DataFrame:
    """(shard, bucket, before) from the rows of each bucket: how many the
    shard has in smaller ones. Summed inside blocks of buckets and over the
    blocks, so that no task holds more rows than a shard has blocks."""
    blocked = counts.withColumn("_block", F.floor(F.col("bucket") / block))
    sums = blocked.groupBy("shard", "_block").agg(F.sum("n").alias("_n"))
    ahead = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("shard", "_block").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ahead_of = sums.select("shard", "_block", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
    own = blocked.withColumn("_own", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return own.join(ahead_of, ["shard", "_block"]).select("shard", "bucket", (F.col("_own") + F.col("_ahead")).cast("bigint").alias("before"))


def _settled(docs: DataFrame) -> DataFrame:
    """``docs``, written first if they come out of a shuffle: a task that is
    run again could then meet its rows in another order, and number them
    otherwise."""
    plan = docs._jdf.queryExecution().executedPlan().toString()
    return stored(docs, "settled") if "Exchange" in plan else docs


def shard_documents(docs: DataFrame, shards: int = 16, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES,
                    folder: str | None = None) -> DataFrame:
    """Write shuffled shards and return for each row its shard, its slot in
    it and the shard it would have if there were one more. An empty table
    gives no rows; other columns are ignored."""
    written = write_shards(docs, folder or run_folder(docs.sparkSession, "shards"), shards, seed, bucket_bytes)
    counts = written.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = rows_before(counts)
    digest = F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32")
    rows = written.select("doc_id", "size", digest, "shard", "bucket", "place")   # no text goes into the join
    return rows.join(before, ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", (F.col("before") + F.col("place")).alias("slot"),
        shard_of(F.col("doc_id"), shards + 1, seed).alias("grown_shard"))
