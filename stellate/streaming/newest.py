"""Streams whose rows come repeatedly, late or out of order.

A row id's newest version is known by an event time. What is kept between the
micro-batches is a table of the lake itself, the newest time of each id, in
buckets of ids: a batch reads and writes it in the commit that takes its rows
in, so state and facts never disagree, whatever is lost or sent again. It tells
rows that are newer from repeats and late ones; of several in one batch the
newest counts. The others are counted beside the fact. An id is forgotten once
it lies ``delay`` behind the newest time of all, and rows that come later than
that are old.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..plans.upkeep import apply_staged, merge_fact
from ..plans.versions import Change, Version, commit_with
from ..session import checkpoint_dir, fresh_path
from .refresh import Feed

DELAY_SECONDS = 30 * 86_400
BUCKETS = 64
NEWEST, LATE = "_newest", "_late"      # after the fact's name


def newest_times(batch: DataFrame, row_id: str, event_time: str) -> DataFrame:
    """Of each id the newest time, ``newest``, and how many rows have it,
    ``n``. Rows without an id or time are none. Only the two columns are
    shuffled, and those of an id are counted before."""
    known = batch.where(F.col(row_id).isNotNull() & F.col(event_time).isNotNull())
    times = known.groupBy(F.col(row_id).alias("id"), F.col(event_time).alias("newest")).agg(F.count(F.lit(1)).alias("n"))
    return times.groupBy("id").agg(F.max_by("n", "newest").alias("n"), F.max("newest").alias("newest"))


def last_rows(rows: DataFrame, row_id: str) -> DataFrame:
    """Of each id's rows, which have one time, the last in order of their
    columns. An id may be that of very many: they are reduced before they are
    shuffled."""
    best = rows.groupBy(F.col(row_id).alias("_id")).agg(F.max(F.struct(*rows.columns)).alias("_row"))
    return best.select("_row.*")


def newer_times(change: Change, batch: DataFrame, name: str, row_id: str, event_time: str, delay: int = DELAY_SECONDS) -> DataFrame:
    """``newest_times`` of the ids whose rows are newer than all before them,
    written once; the table of newest times is brought up to date with them."""
    held = change.read(name)
    newer = newest_times(batch, row_id, event_time)
    if held is not None:
        top = held.agg(F.max("newest")).first()[0]
        seen = held.select(F.col("id").alias("_seen"), F.col("newest").alias("_at"))
        newer = newer.join(seen, newer["id"] == seen["_seen"], "left").where(F.col("_at").isNull() | (F.col("newest") > F.col("_at"))).drop("_seen", "_at")
        if top is not None:
            newer = newer.where(F.col("newest") >= F.lit(top) - F.make_interval(secs=F.lit(delay)))
    path = fresh_path(change.spark, "newer")
    newer.write.parquet(path)
    newer = change.spark.read.schema(newer.schema).parquet(path)
    times = newer.select("id", "newest", F.pmod(F.xxhash64("id"), F.lit(BUCKETS)).cast("int").alias("bucket"))
    merge_fact(change, times, name, "id", "bucket")
    return newer


def newer_rows(batch: DataFrame, newer: DataFrame, feed: Feed, row_id: str, event_time: str) -> DataFrame:
    """The staged rows of ``batch`` of the ids and times in ``newer``, one an
    id. Rows are staged, and so narrow, when they are shuffled. Where several
    rows of an id have its newest time the raw ones are compared."""
    marked = batch.where(F.col(row_id).isNotNull() & F.col(event_time).isNotNull()).withColumns({"_id": F.col(row_id), "_at": F.col(event_time)})
    alone = _at_times(feed.stage(marked.drop(event_time)), newer.where("n = 1"))
    tied = newer.where("n > 1")
    if tied.isEmpty():
        return alone
    return alone.unionByName(feed.stage(last_rows(_at_times(marked, tied), row_id).drop(event_time)))


def _at_times(rows: DataFrame, times: DataFrame) -> DataFrame:
    """The rows of the ids and times in ``times``."""
    same = (F.col("_id") == F.col("_key")) & (F.col("_at") == F.col("_newest"))
    return rows.join(times.select(F.col("id").alias("_key"), F.col("newest").alias("_newest")), same, "left_semi").drop("_id", "_at")


def forget(change: Change, name: str, delay: int = DELAY_SECONDS) -> None:
    """Drop the ids that lie ``delay`` seconds behind the newest time."""
    held = change.read(name)
    top = None if held is None else held.agg(F.max("newest")).first()[0]
    if top is not None:
        change.replace(name, held.where(F.col("newest") >= F.lit(top) - F.make_interval(secs=F.lit(delay))), "bucket")


def apply_newest(batch: DataFrame, root: str, feed: Feed, row_id: str, event_time: str, name: str, delay: int = DELAY_SECONDS) -> Version:
    """Newer rows of a batch into the lake, and how many were not, as one
    version. A batch that is sent again changes nothing."""
    spark = batch.sparkSession
    table = feed.fact.name

    def work(change: Change) -> None:
        counts = change.read(table + LATE)
        if counts is not None and not counts.where(F.col("batch") == name).isEmpty():
            return
        newer = newer_times(change, batch, table + NEWEST, row_id, event_time, delay)
        n_old = batch.count() - newer.count()
        apply_staged(change, newer_rows(batch, newer, feed, row_id, event_time), feed.fact, name)
        change.append(table + LATE, spark.createDataFrame([(name, n_old)], "batch string, n_old bigint"))

    return commit_with(spark, root, work)


def start_newest(spark: SparkSession, feed: Feed, source_dir: str, schema: StructType, root: str, row_id: str, event_time: str,
                 checkpoint_location: str | None = None, available_now: bool = True, delay: int = DELAY_SECONDS):
    """Start a feed's stream over Parquet files landing in ``source_dir``,
    each row with its event time. Batches are named by the checkpoint's
    folder and their number."""
    location = checkpoint_location or f"{checkpoint_dir(spark).rstrip('/')}/streams/{feed.name}-newest"
    stream = spark.readStream.schema(schema).parquet(source_dir)
    writer = stream.writeStream.foreachBatch(
        lambda df, n: apply_newest(df, root, feed, row_id, event_time, f"{location}-{n}", delay) and None).option("checkpointLocation", location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
