"""Event-driven refresh of a lake with Structured Streaming.

New raw records arriving as files in a folder are applied one micro-batch at a
time through ``foreachBatch``, to the same tables that the batch job writes:

  * the member dimensions get the batch's unseen members appended with keys
    after their largest (existing keys never change), all in one pass;
  * the batch's facts take the place of stored facts of the same row id, and
    all others stay, whatever years they share;
  * rows of days that the calendar lacks go to the quarantine.

A batch is one commit (``plans.versions``): a driver lost on the way leaves
the version before it, and the steps give the same tables when repeated, so
neither a retried batch nor a stream started anew, with its batch ids from 0
again, loses or doubles a row. Several streams may write one lake: one that
finds the tables changed applies its batch again. Progress lives in a
checkpoint folder on shared storage (``spark.checkpoint.dir`` by default).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..plans.stage import stage_fires, stage_weather
from ..plans.upkeep import apply_staged
from ..plans.versions import Version, commit_with
from ..session import checkpoint_dir
from ..specs import FIRES_FACT, WEATHER_FACT, FactSpec


@dataclass(frozen=True)
class Feed:
    """A raw source and the fact that it feeds."""

    name: str
    stage: Callable[[DataFrame], DataFrame]
    fact: FactSpec


FIRES = Feed("fire-refresh", stage_fires, FIRES_FACT)
WEATHER = Feed("weather-refresh", stage_weather, WEATHER_FACT)


def apply_batch(batch: DataFrame, root: str, feed: Feed, name: str = "") -> Version:
    """Raw rows of one batch -> refreshed dimensions, merged facts and
    quarantine, as one version. Of rows that repeat a row id inside the batch
    all are kept, as in the source. ``name`` marks quarantined rows."""
    staged = feed.stage(batch)
    return commit_with(batch.sparkSession, root, lambda change: apply_staged(change, staged, feed.fact, name))


def start_refresh(spark: SparkSession, feed: Feed, source_dir: str, schema: StructType, root: str,
                  checkpoint_location: str | None = None, available_now: bool = True,
                  max_files_per_trigger: int | None = None):
    """Start a feed's stream over Parquet files landing in ``source_dir``."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    location = checkpoint_location or f"{checkpoint_dir(spark).rstrip('/')}/streams/{feed.name}"
    writer = (reader.parquet(source_dir).writeStream.foreachBatch(lambda df, n: apply_batch(df, root, feed, f"{feed.name}-{n}") and None)
                    .option("checkpointLocation", location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def start_fire_refresh(spark: SparkSession, source_dir: str, schema: StructType, root: str, **options):
    return start_refresh(spark, FIRES, source_dir, schema, root, **options)


def start_weather_refresh(spark: SparkSession, source_dir: str, schema: StructType, root: str, **options):
    return start_refresh(spark, WEATHER, source_dir, schema, root, **options)
