"""As-of joins: for each row the latest row of another table at or before its
time, of the same group.

Both sides are reduced to one row an instant (group and time), so that a hot
group shrinks to its different times, and dealt out by (group, time bucket).
Inside a bucket a window carries the last match forward; a row without one
there takes the last match of the group's earlier buckets, which a second
window finds on one row a bucket. A bucket holds no more instants than its
width has, whatever the tables' size; nothing is compared pair by pair.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY = 86400


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_time: str, right_time: str, take: Sequence[str],
              strict: bool = False, bucket_seconds: int = 30 * DAY, prefix: str = "last_") -> DataFrame:
    """``left`` with, of the latest row of ``right`` of the same ``by`` (null
    matches null) whose time is at or before (``strict``: before) its own, the
    columns ``take`` and the time, prefixed; null where there is none.

    Of several rows of one instant the one that is last by ``take`` counts
    (nulls first). Rows of a null time match nothing and are no match. Times
    are dates or timestamps (compared to the second's fraction)."""
    groups = [f"_by{i}" for i in range(len(by))]
    key = [F.col(b).alias(g) for b, g in zip(by, groups)]
    kind = "timestamp_ntz"
    match = F.struct(F.col("_t"), *[F.col(c).alias(f"_v{i}") for i, c in enumerate(take)])
    facts = (right.where(F.col(right_time).isNotNull()).select(*key, F.col(right_time).cast(kind).alias("_t"), *take)
             .groupBy(*groups, "_t").agg(F.max(match).alias("_match")))
    asked = left.where(F.col(left_time).isNotNull()).select(*key, F.col(left_time).cast(kind).alias("_t")).distinct()
    # at one instant matches come first, unless they have to be earlier
    both = facts.withColumn("_asks", F.lit(0)).unionByName(asked.withColumn("_match", F.lit(None)).withColumn("_asks", F.lit(1)))
    events = both.withColumn("_turn", -F.col("_asks") if strict else F.col("_asks")).withColumn("_bucket", _bucket(bucket_seconds))
    inside = Window.partitionBy(*groups, "_bucket").orderBy("_t", "_turn").rowsBetween(Window.unboundedPreceding, 0)
    near = events.withColumn("_found", F.last("_match", ignorenulls=True).over(inside)).where("_asks = 1")
    # what a bucket hands on: a row each
    ends = events.groupBy(*groups, "_bucket").agg(F.max("_match").alias("_end"))
    earlier = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("_carried", F.max("_end").over(earlier)).where("_carried IS NOT NULL").select(
        *[F.col(g).alias(f"{g}c") for g in groups], F.col("_bucket").alias("_bucketc"), "_carried")
    same = reduce(lambda a, b: a & b, [near[g].eqNullSafe(carried[f"{g}c"]) for g in groups], near["_bucket"] == carried["_bucketc"])
    found = (near.join(carried, same, "left").withColumn("_found", F.coalesce("_found", "_carried")).where("_found IS NOT NULL")
             .select(*[F.col(g).alias(f"{g}f") for g in groups], F.col("_t").alias("_tf"),
                     *[F.col("_found")[f"_v{i}"].alias(f"{prefix}{c}") for i, c in enumerate(take)], F.col("_found")["_t"].alias(f"{prefix}{right_time}")))
    timed = left.withColumn("_tl", F.col(left_time).cast(kind))
    cond = reduce(lambda a, b: a & b, [timed[b].eqNullSafe(found[f"{g}f"]) for b, g in zip(by, groups)], timed["_tl"] == found["_tf"])
    return timed.join(found, cond, "left").drop("_tl", "_tf", *[f"{g}f" for g in groups])


def _bucket(width: int) -> Column:
    """Number of the bucket of ``_t`` (to the hour), whatever the session's zone."""
    return F.floor((F.unix_date(F.col("_t").cast("date")).cast("bigint") * DAY + F.hour("_t") * 3600) / F.lit(width)).cast("bigint")
