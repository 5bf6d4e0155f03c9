"""Null-safe star joins.

Strategy per dimension:
  * ``broadcast`` when the dimension's measured size (rows and text bytes) is
    under ``stellate.broadcast.maxBytes`` - no shuffle of the fact at all.
    Asking for ``broadcast`` is a hint: beyond the bound the join is salted;
  * ``salted`` when it is not: members whose fact rows exceed an average
    shuffle partition are hot; their fact rows get a deterministic salt in
    [0, s) and the dimension row is copied s times, so one hot member (even a
    third of all rows, e.g. a NULL name) is spread over s tasks. The hot list
    comes from the member counts of the dimension build, or is counted on the
    fact where the dimension has none; it is shorter than the partition count;
  * ``shuffle``, on request only: plain sort-merge join (AQE may split skew).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, ByteType, DateType, DecimalType, DoubleType,
                               FloatType, IntegerType, LongType, ShortType,
                               TimestampNTZType, TimestampType)

from .keys import GroupStats

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024          # one dimension
DEFAULT_BROADCAST_TOTAL_BYTES = 256 * 1024 * 1024   # all dimensions of one star join
_WIDTH = {BooleanType: 1, ByteType: 1, ShortType: 2, IntegerType: 4, LongType: 8, FloatType: 4,
          DoubleType: 8, DateType: 4, TimestampType: 8, TimestampNTZType: 8, DecimalType: 16}


def null_safe_condition(left: DataFrame, right: DataFrame, left_cols: Sequence[str],
                        right_cols: Sequence[str] | None = None) -> Column:
    """AND of ``left.a <=> right.b``: NULL matches NULL."""
    right_cols = right_cols or left_cols
    return reduce(lambda a, b: a & b,
                  [left[l].eqNullSafe(right[r]) for l, r in zip(left_cols, right_cols)])


def broadcast_bytes(df: DataFrame) -> int:
    try:
        v = df.sparkSession.conf.get("stellate.broadcast.maxBytes", None)
    except Exception:
        v = None
    return int(v) if v else DEFAULT_BROADCAST_BYTES


def broadcast_total_bytes(df: DataFrame) -> int:
    try:
        v = df.sparkSession.conf.get("stellate.broadcast.totalBytes", None)
    except Exception:
        v = None
    return int(v) if v else DEFAULT_BROADCAST_TOTAL_BYTES


def measure(df: DataFrame) -> GroupStats:
    """Rows of ``df`` and the real bytes of its columns of varying width, in
    one aggregation (partial sums per task, one row to the driver)."""
    varying = [f.name for f in df.schema.fields if type(f.dataType) not in _WIDTH]
    size = " + ".join(f"coalesce(octet_length(CAST(`{c}` AS STRING)), 0)" for c in varying) or "0"
    r = df.agg(F.count(F.lit(1)).alias("n"), F.expr(f"sum(CAST({size} AS BIGINT))").alias("b")).first()
    return GroupStats(r["n"], None, r["b"] or 0)


def side_bytes(side: DataFrame, stats: GroupStats | None = None) -> int:
    """Size of a join side: fixed widths (and 8 bytes for each field of
    varying width) per row plus measured text bytes. Without stats, or with
    stats that lack the text's size, the side is measured."""
    if stats is None or stats.text_bytes is None:
        stats = measure(side)
    fixed = 16 + sum(_WIDTH.get(type(f.dataType), 8) for f in side.schema.fields)
    return stats.members * fixed + stats.text_bytes


def fits_broadcast(df: DataFrame, max_bytes: int | None = None) -> bool:
    """Whether the measured size is within the bound."""
    return side_bytes(df) <= (max_bytes or broadcast_bytes(df))


def null_safe_join(fact: DataFrame, dim: DataFrame, attrs: Sequence[str], key: str,
                   strategy: str = "auto", salt_cols: Sequence[str] | None = None,
                   extra: Sequence[str] = (), stats=None, keep_right: bool = False,
                   counted: DataFrame | None = None) -> DataFrame:
    """Inner join of ``fact`` to ``dim`` on ``attrs`` with ``<=>``; adds
    ``key`` (and ``extra`` dimension columns) to the fact row. ``stats``
    (members, text bytes, fact rows) from the dimension build replaces the
    measuring job when given. ``keep_right`` leaves the dimension's renamed
    attribute columns in place for a caller that projects once at the end
    (fewer plan nodes in a long star join). ``counted`` has the rows of
    ``fact`` before other joins, for the list of hot members."""
    rnames = [f"_{key}_r{i}" for i in range(len(attrs))]
    has_rows = "_rows" in dim.columns
    right = dim.selectExpr(f"`{key}`", *[f"`{c}`" for c in extra],
                           *[f"`{a}` AS `{r}`" for a, r in zip(attrs, rnames)],
                           *(["_rows"] if has_rows else []))
    if strategy in ("auto", "broadcast"):
        # a broadcast request is honoured only within the measured size bound
        plain = right.drop("_rows") if has_rows else right
        strategy = "broadcast" if side_bytes(plain, stats) <= broadcast_bytes(plain) else "salted"
    if strategy == "salted":
        total = stats.weight if stats is not None else None
        return _salted_join(fact, right, attrs, rnames, salt_cols or fact.columns, total, fact if counted is None else counted)
    if has_rows:
        right = right.drop("_rows")
    if strategy == "broadcast":
        right = F.broadcast(right)
    cond = F.expr(" AND ".join(f"`{a}` <=> `{r}`" for a, r in zip(attrs, rnames)))
    out = fact.join(right, cond, "inner")
    return out if keep_right else out.drop(*rnames)


def _salted_join(fact: DataFrame, right: DataFrame, attrs: Sequence[str], rnames: Sequence[str],
                 salt_cols: Sequence[str], total: int | None, counted: DataFrame) -> DataFrame:
    spark = fact.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hnames = [f"_h{i}" for i in range(len(attrs))]
    if "_rows" in right.columns:   # member counts from the dimension build
        counts = right.selectExpr(*[f"`{r}` AS `{h}`" for r, h in zip(rnames, hnames)], "_rows")
        right = right.drop("_rows")
        if total is None:
            total = counts.agg(F.sum("_rows")).first()[0]
    else:                          # counted on the fact's rows, combined per task first
        counts = counted.groupBy(*[F.col(a).alias(h) for a, h in zip(attrs, hnames)]).agg(F.count(F.lit(1)).alias("_rows"))
        total = counted.count()
    per_task = max(1, (total or 0) // max(1, parts))
    # a member is hot when it alone fills more than an average task; fewer than
    # ``parts`` members can, so the list is small, and their copies add at most
    # 2 x parts dimension rows
    salts = F.least(F.ceil(F.col("_rows") / per_task), F.lit(parts)).cast("int").alias("_hs")
    hot = counts.filter(F.col("_rows") > per_task).select(*hnames, salts)
    hot = F.broadcast(spark.createDataFrame(hot.collect(), hot.schema))
    salt = F.when(F.col("_hs").isNull(), F.lit(0)).otherwise(
        F.pmod(F.xxhash64(*[F.col(c) for c in salt_cols]), F.col("_hs")).cast("int"))
    tagged = (fact.join(hot, null_safe_condition(fact, hot, attrs, hnames), "left")
                  .withColumn("_salt", salt).drop("_hs", *hnames))
    copies = (right.join(hot, null_safe_condition(right, hot, rnames, hnames), "left")
                   .withColumn("_rsalt", F.explode(F.sequence(F.lit(0), F.coalesce("_hs", F.lit(1)) - 1))).drop("_hs", *hnames))
    cond = null_safe_condition(tagged, copies, attrs, rnames) & (tagged["_salt"] == copies["_rsalt"])
    return tagged.join(copies, cond, "inner").drop(*rnames, "_salt", "_rsalt")
