"""Cube marts kept up to date from signed rows.

What is stored are the cells of the finest grain, with measures that can be
added up: rows, sum, largest value, and the different members of a dense key
as bitmaps. The cube's other cells follow from them without reading the facts.

Inserted rows change cells by addition, the larger value and the union of
bitmaps. Deleted rows are subtracted from rows and sums; a largest value or a
member can only be taken back by looking again, so cells that lost rows (and no
others) read their two measures anew from the facts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import fits_broadcast, null_safe_condition
from .versions import Change

SIGN = "sign"
MEMBERS = "_members"       # after the mart's name


@dataclass(frozen=True)
class CellMart:
    """``dims`` span the cube; ``value`` is summed (as a decimal) and its
    largest kept; ``member`` is an integer key from 0 on whose different
    values are counted."""

    name: str
    dims: tuple[str, ...]
    value: str
    member: str
    total_type: str = "decimal(28,2)"

    def _cells(self, rows: DataFrame, sign: Column) -> DataFrame:
        added = sign > 0
        return rows.groupBy(*self.dims).agg(
            F.sum(sign).cast("bigint").alias("n"), F.coalesce(F.sum(F.col(self.value).cast(self.total_type) * sign), F.lit(0)).cast(self.total_type).alias("total"),
            F.max(F.when(added, F.col(self.value))).alias("largest"), F.sum(F.when(added, 0).otherwise(1)).cast("bigint").alias("_lost"))

    def _members(self, rows: DataFrame) -> DataFrame:
        """Bitmaps of members: a row for each cell and 32,768 keys."""
        known = rows.where(F.col(self.member).isNotNull())
        return known.groupBy(*self.dims, F.bitmap_bucket_number(self.member).alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(self.member)).alias("bitmap"))

    def _of(self, rows: DataFrame, cells: DataFrame, how: str) -> DataFrame:
        """Rows whose cell is, or is not, among ``cells`` (a few columns of
        each), which are broadcast where their measured size allows it."""
        own = cells.select(*[F.col(d).alias(f"_c{i}") for i, d in enumerate(self.dims)]).distinct()
        own = F.broadcast(own) if fits_broadcast(own) else own
        return rows.join(own, null_safe_condition(rows, own, self.dims, [f"_c{i}" for i in range(len(self.dims))]), how)

    def build(self, change: Change, facts: DataFrame) -> None:
        """The cells of all facts."""
        change.replace(self.name, self._cells(facts, F.lit(1)).drop("_lost"))
        change.replace(self.name + MEMBERS, self._members(facts))

    def apply(self, change: Change, signed: DataFrame, facts: DataFrame) -> None:
        """Add rows of sign 1 and take away rows of sign -1; ``facts`` are the
        rows as they are afterwards. A batch goes in once: commit the cells
        with the facts."""
        delta = self._cells(signed, F.col(SIGN)).checkpoint(eager=True)
        old = change.read(self.name).withColumn("_lost", F.lit(0).cast("bigint"))
        summed = (old.unionByName(delta).groupBy(*self.dims)
                  .agg(F.sum("n").alias("n"), F.sum("total").cast(self.total_type).alias("total"), F.max("largest").alias("largest"), F.sum("_lost").alias("_lost"))
                  .where("n > 0"))
        lost = delta.where("_lost > 0")
        # only the facts of cells that lost rows are read again
        again = self._of(facts, lost, "left_semi")
        found = again.groupBy(*self.dims).agg(F.max(self.value).alias("_again"))
        names = [f"_a{i}" for i in range(len(self.dims))]
        found = found.select(*[F.col(d).alias(a) for d, a in zip(self.dims, names)], "_again")
        joined = summed.join(found, null_safe_condition(summed, found, self.dims, names), "left")
        largest = F.when(F.col("_lost") > 0, F.col("_again")).otherwise(F.col("largest")).alias("largest")
        cells = joined.select(*self.dims, "n", "total", largest)
        kept = self._of(change.read(self.name + MEMBERS), lost, "left_anti")
        grown = self._of(self._members(signed.where(F.col(SIGN) > 0)), lost, "left_anti")
        members = (kept.unionByName(grown).groupBy(*self.dims, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
                   .unionByName(self._members(again)))
        change.replace(self.name, cells)
        change.replace(self.name + MEMBERS, members)

    def cube(self, cells: DataFrame, members: DataFrame) -> DataFrame:
        """Every cell of the cube: rows, total, largest, different members,
        and the grouping id; the facts are not read."""
        sums = cells.cube(*self.dims).agg(F.sum("n").alias("n"), F.sum("total").cast(self.total_type).alias("total"),
                                          F.max("largest").alias("largest"), F.grouping_id().cast("int").alias("gid"))
        by_bucket = [[F.col(d) for d in own] + [F.col("bucket")] for own in _subsets(self.dims)]
        ored = members.groupingSets(by_bucket, *self.dims, "bucket").agg(
            F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("c"), F.grouping_id().cast("int").alias("g"))
        # the bucket is grouped in every set: the last bit is never set
        counts = ored.groupBy(*[F.col(d).alias(f"_m{i}") for i, d in enumerate(self.dims)], F.shiftright("g", 1).alias("_g")).agg(
            F.sum("c").alias("members"))
        cond = null_safe_condition(sums, counts, self.dims, [f"_m{i}" for i in range(len(self.dims))]) & (sums["gid"] == counts["_g"])
        return sums.join(counts, cond, "left").select(*self.dims, "n", "total", "largest", F.coalesce("members", F.lit(0)).cast("bigint").alias("members"), "gid")


def _subsets(dims: Sequence[str]) -> list[list[str]]:
    return [[d for i, d in enumerate(dims) if bits >> i & 1] for bits in range(1 << len(dims))]
