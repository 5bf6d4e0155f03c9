"""Bringing a versioned lake up to date: dimensions, calendar, facts and the
quarantine of rows that the calendar does not hold. Every function works on a
``Change``, so what a batch does to several tables becomes one commit.

Stored keys never change. All dimensions of a fact are refreshed by one pass
over the staged rows; the next key of each is kept with its table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.dims import build_dates, build_dims_with_stats, calendar_size, dim_table, more_dates, with_size_bands
from ..operators.facts import build_fact, calendar_misses
from ..operators.keys import GroupStats
from ..session import fresh_path
from ..specs import CALENDAR_END, CALENDAR_START, DATES_TABLE, FIRE_SIZES, DimSpec, FactSpec, fact_column, without_missing_dims
from .lake import fact_for_write
from .versions import NULL_PARTITION, Change, partition_of, side_by_side

QUARANTINE = "_quarantine"     # after the fact's name
REASON, BATCH = "_reason", "_batch"


# Dimensions ------------------------------------------------------------------

def refresh_dimensions(change: Change, staged: DataFrame, specs: Sequence[DimSpec]) -> tuple[dict[str, DataFrame], dict[str, GroupStats]]:
    """Append to all dimensions the members of ``staged`` that they lack, with
    keys after each one's largest; repeated, it appends nothing.

    One aggregation over the staged rows gives the members of all dimensions,
    one anti join leaves out those that are stored, one sort numbers the rest.
    Returns the dimensions and their sizes, which are kept with the tables, so
    that no join has to measure them.
    """
    known = {s.name: change.read(s.name) for s in specs if s.name in change}
    starts = {s.name: _next_key(change, s) for s in specs if s.name in change}
    fresh, stats = build_dims_with_stats(staged, specs, known=known or None, starts=starts)

    def put(spec: DimSpec) -> None:
        n = stats[spec.name].members
        if not n and spec.name in change:
            return
        rows = dim_table(fresh[spec.name])
        if spec.name == FIRE_SIZES.name:
            rows = with_size_bands(rows)
        text = stats[spec.name].text_bytes
        if spec.name in change:
            before = change.facts(spec.name).get("text_bytes")
            text = None if before is None or text is None else int(before) + text
        change.append(spec.name, rows, next_key=starts.get(spec.name, 0) + n, text_bytes=text)

    side_by_side([lambda s=s: put(s) for s in specs])
    return {s.name: change.read(s.name) for s in specs}, {s.name: _size(change, s, stats[s.name], s.name in known) for s in specs}


def _size(change: Change, spec: DimSpec, fresh: GroupStats, grown: bool) -> GroupStats | None:
    """Members and text bytes of a dimension; None if they are to be measured."""
    if not grown:
        return fresh
    kept = change.facts(spec.name)
    if kept.get("text_bytes") is None or kept.get("next_key") is None:
        return None
    return GroupStats(int(kept["next_key"]), None, int(kept["text_bytes"]))


def _next_key(change: Change, spec: DimSpec) -> int:
    kept = change.facts(spec.name).get("next_key")
    if kept is not None:
        return int(kept)
    top = change.read(spec.name).agg(F.max(spec.key)).first()[0]
    return 0 if top is None else int(top) + 1


# Calendar --------------------------------------------------------------------

def refresh_dates(change: Change, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    """The stored calendar, written if there is none yet."""
    if DATES_TABLE not in change:
        change.replace(DATES_TABLE, build_dates(change.spark, start, end), start=start, end=end,
                       origin=start, unknown=calendar_size(start, end) + 1)
    return change.read(DATES_TABLE)


def calendar_range(change: Change) -> tuple[str, str]:
    """First day and end (exclusive) of the stored calendar."""
    kept = change.facts(DATES_TABLE)
    return str(kept["start"]), str(kept["end"])


def extend_dates(change: Change, start: str | None = None, end: str | None = None) -> DataFrame:
    """Add the days from ``start`` and up to ``end`` (exclusive) that the
    stored calendar lacks. No stored day and not the unknown member gets
    another key: the unknown member's is reserved, and days step over it."""
    refresh_dates(change)
    kept = change.facts(DATES_TABLE)
    first, last = str(kept["start"]), str(kept["end"])
    new_first, new_last = min(first, start or first), max(last, end or last)
    for lo, hi in ((new_first, first), (last, new_last)):
        if lo < hi:
            change.append(DATES_TABLE, more_dates(change.spark, lo, hi, str(kept["origin"]), int(kept["unknown"])))
    change.note(DATES_TABLE, start=new_first, end=new_last)
    return change.read(DATES_TABLE)


# Facts -----------------------------------------------------------------------

def _held(change: Change, df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to a folder of this run."""
    path = fresh_path(change.spark, name)
    df.write.parquet(path)
    return change.spark.read.schema(df.schema).parquet(path)


def _same_row(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in columns])


def merge_fact(change: Change, fact: DataFrame, name: str, row_id: str, partition_col: str = "year", ids: DataFrame | None = None) -> None:
    """Put the rows of ``fact`` in place of stored rows of the same id, and
    leave all others. Only partitions are rewritten that the rows are in or
    come from; repeating the merge gives the same table.

    ``ids`` (one column, ``row_id``; read several times) are the ids that are
    replaced, where they are more than those of ``fact``. A null id names no
    row: such rows are the same where all their columns are, and replace only
    each other.
    """
    if name not in change:
        change.replace(name, fact_for_write(fact, partition_col), partition_col)
        return
    batch = _held(change, fact, "batch")      # the rows are read several times
    ids = batch.select(row_id) if ids is None else ids
    # partitions are few: a row each
    own = batch.groupBy(partition_of(partition_col).alias("part")).agg(F.count_if(F.col(row_id).isNull()).alias("unnamed")).collect()
    has_unnamed, own_parts = any(r.unnamed for r in own), {r.part for r in own}
    if not own and not change.tables[name].parts:
        return
    unnamed = batch.where(F.col(row_id).isNull())
    edge = ids.agg(F.min(row_id).alias("low"), F.max(row_id).alias("high")).first()
    touched = set(own_parts)
    named_ids = ids.where(F.col(row_id).isNotNull()).distinct()
    others = change.tables[name].parts.keys() - own_parts
    if edge.low is not None and others:
        # the bounds reach the scan; two columns are read
        inside = change.read(name, others).where(F.col(row_id).between(edge.low, edge.high)).select(row_id, partition_of(partition_col).alias("_part"))
        touched |= {r[0] for r in inside.join(named_ids, row_id, "left_semi").select("_part").distinct().collect()}
    if not touched:
        return
    stored = change.read(name, touched).select(*fact.columns)
    kept = stored.join(named_ids, row_id, "left_anti")            # a null id is never among them
    if has_unnamed:
        copies = unnamed.distinct()
        kept = kept.join(copies, _same_row(kept, copies, fact.columns), "left_anti")
    # of the partitions touched those that get no rows go
    change.replace_parts(name, fact_for_write(kept.unionByName(batch), partition_col), partition_col, emptied=touched)


# Quarantine ------------------------------------------------------------------

def outside_calendar(staged: DataFrame, spec: FactSpec, start: str, end: str, batch: str) -> DataFrame:
    """The staged rows that the calendar join drops, with the roles whose date
    it does not hold, the batch they came in, and the partition column."""
    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
    roles = [F.when((F.col(r.source).cast("date") < lo) | (F.col(r.source).cast("date") >= hi), F.lit(r.key_out)) for r in spec.roles]
    year = next(expr for expr, alias in spec.select if alias == spec.partition_col)
    return calendar_misses(staged, spec, start, end).select(
        "*", F.concat(F.lit("no such day: "), F.array_join(F.array_compact(F.array(*roles)), ", ")).alias(REASON),
        F.lit(batch).alias(BATCH), F.expr(year).cast("int").alias(spec.partition_col))


def _modelled(change: Change, staged: DataFrame, spec: FactSpec, batch: str) -> tuple[FactSpec, DataFrame, DataFrame]:
    """The facts of staged rows, with new members appended to the dimensions,
    and the rows that the calendar does not hold."""
    spec = without_missing_dims(spec, staged.columns)
    dates = refresh_dates(change)
    dims, stats = refresh_dimensions(change, staged, spec.dims)
    start, end = calendar_range(change)
    return spec, build_fact(staged, spec, dims, dates, stats=stats), outside_calendar(staged, spec, start, end, batch)


def apply_staged(change: Change, staged: DataFrame, spec: FactSpec, batch: str = "") -> None:
    """Staged rows into the lake, in place of those of the same id, which may
    be in the fact or in the quarantine beside it."""
    staged = _held(change, staged, "staged")      # members, facts, misses and ids are read from it
    spec, fact, misses = _modelled(change, staged, spec, batch)
    id_staged, id_fact = spec.row_id[0], fact_column(spec, spec.row_id[0])
    ids = staged.select(id_staged)
    merge_fact(change, fact, spec.name, id_fact, spec.partition_col, ids.withColumnRenamed(id_staged, id_fact))
    merge_fact(change, misses, spec.name + QUARANTINE, id_staged, spec.partition_col, ids)


def replace_years(change: Change, staged: DataFrame, spec: FactSpec, batch: str = "", is_stored: bool = False) -> None:
    """Staged rows into the lake, in place of all rows of their years (an
    extract of whole years). ``is_stored``: they are read from files as they
    are, and need not be written to be read several times."""
    staged = staged if is_stored else _held(change, staged, "staged")
    spec, fact, misses = _modelled(change, staged, spec, batch)
    year = next(expr for expr, alias in spec.select if alias == spec.partition_col)
    given = {r[0] for r in staged.select(F.coalesce(F.expr(year).cast("string"), F.lit(NULL_PARTITION))).distinct().collect()}
    for name, rows in ((spec.name, fact), (spec.name + QUARANTINE, misses)):
        change.replace_parts(name, fact_for_write(rows, spec.partition_col), spec.partition_col, emptied=given)


def replay_quarantine(change: Change, spec: FactSpec) -> int:
    """Move the quarantined rows that the calendar holds by now into the
    fact; returns how many there were. Repeated, it moves none."""
    name = spec.name + QUARANTINE
    held = change.read(name)
    if held is None:
        return 0
    start, end = calendar_range(change)
    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
    days = [F.col(r.source).cast("date") for r in spec.roles]
    inside = reduce(lambda a, b: a & b, [d.isNull() | ((d >= lo) & (d < hi)) for d in days])
    ready = held.where(inside).drop(REASON, BATCH, spec.partition_col)
    n = ready.count()
    if n:
        own, fact, _ = _modelled(change, ready, spec, "")
        merge_fact(change, fact, own.name, fact_column(own, own.row_id[0]), own.partition_col)
        change.replace(name, fact_for_write(held.where(~inside), own.partition_col), own.partition_col)
    return n
