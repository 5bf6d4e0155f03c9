"""Dimension builders: member dimensions with dense keys, the calendar
dimension with its unknown member, size bands, role-playing copies, and the
type-1 incremental refresh."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.conform import prefix_names
from ..functions.temporal import CALENDAR_TYPES, calendar_sql
from ..specs import CALENDAR_END, CALENDAR_START, DATES_KEY, SIZE_BANDS, DimSpec
from .joins import fits_broadcast, null_safe_condition
from .keys import GroupStats, dense_key, dense_key_with_stats

ROWS = "_rows"   # member frequency kept next to each member (skew planning)


def _union_attrs(specs: Sequence[DimSpec]) -> list[str]:
    cols: list[str] = []
    for s in specs:
        for a in s.attrs:
            if a not in cols:
                cols.append(a)
    return cols


def _in_order(attrs: Sequence[str], cols: Sequence[str]) -> bool:
    pos = [cols.index(a) for a in attrs]
    return pos == sorted(pos)


def build_dims(staged: DataFrame, specs: Sequence[DimSpec], start: int = 0) -> dict[str, DataFrame]:
    return build_dims_with_stats(staged, specs, start)[0]


def build_dims_with_stats(staged: DataFrame, specs: Sequence[DimSpec], start: int = 0,
                          known: Mapping[str, DataFrame] | None = None,
                          starts: Mapping[str, int] | None = None) -> tuple[dict[str, DataFrame], dict[str, GroupStats]]:
    """Build several member dimensions from one pass over ``staged``.

    One GROUPING SETS aggregation (Expand + partial/final hash aggregate) gives
    the members of every dimension with their row counts; map-side partial
    aggregation collapses hot members before the shuffle. One range-partitioned
    ``dense_key`` pass then numbers the members of all dimensions at once,
    restarting per dimension. Each result has columns (key, *attrs, _rows);
    the stats give each dimension's member count and fact-row total.

    ``known`` are dimensions that exist: the members they hold are left out by
    one null-safe anti join on (dimension, attributes), before the sort, and
    the others are numbered from ``starts`` on, by dimension.
    """
    specs = list(specs)
    cols = _union_attrs(specs)
    same = known is not None and len({s.attrs for s in specs}) < len(specs)
    if any(not _in_order(s.attrs, cols) for s in specs) or same:
        # attribute orders that disagree cannot share one sort, nor can
        # stored dimensions of the same attributes: build apart
        parts = [build_dims_with_stats(staged, [s], start, known, starts) for s in specs]
        return ({s.name: p[0][s.name] for s, p in zip(specs, parts)},
                {s.name: p[1][s.name] for s, p in zip(specs, parts)})

    by_attrs: dict[tuple[str, ...], int] = {}
    for s in specs:
        if s.attrs not in by_attrs:
            gid = 0
            for i, c in enumerate(cols):
                if c not in s.attrs:
                    gid |= 1 << (len(cols) - 1 - i)
            by_attrs[s.attrs] = gid

    if len(by_attrs) == 1:
        members = staged.groupBy(*cols).agg(F.expr(f"count(1) AS {ROWS}"), F.expr("CAST(0 AS BIGINT) AS _gid"))
        gids = {a: 0 for a in by_attrs}
    else:
        sets = [[F.col(a) for a in attrs] for attrs in by_attrs]
        members = staged.groupingSets(sets, *cols).agg(
            F.expr(f"count(1) AS {ROWS}"), F.expr("CAST(grouping_id() AS BIGINT) AS _gid"))
        gids = by_attrs
    held = [s for s in specs if s.name in (known or {})]
    if held:
        members = _unknown(members, [(gids[s.attrs], known[s.name], s) for s in held], cols)
    keyed, gstats = dense_key_with_stats(
        members, cols, "_key", start=start, group_col="_gid", weight_col=ROWS, materialize=len(by_attrs) > 1,
        starts={gids[s.attrs]: (starts or {}).get(s.name, start) for s in specs})
    out, stats = {}, {}
    for s in specs:
        g = gids[s.attrs]
        out[s.name] = keyed.filter(f"_gid = {g}").selectExpr(f"_key AS `{s.key}`", *[f"`{a}`" for a in s.attrs],
                                                              ROWS)
        stats[s.name] = gstats.get(g, GroupStats(0, 0, 0))
    return out, stats


def _unknown(members: DataFrame, held: Sequence[tuple[int, DataFrame, DimSpec]], cols: Sequence[str]) -> DataFrame:
    """The (dimension, attributes) rows that no stored dimension has."""
    kinds = {c: members.schema[c].dataType.simpleString() for c in cols}
    names = [f"_e{i}" for i in range(len(cols))]
    ledger = None
    for gid, dim, spec in held:
        own = dim.selectExpr(f"CAST({gid} AS BIGINT) AS _eg", *[f"CAST({f'`{c}`' if c in spec.attrs else 'NULL'} AS {kinds[c]}) AS {n}"
                                                               for c, n in zip(cols, names)])
        ledger = own if ledger is None else ledger.unionByName(own)
    if fits_broadcast(ledger):
        ledger = F.broadcast(ledger)
    cond = null_safe_condition(members, ledger, cols, names) & (members["_gid"] == ledger["_eg"])
    return members.join(ledger, cond, "left_anti")


def build_dim(staged: DataFrame, spec: DimSpec, start: int = 0) -> DataFrame:
    """One member dimension: (key, *attrs, _rows)."""
    return build_dims(staged, [spec], start)[spec.name]


def dim_table(keyed: DataFrame) -> DataFrame:
    """The published dimension: drops the planning column."""
    return keyed.drop(ROWS) if ROWS in keyed.columns else keyed


def with_size_bands(dim: DataFrame, class_col: str = "fire_size_class") -> DataFrame:
    """Add lower_bound / upper_bound (DOUBLE) looked up by class letter; a
    class outside the table gets NULL bounds."""
    c = f"`{class_col}`"
    lower = " ".join(f"WHEN {c} = '{cls}' THEN CAST({lo} AS DOUBLE)" for cls, lo, _ in SIZE_BANDS)
    upper = " ".join(f"WHEN {c} = '{cls}' THEN CAST({'NULL' if hi is None else hi} AS DOUBLE)"
                     for cls, _, hi in SIZE_BANDS)
    return dim.selectExpr("*", f"CASE {lower} END AS lower_bound", f"CASE {upper} END AS upper_bound")


_CAL_TYPES = CALENDAR_TYPES


def calendar_size(start: str = CALENDAR_START, end: str = CALENDAR_END) -> int:
    return (_dt.date.fromisoformat(end) - _dt.date.fromisoformat(start)).days


def date_sequence(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END,
                  num_partitions: int | None = None) -> DataFrame:
    """All dates in [start, end) as column ``date``, generated in parallel by
    ``spark.range`` (no driver-side list)."""
    n = calendar_size(start, end)
    ids = spark.range(0, n, numPartitions=num_partitions) if num_partitions else spark.range(0, n)
    return ids.selectExpr(f"date_add(DATE'{start}', CAST(id AS INT)) AS date")


def build_dates(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END,
                key: str = DATES_KEY) -> DataFrame:
    """Calendar dimension, 1-based key in date order (arithmetic, no sort), and
    an ``unknown`` member with key max+1 and NULL attributes so that NULL dates
    still join through ``<=>``."""
    n = calendar_size(start, end)
    days = spark.range(0, n).selectExpr("id", f"date_add(DATE'{start}', CAST(id AS INT)) AS d")
    cal = calendar_sql("d")
    dates = days.selectExpr(f"CAST(id + 1 AS BIGINT) AS {key}", "'date' AS date_type",
                            *[f"CAST({cal[c]} AS {t}) AS {c}" for c, t in _CAL_TYPES.items()])
    unknown = spark.range(1).selectExpr(f"CAST({n + 1} AS BIGINT) AS {key}", "'unknown' AS date_type",
                                        *[f"CAST(NULL AS {t}) AS {c}" for c, t in _CAL_TYPES.items()])
    return dates.unionByName(unknown)


def more_dates(spark: SparkSession, first: str, end: str, origin: str, unknown: int, key: str = DATES_KEY) -> DataFrame:
    """Calendar rows of the days in [first, end) for a calendar whose first
    day, ``origin``, has key 1 and whose unknown member has key ``unknown``:
    keys count the days, and those from ``unknown`` on step over it, so that
    no stored key changes. Days before the origin get keys below 1."""
    days = (_dt.date.fromisoformat(end) - _dt.date.fromisoformat(first)).days
    begin = (_dt.date.fromisoformat(first) - _dt.date.fromisoformat(origin)).days
    cal = calendar_sql("d")
    return (spark.range(0, max(0, days)).selectExpr(f"id + {begin + 1} AS n", f"date_add(DATE'{first}', CAST(id AS INT)) AS d")
            .selectExpr(f"CAST(CASE WHEN n < {unknown} THEN n ELSE n + 1 END AS BIGINT) AS {key}", "'date' AS date_type",
                        *[f"CAST({cal[c]} AS {t}) AS {c}" for c, t in _CAL_TYPES.items()]))


def role_play(dim: DataFrame, prefix: str) -> DataFrame:
    """A prefixed copy of a dimension for one of its roles."""
    return prefix_names(dim, prefix)


def new_members(existing: DataFrame, staged: DataFrame, spec: DimSpec) -> DataFrame:
    """Members of ``staged`` that ``existing`` lacks, keyed after its maximum.

    New members come from a GROUP BY (partial aggregation) and a null-safe
    anti join against the existing members, broadcast only when their measured
    size is within the bound. Re-running with the output already
    appended finds nothing new, so an append of the result is idempotent.
    """
    cur = dim_table(existing).select(spec.key, *spec.attrs)
    members = staged.groupBy(*spec.attrs).agg(F.count(F.lit(1)).alias(ROWS))
    ref = cur.select(*[F.col(a).alias(f"_e{i}") for i, a in enumerate(spec.attrs)])
    if fits_broadcast(ref):
        ref = F.broadcast(ref)
    cond = null_safe_condition(members, ref, spec.attrs, [f"_e{i}" for i in range(len(spec.attrs))])
    new = members.join(ref, cond, "left_anti")
    top = cur.agg(F.max(spec.key).alias("m")).first()["m"]
    start = 0 if top is None else int(top) + 1
    return dense_key(new, list(spec.attrs), spec.key, start=start).select(spec.key, *spec.attrs)


def refresh_dim(existing: DataFrame, staged: DataFrame, spec: DimSpec) -> DataFrame:
    """Type-1 refresh: every existing (key, attrs) row unchanged, members not
    seen before appended with new dense keys after the current maximum."""
    cur = dim_table(existing).select(spec.key, *spec.attrs)
    return cur.unionByName(new_members(existing, staged, spec))
