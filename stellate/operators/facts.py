"""Fact assembly: role-playing calendar joins plus null-safe joins to every
member dimension, then the fact projection."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..specs import DATES_KEY, FactSpec
from .joins import broadcast_bytes, broadcast_total_bytes, measure, null_safe_join, side_bytes


def join_dates(fact: DataFrame, dates: DataFrame, source: str, key_out: str,
               prefix: str = "", keep: bool = False) -> DataFrame:
    """Add the calendar key of ``source`` (a date or timestamp column).

    The calendar has one row per day of a fixed range plus the unknown member,
    so its size is bounded by construction and it is always broadcast. NULL
    dates match the unknown member; a date outside the calendar matches
    nothing and the row is dropped (``dropped_by_calendar`` counts those).
    """
    rd = f"_{prefix}rd"
    cal = F.broadcast(dates.selectExpr(f"{DATES_KEY} AS `{key_out}`", f"date_actual AS `{rd}`"))
    out = fact.join(cal, F.expr(f"CAST(`{source}` AS DATE) <=> `{rd}`"), "inner")
    return out if keep else out.drop(rd)


def star_join(staged: DataFrame, spec: FactSpec, dims: Mapping[str, DataFrame], dates: DataFrame,
              strategies: Mapping[str, str] | None = None, stats: Mapping | None = None) -> DataFrame:
    """Join ``staged`` to the calendar once per role and to each member
    dimension of ``spec``; the per-dimension strategy comes from
    ``strategies``, then the spec's ``broadcast`` flag, then a size check.
    Helper columns of the joins stay until the caller's final projection."""
    strategies = dict(strategies or {})
    stats = stats or {}
    f = staged
    for role in spec.roles:
        f = join_dates(f, dates, role.source, role.key_out, role.prefix, keep=True)
    # every broadcast dimension is held by every executor at once: keep their
    # sum under a budget; dimensions past it take the salted shuffle join
    budget = broadcast_total_bytes(staged)
    for ds in spec.dims:
        strat = strategies.get(ds.name)
        if strat is None:
            strat = "auto" if ds.broadcast is None or ds.broadcast else "salted"
        own = stats.get(ds.name)
        if strat in ("auto", "broadcast"):
            side = dims[ds.name].select(ds.key, *ds.attrs)
            own = own or measure(side)   # a dimension read back has no stats yet
            size = side_bytes(side, own)
            strat = "broadcast" if size <= min(budget, broadcast_bytes(staged)) else "salted"
            budget -= size if strat == "broadcast" else 0
        f = null_safe_join(f, dims[ds.name], ds.attrs, ds.key, strategy=strat,
                           salt_cols=list(spec.row_id) or None, stats=own,
                           keep_right=True, counted=staged)
    return f


def build_fact(staged: DataFrame, spec: FactSpec, dims: Mapping[str, DataFrame], dates: DataFrame,
               strategies: Mapping[str, str] | None = None, stats: Mapping | None = None) -> DataFrame:
    joined = star_join(staged, spec, dims, dates, strategies, stats)
    return joined.selectExpr(*[f"{expr} AS `{alias}`" for expr, alias in spec.select])


def calendar_misses(staged: DataFrame, spec: FactSpec, start: str, end: str) -> DataFrame:
    """Rows the inner calendar joins drop: some role date is set but outside
    [start, end). The reference dropped them silently; callers report the
    count (a filter, no join)."""
    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
    cond = None
    for role in spec.roles:
        d = F.col(role.source).cast("date")
        miss = d.isNotNull() & ((d < lo) | (d >= hi))
        cond = miss if cond is None else (cond | miss)
    return staged.filter(cond)


def role_date_report(staged: DataFrame, spec: FactSpec, start: str, end: str) -> DataFrame:
    """(fact, role, dropped, unknown) per calendar role in one aggregation:
    ``dropped`` rows have a date outside [start, end) and fall out of the
    inner join; ``unknown`` rows have no date and get the unknown member."""
    aggs = []
    for r in spec.roles:
        d = f"CAST(`{r.source}` AS DATE)"
        aggs.append(f"count_if({d} IS NOT NULL AND ({d} < DATE'{start}' OR {d} >= DATE'{end}')) AS `{r.key_out}__d`")
        aggs.append(f"count_if({d} IS NULL) AS `{r.key_out}__u`")
    one = staged.agg(*[F.expr(a) for a in aggs])
    triples = ", ".join(f"'{r.key_out}', `{r.key_out}__d`, `{r.key_out}__u`" for r in spec.roles)
    return one.selectExpr(f"'{spec.name}' AS fact", f"stack({len(spec.roles)}, {triples}) AS (role, dropped, unknown)")
