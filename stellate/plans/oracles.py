"""DuckDB-runnable SQL that states, independently of the Spark code, what the
queries must return. Dimension keys are ``row_number() - 1`` over the
distinct members ordered by every attribute NULLS FIRST; ``<=>`` is
``IS NOT DISTINCT FROM``."""

from __future__ import annotations

from collections.abc import Sequence

from ..operators.dims import calendar_size
from ..specs import CALENDAR_END, CALENDAR_START, SIZE_BANDS, DimSpec
from .fixtures import FX_FIRES_SQL, FX_WEATHER_LOWER_BOUND, FX_WEATHER_RAW_SQL

UNKNOWN_DATE_ID = calendar_size(CALENDAR_START, CALENDAR_END) + 1


def dim_cte(spec: DimSpec, source: str = "fx", name: str | None = None) -> str:
    attrs = ", ".join(spec.attrs)
    order = ", ".join(f"{a} NULLS FIRST" for a in spec.attrs)
    return (f"{name or spec.name} AS (SELECT CAST(row_number() OVER (ORDER BY {order}) - 1 AS BIGINT) AS {spec.key}, "
            f"{attrs} FROM (SELECT DISTINCT {attrs} FROM {source}) t)")


def dim_join(spec: DimSpec, left: str = "fx", name: str | None = None) -> str:
    n = name or spec.name
    cond = " AND ".join(f"{left}.{a} IS NOT DISTINCT FROM {n}.{a}" for a in spec.attrs)
    return f"JOIN {n} ON {cond}"


def date_id(col: str) -> str:
    return (f"CASE WHEN {col} IS NULL THEN CAST({UNKNOWN_DATE_ID} AS BIGINT) "
            f"ELSE CAST(datediff('day', DATE '{CALENDAR_START}', {col}) + 1 AS BIGINT) END")


def in_calendar(col: str) -> str:
    return f"({col} IS NULL OR ({col} >= DATE '{CALENDAR_START}' AND {col} < DATE '{CALENDAR_END}'))"


def stamp_text(day: str, time_col: str) -> str:
    """Timestamp text of a surviving date and its time."""
    t = f"coalesce({time_col}, '0000')"
    return (f"CASE WHEN {day} IS NULL THEN NULL ELSE strftime({day}, '%Y-%m-%d') || ' ' || "
            f"CASE WHEN length({t}) = 4 THEN substr({t}, 1, 2) || ':' || substr({t}, 3, 2) ELSE lpad({t}, 2, '0') || ':00' END || ':00' END")


def size_band_cols(col: str = "fire_size_class") -> str:
    lo = " ".join(f"WHEN {col} = '{c}' THEN CAST({l} AS DOUBLE)" for c, l, _ in SIZE_BANDS)
    hi = " ".join(f"WHEN {col} = '{c}' THEN CAST({'NULL' if h is None else h} AS DOUBLE)" for c, _, h in SIZE_BANDS)
    return f"CASE {lo} END AS lower_bound, CASE {hi} END AS upper_bound"


def with_fx(body: str, ctes: Sequence[str] = ()) -> str:
    parts = [f"fx AS ({FX_FIRES_SQL})"] + list(ctes)
    return "WITH " + ",\n".join(parts) + "\n" + body


def with_weather(body: str, ctes: Sequence[str] = ()) -> str:
    parts = [f"wx AS (SELECT serialid, TRY_CAST(date_str AS DATE) AS date_str, type, longitude, latitude, "
             f"max_temp, min_temp FROM ({FX_WEATHER_RAW_SQL}) r "
             f"WHERE TRY_CAST(date_str AS DATE) >= DATE '{FX_WEATHER_LOWER_BOUND}')"] + list(ctes)
    return "WITH " + ",\n".join(parts) + "\n" + body


def dates_cte(name: str = "dates", start: str | None = None, end: str | None = None,
              bounds: str | None = None) -> str:
    """The calendar dimension in DuckDB. With ``bounds`` (a SELECT giving
    timestamps ``s`` and exclusive ``e``) the range comes from data."""
    if bounds is None:
        start, end = start or CALENDAR_START, end or CALENDAR_END
        bounds = f"SELECT TIMESTAMP '{start}' AS s, TIMESTAMP '{end}' AS e"
    attrs = """CAST(d AS DATE) AS date_actual, CAST(epoch(d) AS BIGINT) AS epoch, dayname(d) AS day_name,
      CAST(dayofweek(d) + 1 AS INT) AS day_of_week, CAST(day(d) AS INT) AS day_of_month,
      CAST(dayofyear(d) AS INT) AS day_of_year,
      CAST(CAST(ceil((day(d) + dayofweek(date_trunc('month', d))) / 7.0) AS INT) AS VARCHAR) AS week_of_month,
      CAST(weekofyear(d) AS INT) AS week_of_year, CAST(month(d) AS INT) AS month_actual,
      monthname(d) AS month_name, strftime(d, '%b') AS month_name_abbreviated,
      CAST(quarter(d) AS INT) AS quarter_actual,
      CASE quarter(d) WHEN 1 THEN 'First' WHEN 2 THEN 'Second' WHEN 3 THEN 'Third' WHEN 4 THEN 'Fourth' END AS quarter_name,
      CAST(year(d) AS INT) AS year_actual"""
    nulls = """CAST(NULL AS DATE), CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS INT), CAST(NULL AS INT),
      CAST(NULL AS INT), CAST(NULL AS VARCHAR), CAST(NULL AS INT), CAST(NULL AS INT), CAST(NULL AS VARCHAR),
      CAST(NULL AS VARCHAR), CAST(NULL AS INT), CAST(NULL AS VARCHAR), CAST(NULL AS INT)"""
    return f"""{name}_b AS ({bounds}),
{name}_g AS (SELECT s, unnest(generate_series(s, e - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d FROM {name}_b),
{name} AS (
  SELECT CAST(datediff('day', s, d) + 1 AS BIGINT) AS date_dim_id, 'date' AS date_type, {attrs} FROM {name}_g
  UNION ALL
  SELECT CAST(datediff('day', s, e) + 1 AS BIGINT), 'unknown', {nulls} FROM {name}_b)"""
