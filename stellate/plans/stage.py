"""Staging: raw source frames -> typed, lower-cased frames ready for
modelling. Pure projections and one filter; Catalyst fuses them with the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.conform import cast_sql
from ..functions.temporal import date_time_sql, julian_to_date_sql
from ..specs import (COORD_DECIMAL, FIRE_COORD_COLS, FIRE_DATETIME_PREFIXES, FIRE_DROP_COLS,
                     FIRE_INT_COLS, FIRE_MONEY_COLS, FIRE_TIME_COLS, FIRE_TIME_FILL, MONEY_DECIMAL,
                     WEATHER_DATE_COL, WEATHER_LOWER_BOUND)


def stage_fires(raw: DataFrame) -> DataFrame:
    """Narrow decimals (try_cast: overflow or junk -> NULL, as the legacy
    non-ANSI cast did), fill missing HHMM times with 0000, turn each Julian
    date + HHMM time into a TIMESTAMP_NTZ, lower-case names, drop the parts."""
    # one projection (one call to the JVM): typed, filled, combined, renamed, pruned
    kinds = {**{c: ("INT", True) for c in FIRE_INT_COLS}, **{c: (MONEY_DECIMAL, True) for c in FIRE_MONEY_COLS},
             **{c: (COORD_DECIMAL, True) for c in FIRE_COORD_COLS}}
    typed = {c: (cast_sql(c, *kinds[c]) if c in kinds else f"`{c}`") for c in raw.columns}
    for c in FIRE_TIME_COLS:
        if c in typed:
            typed[c] = f"coalesce({typed[c]}, '{FIRE_TIME_FILL}')"
    out = [f"{e} AS `{c.lower()}`" for c, e in typed.items() if c.lower() not in FIRE_DROP_COLS]
    for p in FIRE_DATETIME_PREFIXES:
        if f"{p}_DATE" in typed and f"{p}_TIME" in typed:
            day = julian_to_date_sql(typed[f"{p}_DATE"])
            out.append(f"{date_time_sql(day, typed[f'{p}_TIME'])} AS `{p.lower()}_timestamp`")
    return raw.selectExpr(*out)


def stage_weather(raw: DataFrame, lower_bound: str = WEATHER_LOWER_BOUND,
                  date_col: str = WEATHER_DATE_COL) -> DataFrame:
    """Text date -> DATE (bad text -> NULL) and keep dates on/after the bound;
    NULL dates drop out. The filter is on a typed column, so on Parquet input
    it reaches the scan."""
    typed = raw.selectExpr(*[f"try_cast(`{c}` AS DATE) AS `{c}`" if c == date_col else f"`{c}`"
                             for c in raw.columns])
    return typed.filter(f"`{date_col}` >= DATE'{lower_bound}'")
