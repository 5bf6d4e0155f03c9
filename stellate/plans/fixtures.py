"""Wildfire- and weather-shaped raw frames derived from the driver tables.

The fixture SQL text is shared by the Spark side (run over DataFrames put in
place of the table names) and by the DuckDB oracle, so both start from
identical rows. It holds the awkward rows that staging must survive: missing
and impossible times, dates outside the calendar, every size class and an
unknown one, members with all attributes NULL, bad dates and coordinates.
The Spark side then re-encodes the rows the way the raw sources deliver them
(upper-case names, wide decimals, Julian dates, HHMM text, all-text CSV) and
runs the real staging/modelling code on them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.temporal import date_to_julian_sql
from ..sources.readers import run_sql
from ..specs import WEATHER_LOWER_BOUND


def _is_clock(t: str) -> str:
    """Whether a time text is a time: hours of one or two digits, or HHMM."""
    t = f"coalesce({t}, '0000')"
    return (f"(CASE WHEN length({t}) = 4 THEN substr({t}, 1, 2) < '24' AND substr({t}, 3, 2) < '60' "
            f"WHEN length({t}) = 2 THEN {t} < '24' ELSE length({t}) = 1 END)")


def _hhmm(n: str, m: str) -> str:
    return f"lpad(CAST({n} % 24 AS STRING), 2, '0') || lpad(CAST({m} % 60 AS STRING), 2, '0')"


_K = "o.o_orderkey"
# disc_day and cont_day are the dates that survive staging: NULL where the
# time beside them is none.
FX_FIRES_TEMPLATE = f"""
SELECT x.*, CASE WHEN {_is_clock('disc_time')} THEN disc_date END AS disc_day,
  CASE WHEN {_is_clock('cont_time')} THEN cont_date END AS cont_day
FROM (SELECT {_K} AS objectid,
  'FPA-' || CAST({_K} AS STRING) AS fpa_id,
  CAST(o.o_orderdate AS DATE) - CASE WHEN {_K} % 101 = 0 THEN 4000 ELSE 0 END AS disc_date,
  CASE WHEN o.o_orderstatus = 'O' THEN NULL ELSE CAST(o.o_orderdate AS DATE) + CAST({_K} % 9 AS INT) END AS cont_date,
  CASE WHEN {_K} % 11 = 0 THEN NULL WHEN {_K} % 29 = 1 THEN '905' WHEN {_K} % 29 = 2 THEN '5'
       WHEN {_K} % 29 = 3 THEN '2400' WHEN {_K} % 29 = 4 THEN '130559' WHEN {_K} % 29 = 5 THEN ''
       WHEN {_K} % 29 = 6 THEN '17' ELSE {_hhmm(_K, _K)} END AS disc_time,
  CASE WHEN o.o_orderstatus = 'O' OR {_K} % 13 = 0 THEN NULL WHEN {_K} % 31 = 1 THEN '905'
       WHEN {_K} % 31 = 2 THEN '7' WHEN {_K} % 31 = 3 THEN '2360'
       ELSE {_hhmm(f'({_K} * 7 + 3)', f'({_K} * 11 + 5)')} END AS cont_time,
  CAST(substr(o.o_orderpriority, 1, 1) AS INT) AS stat_cause_code,
  nullif(o.o_orderpriority, '3-MEDIUM') AS stat_cause_descr,
  CASE WHEN {_K} % 47 <> 0 THEN CAST(c.c_nationkey % 4 AS INT) END AS owner_code,
  CASE WHEN {_K} % 47 <> 0 THEN nullif(c.c_mktsegment, 'FURNITURE') END AS owner_descr,
  r.r_name AS state, nullif(n.n_name, 'NATION_3') AS fips_name,
  CASE WHEN {_K} % 53 = 0 THEN 'Z' WHEN o.o_totalprice < 50000 THEN 'A' WHEN o.o_totalprice < 100000 THEN 'B'
       WHEN o.o_totalprice < 150000 THEN 'C' WHEN o.o_totalprice < 200000 THEN 'D' WHEN o.o_totalprice < 250000 THEN 'E'
       WHEN o.o_totalprice < 300000 THEN 'F' ELSE 'G' END AS fire_size_class,
  o.o_totalprice AS fire_size,
  CASE WHEN {_K} % 43 <> 0 THEN o.o_orderstatus END AS source_system_type,
  CASE WHEN {_K} % 43 <> 0 THEN c.c_mktsegment END AS source_system,
  CASE WHEN {_K} % 43 <> 0 THEN 'SRU-' || CAST(n.n_nationkey AS STRING) END AS source_reporting_unit,
  CASE WHEN {_K} % 43 <> 0 THEN n.n_name END AS source_reporting_unit_name,
  CASE WHEN o.o_custkey % 41 <> 0 THEN r.r_name END AS nwcg_reporting_agency,
  CASE WHEN o.o_custkey % 41 <> 0 THEN 'UNIT-' || CAST(o.o_custkey % 40 AS STRING) END AS nwcg_reporting_unit_id,
  CASE WHEN o.o_custkey % 41 <> 0 THEN nullif(n.n_name, 'NATION_7') END AS nwcg_reporting_unit_name,
  CASE WHEN {_K} % 3 = 0 THEN NULL ELSE 'FIRE-' || CAST(o.o_custkey AS STRING) END AS fire_name,
  CASE WHEN {_K} % 5 = 0 THEN 'ICS-' || CAST(o.o_custkey % 50 AS STRING) END AS ics_209_name,
  CASE WHEN {_K} % 2 = 0 THEN 'FC-' || CAST({_K} % 13 AS STRING) END AS fire_code,
  CASE WHEN o.o_totalprice >= 300000 THEN 'MTBS-' || CAST(o.o_custkey AS STRING) END AS mtbs_fire_name,
  CAST(n.n_nationkey AS DOUBLE) + 30.25 AS latitude,
  -70.12345678 - CAST(c.c_custkey % 90 AS DOUBLE) AS longitude
FROM {{orders}} o JOIN {{customer}} c ON o.o_custkey = c.c_custkey
JOIN {{nation}} n ON c.c_nationkey = n.n_nationkey JOIN {{region}} r ON n.n_regionkey = r.r_regionkey) x
"""

# Weather outliers as the CSV delivers them: every column text, plus the two
# columns the job drops at ingest.
FX_WEATHER_RAW_TEMPLATE = """
SELECT CAST(event_id AS STRING) AS id, 'STATION-' || CAST(user_id AS STRING) AS station_name,
  CAST(event_id AS STRING) AS serialid,
  CASE WHEN event_id % 997 = 0 THEN '1991-12-31' WHEN event_id % 997 = 1 THEN '1992-01-01' WHEN event_id % 997 = 2 THEN NULL
       WHEN event_id % 997 = 3 THEN 'no date' WHEN event_id % 997 = 4 THEN '2040-01-01'
       ELSE CAST(CAST(ts AS DATE) - CAST(event_id % 2300 + 8035 AS INT) AS STRING) END AS date_str,
  CASE WHEN event_id % 23 <> 0 THEN event_type END AS type, CAST(user_id % 50 - 125 AS STRING) AS longitude,
  CASE WHEN event_id % 499 = 7 THEN 'n/a' ELSE CAST(user_id % 20 + 30 AS STRING) END AS latitude,
  CAST(event_id % 97 AS STRING) AS max_temp, CAST(event_id % 89 - 40 AS STRING) AS min_temp
FROM {events}
"""

FX_WEATHER_LOWER_BOUND = WEATHER_LOWER_BOUND

FIRE_TABLES = ("orders", "customer", "nation", "region")
FX_FIRES_SQL = FX_FIRES_TEMPLATE.format(**{t: t for t in FIRE_TABLES})
FX_WEATHER_RAW_SQL = FX_WEATHER_RAW_TEMPLATE.format(events="events")

# lower-case fixture column -> raw source column (and how it is encoded)
_RAW_TEXT = ("fpa_id", "stat_cause_descr", "owner_descr", "state", "fips_name", "fire_size_class",
             "source_system_type", "source_system", "source_reporting_unit",
             "source_reporting_unit_name", "nwcg_reporting_agency", "nwcg_reporting_unit_id",
             "nwcg_reporting_unit_name", "fire_name", "ics_209_name", "fire_code", "mtbs_fire_name")
_WIDE = "decimal(38,18)"


def fx_fires(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, FX_FIRES_TEMPLATE, sf_dir, FIRE_TABLES)


def raw_fires(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture re-encoded like the JDBC source: upper-case names, wide
    decimals, Julian dates, HHMM text."""
    fx = fx_fires(spark, sf_dir)
    cols = ["objectid AS OBJECTID"] + [f"{c} AS {c.upper()}" for c in _RAW_TEXT] + [
        f"CAST(year(disc_date) AS {_WIDE}) AS FIRE_YEAR",
        f"{date_to_julian_sql('disc_date')} AS DISCOVERY_DATE",
        f"CAST(dayofyear(disc_date) AS {_WIDE}) AS DISCOVERY_DOY",
        "disc_time AS DISCOVERY_TIME",
        f"{date_to_julian_sql('cont_date')} AS CONT_DATE",
        f"CAST(dayofyear(cont_date) AS {_WIDE}) AS CONT_DOY",
        "cont_time AS CONT_TIME",
        f"CAST(stat_cause_code AS {_WIDE}) AS STAT_CAUSE_CODE",
        f"CAST(owner_code AS {_WIDE}) AS OWNER_CODE",
        f"CAST(fire_size AS {_WIDE}) AS FIRE_SIZE",
        f"CAST(latitude AS {_WIDE}) AS LATITUDE",
        f"CAST(longitude AS {_WIDE}) AS LONGITUDE",
    ]
    return fx.selectExpr(*cols)


def raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, FX_WEATHER_RAW_TEMPLATE, sf_dir, ("events",))
