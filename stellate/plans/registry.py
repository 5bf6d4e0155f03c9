"""Registered queries (Spark side) and their oracle SQL (DuckDB side).

Every query reads the driver tables under ``sf_dir`` (or frames Spark derives
from them) in full; a LIMIT appears only where it is the feature (preview).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.conform import cast_columns, columns_of_type, fill_default, lower_names
from ..functions.temporal import date_time, date_to_julian, julian_to_date
from ..operators.dims import (build_dates, build_dim, build_dims_with_stats, calendar_size, date_sequence, dim_table, refresh_dim,
                              role_play, with_size_bands)
from ..operators.facts import role_date_report
from ..operators.joins import null_safe_join
from ..operators.keys import dense_key
from ..operators.quality import (duplicate_key_report, max_profile, null_key_report, null_profile, orphan_report,
                                 row_count_report, schema_profile)
from ..operators.layout import read_clustered, write_clustered
from ..session import fresh_path
from ..sources.readers import even_ranges, read_csv, read_table
from ..specs import (CALENDAR_END, CALENDAR_START, DATES_KEY, FIRE_CAUSES, FIRE_DIMS, FIRE_NAMES,
                     FIRE_SIZES, FIRES_FACT, LOCATIONS, OWNERS, REPORTERS, WEATHER_FACT, WEATHER_TYPES, DimSpec)
from . import oracles as O
from .fixtures import FX_WEATHER_LOWER_BOUND, FX_WEATHER_RAW_SQL, raw_fires, raw_weather
from .job import KEYS, build_lake, foreign_keys
from .cells import CellMart
from .evolve import Drift, Narrowing, append_evolving, republish
from .lake import publish, write_dim, write_fact, write_tables
from .marts import (cell_check, containment_efficiency, coordinate_overlay, cube_mart, distance_overlay, grouping_sets_mart,
                    kmeans_cells, time_between)
from .model import fire_model, weather_model
from .stage import stage_fires, stage_weather
from .upkeep import apply_staged, extend_dates, refresh_dates, refresh_dimensions, replay_quarantine
from .versions import Change, Version, commit_with, one_folder, read_lake, read_version, vacuum, version
from ..streaming.newest import start_newest
from ..streaming.refresh import FIRES, WEATHER, apply_batch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_fires(raw_fires(spark, sf_dir))


def _weather_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_weather(spark, sf_dir).drop("id", "station_name")


# --------------------------------------------------------------------------
# C6 / J6: the full wildfire star (2 calendar roles + 7 member dimensions)
# --------------------------------------------------------------------------
def _fact_star_body() -> str:
    joins = "\n".join(O.dim_join(d) for d in FIRE_DIMS)
    keys = ", ".join(f"{d.name}.{d.key} AS {d.key}" for d in FIRE_DIMS)
    return f"""
SELECT fx.objectid AS fire_id, fx.fpa_id AS fpa_id,
  {O.date_id('fx.disc_day')} AS discovery_date_id, {O.date_id('fx.cont_day')} AS cont_date_id,
  {keys},
  CAST(fx.fire_size AS DECIMAL(10,2)) AS fire_size, CAST(fx.latitude AS DECIMAL(11,8)) AS latitude,
  CAST(year(fx.disc_date) AS INT) AS fire_year, CAST(fx.longitude AS DECIMAL(11,8)) AS longitude,
  {O.stamp_text('fx.disc_day', 'fx.disc_time')} AS discovery_timestamp,
  {O.stamp_text('fx.cont_day', 'fx.cont_time')} AS cont_timestamp,
  CAST(year(fx.disc_date) AS INT) AS year
FROM fx
{joins}
WHERE {O.in_calendar('fx.disc_day')} AND {O.in_calendar('fx.cont_day')}"""


def _fire_ctes() -> list[str]:
    return [O.dim_cte(d) for d in FIRE_DIMS]


_WEATHER_FACT_BODY = f"""
SELECT wx.serialid AS weather_outlier_id, {O.date_id('wx.date_str')} AS weather_date_dim_id,
  weather_types.weather_type_id AS weather_type_id, wx.longitude AS longitude, wx.latitude AS latitude,
  wx.max_temp AS max_temp, wx.min_temp AS min_temp, CAST(year(wx.date_str) AS INT) AS year
FROM wx {O.dim_join(WEATHER_TYPES, 'wx')}
WHERE {O.in_calendar('wx.date_str')}"""


FACT_STAR_SQL = O.with_fx(_fact_star_body(), _fire_ctes())
FACT_STAR_CTES = _fire_ctes() + [f"fires_fact AS ({_fact_star_body()})"]


@query("fact_star", FACT_STAR_SQL)
def fact_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fire_model(spark, raw_fires(spark, sf_dir)).fact


# --------------------------------------------------------------------------
# Joins J1-J5
# --------------------------------------------------------------------------
OWNER_DESCRS = DimSpec("owner_descrs", "owner_descr_id", ("owner_descr",))


@query("join_nullsafe_1", O.with_fx(
    f"SELECT fx.objectid AS objectid, fx.owner_descr AS owner_descr, owner_descrs.owner_descr_id AS owner_descr_id "
    f"FROM fx {O.dim_join(OWNER_DESCRS)}", [O.dim_cte(OWNER_DESCRS)]))
def join_nullsafe_1(spark, sf_dir):
    staged = _staged(spark, sf_dir)
    dims, stats = build_dims_with_stats(staged, [OWNER_DESCRS])
    return (null_safe_join(staged.select("objectid", "owner_descr"), dims["owner_descrs"], OWNER_DESCRS.attrs,
                           OWNER_DESCRS.key, strategy="broadcast", stats=stats["owner_descrs"])
            .select("objectid", "owner_descr", "owner_descr_id"))


@query("join_nullsafe_n", O.with_fx(
    f"SELECT fx.objectid AS objectid, reporters.reporter_id AS reporter_id, locations.location_id AS location_id "
    f"FROM fx {O.dim_join(REPORTERS)} {O.dim_join(LOCATIONS)}", [O.dim_cte(REPORTERS), O.dim_cte(LOCATIONS)]))
def join_nullsafe_n(spark, sf_dir):
    staged = _staged(spark, sf_dir)
    f = staged
    dims, stats = build_dims_with_stats(staged, (REPORTERS, LOCATIONS))
    for spec in (REPORTERS, LOCATIONS):
        f = null_safe_join(f, dims[spec.name], spec.attrs, spec.key, stats=stats[spec.name])
    return f.select("objectid", "reporter_id", "location_id")


@query("join_broadcast", O.with_fx(
    f"SELECT fx.objectid AS objectid, fire_causes.fire_cause_id AS fire_cause_id FROM fx {O.dim_join(FIRE_CAUSES)}",
    [O.dim_cte(FIRE_CAUSES)]))
def join_broadcast(spark, sf_dir):
    staged = _staged(spark, sf_dir)
    dims, stats = build_dims_with_stats(staged, [FIRE_CAUSES])
    return (null_safe_join(staged, dims["fire_causes"], FIRE_CAUSES.attrs, FIRE_CAUSES.key, strategy="broadcast",
                           stats=stats["fire_causes"])
            .select("objectid", "fire_cause_id"))


@query("join_shuffle", O.with_fx(
    f"SELECT fx.objectid AS objectid, fire_names.fire_name_id AS fire_name_id FROM fx {O.dim_join(FIRE_NAMES)}",
    [O.dim_cte(FIRE_NAMES)]))
def join_shuffle(spark, sf_dir):
    """High-cardinality dimension: no broadcast; hot members are salted."""
    staged = _staged(spark, sf_dir)
    dim = build_dim(staged, FIRE_NAMES)
    return (null_safe_join(staged, dim, FIRE_NAMES.attrs, FIRE_NAMES.key, strategy="salted",
                           salt_cols=["objectid"])
            .select("objectid", "fire_name_id"))


@query("role_playing_dates", O.with_fx(
    f"""SELECT fx.objectid AS objectid, dd.date_dim_id AS disc_date_dim_id, dd.day_name AS disc_day_name,
      dd.quarter_name AS disc_quarter_name, cd.date_dim_id AS cont_date_dim_id, cd.month_name AS cont_month_name,
      cd.date_type AS cont_date_type
    FROM fx JOIN dates dd ON fx.disc_day IS NOT DISTINCT FROM dd.date_actual
    JOIN dates cd ON fx.cont_day IS NOT DISTINCT FROM cd.date_actual""", [O.dates_cte()]))
def role_playing_dates(spark, sf_dir):
    staged = _staged(spark, sf_dir)
    dates = build_dates(spark)
    disc, cont = F.broadcast(role_play(dates, "disc_")), F.broadcast(role_play(dates, "cont_"))
    f = staged.select("objectid", F.col("discovery_timestamp").cast("date").alias("d_day"),
                      F.col("cont_timestamp").cast("date").alias("c_day"))
    f = f.join(disc, F.col("d_day").eqNullSafe(F.col("disc_date_actual")), "inner")
    f = f.join(cont, F.col("c_day").eqNullSafe(F.col("cont_date_actual")), "inner")
    return f.select("objectid", "disc_date_dim_id", "disc_day_name", "disc_quarter_name",
                    "cont_date_dim_id", "cont_month_name", "cont_date_type")


# --------------------------------------------------------------------------
# Aggregation / dimension building A1, C3, C4, W1, F4/F5
# --------------------------------------------------------------------------
@query("distinct_members", O.with_fx("SELECT DISTINCT state, fips_name, stat_cause_descr FROM fx"))
def distinct_members(spark, sf_dir):
    return _staged(spark, sf_dir).select("state", "fips_name", "stat_cause_descr").distinct()


@query("dim_build", O.with_fx("SELECT * FROM fire_names", [O.dim_cte(FIRE_NAMES)]))
def dim_build(spark, sf_dir):
    return dim_table(build_dim(_staged(spark, sf_dir), FIRE_NAMES))


@query("size_bands", O.with_fx(
    f"SELECT fire_size_id, fire_size_class, {O.size_band_cols()} FROM fire_sizes", [O.dim_cte(FIRE_SIZES)]))
def size_bands(spark, sf_dir):
    return dim_table(with_size_bands(build_dim(_staged(spark, sf_dir), FIRE_SIZES)))


@query("surrogate_key", """
SELECT CAST(row_number() OVER (ORDER BY a NULLS FIRST, b NULLS FIRST, s NULLS FIRST) - 1 AS BIGINT) AS id, a, b, s
FROM (SELECT DISTINCT nullif(p_brand, 'Brand#13') AS a, nullif(p_type, 'ECONOMY') AS b, p_size AS s FROM part) t""")
def surrogate_key(spark, sf_dir):
    part = read_table(spark, sf_dir, "part")
    members = part.select(F.expr("nullif(p_brand, 'Brand#13')").alias("a"),
                          F.expr("nullif(p_type, 'ECONOMY')").alias("b"),
                          F.col("p_size").alias("s")).distinct()
    return dense_key(members, ["a", "b", "s"], "id")


@query("agg_max", O.with_fx("SELECT max(fire_name_id) AS max_fire_name_id FROM fire_names",
                            [O.dim_cte(FIRE_NAMES)]))
def agg_max(spark, sf_dir):
    dim = build_dim(_staged(spark, sf_dir), FIRE_NAMES)
    return dim.agg(F.max("fire_name_id").alias("max_fire_name_id"))


@query("dim_refresh", """
WITH m AS (SELECT DISTINCT o_orderpriority AS priority, CAST(year(o_orderdate) AS INT) AS yr FROM orders),
old AS (SELECT CAST(row_number() OVER (ORDER BY priority NULLS FIRST, yr NULLS FIRST) - 1 AS BIGINT) AS member_id,
          priority, yr FROM m WHERE yr <= 1997),
fresh AS (SELECT * FROM m WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.priority IS NOT DISTINCT FROM m.priority
                                             AND old.yr IS NOT DISTINCT FROM m.yr))
SELECT * FROM old
UNION ALL
SELECT CAST((SELECT max(member_id) FROM old) + row_number() OVER (ORDER BY priority NULLS FIRST, yr NULLS FIRST) AS BIGINT),
       priority, yr FROM fresh""")
def dim_refresh(spark, sf_dir):
    """Type-1 refresh: members of 1995-1997 first, then all orders; old keys
    never change and new members get keys after the old maximum."""
    spec = DimSpec("priorities", "member_id", ("priority", "yr"))
    orders = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("priority"), F.year("o_orderdate").cast("int").alias("yr"))
    first = dim_table(build_dim(orders.filter(F.col("yr") <= 1997), spec))
    return refresh_dim(first, orders, spec)


# --------------------------------------------------------------------------
# Staging C1, C2 and its parts P4, P5, P8-P14, F1, F3, X1-X4
# --------------------------------------------------------------------------
_TEXT = ("fpa_id", "stat_cause_descr", "owner_descr", "state", "fips_name", "fire_size_class",
         "source_system_type", "source_system", "source_reporting_unit", "source_reporting_unit_name",
         "nwcg_reporting_agency", "nwcg_reporting_unit_id", "nwcg_reporting_unit_name", "fire_name",
         "ics_209_name", "fire_code", "mtbs_fire_name")


@query("stage_fires", O.with_fx(f"""
SELECT objectid, {', '.join(_TEXT)}, CAST(year(disc_date) AS INT) AS fire_year,
  stat_cause_code, owner_code, CAST(fire_size AS DECIMAL(10,2)) AS fire_size,
  CAST(latitude AS DECIMAL(11,8)) AS latitude, CAST(longitude AS DECIMAL(11,8)) AS longitude,
  {O.stamp_text('disc_day', 'disc_time')} AS discovery_timestamp,
  {O.stamp_text('cont_day', 'cont_time')} AS cont_timestamp
FROM fx"""))
def stage_fires_q(spark, sf_dir):
    staged = _staged(spark, sf_dir)
    return staged.withColumns({"discovery_timestamp": F.col("discovery_timestamp").cast("string"),
                               "cont_timestamp": F.col("cont_timestamp").cast("string")})


@query("fill_default", O.with_fx("""
SELECT objectid, coalesce(disc_time, '0000') AS discovery_time,
  coalesce(cont_time, '0000') AS cont_time FROM fx"""))
def fill_default_q(spark, sf_dir):
    raw = fill_default(raw_fires(spark, sf_dir), "0000", ["DISCOVERY_TIME", "CONT_TIME"])
    return raw.select(F.col("OBJECTID").alias("objectid"), F.col("DISCOVERY_TIME").alias("discovery_time"),
                      F.col("CONT_TIME").alias("cont_time"))


@query("rename_lower", O.with_fx(f"SELECT objectid, {', '.join(_TEXT)} FROM fx"))
def rename_lower(spark, sf_dir):
    low = lower_names(raw_fires(spark, sf_dir))
    return low.select("objectid", *_TEXT)


@query("stage_weather", O.with_weather("SELECT * FROM wx"))
def stage_weather_q(spark, sf_dir):
    return stage_weather(_weather_raw(spark, sf_dir), FX_WEATHER_LOWER_BOUND)


@query("fact_events", O.with_weather(_WEATHER_FACT_BODY, [O.dim_cte(WEATHER_TYPES, 'wx')]))
def fact_events(spark, sf_dir):
    return weather_model(spark, _weather_raw(spark, sf_dir), FX_WEATHER_LOWER_BOUND).fact


@query("julian_to_date", """
SELECT o_orderkey, CAST(datediff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) + 2440587.5 AS DECIMAL(10,2)) AS jd,
  CAST(o_orderdate AS DATE) AS d FROM orders""")
def julian_to_date_q(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    jd = date_to_julian(F.col("o_orderdate").cast("date")).cast("decimal(10,2)")
    return o.select("o_orderkey", jd.alias("jd")).select("o_orderkey", "jd", julian_to_date("jd").alias("d"))


@query("date_time_concat", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M') || ':00' AS ts FROM events")
def date_time_concat(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    stamp = date_time(F.col("ts").cast("date"), F.date_format("ts", "HHmm"))
    return e.select("event_id", stamp.cast("string").alias("ts"))


@query("cast_narrow_int", """
SELECT l_orderkey, l_linenumber, CAST(trunc(l_quantity) AS INT) AS quantity,
  CAST(trunc(l_extendedprice) AS INT) AS extendedprice FROM lineitem""")
def cast_narrow_int(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    wide = cast_columns(li, ["l_quantity", "l_extendedprice"], "decimal(38,18)")
    out = cast_columns(wide, ["l_quantity", "l_extendedprice"], "int", safe=True)
    return out.select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("quantity"),
                      F.col("l_extendedprice").alias("extendedprice"))


@query("cast_decimal", """
SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(10,2)) AS extendedprice,
  CAST(l_discount AS DECIMAL(11,8)) AS discount FROM lineitem""")
def cast_decimal(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    wide = cast_columns(li, ["l_extendedprice", "l_discount"], "decimal(38,18)")
    out = cast_columns(cast_columns(wide, ["l_extendedprice"], "decimal(10,2)", safe=True),
                       ["l_discount"], "decimal(11,8)", safe=True)
    return out.select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("extendedprice"),
                      F.col("l_discount").alias("discount"))


# --------------------------------------------------------------------------
# Calendar C5, S4, X5-X16, U1
# --------------------------------------------------------------------------
_ORDER_YEARS = ("SELECT CAST(make_date(CAST(min(year(o_orderdate)) AS INT), 1, 1) AS TIMESTAMP) AS s, "
                "CAST(make_date(CAST(max(year(o_orderdate)) AS INT) + 1, 1, 1) AS TIMESTAMP) AS e FROM orders")


def _order_year_bounds(spark, sf_dir) -> tuple[str, str]:
    r = read_table(spark, sf_dir, "orders").agg(F.min(F.year("o_orderdate")).alias("a"),
                                                F.max(F.year("o_orderdate")).alias("b")).first()
    return f"{r['a']:04d}-01-01", f"{r['b'] + 1:04d}-01-01"


@query("dim_dates", "WITH " + O.dates_cte(bounds=_ORDER_YEARS) + " SELECT * FROM dates")
def dim_dates(spark, sf_dir):
    """Calendar over the whole years the orders span, plus the unknown member."""
    start, end = _order_year_bounds(spark, sf_dir)
    return build_dates(spark, start, end)


@query("date_sequence", """
WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) AS e FROM orders)
SELECT CAST(unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM b""")
def date_sequence_q(spark, sf_dir):
    r = read_table(spark, sf_dir, "orders").agg(F.min("o_orderdate").cast("date").alias("a"),
                                                F.max("o_orderdate").cast("date").alias("b")).first()
    end = r["b"] + dt.timedelta(days=1)          # the sequence end is exclusive
    return date_sequence(spark, r["a"].isoformat(), end.isoformat())


# --------------------------------------------------------------------------
# Profiling C9 (P15, A3, A5, O3) and quality C8 (A4, A6, A7, U2), previews O2
# --------------------------------------------------------------------------
_RAW_NULL_SOURCE = {  # raw column -> fixture condition that makes it NULL
    "OBJECTID": "objectid IS NULL", "FIRE_YEAR": "disc_date IS NULL", "DISCOVERY_DATE": "disc_date IS NULL",
    "DISCOVERY_DOY": "disc_date IS NULL", "DISCOVERY_TIME": "disc_time IS NULL", "CONT_DATE": "cont_date IS NULL",
    "CONT_DOY": "cont_date IS NULL", "CONT_TIME": "cont_time IS NULL",
    "STAT_CAUSE_CODE": "stat_cause_code IS NULL", "OWNER_CODE": "owner_code IS NULL",
    "FIRE_SIZE": "fire_size IS NULL", "LATITUDE": "latitude IS NULL", "LONGITUDE": "longitude IS NULL",
}
_RAW_NULL_SOURCE.update({c.upper(): f"{c} IS NULL" for c in _TEXT})


@query("profile_nulls", O.with_fx(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {cond}) AS countna FROM fx"
    for c, cond in _RAW_NULL_SOURCE.items())))
def profile_nulls(spark, sf_dir):
    return null_profile(raw_fires(spark, sf_dir))


@query("profile_max", O.with_fx("""
SELECT CAST(max(datediff('day', DATE '1970-01-01', disc_date)) + 2440587.5 AS DECIMAL(10,2)) AS discovery_date_max,
  CAST(max(datediff('day', DATE '1970-01-01', cont_date)) + 2440587.5 AS DECIMAL(10,2)) AS cont_date_max,
  CAST(max(fire_size) AS DECIMAL(10,2)) AS fire_size_max FROM fx"""))
def profile_max(spark, sf_dir):
    raw = cast_columns(raw_fires(spark, sf_dir), ["DISCOVERY_DATE", "CONT_DATE", "FIRE_SIZE"], "decimal(10,2)")
    return max_profile(raw, ["DISCOVERY_DATE", "CONT_DATE", "FIRE_SIZE"])


_STAGED_TYPES = ([("objectid", "bigint", "objectid IS NULL")]
                 + [(c, "string", f"{c} IS NULL") for c in _TEXT]
                 + [("fire_year", "int", "disc_date IS NULL"), ("discovery_timestamp", "timestamp_ntz", "disc_day IS NULL"),
                    ("cont_timestamp", "timestamp_ntz", "cont_day IS NULL"), ("stat_cause_code", "int", "stat_cause_code IS NULL"),
                    ("owner_code", "int", "owner_code IS NULL"), ("fire_size", "decimal(10,2)", "fire_size IS NULL"),
                    ("latitude", "decimal(11,8)", "latitude IS NULL"), ("longitude", "decimal(11,8)", "longitude IS NULL")])


@query("profile_schema", O.with_fx(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) FILTER (WHERE {cond}) AS countna FROM fx"
    for c, t, cond in _STAGED_TYPES)))
def profile_schema(spark, sf_dir):
    return schema_profile(_staged(spark, sf_dir))


_RAW_DECIMALS = ("FIRE_YEAR", "DISCOVERY_DATE", "DISCOVERY_DOY", "CONT_DATE", "CONT_DOY", "STAT_CAUSE_CODE",
                 "OWNER_CODE", "FIRE_SIZE", "LATITUDE", "LONGITUDE")


@query("profile_decimal_cols", O.with_fx(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE NOT ({_RAW_NULL_SOURCE[c]})) AS non_null FROM fx"
    for c in _RAW_DECIMALS)))
def profile_decimal_cols(spark, sf_dir):
    """The raw frame's DECIMAL columns (found from the schema) with their
    non-null counts, one aggregation for all of them."""
    raw = raw_fires(spark, sf_dir)
    cols = columns_of_type(raw)
    agg = raw.agg(*[F.count(c).alias(c) for c in cols])
    return agg.unpivot([], cols, "column_name", "non_null")


def stored_lake(spark, sf_dir) -> dict[str, DataFrame]:
    """The 11 tables, written as a lake and read back."""
    fm = fire_model(spark, raw_fires(spark, sf_dir))
    wm = weather_model(spark, _weather_raw(spark, sf_dir), FX_WEATHER_LOWER_BOUND, dates=fm.dates)
    paths = write_tables({**fm.tables(), **wm.tables()}, fresh_path(spark, "lake"))
    return {name: spark.read.parquet(path) for name, path in paths.items()}


_ALL_CTES = (FACT_STAR_CTES + [O.dates_cte(), O.dim_cte(WEATHER_TYPES, "wx"), f"weather_fact AS ({_WEATHER_FACT_BODY})"])


def _with_all(body: str) -> str:
    return O.with_weather(body, [f"fx AS ({O.FX_FIRES_SQL})"] + _ALL_CTES)


def _number(key: str) -> str:
    return f"CAST({key} AS BIGINT)"


# The stored tables of a right lake break no rule, so the checks run on copies
# broken by rule: keys set to NULL, rows doubled, members taken away. The
# oracles count what the rule breaks.
@query("dq_null_keys", _with_all(" UNION ".join(
    f"SELECT '{t}' AS table_name, count(*) FILTER (WHERE {_number(k)} % 17 = 3) AS null_keys FROM {t}"
    for t, k in KEYS.items())))
def dq_null_keys(spark, sf_dir):
    return null_keys_of(stored_lake(spark, sf_dir))


def null_keys_of(lake: dict[str, DataFrame]) -> DataFrame:
    return null_key_report({t: (lake[t].withColumn(k, F.expr(f"CASE WHEN {_number(k)} % 17 <> 3 THEN {k} END")), k)
                            for t, k in KEYS.items()})


@query("dq_duplicate_keys", _with_all(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(DISTINCT {k}) FILTER (WHERE {_number(k)} % 19 = 4) AS duplicate_keys FROM {t}"
    for t, k in KEYS.items())))
def dq_duplicate_keys(spark, sf_dir):
    lake = stored_lake(spark, sf_dir)
    return duplicate_key_report({t: (lake[t].union(lake[t].where(f"{_number(k)} % 19 = 4")), k) for t, k in KEYS.items()})


@query("dq_row_counts", _with_all(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in KEYS)))
def dq_row_counts(spark, sf_dir):
    lake = stored_lake(spark, sf_dir)
    return row_count_report({t: lake[t] for t in KEYS})


_FIRE_FKS = {**{d.name: d.key for d in FIRE_DIMS}, **{f"dates_{r.key_out}": r.key_out for r in FIRES_FACT.roles}}


@query("dq_orphans", _with_all(" UNION ALL ".join(
    f"SELECT '{name}' AS dimension, count(*) FILTER (WHERE {fk} % 5 = 2) AS orphans FROM fires_fact"
    for name, fk in _FIRE_FKS.items())))
def dq_orphans(spark, sf_dir):
    """Every fifth member is taken out of its dimension; the fact is read once
    for all nine keys."""
    return orphans_of(stored_lake(spark, sf_dir))


def orphans_of(lake: dict[str, DataFrame]) -> DataFrame:
    fks = foreign_keys(FIRES_FACT, lake)
    return orphan_report(lake["fires_fact"], {n: (dim.where(f"{key} % 5 <> 2"), key, fk) for n, (dim, key, fk) in fks.items()})


@query("dq_dropped_rows", _with_all(f"""
SELECT 'fires_fact' AS fact, 'discovery_date_id' AS role,
  count(*) FILTER (WHERE disc_day IS NOT NULL AND NOT {O.in_calendar('disc_day')}) AS dropped,
  count(*) FILTER (WHERE disc_day IS NULL) AS unknown FROM fx
UNION ALL
SELECT 'fires_fact', 'cont_date_id', count(*) FILTER (WHERE cont_day IS NOT NULL AND NOT {O.in_calendar('cont_day')}),
  count(*) FILTER (WHERE cont_day IS NULL) FROM fx
UNION ALL
SELECT 'weather_fact', 'weather_date_dim_id', count(*) FILTER (WHERE NOT {O.in_calendar('date_str')}),
  count(*) FILTER (WHERE date_str IS NULL) FROM wx"""))
def dq_dropped_rows(spark, sf_dir):
    """Per fact and calendar role: rows the inner calendar join drops (date
    outside the calendar) and rows keyed to the unknown date (no date)."""
    weather = stage_weather(_weather_raw(spark, sf_dir), FX_WEATHER_LOWER_BOUND)
    return (role_date_report(_staged(spark, sf_dir), FIRES_FACT, CALENDAR_START, CALENDAR_END)
            .unionByName(role_date_report(weather, WEATHER_FACT, CALENDAR_START, CALENDAR_END)))


@query("union_distinct", O.with_fx(
    "SELECT fips_name AS name FROM fx UNION SELECT nwcg_reporting_unit_name AS name FROM fx"))
def union_distinct(spark, sf_dir):
    s = _staged(spark, sf_dir)
    return (s.select(F.col("fips_name").alias("name"))
             .union(s.select(F.col("nwcg_reporting_unit_name").alias("name"))).distinct())


@query("preview_limit", O.with_fx(_fact_star_body() + " ORDER BY fire_id LIMIT 10", _fire_ctes()))
def preview_limit(spark, sf_dir):
    """Top 10 fact rows by key: a top-k (TakeOrderedAndProject), no full sort."""
    return fire_model(spark, raw_fires(spark, sf_dir)).fact.orderBy("fire_id").limit(10)


# --------------------------------------------------------------------------
# Sources and sinks S2, S3, S6, K1-K8
# --------------------------------------------------------------------------
@query("src_csv", f"SELECT serialid, date_str, type, longitude, latitude, max_temp, min_temp FROM ({FX_WEATHER_RAW_SQL}) r")
def src_csv(spark, sf_dir):
    path = fresh_path(spark, "weather-csv")
    raw_weather(spark, sf_dir).write.option("header", True).csv(path)
    return read_csv(spark, path, drop=("id", "station_name"))


_GAPPED = "CASE WHEN o_orderkey % 11 = 3 THEN NULL WHEN o_orderkey % 10 < 9 THEN o_orderkey ELSE o_orderkey * 100000 END"


@query("src_ranges", f"""
SELECT count(*) AS n_rows, count(*) AS n_matched, CAST(sum(coalesce(k, 0)) AS BIGINT) AS key_sum, TRUE AS is_disjoint, TRUE AS is_even
FROM (SELECT CAST({_GAPPED} AS BIGINT) AS k FROM orders) t""")
def src_ranges(spark, sf_dir):
    """The predicates of a parallel read, applied to a table whose keys have
    gaps and NULLs: every row meets one, and none is met by over a fifth more
    rows than the average."""
    keys = read_table(spark, sf_dir, "orders").selectExpr(f"CAST({_GAPPED} AS BIGINT) AS k")
    ranges = even_ranges(keys, "k", 8)
    # the NULLs go with the first range, which is cut on the other keys
    met = F.array_compact(F.array(*[F.when(F.expr(r), F.lit(i)) for i, r in enumerate(ranges)]))
    per_range = keys.withColumn("met", met).groupBy(F.get("met", F.lit(0)).alias("range")).agg(
        F.count(F.lit(1)).alias("n"), F.count("k").alias("known"), F.sum(F.size("met")).alias("m"), F.max(F.size("met")).alias("most"),
        F.sum(F.coalesce("k", F.lit(0))).alias("s"))
    return per_range.agg(F.sum("n").alias("n_rows"), F.sum("m").alias("n_matched"), F.sum("s").alias("key_sum"), (F.max("most") == 1).alias("is_disjoint"),
                         (F.max("known") <= 1.2 * F.sum("known") / len(ranges)).alias("is_even"))


@query("scan_cell_pruned", O.with_fx(f"""
SELECT objectid, CAST(latitude AS DECIMAL(11,8)) AS latitude, CAST(longitude AS DECIMAL(11,8)) AS longitude, disc_day AS day
FROM fx WHERE disc_day BETWEEN DATE '1996-03-01' AND DATE '1996-09-30' AND CAST(latitude AS DECIMAL(11,8)) BETWEEN 35 AND 42
  AND CAST(longitude AS DECIMAL(11,8)) BETWEEN -110 AND -90"""))
def scan_cell_pruned(spark, sf_dir):
    """Fires laid out along a Z curve over place and day, and a box of them
    read from the files whose index meets it."""
    path = fresh_path(spark, "clustered")
    fires = _staged(spark, sf_dir).select("objectid", "latitude", "longitude", F.to_date("discovery_timestamp").alias("day"))
    write_clustered(fires, path, ["latitude", "longitude", "day"], rows_per_file=500)
    return read_clustered(spark, path, fires.schema, {"day": (dt.date(1996, 3, 1), dt.date(1996, 9, 30)), "latitude": (35, 42), "longitude": (-110, -90)})


@query("sink_dim_roundtrip", O.with_fx("SELECT * FROM locations", [O.dim_cte(LOCATIONS)]))
def sink_dim_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "locations")
    write_dim(dim_table(build_dim(_staged(spark, sf_dir), LOCATIONS)), path)
    return spark.read.parquet(path)


def _written_fact(spark, sf_dir) -> str:
    path = fresh_path(spark, "fires_fact")
    write_fact(fire_model(spark, raw_fires(spark, sf_dir)).fact, path)
    return path


@query("sink_fact_partitioned", FACT_STAR_SQL)
def sink_fact_partitioned(spark, sf_dir):
    return spark.read.parquet(_written_fact(spark, sf_dir))


@query("scan_year_pruned", O.with_fx(f"SELECT * FROM ({_fact_star_body()}) f WHERE year = 1997", _fire_ctes()))
def scan_year_pruned(spark, sf_dir):
    """Reads only the year=1997 folder (PartitionFilters in the scan)."""
    return spark.read.parquet(_written_fact(spark, sf_dir)).filter(F.col("year") == 1997)


def _sums(table: str) -> str:
    """Sums that a swapped column would change: the key, and in a fact all
    foreign keys, each with a weight of its own."""
    spec = {f.name: f for f in (FIRES_FACT, WEATHER_FACT)}.get(table)
    fks = [r.key_out for r in spec.roles] + [d.key for d in spec.dims] if spec else []
    weighted = " + ".join(f"{i + 2} * {k}" for i, k in enumerate(fks)) or "0"
    return (f"SELECT '{table}' AS table_name, count(*) AS row_count, CAST(sum({_number(KEYS[table])}) AS BIGINT) AS key_sum, "
            f"CAST(sum({weighted}) AS BIGINT) AS fk_sum FROM ")


@query("catalog_publish", _with_all(" UNION ALL ".join(_sums(t) + t for t in KEYS)))
def catalog_publish(spark, sf_dir):
    """Write all 11 tables, publish them in a fresh database with DDL taken
    from the written schemas (partitions repaired), read them through the
    catalog, and drop the database again (the files stay)."""
    root = fresh_path(spark, "lake")
    fm = fire_model(spark, raw_fires(spark, sf_dir))
    wm = weather_model(spark, _weather_raw(spark, sf_dir), FX_WEATHER_LOWER_BOUND, dates=fm.dates)
    paths = write_tables({**fm.tables(), **wm.tables()}, root)
    db = "stellate_" + uuid.uuid4().hex[:10]
    publish(spark, db, paths, root + "/_catalog")
    try:
        found = spark.sql(" UNION ALL ".join(_sums(t) + f"`{db}`.`{t}`" for t in KEYS))
        return spark.createDataFrame(found.collect(), found.schema)   # a row a table
    finally:
        spark.sql(f"DROP DATABASE `{db}` CASCADE")


_DRIFTS = [("locations", "region", "added", None, "string"), ("locations", "location_id", "refused", "bigint", "string"),
           ("owners", "owner_code", "widened", "int", "bigint"), ("owners", "note", "missing", "string", None)]


@query("catalog_evolve", O.with_fx(
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{k}' AS change, {repr(a) if a else 'NULL'} AS stored, "
                       f"{repr(b) if b else 'NULL'} AS incoming, {n} AS n_rows, {v} AS n_new FROM {t}"
                       for (t, c, k, a, b), n, v in zip(_DRIFTS, ("2 * count(*)", "2 * count(*)", "2 * count(*)", "2 * count(*)"),
                                                        ("count(*)", "count(*)", "sum(CASE WHEN owner_code IS NULL THEN 0 ELSE 1 END)",
                                                         "sum(CASE WHEN owner_code IS NULL THEN 0 ELSE 1 END)"))),
    [O.dim_cte(LOCATIONS), O.dim_cte(OWNERS)]))
def catalog_evolve(spark, sf_dir):
    """Published dimensions that get rows of other schemas: a column more, a
    wider type, a column less, and a type that is refused. The catalog follows
    without losing a row; each change is reported beside the table's rows and
    those that only the new schema can hold."""
    dims = build_dims_with_stats(_staged(spark, sf_dir), [LOCATIONS, OWNERS])[0]
    places, owners, root = dim_table(dims["locations"]), dim_table(dims["owners"]).withColumn("note", F.lit("x")), fresh_path(spark, "lake")
    db = "stellate_" + uuid.uuid4().hex[:10]
    drifts: list[Drift] = []

    def second(change: Change) -> None:
        drifts[:] = append_evolving(change, "locations", places.withColumn("region", F.lit("west")))
        drifts.extend(append_evolving(change, "owners", owners.drop("note").withColumn("owner_code", F.col("owner_code").cast("bigint") + (1 << 40))))

    def first(change: Change) -> None:
        change.replace("locations", places)
        change.replace("owners", owners)

    at = commit_with(spark, root, first)
    republish(spark, db, root, at)
    try:
        commit_with(spark, root, second)
        try:
            commit_with(spark, root, lambda change: append_evolving(change, "locations", places.withColumn("location_id", F.col("location_id").cast("string"))))
        except Narrowing:
            drifts.append(Drift("locations", "location_id", "refused", "bigint", "string"))
        at = one_folder(spark, root, version(spark, root))
        republish(spark, db, root, at)
        counts = spark.sql(f"SELECT 'locations' AS t, count(*) AS n_rows, count(region) AS n_new FROM `{db}`.locations UNION ALL "
                           f"SELECT 'owners', count(*), count_if(owner_code >= {1 << 40}) FROM `{db}`.owners").collect()   # a row a table
    finally:
        spark.sql(f"DROP DATABASE `{db}` CASCADE")
    found = {r.t: (r.n_rows, r.n_new) for r in counts}
    return spark.createDataFrame([(d.table, d.column, d.change, d.stored, d.incoming, *found[d.table]) for d in drifts],
                                 "table_name string, column_name string, change string, stored string, incoming string, n_rows bigint, n_new bigint")


# --------------------------------------------------------------------------
# A lake that is written again: C10, D6
# --------------------------------------------------------------------------
def _fires_with_members(spark, root: str, at: Version | None = None) -> DataFrame:
    """Stored facts beside the attributes that their stored keys lead to."""
    lake = read_lake(spark, root, at)
    f = lake["fires_fact"]
    for d in FIRE_DIMS:
        f = f.join(lake[d.name], d.key)
    for role in FIRES_FACT.roles:
        f = f.join(role_play(lake["dates"], role.prefix), F.col(role.key_out) == F.col(f"{role.prefix}{DATES_KEY}"))
    attrs = [a for d in FIRE_DIMS for a in d.attrs]
    return f.select("fire_id", *dict.fromkeys(attrs), F.col("disc_date_actual").alias("disc_day"),
                    F.col("cont_date_actual").alias("cont_day"), "fire_size", "year")


def _fires_with_members_sql(size: str = "fire_size") -> str:
    attrs = ", ".join(dict.fromkeys(a for d in FIRE_DIMS for a in d.attrs))
    return O.with_fx(f"""SELECT objectid AS fire_id, {attrs}, disc_day, cont_day, CAST({size} AS DECIMAL(10,2)) AS fire_size,
      CAST(year(disc_date) AS INT) AS year FROM fx WHERE {O.in_calendar('disc_day')} AND {O.in_calendar('cont_day')}""")


@query("lake_rerun", _fires_with_members_sql())
def lake_rerun(spark, sf_dir):
    """The job over the years up to 1997, then over 1997 and later: old keys
    stay right, the shared year is replaced, nothing is lost."""
    raw, weather, root = raw_fires(spark, sf_dir), _weather_raw(spark, sf_dir), fresh_path(spark, "lake")
    for years in ("FIRE_YEAR <= 1997", "FIRE_YEAR >= 1997"):
        build_lake(spark, raw.where(years), weather, root, weather_lower_bound=FX_WEATHER_LOWER_BOUND)
    return _fires_with_members(spark, root)


_UNNAMED = "objectid % 37 = 5"
_REVISED = f"year(disc_date) = 1997 AND objectid % 2 = 0 AND NOT ({_UNNAMED})"


@query("lake_refresh", _fires_with_members_sql(f"CASE WHEN {_REVISED} THEN fire_size + 1 ELSE fire_size END").replace(
    "SELECT objectid AS fire_id", f"SELECT CASE WHEN NOT ({_UNNAMED}) THEN objectid END AS fire_id", 1))
def lake_refresh(spark, sf_dir):
    """The job over the years up to 1997, then a batch with revised rows of
    1997 and all later years, and the batch once more. Some rows have no id:
    they are told apart by all their columns."""
    raw, weather, root = raw_fires(spark, sf_dir), _weather_raw(spark, sf_dir), fresh_path(spark, "lake")
    raw = raw.withColumn("OBJECTID", F.expr(f"CASE WHEN NOT ({_UNNAMED.replace('objectid', 'OBJECTID')}) THEN OBJECTID END"))
    build_lake(spark, raw.where("FIRE_YEAR <= 1997"), weather, root, weather_lower_bound=FX_WEATHER_LOWER_BOUND)
    revised = raw.where("FIRE_YEAR = 1997 AND OBJECTID % 2 = 0").withColumn(
        "FIRE_SIZE", (F.col("FIRE_SIZE") + 1).cast(raw.schema["FIRE_SIZE"].dataType))
    batch = revised.unionByName(raw.where("FIRE_YEAR > 1997"))
    for _ in range(2):
        apply_batch(batch, root, FIRES)
    return _fires_with_members(spark, root)


_EARLY = "year(disc_date) <= 1997"


@query("lake_versions", _fires_with_members_sql().replace("SELECT objectid", "SELECT 1 AS version, objectid", 1) + f" AND {_EARLY} UNION ALL SELECT * FROM ("
       + _fires_with_members_sql().replace("SELECT objectid", "SELECT 2 AS version, objectid", 1) + ") second")
def lake_versions(spark, sf_dir):
    """Two commits, a write between them that its driver abandons, and both
    versions read afterwards."""
    raw, root = raw_fires(spark, sf_dir), fresh_path(spark, "lake")
    first = apply_batch(raw.where("FIRE_YEAR <= 1997"), root, FIRES)
    abandoned = Change(spark, root)
    apply_staged(abandoned, stage_fires(raw.where("FIRE_YEAR >= 1997").withColumn("STATE", F.lit("nowhere"))), FIRES_FACT)
    second = apply_batch(raw.where("FIRE_YEAR > 1997"), root, FIRES)
    vacuum(spark, root, keep=2, older_than=0)
    return (_fires_with_members(spark, root, version(spark, root, first.number)).select(F.lit(1).alias("version"), "*")
            .unionByName(_fires_with_members(spark, root, version(spark, root, second.number)).select(F.lit(2).alias("version"), "*")))


def _grown_dim_sql(spec: DimSpec) -> str:
    """Members of the early rows in order, then the others in order."""
    attrs, order = ", ".join(spec.attrs), ", ".join(f"{a} NULLS FIRST" for a in spec.attrs)
    text = " || '|' || ".join(f"coalesce(CAST({a} AS STRING), '-')" for a in spec.attrs)
    return (f"SELECT '{spec.name}' AS dimension, CAST(row_number() OVER (ORDER BY late, {order}) - 1 AS BIGINT) AS key, {text} AS member "
            f"FROM (SELECT {attrs}, min(CASE WHEN {_EARLY} THEN 0 ELSE 1 END) AS late FROM fx GROUP BY {attrs}) t")


@query("dim_refresh_all", O.with_fx(" UNION ALL ".join(f"SELECT * FROM ({_grown_dim_sql(d)}) g" for d in FIRE_DIMS)))
def dim_refresh_all(spark, sf_dir):
    """All seven member dimensions brought up to date by one pass over the
    staged rows, and by a second run that finds nothing new."""
    staged, root = _staged(spark, sf_dir), fresh_path(spark, "lake")
    for rows in (staged.where("fire_year <= 1997"), staged, staged):
        at = commit_with(spark, root, lambda change: refresh_dimensions(change, rows, FIRE_DIMS))
    lake = read_lake(spark, root, at)
    member = {d.name: F.concat_ws("|", *[F.coalesce(F.col(a).cast("string"), F.lit("-")) for a in d.attrs]) for d in FIRE_DIMS}
    parts = [lake[d.name].select(F.lit(d.name).alias("dimension"), F.col(d.key).alias("key"), member[d.name].alias("member")) for d in FIRE_DIMS]
    return reduce(lambda a, b: a.unionByName(b), parts)


_SHORT = ("1996-01-01", "1998-01-01")
_SHORT_UNKNOWN = calendar_size(*_SHORT) + 1


def _stepped(n: str, unknown: int) -> str:
    return f"CASE WHEN {n} < {unknown} THEN {n} ELSE {n} + 1 END"


@query("dates_extend", O.with_fx(f"""
SELECT CAST(CASE WHEN date_type = 'unknown' THEN {_SHORT_UNKNOWN}
    ELSE {_stepped(f"datediff('day', DATE '{_SHORT[0]}', date_actual) + 1", _SHORT_UNKNOWN)} END AS BIGINT) AS date_dim_id, * EXCLUDE (date_dim_id)
FROM dates""", [O.dates_cte(bounds="SELECT CAST(min(d) AS TIMESTAMP) AS s, CAST(max(d) AS TIMESTAMP) + INTERVAL 1 DAY AS e FROM "
                            "(SELECT disc_day AS d FROM fx UNION ALL SELECT cont_day FROM fx) x")]))
def dates_extend(spark, sf_dir):
    """A stored calendar of two years that grows to all days of the fires,
    both ways; no key changes, the unknown member's neither."""
    root = fresh_path(spark, "lake")
    edge = _staged(spark, sf_dir).select(F.explode(F.array(F.to_date("discovery_timestamp"), F.to_date("cont_timestamp"))).alias("d")).agg(
        F.min("d").alias("low"), F.date_add(F.max("d"), 1).alias("end")).first()
    commit_with(spark, root, lambda change: refresh_dates(change, *_SHORT))
    at = commit_with(spark, root, lambda change: extend_dates(change, str(edge.low), str(edge.end)))
    return read_version(spark, root, "dates", at)


_REPLAY_START = "1987-01-01"
_held = f"({{d}} IS NULL OR ({{d}} >= DATE '{_REPLAY_START}' AND {{d}} < DATE '{CALENDAR_END}'))"


@query("quarantine_replay", O.with_fx(f"""
SELECT objectid AS fire_id, CASE WHEN {_held.format(d='disc_day')} AND {_held.format(d='cont_day')} THEN 'fact' ELSE 'quarantine' END AS place,
  CASE WHEN NOT ({_held.format(d='disc_day')} AND {_held.format(d='cont_day')}) THEN NULL
    WHEN disc_day IS NULL THEN CAST({O.UNKNOWN_DATE_ID} AS BIGINT) ELSE CAST(datediff('day', DATE '{CALENDAR_START}', disc_day) + 1 AS BIGINT) END AS discovery_date_id,
  CASE WHEN NOT ({_held.format(d='disc_day')} AND {_held.format(d='cont_day')}) THEN 'no such day: ' || concat_ws(', ',
    CASE WHEN NOT {O.in_calendar('disc_day')} THEN 'discovery_date_id' END, CASE WHEN NOT {O.in_calendar('cont_day')} THEN 'cont_date_id' END) END AS reason
FROM fx"""))
def quarantine_replay(spark, sf_dir):
    """Fires of days that the calendar lacks wait in the quarantine; once the
    calendar has grown those of its new days become facts, the others stay.
    Both batch and replay run twice."""
    raw, root = raw_fires(spark, sf_dir), fresh_path(spark, "lake")
    for _ in range(2):
        apply_batch(raw, root, FIRES, "first")
    commit_with(spark, root, lambda change: extend_dates(change, start=_REPLAY_START))
    for _ in range(2):
        at = commit_with(spark, root, lambda change: replay_quarantine(change, FIRES_FACT))
    lake = read_lake(spark, root, at)
    return lake["fires_fact"].select("fire_id", F.lit("fact").alias("place"), "discovery_date_id", F.lit(None).cast("string").alias("reason")).unionByName(
        lake["fires_fact_quarantine"].select(F.col("objectid").alias("fire_id"), F.lit("quarantine").alias("place"),
                                             F.lit(None).cast("bigint").alias("discovery_date_id"), F.col("_reason").alias("reason")))


_TIMED = [("SELECT *, TIMESTAMP '2020-01-01 00:00:00' AS seen_at, 0 AS plus FROM fx",),
          ("SELECT *, TIMESTAMP '2020-01-03 00:00:00', 1 FROM fx WHERE objectid % 2 = 0", "SELECT *, TIMESTAMP '2020-01-02 00:00:00', 5 FROM fx WHERE objectid % 2 = 0"),
          ("SELECT *, TIMESTAMP '2020-01-02 12:00:00', 7 FROM fx WHERE objectid % 2 = 0", "SELECT *, TIMESTAMP '2020-01-04 00:00:00', 2 FROM fx WHERE objectid % 5 = 0")]


@query("stream_newest", O.with_fx(f"""
SELECT fire_id, CAST(fire_size AS DECIMAL(10,2)) AS fire_size, (SELECT count(*) FROM fx WHERE objectid % 2 = 0) * 2 AS n_old FROM (
  SELECT objectid AS fire_id, fire_size + plus AS fire_size, disc_day, cont_day, row_number() OVER (PARTITION BY objectid ORDER BY seen_at DESC) AS place
  FROM ({' UNION ALL '.join(s for batch in _TIMED for s in batch)}) u) t WHERE place = 1 AND {O.in_calendar('disc_day')} AND {O.in_calendar('cont_day')}"""))
def stream_newest(spark, sf_dir):
    """A stream of three batches with repeated ids, inside and across
    batches, some late: the newest row of each id is stored, and the others
    are counted."""
    raw, root, src = raw_fires(spark, sf_dir), fresh_path(spark, "lake"), fresh_path(spark, "src")
    kind = raw.schema["FIRE_SIZE"].dataType

    def rows(where: str, at: str, plus: int) -> DataFrame:
        return raw.where(where).withColumn("FIRE_SIZE", (F.col("FIRE_SIZE") + plus).cast(kind)).withColumn("SEEN_AT", F.lit(at).cast("timestamp"))

    batches = ([("1 = 1", "2020-01-01", 0)], [("OBJECTID % 2 = 0", "2020-01-03", 1), ("OBJECTID % 2 = 0", "2020-01-02", 5)],
               [("OBJECTID % 2 = 0", "2020-01-02 12:00:00", 7), ("OBJECTID % 5 = 0", "2020-01-04", 2)])
    place = fresh_path(spark, "stream")
    for batch in batches:
        frames = [rows(*b) for b in batch]
        reduce(lambda a, b: a.unionByName(b), frames).write.mode("append").parquet(src)
        start_newest(spark, FIRES, src, frames[0].schema, root, "OBJECTID", "SEEN_AT", checkpoint_location=place).awaitTermination()
    lake = read_lake(spark, root)
    old = lake["fires_fact_late"].agg(F.sum("n_old")).first()[0]
    return lake["fires_fact"].select("fire_id", "fire_size", F.lit(old).cast("bigint").alias("n_old"))


@query("lake_refresh_weather", O.with_weather(f"""
SELECT serialid AS weather_outlier_id, date_str AS day, type, latitude, longitude, CAST(year(date_str) AS INT) AS year
FROM wx WHERE {O.in_calendar('date_str')}"""))
def lake_refresh_weather(spark, sf_dir):
    """Weather outliers in two batches that share rows, into an empty lake."""
    raw, root = _weather_raw(spark, sf_dir), fresh_path(spark, "lake")
    for rows in ("CAST(serialid AS BIGINT) % 3 < 2", "CAST(serialid AS BIGINT) % 3 > 0"):
        apply_batch(raw.where(rows), root, WEATHER)
    lake = read_lake(spark, root)
    f = lake["weather_fact"].join(lake["weather_types"], WEATHER_TYPES.key)
    dates = lake["dates"].select(F.col(DATES_KEY).alias("weather_date_dim_id"), F.col("date_actual").alias("day"))
    return f.join(dates, "weather_date_dim_id").select("weather_outlier_id", "day", "type", "latitude", "longitude", "year")


# --------------------------------------------------------------------------
# Marts and analyses D1-D5
# --------------------------------------------------------------------------
_PRICE = "CAST(o_totalprice AS DECIMAL(12,2))"


@query("mart_cube", f"""
SELECT o_orderstatus, o_orderpriority, count(*) AS n_orders,
  CAST(sum({_PRICE}) AS DECIMAL(18,2)) AS total_price,
  CAST(grouping(o_orderstatus, o_orderpriority) AS INT) AS gid
FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)""")
def mart_cube(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    return cube_mart(o, ["o_orderstatus", "o_orderpriority"],
                     {"n_orders": F.count(F.lit(1)),
                      "total_price": F.sum(F.col("o_totalprice").cast("decimal(12,2)")).cast("decimal(18,2)")})


@query("mart_grouping_sets", f"""
SELECT CAST(year(o_orderdate) AS INT) AS yr, o_orderpriority, count(*) AS n_orders,
  CAST(sum({_PRICE}) AS DECIMAL(18,2)) AS total_price,
  CAST(grouping(CAST(year(o_orderdate) AS INT), o_orderpriority) AS INT) AS gid
FROM orders GROUP BY GROUPING SETS ((CAST(year(o_orderdate) AS INT), o_orderpriority), (CAST(year(o_orderdate) AS INT)), ())""")
def mart_grouping_sets(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").withColumn("yr", F.year("o_orderdate").cast("int"))
    return grouping_sets_mart(o, [["yr", "o_orderpriority"], ["yr"], []], ["yr", "o_orderpriority"],
                              {"n_orders": F.count(F.lit(1)),
                               "total_price": F.sum(F.col("o_totalprice").cast("decimal(12,2)")).cast("decimal(18,2)")})


@query("containment_by_agency", O.with_fx(f"""
SELECT nwcg_reporting_agency AS agency, count(*) AS n_events, count(*) - count(secs) AS n_unknown,
  round(avg(secs) / 3600.0, 2) AS avg_hours, max(secs) AS max_seconds
FROM (SELECT nwcg_reporting_agency, date_diff('second', CAST({O.stamp_text('disc_day', 'disc_time')} AS TIMESTAMP),
        CAST({O.stamp_text('cont_day', 'cont_time')} AS TIMESTAMP)) AS secs
      FROM fx WHERE {O.in_calendar('disc_day')} AND {O.in_calendar('cont_day')}) t
GROUP BY nwcg_reporting_agency"""))
def containment_by_agency(spark, sf_dir):
    """Time from discovery to containment on the star, per agency."""
    fm = fire_model(spark, raw_fires(spark, sf_dir), only=("reporters",))
    return containment_efficiency(fm.fact, dim_table(fm.dims["reporters"]))


_ORDER_MART = CellMart("order_cells", ("o_orderstatus", "o_orderpriority"), "o_totalprice", "o_custkey")
# what the second batch leaves: rows deleted, prices revised
_AFTER = """SELECT nullif(o_orderstatus, 'P') AS o_orderstatus, o_orderpriority, o_custkey,
  CAST(CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice - 1000 ELSE o_totalprice END AS DECIMAL(12,2)) AS o_totalprice
FROM {orders} WHERE o_orderkey % 7 <> 0"""


@query("mart_cube_delta", f"""
SELECT o_orderstatus, o_orderpriority, count(*) AS n, CAST(sum(o_totalprice) AS DECIMAL(28,2)) AS total, max(o_totalprice) AS largest,
  count(DISTINCT o_custkey) AS members, CAST(grouping(o_orderstatus, o_orderpriority) AS INT) AS gid
FROM ({_AFTER.format(orders="orders")}) o GROUP BY CUBE (o_orderstatus, o_orderpriority)""")
def mart_cube_delta(spark, sf_dir):
    """Cells built from two thirds of the orders, then kept up to date with
    insertions, revisions and deletions; the cube follows from the cells."""
    orders, root = read_table(spark, sf_dir, "orders"), fresh_path(spark, "lake")
    rows = orders.selectExpr("o_orderkey", "nullif(o_orderstatus, 'P') AS o_orderstatus", "o_orderpriority", "o_custkey",
                             "CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice")
    lower = "CAST(o_totalprice - 1000 AS DECIMAL(12,2))"
    first = rows.where("o_orderkey % 3 <> 0")
    second = rows
    third = rows.where("o_orderkey % 7 <> 0").withColumn("o_totalprice", F.expr(f"CASE WHEN o_orderkey % 5 = 0 THEN {lower} ELSE o_totalprice END"))
    gone = rows.where("o_orderkey % 7 = 0 OR o_orderkey % 5 = 0").withColumn("sign", F.lit(-1))
    revised = third.where("o_orderkey % 5 = 0").withColumn("sign", F.lit(1))
    commit_with(spark, root, lambda change: _ORDER_MART.build(change, first))
    commit_with(spark, root, lambda change: _ORDER_MART.apply(change, rows.where("o_orderkey % 3 = 0").withColumn("sign", F.lit(1)), second))
    at = commit_with(spark, root, lambda change: _ORDER_MART.apply(change, gone.unionByName(revised), third))
    lake = read_lake(spark, root, at)
    return _ORDER_MART.cube(lake["order_cells"], lake["order_cells_members"])


def _cell_sql(col: str, size: int = 10) -> str:
    return f"CAST(floor({col} / {size}) AS BIGINT)"


@query("geo_day_overlay", O.with_weather(f"""
, a AS (SELECT {_cell_sql('CAST(CAST(latitude AS DECIMAL(11,8)) AS DOUBLE)')} AS lat_cell,
    {_cell_sql('CAST(CAST(longitude AS DECIMAL(11,8)) AS DOUBLE)')} AS lon_cell, disc_day AS day, count(*) AS a_n
  FROM fx WHERE disc_day IS NOT NULL AND {O.in_calendar('disc_day')} AND {O.in_calendar('cont_day')} GROUP BY 1, 2, 3),
b AS (SELECT {_cell_sql('TRY_CAST(latitude AS DOUBLE)')} AS lat_cell, {_cell_sql('TRY_CAST(longitude AS DOUBLE)')} AS lon_cell,
    date_str AS day, count(*) AS b_n FROM wx WHERE {O.in_calendar('date_str')} GROUP BY 1, 2, 3)
SELECT a.lat_cell, a.lon_cell, count(*) AS shared_days, CAST(sum(a_n) AS BIGINT) AS a_total, CAST(sum(b_n) AS BIGINT) AS b_total,
  CASE WHEN stddev_pop(a_n) = 0 OR stddev_pop(b_n) = 0 THEN NULL
       ELSE round(corr(CAST(a_n AS DOUBLE), CAST(b_n AS DOUBLE)), 6) END AS corr_ab
FROM a JOIN b ON a.lat_cell = b.lat_cell AND a.lon_cell = b.lon_cell AND a.day = b.day
GROUP BY a.lat_cell, a.lon_cell""", [f"fx AS ({O.FX_FIRES_SQL})"]))
def geo_day_overlay(spark, sf_dir):
    """Both facts superimposed on a grid of coordinates, day by day."""
    fires, weather, dates = _facts_without_members(spark, sf_dir)
    return coordinate_overlay(fires, weather, dates)


_GREAT_CIRCLE = """2 * 6371.0088 * asin(least(1.0, sqrt(pow(sin(radians(w.lat - f.lat) / 2), 2)
  + cos(radians(f.lat)) * cos(radians(w.lat)) * pow(sin(radians(w.lon - f.lon) / 2), 2))))"""


@query("geo_distance_overlay", O.with_weather(f"""
, f AS (SELECT objectid AS fire_id, CAST(CAST(latitude AS DECIMAL(11,8)) AS DOUBLE) AS lat, CAST(CAST(longitude AS DECIMAL(11,8)) AS DOUBLE) AS lon,
    disc_day AS day FROM fx WHERE disc_day IS NOT NULL AND {O.in_calendar('disc_day')} AND {O.in_calendar('cont_day')}),
w AS (SELECT TRY_CAST(latitude AS DOUBLE) AS lat, TRY_CAST(longitude AS DOUBLE) AS lon, date_str AS on_day, unnest(range(0, 4)) AS k
  FROM wx WHERE {O.in_calendar('date_str')}),
n AS (SELECT f.fire_id, count(*) AS n FROM f JOIN w ON f.day = w.on_day + CAST(w.k AS INT) AND w.lat IS NOT NULL AND w.lon IS NOT NULL
    AND {_GREAT_CIRCLE} <= 150.0 GROUP BY f.fire_id)
SELECT f.fire_id, CAST(coalesce(n, 0) AS BIGINT) AS n_outliers FROM f LEFT JOIN n USING (fire_id)
WHERE f.lat IS NOT NULL AND f.lon IS NOT NULL""", [f"fx AS ({O.FX_FIRES_SQL})"]))
def geo_distance_overlay(spark, sf_dir):
    """Per fire the weather outliers within 150 km and three days before."""
    return distance_overlay(*_facts_without_members(spark, sf_dir))


@query("fire_asof", O.with_weather(f"""
, own AS (SELECT fire_id, reporter_id, CAST(discovery_timestamp AS TIMESTAMP) AS found,
    {_cell_sql('CAST(latitude AS DOUBLE)')} AS lat_cell, {_cell_sql('CAST(longitude AS DOUBLE)')} AS lon_cell FROM fires_fact),
at_once AS (SELECT reporter_id, found, max(fire_id) AS fire_id FROM own WHERE found IS NOT NULL GROUP BY reporter_id, found),
outliers AS (SELECT {_cell_sql('TRY_CAST(latitude AS DOUBLE)')} AS lat_cell, {_cell_sql('TRY_CAST(longitude AS DOUBLE)')} AS lon_cell,
    date_str AS on_day, max(serialid) AS serialid FROM wx WHERE {O.in_calendar('date_str')} GROUP BY 1, 2, 3),
timed AS (SELECT * FROM own WHERE found IS NOT NULL),
since AS (SELECT o.*, p.fire_id AS previous_fire_id, date_diff('second', p.found, o.found) AS seconds_since
  FROM timed o ASOF LEFT JOIN at_once p ON o.reporter_id = p.reporter_id AND o.found > p.found),
placed AS (SELECT * FROM since WHERE lat_cell IS NOT NULL AND lon_cell IS NOT NULL),
near AS (SELECT s.fire_id, w.serialid, date_diff('day', w.on_day, CAST(s.found AS DATE)) AS ago
  FROM placed s ASOF JOIN outliers w ON s.lat_cell = w.lat_cell AND s.lon_cell = w.lon_cell AND CAST(s.found AS DATE) >= w.on_day)
SELECT o.fire_id, s.previous_fire_id, s.seconds_since, CASE WHEN ago <= 7 THEN n.serialid END AS weather_outlier_id,
  CAST(CASE WHEN ago <= 7 THEN ago END AS INT) AS days_since_outlier
FROM own o LEFT JOIN since s USING (fire_id) LEFT JOIN near n USING (fire_id)""", [f"fx AS ({O.FX_FIRES_SQL})"] + FACT_STAR_CTES))
def fire_asof(spark, sf_dir):
    """Exact time between records: each fire and the one before it of its
    reporting unit, and the last weather outlier of its cell."""
    fm = fire_model(spark, raw_fires(spark, sf_dir), only=("reporters",))
    wm = weather_model(spark, _weather_raw(spark, sf_dir), FX_WEATHER_LOWER_BOUND, dates=fm.dates, only=())
    return time_between(fm.fact, wm.fact, fm.dates)


def _facts_without_members(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Both facts with their calendar keys only, and the calendar."""
    fm = fire_model(spark, raw_fires(spark, sf_dir), only=())
    wm = weather_model(spark, _weather_raw(spark, sf_dir), FX_WEATHER_LOWER_BOUND, dates=fm.dates, only=())
    return fm.fact, wm.fact, fm.dates


@query("kmeans_cells", O.with_fx(f"""
SELECT count(*) AS n_points, CAST(4 AS BIGINT) AS n_cells, count(*) FILTER (WHERE latitude IS NULL) AS n_misplaced,
  TRUE AS converged
FROM fx WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND {O.in_calendar('disc_day')} AND {O.in_calendar('cont_day')}"""))
def kmeans_cells_q(spark, sf_dir):
    """Clusters of the star's coordinates: every row is in the cell of its
    nearest centre, no row is left out, and the iteration has converged."""
    return cell_check(kmeans_cells(fire_model(spark, raw_fires(spark, sf_dir), only=()).fact))
