"""Declarative table specs: which staged columns make which dimension, and how
a fact table is assembled from them.

The wildfire / weather-outlier model below is one spec over the generic
operators; any other star schema is a different set of specs.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class DimSpec:
    """A member dimension: distinct combinations of ``attrs`` get a dense key."""

    name: str                      # table / folder name
    key: str                       # surrogate key column
    attrs: tuple[str, ...]         # natural attributes, in key order
    broadcast: bool | None = None  # None: decide from a checked size bound


@dataclass(frozen=True)
class RoleSpec:
    """One use of the calendar dimension (role-playing dimension)."""

    prefix: str       # column prefix for this copy of the calendar
    source: str       # staged column (timestamp or date) holding the date
    key_out: str      # name of the foreign key in the fact


@dataclass(frozen=True)
class FactSpec:
    name: str
    roles: tuple[RoleSpec, ...]
    dims: tuple[DimSpec, ...]
    # (expression or column, output name) in output order; dimension keys are
    # referred to by their key names.
    select: tuple[tuple[str, str], ...]
    partition_col: str = "year"
    row_id: tuple[str, ...] = field(default=())  # columns that identify a row (salt)


# ---------------------------------------------------------------------------
# Fixed values of the wildfire / weather model: table names, key names and
# attribute lists of each dimension, the source and staging column lists, the
# calendar range, the quarter names, the fire size bands, and the role prefixes
# and output columns of the two facts. They must equal the reference model.
# ---------------------------------------------------------------------------
SOURCES = DimSpec("sources", "source_id",
                  ("source_system_type", "source_system", "source_reporting_unit",
                   "source_reporting_unit_name"))
REPORTERS = DimSpec("reporters", "reporter_id",
                    ("nwcg_reporting_agency", "nwcg_reporting_unit_id", "nwcg_reporting_unit_name"))
FIRE_NAMES = DimSpec("fire_names", "fire_name_id",
                     ("fire_name", "ics_209_name", "fire_code", "mtbs_fire_name"))
FIRE_CAUSES = DimSpec("fire_causes", "fire_cause_id", ("stat_cause_code", "stat_cause_descr"))
FIRE_SIZES = DimSpec("fire_sizes", "fire_size_id", ("fire_size_class",))
OWNERS = DimSpec("owners", "owner_id", ("owner_code", "owner_descr"))
LOCATIONS = DimSpec("locations", "location_id", ("state", "fips_name"))
WEATHER_TYPES = DimSpec("weather_types", "weather_type_id", ("type",))

DATES_TABLE = "dates"
DATES_KEY = "date_dim_id"
CALENDAR_START = "1990-01-01"
CALENDAR_END = "2040-01-01"          # exclusive

FIRE_DIMS = (SOURCES, REPORTERS, FIRE_NAMES, FIRE_CAUSES, FIRE_SIZES, OWNERS, LOCATIONS)

# Columns read from the wildfire source; others stay there.
FIRE_SOURCE_COLS = (
    "OBJECTID", "FOD_ID", "FPA_ID", "SOURCE_SYSTEM_TYPE", "SOURCE_SYSTEM", "NWCG_REPORTING_AGENCY",
    "NWCG_REPORTING_UNIT_ID", "NWCG_REPORTING_UNIT_NAME", "SOURCE_REPORTING_UNIT", "SOURCE_REPORTING_UNIT_NAME",
    "LOCAL_FIRE_REPORT_ID", "LOCAL_INCIDENT_ID", "FIRE_CODE", "FIRE_NAME", "ICS_209_INCIDENT_NUMBER", "ICS_209_NAME",
    "MTBS_ID", "MTBS_FIRE_NAME", "COMPLEX_NAME", "FIRE_YEAR", "DISCOVERY_DATE", "DISCOVERY_DOY", "DISCOVERY_TIME",
    "STAT_CAUSE_CODE", "STAT_CAUSE_DESCR", "CONT_DATE", "CONT_DOY", "CONT_TIME", "FIRE_SIZE", "FIRE_SIZE_CLASS",
    "LATITUDE", "LONGITUDE", "OWNER_CODE", "OWNER_DESCR", "STATE", "COUNTY", "FIPS_CODE", "FIPS_NAME")

# Raw wildfire staging: decimal columns narrowed to INT, to DECIMAL(10,2) and to
# coordinates DECIMAL(11,8); time columns filled with "0000"; Julian date and
# HHMM time pairs combined to timestamps; day-of-year and the date/time parts dropped.
FIRE_INT_COLS = ("FOD_ID", "FIRE_YEAR", "DISCOVERY_DOY", "STAT_CAUSE_CODE", "CONT_DOY", "OWNER_CODE")
FIRE_MONEY_COLS = ("DISCOVERY_DATE", "CONT_DATE", "FIRE_SIZE")
FIRE_COORD_COLS = ("LATITUDE", "LONGITUDE")
MONEY_DECIMAL = "decimal(10,2)"
COORD_DECIMAL = "decimal(11,8)"
FIRE_TIME_FILL = "0000"
FIRE_TIME_COLS = ("CONT_TIME", "DISCOVERY_TIME")
FIRE_DATETIME_PREFIXES = ("DISCOVERY", "CONT")
FIRE_DROP_COLS = ("discovery_doy", "discovery_date", "discovery_time", "cont_doy", "cont_date", "cont_time")

WEATHER_DROP_COLS = ("id", "station_name")
WEATHER_DATE_COL = "date_str"
WEATHER_LOWER_BOUND = "1992-01-01"

# Fire size class -> (lower_bound, upper_bound) in acres; G is open-ended.
SIZE_BANDS = (
    ("A", 0.0, 0.25),
    ("B", 0.26, 9.9),
    ("C", 10.0, 99.9),
    ("D", 100.0, 299.0),
    ("E", 300.0, 999.0),
    ("F", 1000.0, 4999.0),
    ("G", 5000.0, None),
)

QUARTER_NAMES = ("First", "Second", "Third", "Fourth")

FIRES_FACT = FactSpec(
    name="fires_fact",
    roles=(RoleSpec("disc_", "discovery_timestamp", "discovery_date_id"),
           RoleSpec("cont_", "cont_timestamp", "cont_date_id")),
    dims=FIRE_DIMS,
    select=(("objectid", "fire_id"), ("fpa_id", "fpa_id"),
            ("discovery_date_id", "discovery_date_id"), ("cont_date_id", "cont_date_id"),
            ("source_id", "source_id"), ("reporter_id", "reporter_id"),
            ("fire_name_id", "fire_name_id"), ("fire_cause_id", "fire_cause_id"),
            ("fire_size_id", "fire_size_id"), ("owner_id", "owner_id"),
            ("location_id", "location_id"), ("fire_size", "fire_size"),
            ("latitude", "latitude"), ("fire_year", "fire_year"), ("longitude", "longitude"),
            ("CAST(discovery_timestamp AS STRING)", "discovery_timestamp"),
            ("CAST(cont_timestamp AS STRING)", "cont_timestamp"),
            ("fire_year", "year")),
    row_id=("objectid",),
)

WEATHER_FACT = FactSpec(
    name="weather_fact",
    roles=(RoleSpec("weather_", "date_str", "weather_date_dim_id"),),
    dims=(WEATHER_TYPES,),
    select=(("serialid", "weather_outlier_id"), ("weather_date_dim_id", "weather_date_dim_id"),
            ("weather_type_id", "weather_type_id"), ("longitude", "longitude"),
            ("latitude", "latitude"), ("max_temp", "max_temp"), ("min_temp", "min_temp"),
            ("CAST(year(date_str) AS INT)", "year")),
    row_id=("serialid",),
)


def fact_column(spec: FactSpec, staged: str) -> str:
    """Name in the fact of a staged column."""
    return next(alias for expr, alias in spec.select if expr == staged)


def without_missing_dims(spec: FactSpec, columns) -> FactSpec:
    """The fact without the dimensions whose attributes the source lacks."""
    return with_dims(spec, {d.name for d in spec.dims if set(d.attrs) <= set(columns)})


def with_dims(spec: FactSpec, names) -> FactSpec:
    """The fact with the keys of the named dimensions only."""
    dims = tuple(d for d in spec.dims if d.name in names)
    gone = {d.key for d in spec.dims} - {d.key for d in dims}
    return FactSpec(spec.name, spec.roles, dims, tuple(s for s in spec.select if s[0] not in gone),
                    spec.partition_col, spec.row_id)
