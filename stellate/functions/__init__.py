from .conform import (cast_columns, columns_of_type, fill_default, lower_names,
                      prefix_names, schema_rows)
from .temporal import (CALENDAR_TYPES, calendar_columns, calendar_sql, date_time, date_time_sql,
                       date_to_julian, date_to_julian_sql, epoch_seconds, hhmm_to_clock,
                       julian_to_date, julian_to_date_sql, quarter_name, week_of_month,
                       week_of_month_sql)

__all__ = [
    "CALENDAR_TYPES", "calendar_columns", "calendar_sql", "cast_columns", "columns_of_type",
    "date_time", "date_time_sql", "date_to_julian", "date_to_julian_sql", "epoch_seconds",
    "fill_default", "hhmm_to_clock", "julian_to_date", "julian_to_date_sql", "lower_names",
    "prefix_names", "quarter_name", "schema_rows", "week_of_month", "week_of_month_sql",
]
