from .dims import (build_dates, build_dim, build_dims, build_dims_with_stats, date_sequence, dim_table,
                   new_members, refresh_dim, role_play, with_size_bands)
from .facts import build_fact, calendar_misses, join_dates, role_date_report, star_join
from .joins import fits_broadcast, null_safe_condition, null_safe_join
from .keys import GroupStats, dense_key, dense_key_with_stats
from .quality import (duplicate_key_report, max_profile, null_key_report, null_profile, orphan_report,
                      row_count_report, schema_profile)

__all__ = [
    "GroupStats", "build_dates", "build_dim", "build_dims", "build_dims_with_stats", "build_fact",
    "calendar_misses", "date_sequence", "dense_key", "dense_key_with_stats", "dim_table",
    "duplicate_key_report", "fits_broadcast", "join_dates", "max_profile", "new_members",
    "null_key_report", "null_profile", "null_safe_condition", "null_safe_join", "orphan_report",
    "refresh_dim", "role_date_report", "role_play", "row_count_report", "schema_profile",
    "star_join", "with_size_bands",
]
