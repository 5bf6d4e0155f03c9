from .readers import (TABLES, jdbc_bounds_options, read_csv, read_jdbc, read_table,
                      run_sql, select_query)

__all__ = ["TABLES", "jdbc_bounds_options", "read_csv", "read_jdbc", "read_table", "run_sql", "select_query"]
