"""Writers: Parquet, CSV, JDBC; lineage stamping and routing."""

from martlet.sinks.writers import (  # noqa: F401
    write_parquet, export_csv, write_jdbc, drop_void_columns, restamp_lineage,
    append_new_rows, select_target_columns, route_by_kind,
)
from martlet.sinks.single_file import export_csv_file, join_parts, part_files  # noqa: F401
