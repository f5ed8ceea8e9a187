"""Typed scans, literal relations, table layout and sinks."""

from .layout import lay_out
from .sinks import order_manifest, publish, publish_bundle, read_bundle, write_table
from .tables import (TABLE_SCHEMAS, literal_table, numeric_columns, read_csv, read_csv_with_rejects, read_in_order,
                     read_table, select_existing)

__all__ = ["TABLE_SCHEMAS", "lay_out", "literal_table", "numeric_columns", "order_manifest", "publish",
           "publish_bundle", "read_bundle", "read_csv", "read_csv_with_rejects", "read_in_order", "read_table",
           "select_existing", "write_table"]
