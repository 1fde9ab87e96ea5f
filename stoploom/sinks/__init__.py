"""Writing merged tables and reports."""

from stoploom.sinks.counted import write_counted
from stoploom.sinks.writers import (
    publish,
    save_table_if_db,
    write_csv,
    write_partitioned,
)

__all__ = ["publish", "save_table_if_db", "write_counted", "write_csv", "write_partitioned"]
