"""Reading and writing tables."""

from ledgerlens.sources.layout import parquet_ranges, read_days, write_by_day
from ledgerlens.sources.readers import read_csv, read_parquet, register
from ledgerlens.sources.writers import export_predictions, export_result, flatten_predictions, write_csv

__all__ = [
    "export_predictions",
    "export_result",
    "flatten_predictions",
    "parquet_ranges",
    "read_csv",
    "read_days",
    "read_parquet",
    "register",
    "write_by_day",
    "write_csv",
]
