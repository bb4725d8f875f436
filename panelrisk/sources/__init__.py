"""Sources and sinks: CSV scans, lake zones, exports."""

from .csv import PANDAS_NA_TOKENS, normalise_null_tokens, read_csv_files, read_csv_null_tokens
from .lake import export_csv, land, metrics_row, publish, read_zone, resolve, roundtrip, write_metrics

__all__ = ["PANDAS_NA_TOKENS", "normalise_null_tokens", "read_csv_files", "read_csv_null_tokens",
           "export_csv", "land", "metrics_row", "publish", "read_zone", "resolve", "roundtrip",
           "write_metrics"]
