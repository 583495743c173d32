from millrace.sources.config import Source, parse_options, parse_sources
from millrace.sources.ranges import csv_records, read_csv_by_ranges
from millrace.sources.readers import (
    PRODUCT_FEED,
    inline_rows,
    jdbc_options,
    read_csv,
    read_source,
    read_table,
)

__all__ = [
    "PRODUCT_FEED",
    "Source",
    "csv_records",
    "inline_rows",
    "jdbc_options",
    "parse_options",
    "parse_sources",
    "read_csv",
    "read_csv_by_ranges",
    "read_source",
    "read_table",
]
