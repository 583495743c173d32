from millrace.sinks.database import (
    DatabaseTable,
    run_statement,
    table_statement,
    upsert_counts,
    upsert_products,
    upsert_rows,
    upsert_statement,
)
from millrace.sinks.drilldown import DrillDown, row_changes
from millrace.sinks.files import append_audit, write_rejects
from millrace.sinks.tables import COUNTS, PRODUCTS, KeyedTable, buckets_for, ensure_table

__all__ = [
    "COUNTS",
    "PRODUCTS",
    "DatabaseTable",
    "DrillDown",
    "KeyedTable",
    "append_audit",
    "buckets_for",
    "ensure_table",
    "row_changes",
    "run_statement",
    "table_statement",
    "upsert_counts",
    "upsert_products",
    "upsert_rows",
    "upsert_statement",
    "write_rejects",
]
