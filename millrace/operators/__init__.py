from millrace.operators.aggregate import count_by, count_by_sql, count_rows, max_id
from millrace.operators.audit import audit_events, audit_json, audit_summary
from millrace.operators.hierarchy import (
    hierarchy_document,
    hierarchy_totals,
    write_document,
)
from millrace.operators.latest import latest_by_rank, latest_per_key
from millrace.operators.merge import merge_counts, merge_rows
from millrace.operators.quality import (
    constraint_violations,
    error_rows,
    observe_counts,
    require_rows,
    valid_rows,
    with_reject_reason,
)
from millrace.operators.sequence import (
    with_dense_key,
    with_position,
    with_request_id,
    with_surrogate_key,
)

__all__ = [
    "audit_events",
    "audit_json",
    "audit_summary",
    "constraint_violations",
    "count_by",
    "count_by_sql",
    "count_rows",
    "error_rows",
    "hierarchy_document",
    "hierarchy_totals",
    "latest_by_rank",
    "latest_per_key",
    "max_id",
    "merge_counts",
    "merge_rows",
    "observe_counts",
    "require_rows",
    "valid_rows",
    "with_dense_key",
    "with_position",
    "with_reject_reason",
    "with_request_id",
    "with_surrogate_key",
    "write_document",
]
