"""File sinks: rejected rows and audit events."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame

from millrace.operators.audit import audit_json


def write_rejects(rejects: DataFrame, path: str, batch_id: str) -> str:
    """Write rejected rows as CSV with a header in a folder of their own batch; returns the folder.

    A batch that is run again replaces its own folder and no other.
    """
    folder = f"{path.rstrip('/')}/batch_id={quote(batch_id, safe='+')}"  # as Spark names partitions
    (
        rejects.write.mode("overwrite")
        .options(header="true", escape='"', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
        .csv(folder)
    )
    return folder


def append_audit(events: DataFrame, path: str) -> None:
    """Append audit events to a folder of JSON lines."""
    audit_json(events).write.mode("append").text(path)
