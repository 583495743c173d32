"""Keyed batch and incremental ingestion as DataFrame functions."""

from millrace.sinks.tables import KeyedTable
from millrace.staging import Staging, shared_folder

__all__ = ["KeyedTable", "Staging", "shared_folder"]
