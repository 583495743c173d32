from millrace.plans.ingest import BatchLog, run_ingest
from millrace.plans.transform import transform_rows

__all__ = ["BatchLog", "run_ingest", "transform_rows"]
