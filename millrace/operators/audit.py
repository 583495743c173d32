"""Batch audit events as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Statuses of a batch that went well, and what any other status is recorded as.
GOOD_STATUSES = ("Received", "Transformed", "Delivered")
FAILED_EVENT = "Batch Failure"
#: A batch that the target holds already: nothing was done, and nothing is wrong.
SKIPPED = "Skipped"
# Names of the two halves of the business key.
KEY_STRUCTURE = "Business_object|Batch_count"


def audit_events(
    batches: DataFrame, application_id: str, at: Column | None = None, structure: str = KEY_STRUCTURE
) -> DataFrame:
    """Audit records from rows ``(batch_status, subject_area, business_domain, n_rows, err_message)``.

    A good status is an INFO event carrying its own name, and so is a skipped batch; any other is
    an ERROR event carrying the error text.
    """
    good = F.col("batch_status").isin(*GOOD_STATUSES, SKIPPED)
    at = F.current_timestamp() if at is None else at
    halves = (F.col("business_domain"), F.col("n_rows").cast("string"))
    key_value = F.concat(halves[0], F.lit("|"), halves[1])
    return batches.select(
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.when(good, F.col("batch_status")).otherwise(F.col("err_message")).alias("message"),
        F.when(good, F.col("batch_status")).otherwise(F.lit(FAILED_EVENT)).alias("logEvent"),
        F.when(good, F.lit("INFO")).otherwise(F.lit("ERROR")).alias("logLevel"),
        F.col("subject_area").alias("componentName"),
        F.lit(application_id).alias("applicationId"),
        F.when(good, F.lit("success")).otherwise(F.lit("Failure")).alias("status"),
        F.lit(structure).alias("businessKeyStructure"),
        key_value.alias("businessKeyValue"),
        # from the two values themselves: a domain may hold the mark that joins them
        F.map_from_arrays(F.split(F.lit(structure), r"\|"), F.array(*halves)).alias("businessKey"),
    )


def audit_json(events: DataFrame) -> DataFrame:
    """One JSON text per event, nulls written out."""
    return events.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def audit_summary(batches: DataFrame, batch: str = "subject_area") -> DataFrame:
    """Rows per phase and batch: one column per good status, plus ``Failure``."""
    phase = F.when(F.col("batch_status").isin(*GOOD_STATUSES), F.col("batch_status")).otherwise("Failure")
    return (
        batches.filter(~F.col("batch_status").eqNullSafe(SKIPPED))
        .withColumn("__phase", phase)
        .groupBy(_name(batch))
        .pivot("__phase", [*GOOD_STATUSES, "Failure"])
        .agg(F.sum("n_rows"))
    )


def _name(column: str) -> Column:
    return F.col(f"`{column}`")
