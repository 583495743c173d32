"""Row validity, counts and target constraints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from millrace.errors import EmptySourceError

# The columns that may not be null unless the caller names others.
REQUIRED = ("sku", "name", "description")


def all_present(required: tuple[str, ...] = REQUIRED) -> Column:
    """True where every required column has a value; never null."""
    return reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNotNull() for c in required])


def valid_rows(df: DataFrame, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """Rows in which every required column has a value."""
    return df.filter(all_present(required))


def error_rows(df: DataFrame, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """Rows in which some required column is null: the exact complement of `valid_rows`."""
    return df.filter(~all_present(required))


def with_reject_reason(
    df: DataFrame, required: tuple[str, ...] = REQUIRED, column: str = "reject_reason"
) -> DataFrame:
    """Add the names of the null required columns (``name null, description null``), null if valid."""
    notes = [F.when(F.col(f"`{c}`").isNull(), F.lit(f"{c} null")) for c in required]
    return df.withColumn(column, F.nullif(F.concat_ws(", ", *notes), F.lit("")))


def require_rows(df: DataFrame) -> DataFrame:
    """Return ``df`` unless it is empty. Reads at most one row, not the whole source."""
    if df.isEmpty():
        raise EmptySourceError("the source has no records")
    return df


def observe_counts(df: DataFrame, name: str, **counted: Column) -> tuple[DataFrame, Observation]:
    """Count rows, and the rows matching each condition, in the job that writes ``df`` anyway.

    Call it right before the write, with no shuffle in between: tasks ahead of a shuffle may run
    again when an executor is lost, and would count their rows twice.
    """
    observation = Observation(name)
    counts = [F.count_if(condition).alias(label) for label, condition in counted.items()]
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), *counts), observation


def constraint_violations(
    df: DataFrame,
    unique: tuple[str, ...] = (),
    not_null: tuple[str, ...] = (),
    max_length: dict[str, int] | None = None,
) -> DataFrame:
    """Broken target constraints as ``(constraint_name, column_name, value, n_rows)``.

    All not-null and length checks share one pass over their columns; each unique column has one
    of its own, because it needs a shuffle by its values. Rows are folded per value before they
    move, so a value that fills a third of the table moves as one row per task.
    """

    def broken(kind: str, name: str, where: Column) -> Column:
        row = F.struct(
            F.lit(kind).alias("constraint_name"),
            F.lit(name).alias("column_name"),
            F.col(f"`{name}`").cast("string").alias("value"),
        )
        return F.when(where, row)

    checks = [broken("not null", name, F.col(f"`{name}`").isNull()) for name in not_null]
    checks += [
        broken("max length", name, F.length(F.col(f"`{name}`")) > limit) for name, limit in (max_length or {}).items()
    ]
    n_rows = F.count(F.lit(1)).alias("n_rows")
    found = []
    if checks:
        rows = df.select(F.inline(F.array_compact(F.array(*checks))))
        found.append(rows.groupBy("constraint_name", "column_name", "value").agg(n_rows))
    for name in unique:
        value = df.select(F.col(f"`{name}`").alias("value")).filter("value IS NOT NULL")
        repeated = value.groupBy("value").agg(n_rows).filter("n_rows > 1")
        found.append(
            repeated.select(
                F.lit("unique").alias("constraint_name"),
                F.lit(name).alias("column_name"),
                F.col("value").cast("string").alias("value"),
                "n_rows",
            )
        )
    if not found:
        raise ValueError("name at least one constraint")
    return reduce(DataFrame.unionByName, found)
