"""Grouped counts and scalar look-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, column: str = "name", count_column: str = "count_of_names") -> DataFrame:
    """Rows per value of ``column``, folded in each task ahead of the shuffle."""
    return df.groupBy(F.col(f"`{column}`")).agg(F.count(F.lit(1)).alias(count_column))


def count_by_sql(
    df: DataFrame, column: str = "name", count_column: str = "count_of_names", view: str = "keyed_rows"
) -> DataFrame:
    """The same count as SQL over a temporary view of ``df``."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(f"SELECT `{column}`, count(*) AS `{count_column}` FROM {view} GROUP BY `{column}`")


def count_rows(df: DataFrame, column: str = "n_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(column))


def max_id(df: DataFrame, column: str = "p_id") -> DataFrame:
    """The greatest id, 0 when there is none; reads that one column."""
    return df.agg(F.coalesce(F.max(F.col(f"`{column}`")), F.lit(0)).cast("long").alias("max_id"))
