"""Keep one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sortable(df: DataFrame, columns: list[str]) -> list[str]:
    """Those of the columns whose values have an order."""
    return [c for c in columns if not isinstance(df.schema[c].dataType, (T.MapType, T.VariantType))]


def latest_per_key(
    df: DataFrame, key: tuple[str, ...] = ("sku",), order_by: tuple[str, ...] = ("request_id",)
) -> DataFrame:
    """The row with the greatest ``order_by`` per key; ties go to the greatest remaining columns.

    An aggregate, so each task sends at most one row per key, however often the key occurs.
    """
    rest = [c for c in df.columns if c not in key and c not in order_by]
    ordered = sortable(df, rest)
    ordering = [F.col(f"`{c}`") for c in [*order_by, *ordered]]
    keys = [F.col(f"`{c}`") for c in key]
    if len(ordered) == len(rest):
        best = F.max(F.struct(*ordering))
    else:
        best = F.max_by(F.struct(*[F.col(f"`{c}`") for c in [*order_by, *rest]]), F.struct(*ordering))
    found = df.groupBy(*keys).agg(best.alias("__best"))
    picked = [F.col(f"`{c}`") if c in key else F.col(f"__best.`{c}`").alias(c) for c in df.columns]
    return found.select(*picked)


def latest_by_rank(
    df: DataFrame, key: tuple[str, ...] = ("sku",), order_by: tuple[str, ...] = ("request_id",)
) -> DataFrame:
    """The same rows by ``row_number() = 1``; each task drops all but its first row per key
    ahead of the shuffle. Use it when the columns cannot be compared as a struct."""
    ties = sortable(df, [c for c in df.columns if c not in key and c not in order_by])
    rank = F.row_number().over(
        W.partitionBy(*[F.col(f"`{c}`") for c in key]).orderBy(*[F.col(f"`{c}`").desc() for c in [*order_by, *ties]])
    )
    return df.withColumn("rank", rank).filter(F.col("rank") == 1).drop("rank")
