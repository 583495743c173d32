"""From valid rows to rows ready for the target: sequence id, latest per key, checksum, key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import ROW_DIGITS, record_checksum, run_digits, sequence_id
from millrace.operators.aggregate import count_by
from millrace.operators.latest import latest_by_rank, sortable
from millrace.operators.sequence import with_position, with_surrogate_key
from millrace.staging import Staging


def transform_rows(
    valid: DataFrame,
    run_date: str,
    staging: Staging,
    offset: int = 0,
    key: str = "sku",
    order_by: tuple[str, ...] = ("name", "description"),
    id_column: str = "p_id",
    dense_ids: bool = True,
    partitions: int | None = None,
    slices: int | None = None,
    checksum_delimiter: str = "",
    checksum_null_text: str | None = None,
) -> DataFrame:
    """``id_column``, the source columns, ``request_id`` and ``record_checksum``, one row per key.

    The batch is numbered by key, then ``order_by``, then the other columns, and each key keeps
    its last row. That row is the key's greatest one and its number is the count of rows up to
    and including the key, so the rows themselves are never sorted as a whole. One pass counts
    rows per key and turns the counts into running totals, moving the key column alone; one pass
    keeps the greatest row per key, first inside each task. Their results meet by key.

    ``valid`` is read twice, so it should be a plain read of a stored table; its key must not be
    null, as `valid_rows` sees to. ``dense_ids`` numbers the keys in order from ``offset + 1``;
    otherwise ids follow the layout over ``partitions`` tasks, as `with_surrogate_key` describes.
    """
    if not dense_ids and not partitions:
        raise ValueError("ids by layout need a number of partitions")
    columns = valid.columns
    ordering = [*order_by, *sortable(valid, [c for c in columns if c != key and c not in order_by])]
    numbers = with_position(
        staging.write(count_by(valid, key, "__rows"), "counted"),
        [key],
        staging,
        position="__position",
        weight="__rows",
        running="__upto",
        unique=True,
        slices=slices,
        limit=10**ROW_DIGITS,
    )
    kept = latest_by_rank(valid, (key,), tuple(ordering))
    made = kept.join(numbers, key).select(
        (F.lit(offset).cast("long") + F.col("__position")).alias(id_column),
        *[F.col(f"`{c}`") for c in columns],
        sequence_id(run_digits(F.lit(run_date)), "__upto").alias("request_id"),
        record_checksum(columns, checksum_delimiter, checksum_null_text).alias("record_checksum"),
    )
    if dense_ids:
        return made
    return with_surrogate_key(made.drop(id_column), partitions, offset, id_column, unique_key=[key])
