"""Merge a batch into a keyed table: insert new keys, update known ones, keep the rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRODUCT_UPDATES = ("name", "description", "request_id", "record_checksum")


def _cols(names) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


def merge_rows(
    target: DataFrame,
    batch: DataFrame,
    key: tuple[str, ...] = ("sku",),
    update: tuple[str, ...] = PRODUCT_UPDATES,
    stamp: Column | None = None,
    stamp_column: str | None = "updt_tmstmp",
    unless_equal: str | None = None,
    action: str | None = None,
    newer_by: tuple[str, ...] = (),
) -> DataFrame:
    """The table after the merge, with the target's columns.

    Unknown keys are inserted from the batch. Known keys take ``update`` from the batch and keep
    every other column (such as their id); both get ``stamp`` (now, by default) in
    ``stamp_column``. Keys only the target has stay as they are. The update is unconditional
    unless ``unless_equal`` names a column (such as the checksum): rows equal in it are kept
    untouched; a null in it, on either side, counts as a change. ``action`` adds a column saying
    insert, update or keep. With ``newer_by`` a known key is updated only where the batch's row is
    greater in these columns, compared in order with nulls least, so the result does not depend on which of two
    batches comes first.

    Both sides hold each key once, so no join key is hot: one full outer join on the key.
    """
    stamp = F.current_timestamp() if stamp is None else stamp
    if stamp_column is not None and stamp_column not in target.columns:
        stamp_column = None
    from_batch = set(batch.columns)
    t = target.withColumn("__in_target", F.lit(True)).alias("t")
    u = batch.withColumn("__in_batch", F.lit(True)).alias("u")
    on = [F.col(f"t.`{k}`") == F.col(f"u.`{k}`") for k in key]

    in_target = F.col("t.__in_target").isNotNull()
    in_batch = F.col("u.__in_batch").isNotNull()
    if unless_equal:
        equal = F.col(f"t.`{unless_equal}`") == F.col(f"u.`{unless_equal}`")
        changed = ~F.coalesce(equal, F.lit(False))
        touched = in_batch & (~in_target | changed)
    else:
        touched = in_batch
    if newer_by:
        kinds = {c: target.schema[c].dataType for c in newer_by}
        new, old = (F.struct(*[F.col(f"{side}.`{c}`").cast(k).alias(c) for c, k in kinds.items()]) for side in "ut")
        touched = touched & (~in_target | (new > old))

    def value(name: str) -> Column:
        old = F.col(f"t.`{name}`")
        new = F.col(f"u.`{name}`") if name in from_batch else F.lit(None).cast(target.schema[name].dataType)
        if name == stamp_column:
            new = stamp.cast(target.schema[name].dataType)
        if name in key:
            return F.coalesce(old, F.col(f"u.`{name}`")).alias(name)
        if name == stamp_column or name in update:
            return F.when(touched, new).otherwise(old).alias(name)
        return F.when(in_target, old).otherwise(new).alias(name)

    what = F.when(~in_target, F.lit("insert")).when(touched, F.lit("update")).otherwise(F.lit("keep"))
    extra = [what.alias(action)] if action else []
    return t.join(u, on, "full_outer").select(*[value(n) for n in target.columns], *extra)


def merge_counts(
    target: DataFrame, batch: DataFrame, key: str = "name", mode: str = "upsert"
) -> DataFrame:
    """Merge fresh counts into a table of counts.

    ``upsert`` keeps the target's rows whose key is not in the batch, as they were, so a value
    that no product carries any more keeps its last count; ``replace`` drops them.
    """
    if mode == "replace":
        return batch.select(*_cols(target.columns))
    if mode != "upsert":
        raise ValueError(f"mode must be upsert or replace, not {mode}")
    counts = tuple(c for c in target.columns if c != key)
    return merge_rows(target, batch, (key,), counts, stamp_column=None)
