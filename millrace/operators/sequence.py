"""Global row positions, running totals and ids without putting the rows through one task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.errors import SequenceOverflowError
from millrace.functions.text import ROW_DIGITS, run_digits, sequence_id
from millrace.operators.latest import sortable
from millrace.staging import Staging, local_table

_SLICE, _SPOT, _TIE, _RUN, _NEXT = "__slice", "__spot", "__tie", "__run", "__next"
_SPOT_MASK = (1 << 33) - 1  # low bits of monotonically_increasing_id: the row's place in its task
_SAMPLED = 20  # sampled rows for each slice
_CUT = 4096  # characters of a text that a bound between slices has at most


def _c(names) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _shared(a: Column, b: Column) -> Column:
    """How many characters two strings of at most ``_CUT`` have in common from the start."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(_CUT.bit_length()))])

    def longer(n: Column, step: Column) -> Column:
        fits = F.least(F.length(a), F.length(b)) >= n + step
        return F.when(fits & (F.substring(a, n + 1, step) == F.substring(b, n + 1, step)), n + step).otherwise(n)

    return F.aggregate(steps, F.lit(0), longer)


def _bounds(df: DataFrame, keys: list[Column], slices: int) -> DataFrame:
    """One row ``b`` with the ordered cuts between slices, each no longer than it takes to part two keys.

    About ``_SAMPLED`` rows for each slice are drawn by their random numbers alone, put in order, and
    every so-maniest is compared with the one before: the cut keeps the columns in which both
    agree, of the first other one as many characters as tell them apart, and nothing of the rest.
    """
    drawn = df.select(F.rand(7).alias("r")).orderBy("r").limit(_SAMPLED * slices).agg(F.max("r")).first()[0]
    sample = df.filter(F.rand(7) <= F.lit(drawn if drawn is not None else 0.0)).select(
        *[k.alias(f"k{i}") for i, k in enumerate(keys)]
    )
    kinds = [f.dataType for f in sample.schema]
    cut = [isinstance(kind, T.StringType) for kind in kinds]
    names = [f"k{i}" for i in range(len(keys))]
    sample = sample.select(*[F.substring(n, 1, _CUT).alias(n) if c else F.col(n) for n, c in zip(names, cut, strict=True)])
    inside = W.partitionBy(F.lit(0))  # the sample alone, some rows for each slice
    row, before = F.struct(*names), F.lag(F.struct(*names)).over(inside.orderBy(*names))
    every = F.greatest(F.floor(F.count(F.lit(1)).over(inside) / slices), F.lit(1))
    placed = sample.select(
        row.alias("own"), before.alias("before"), (F.row_number().over(inside.orderBy(*names)) % every).alias("spot")
    ).filter("spot = 0")
    agree, fields = F.lit(True), []
    for name, short in zip(names, cut, strict=True):
        own, other = F.col(f"own.{name}"), F.col(f"before.{name}")
        same = own.eqNullSafe(other)
        parting = F.substring(own, F.lit(1), F.coalesce(_shared(own, other), F.lit(0)) + 1) if short else own
        fields.append(F.when(agree & same, own).when(agree, parting).alias(name))
        agree = agree & same
    return placed.select(F.struct(*fields).alias("k")).agg(F.sort_array(F.collect_list("k")).alias("b"))


def _slice_of(keys: list[Column], df: DataFrame, slices: int) -> Column:
    """The number of each row's slice: how many bounds its keys reach, found by halving.

    The bounds, one small value for each slice, become a literal. Bounds that come a little off only
    shift the cuts. Rows that agree in the first ``_CUT`` characters of a longer text lie in one slice.
    """
    bounds = _bounds(df, keys, slices)
    text, n = bounds.select(F.to_json("b"), F.size("b")).first()
    found = F.from_json(F.lit(text), bounds.schema["b"].dataType)
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(n.bit_length()))]) if n else F.array().cast("array<int>")

    def place(key: Column) -> Column:
        def further(at: Column, step: Column) -> Column:
            return F.when((at + step <= n) & (F.get(found, at + step - 1) <= key), at + step).otherwise(at)

        return F.aggregate(steps, F.lit(0), further)

    return _with(F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)]), place)


def with_position(
    df: DataFrame,
    order_by: list[str],
    staging: Staging,
    *,
    position: str = "position",
    weight: str | None = None,
    running: str = "running_total",
    ahead: str | None = None,
    unique: bool = False,
    slices: int | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Add the 1-based global position under ``order_by``; with ``weight`` its running total too.

    Rows are cut into ordered slices by short bounds from a sample, and one exchange brings each slice
    together, where it is sorted, numbered and summed. The slices are staged once; only one small
    row per slice (its row count and weight) goes to the driver, which adds the slices up.
    ``ahead`` names a column without nulls whose value in the next row becomes ``next_`` and its
    name, null in the last row. Positions and totals are 64-bit; ``limit`` is the first one that the caller has no room for.

    Unless ``unique`` says that no two rows share the ordering values, the row's place in its
    input file is the last ordering key, so a group of equal rows is spread over as many slices
    as its size asks for. ``df`` is read twice, so it should be a plain scan with filters and
    projections or a staged table, whose row order a re-run repeats.
    """
    columns = df.columns
    keys = _c(order_by)
    if not unique:
        df = df.withColumn(_TIE, F.monotonically_increasing_id())
        keys.append(F.col(_TIE))
    slices = slices or 2 * int(staging.spark.conf.get("spark.sql.shuffle.partitions"))
    inside = W.partitionBy(_SLICE).orderBy(*keys)
    upto = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = df.withColumn(_SLICE, _slice_of(keys, df, slices)).select(
        *_c(columns),
        _SLICE,
        (F.row_number().over(inside).cast("long") - 1).alias(_SPOT),
        *([F.sum(F.col(f"`{weight}`")).over(upto).alias(_RUN)] if weight else []),
        *([F.lead(F.col(f"`{ahead}`")).over(inside).alias(_NEXT)] if ahead else []),
    )
    staged = staging.write(placed, "placed")

    total = F.sum(F.col(f"`{weight}`")) if weight else F.lit(0)
    first = F.min_by(F.col(f"`{ahead}`"), _SPOT) if ahead else F.lit(None).cast("int")
    per_slice = (
        staged.groupBy(_SLICE)
        .agg(F.count(F.lit(1)).alias("rows"), total.cast("long").alias("weight"), first.alias("first"))
        .orderBy(_SLICE)
        .collect()  # one row per slice, whatever the size of the data
    )
    offsets, rows, weights = [], 0, 0
    for part, following in zip(per_slice, [*per_slice[1:], None], strict=False):
        offsets.append((part[_SLICE], rows, weights, following["first"] if following else None))
        rows += part["rows"]
        weights += part["weight"] or 0
    if limit is not None and max(rows, weights) >= limit:
        raise SequenceOverflowError(f"position {max(rows, weights)} needs more digits than there are")

    shape = [("__rows_before", T.LongType()), ("__weight_before", T.LongType())]
    shape.append(("__next_first", df.schema[ahead].dataType if ahead else T.IntegerType()))
    offsets_type = T.StructType([T.StructField(_SLICE, T.IntegerType()), *[T.StructField(*f) for f in shape]])
    before = local_table(staging.spark, offsets, offsets_type)
    out = staged.join(F.broadcast(before), _SLICE)  # a row for each slice
    added = [(F.col("__rows_before") + F.col(_SPOT) + 1).alias(position)]
    if weight:
        added.append((F.col("__weight_before") + F.col(_RUN)).alias(running))
    if ahead:
        # the last row of a slice has none after it there, so it takes the next slice's first
        added.append(F.coalesce(_NEXT, "__next_first").alias(f"next_{ahead}"))
    return out.select(*_c(columns), *added)


def with_request_id(
    df: DataFrame,
    run_date: str,
    staging: Staging,
    order_by: tuple[str, ...] = ("sku", "name", "description"),
    column: str = "request_id",
    slices: int | None = None,
    digits: int = ROW_DIGITS,
) -> DataFrame:
    """Give every row its sequence id: run date digits plus the row's global position.

    Columns outside ``order_by`` extend the ordering, so equal keys are numbered the same way
    in every run. A position of more than ``digits`` digits is an error, never cut.
    """
    ordering = [*order_by, *sortable(df, [c for c in df.columns if c not in order_by])]
    placed = with_position(df, ordering, staging, position="__position", slices=slices, limit=10**digits)
    made = sequence_id(run_digits(F.lit(run_date)), "__position", digits)
    return placed.withColumn(column, made).drop("__position")


def with_surrogate_key(
    df: DataFrame,
    partitions: int,
    offset: int | Column = 0,
    column: str = "p_id",
    unique_key: list[str] | None = None,
) -> DataFrame:
    """Put a unique id above ``offset`` first: row k of task i of n gets ``offset + 1 + k*n + i``.

    Spreads the rows over ``partitions`` tasks, which should follow from the size of the data, and
    needs no counting pass. Ids are unique but follow the layout; use `with_dense_key` for ids that
    depend on the data alone. Where columns identify a row, name them as ``unique_key``: rows are
    then spread and ordered by them, so a task that runs again gives the same ids. Otherwise write
    the result before it is shuffled further, because a re-run may see its rows in another order.
    """
    raw = F.monotonically_increasing_id()
    start = offset if isinstance(offset, Column) else F.lit(offset).cast("long")
    spot, task = raw.bitwiseAND(F.lit(_SPOT_MASK)), F.shiftright(raw, 33)
    key = start + 1 + spot * F.lit(partitions).cast("long") + task
    if unique_key:
        by = _c(unique_key)
        spread = df.repartition(partitions, *by).sortWithinPartitions(*by)
    else:
        spread = df.repartition(partitions)
    return spread.select(key.alias(column), "*")


def with_dense_key(
    df: DataFrame,
    order_by: list[str],
    staging: Staging,
    offset: int = 0,
    column: str = "p_id",
    unique: bool = True,
    slices: int | None = None,
) -> DataFrame:
    """Put ``offset`` plus the global position first: ids ``offset + 1`` and on, without gaps."""
    placed = with_position(df, order_by, staging, position="__position", unique=unique, slices=slices)
    key = (F.lit(offset).cast("long") + F.col("__position")).alias(column)
    return placed.select(key, *[F.col(f"`{c}`") for c in df.columns])
