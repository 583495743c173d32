"""Mixing sources to target weights by Pfair scheduling of their blocks."""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from fractions import Fraction
from math import gcd, isqrt, lcm

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.sequence import with_position
from millrace.staging import Staging

BLOCK_ROWS = 16
MOST_SLOTS = 1 << 20  # in a period; the driver makes the schedule of one


def whole_weights(weights: dict) -> dict:
    """The least whole numbers in the proportions of the weights, taken as decimals: blocks in one period."""
    exact = {name: Fraction(str(w)) for name, w in weights.items()}
    scale = lcm(*[w.denominator for w in exact.values()])
    whole = {name: int(w * scale) for name, w in exact.items()}
    shared = gcd(*whole.values())
    whole = {name: w // shared for name, w in whole.items()}
    if sum(whole.values()) > MOST_SLOTS:
        raise ValueError(f"the weights repeat after {sum(whole.values())} blocks, more than {MOST_SLOTS}; use rounder ones")
    return whole


def pfair(weights: list, blocks: list[int]) -> Iterator[tuple[int, int, int]]:
    """(source, block, slot) of so many blocks of each source: earliest deadline first among released blocks.

    With a share w of all weights, block j (from 0) of a source is released at j / w, rounded down,
    and due by (j + 1) / w, rounded up, in exact fractions. Each block gets a slot inside its
    window, so after any number of slots a source with blocks left is less than one block from its
    exact share. Slots in which no block is released stay empty.
    """
    total = sum(map(Fraction, weights))
    spans = [(total / Fraction(w)).as_integer_ratio() for w in weights]  # slots for each block
    waiting = [(0, source, 0) for source, n in enumerate(blocks) if n]
    ready: list[tuple[int, int, int]] = []
    slot = 0
    while waiting or ready:
        if not ready:
            slot = max(slot, waiting[0][0])
        while waiting and waiting[0][0] <= slot:
            _, source, block = heapq.heappop(waiting)
            over, under = spans[source]
            heapq.heappush(ready, (-(-(block + 1) * over // under), source, block))
        _, source, block = heapq.heappop(ready)
        yield source, block, slot
        slot += 1
        if block + 1 < blocks[source]:
            over, under = spans[source]
            heapq.heappush(waiting, ((block + 1) * over // under, source, block + 1))


def schedule(quota: list[int]) -> list[tuple[int, int, int]]:
    """(source, block, slot) for one period in which each source gets its quota of blocks."""
    return list(pfair(quota, quota))


def _rows(spark, values: list[dict], schema: str) -> DataFrame:
    """A DataFrame of a few rows that the driver made."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(values)), f"array<struct<{schema}>>")))


def mix_sources(
    docs: DataFrame,
    staging: Staging,
    *,
    weights: dict | None = None,
    id: str = "doc_id",
    source: str = "source",
    power: float = 0.5,
    block_rows: int = BLOCK_ROWS,
    columns: tuple[str, ...] = (),
) -> DataFrame:
    """Give every row its place in a mixture that follows target weights from its first block on.

    ``weights`` maps each source (None for rows without one) to its target; without them a source of
    n rows weighs the whole part of n to the ``power``. Rows of a source are put in order of a hash
    of their id and cut into blocks of ``block_rows``. Weights are whole numbers, or are brought to the least ones
    in the same proportions, so their exact shares repeat after as many blocks as these add up to. The
    driver makes a Pfair schedule of that one period, and a column expression repeats it: after every
    slot of the whole run a source with blocks left is less than one block from its exact
    target. Weights that only repeat after more than ``MOST_SLOTS`` blocks are an error, never rounded.

    A source that has run out leaves its slots empty, and the others go on in their proportions. No
    row is dropped or repeated.

    Returns ``doc_id``, ``source``, ``mix_block`` (in the source), ``mix_slot``, ``mix_place`` (in
    the block) and, if asked for, a struct ``doc`` of ``columns``. Rows are numbered with a range
    partitioning, so a source that holds most rows is spread over many tasks. Null ids have a hash
    too; equal ids, repeated rows among them, are ordered by their place in the input. An empty table gives an
    empty result; texts are not read. A source without a positive weight is an error, because its
    rows would be lost. Only one number for each source reaches the driver.
    """
    spark = docs.sparkSession
    plain = docs.select(
        F.col(f"`{id}`").cast("long").alias("doc_id"),
        F.col(f"`{source}`").cast("string").alias("source"),
        F.col(f"`{source}`").isNull().cast("int").alias("unnamed"),
        F.md5(F.coalesce(F.col(f"`{id}`").cast("string"), F.lit(""))).alias("draw"),
        *([F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc")] if columns else []),
    )
    counts = {r["source"]: r["count"] for r in plain.groupBy("source").count().collect()}
    names = sorted(counts, key=lambda name: (name is None, name or ""))
    given = weights
    if given is None:
        given = {name: max(1, isqrt(n) if power == 0.5 else int(n**power)) for name, n in counts.items()}
    without = [name for name in names if not given.get(name, 0) > 0]
    if without:
        raise ValueError(f"no positive weight for sources {without}")
    quota = whole_weights({name: given[name] for name in names}) if names else {}
    period, before = sum(quota.values()), 0
    sources = []
    for number, name in enumerate(names):
        sources.append(
            {"source": name, "number": number, "quota": quota[name], "before": before, "unnamed": int(name is None)}
        )
        before += counts[name]
    table = _rows(spark, sources, "source string, number long, quota long, before long, unnamed int")
    positioned = with_position(plain, ["unnamed", "source", "draw", "doc_id"], staging, position="position")
    same = positioned["source"].eqNullSafe(table["source"])
    row = F.col("position") - 1 - F.col("before")
    # The table has a row for each source.
    blocked = (
        positioned.join(F.broadcast(table), same)
        .drop(table["source"], table["unnamed"])
        .withColumn("mix_block", F.floor(row / block_rows))
        .withColumn("mix_place", F.pmod(row, F.lit(block_rows)))
    )
    placed = np.array(schedule([quota[name] for name in names]), np.int64).reshape(-1, 3)
    period_table = pa.table([pa.array(c) for c in placed.T], names=["number", "turn", "slot"])
    # A row for each slot of a period; Spark broadcasts it where it is small.
    places = staging.write(spark.createDataFrame(period_table), "schedule")
    turned = blocked.withColumn("turn", F.pmod("mix_block", "quota"))
    out = turned.join(places, ["number", "turn"])
    slot = F.floor(F.col("mix_block") / F.col("quota")) * period + F.col("slot")
    return out.select(
        "doc_id", "source", "mix_block", slot.alias("mix_slot"), "mix_place", *(["doc"] if columns else [])
    )


def in_mixed_order(mixed: DataFrame) -> DataFrame:
    """The rows in the order of the mixture, in as many ordered partitions as Spark shuffles to."""
    return mixed.repartitionByRange("mix_slot", "mix_place").sortWithinPartitions("mix_slot", "mix_place")
