"""Drill-down sums that are kept up to date by signed changes of the rows below them."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sinks.commits import Change, CommitLog, empty_state
from millrace.sinks.tables import MOST_PARTS, retried
from millrace.staging import delete_path, list_folder, local_table

_ROWS = "__rows"


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def row_changes(gone: DataFrame, come: DataFrame, change: str = "change") -> DataFrame:
    """Rows that go with -1 and rows that come with 1; an updated row is among both, as it was and as it is."""
    return gone.withColumn(change, F.lit(-1)).unionByName(come.withColumn(change, F.lit(1)))


class DrillDown:
    """The stored result of `hierarchy_totals`, to which batches add signed changes.

    A batch is folded to one delta row for each node that it touches, from the changed rows up to the
    whole, and written beside what is stored; neither the rows below nor the stored sums are read.
    Readers sum up the parts. Once the deltas exceed ``delta_ratio`` times the rows of the first part, or are very
    many, the batch folds all into a new first part, so what is rewritten stays in proportion to what arrives.

    Each node counts its rows too, and goes with the last of them. Sums are exact, so the value is a
    whole number or a decimal; other types are an error. ``log`` is as in `KeyedTable`: with the same
    folder, `prepare`d changes are committed together with those of other tables. A batch that is
    stored already is refused by its id.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        headers: list[str],
        value: str,
        *,
        log: str | None = None,
        delta_ratio: float = 0.25,
    ):
        if {"level", "value", _ROWS} & set(headers):
            raise ValueError("headers named level or value would clash with the result's columns")
        self.kind = schema[value].dataType
        if not isinstance(self.kind, (T.IntegralType, T.DecimalType)):
            raise ValueError(f"sums of {self.kind.simpleString()} are not exact, so they cannot be kept by changes")
        self.spark, self.root, self.headers, self.value = spark, root.rstrip("/"), headers, value
        self.delta_ratio = delta_ratio
        self.name = self.root.rpartition("/")[2]
        self.log = CommitLog(spark, log or self.root)
        sums = spark.range(0).agg(F.sum(F.lit(None).cast(self.kind)).alias("value")).schema["value"].dataType
        shown = [T.StructField(h, schema[h].dataType) for h in headers]
        level, total, rows = T.StructField("level", T.IntegerType()), T.StructField("value", sums), T.StructField(_ROWS, T.LongType())
        self.stored = T.StructType([level, *shown, total, rows])

    def _parts(self, record: dict) -> list[list]:
        files = record["tables"].get(self.name, empty_state(1))["files"]
        return files["0"]["parts"] if files else []

    def _read(self, parts: list[list]) -> DataFrame:
        if not parts:
            return local_table(self.spark, [], self.stored)
        return self.spark.read.schema(self.stored).parquet(*[f"{self.root}/data/{folder}" for folder, _ in parts])

    def _folded(self, nodes: DataFrame) -> DataFrame:
        """One row for each node, without those that nothing is left of."""
        sums = nodes.groupBy(*[_c(k) for k in ("level", *self.headers)]).agg(
            F.sum("value").cast(self.stored["value"].dataType).alias("value"), F.sum(_ROWS).alias(_ROWS)
        )
        return sums.filter((F.col("value") != 0) | (F.col(_ROWS) != 0))

    def node_changes(self, changes: DataFrame, change: str = "change") -> DataFrame:
        """One row for each touched node: ``level``, the headers down to it, and what its sum and rows change by."""
        number, sign = _c(self.value).cast(self.kind), _c(change)
        if set(self.headers) - set(changes.columns):
            raise ValueError(f"changes lack {sorted(set(self.headers) - set(changes.columns))}")
        signed = F.when(sign == 1, number).when(sign == -1, -number)
        wrong = F.raise_error(F.lit("a change is 1 or -1")).cast("long")
        rows = F.when(sign.isin(1, -1), sign.cast("long")).otherwise(wrong)
        folded = changes.groupBy(*[_c(h) for h in self.headers]).agg(
            F.coalesce(F.sum(signed), F.lit(0)).alias("value"), F.sum(rows).alias(_ROWS)
        )
        depth = sum((F.lit(1) - F.grouping(h) for h in self.headers), F.lit(0))
        nodes = folded.rollup(*self.headers).agg(
            depth.cast("int").alias("level"), F.sum("value").cast(self.stored["value"].dataType).alias("value"), F.sum(_ROWS).alias(_ROWS)
        )
        whole = reduce(lambda a, b: a & b, [(F.col("level") <= i) | _c(h).isNotNull() for i, h in enumerate(self.headers)])
        return nodes.filter(whole & ((F.col("value") != 0) | (F.col(_ROWS) != 0))).select("level", *[_c(h) for h in self.headers], "value", _ROWS)

    def _write(self, nodes: DataFrame) -> list:
        """Write nodes to a new folder: its name and their number."""
        folder = uuid.uuid4().hex
        nodes.write.parquet(f"{self.root}/data/{folder}")
        return [folder, self._read([[folder, 0]]).count()]

    def prepare(self, changes: DataFrame, change: str = "change") -> Change:
        """Write what signed rows change, for a later commit."""
        record = self.log.last()
        parts = self._parts(record)
        delta = self.node_changes(changes, change)
        new = self._write(delta)
        parts_after = [*parts, new]
        if parts and (sum(n for _, n in parts_after[1:]) > self.delta_ratio * parts[0][1] or len(parts) >= MOST_PARTS):
            parts_after = [self._write(self._folded(self._read(parts_after)))]
        return Change(self.name, 1, record["version"], {"0": parts_after} if new[1] else {})

    def apply(self, changes: DataFrame, batch_id: str, change: str = "change") -> Change:
        """`prepare` and commit; worked out again on top of what another writer committed first."""

        def once() -> Change:
            prepared = self.prepare(changes, change)
            self.log.commit([prepared], batch_id)
            return prepared

        return retried(once)

    def current(self) -> DataFrame:
        """The nodes as `hierarchy_totals` gives them for the rows as they are."""
        return self._folded(self._read(self._parts(self.log.last()))).filter(F.col(_ROWS) > 0).drop(_ROWS)

    def remove_unused(self) -> int:
        """Delete the folders that the last record does not name; run it while no batch is running and no reader is."""
        used = {folder for folder, _ in self._parts(self.log.last())}
        unused = [n for n in list_folder(self.spark, f"{self.root}/data") if n not in used]
        for folder in unused:
            delete_path(self.spark, f"{self.root}/data/{folder}")
        return len(unused)
