"""Target tables: catalog DDL, and keyed tables kept as base and delta files of parquet."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.errors import ConcurrentCommitError
from millrace.operators.merge import merge_rows
from millrace.sinks.commits import Change, CommitLog, Parts, empty_state
from millrace.staging import delete_path, list_folder, local_table, read_text, write_once

# Column names, types and lengths of the two target tables.
PRODUCTS_DDL = (
    "p_id BIGINT, sku VARCHAR(70) NOT NULL, name VARCHAR(70) NOT NULL, description VARCHAR(300) NOT NULL, "
    "request_id VARCHAR(40), record_checksum VARCHAR(45) NOT NULL, updt_tmstmp TIMESTAMP"
)
COUNTS_DDL = "name VARCHAR(70) NOT NULL, `no. of products` BIGINT NOT NULL"
PRODUCT_NOT_NULL = ("p_id", "sku", "name", "description", "record_checksum")
PRODUCT_LENGTHS = {"sku": 70, "name": 70, "description": 300, "request_id": 40, "record_checksum": 45}

PRODUCTS = T.StructType(
    [
        T.StructField("p_id", T.LongType()),
        T.StructField("sku", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("request_id", T.StringType()),
        T.StructField("record_checksum", T.StringType()),
        T.StructField("updt_tmstmp", T.TimestampType()),
    ]
)
COUNTS = T.StructType([T.StructField("name", T.StringType()), T.StructField("no_of_products", T.LongType())])

# Columns that files hold beside the table's own: the version that wrote the row, the tracked value
# it had before, whether it was withdrawn, and the true count behind the one that is shown.
_VERSION, _WAS, _GONE, _LIVE, _ACTION = "__version", "__was", "__gone", "__live", "__action"
_HIDDEN = [
    T.StructField(_VERSION, T.LongType()),
    T.StructField(_WAS, T.StringType()),
    T.StructField(_GONE, T.BooleanType()),
    T.StructField(_LIVE, T.LongType()),
]
MOST_PARTS = 16  # a bucket's base and deltas, beyond which a batch folds them whatever their size
ATTEMPTS = 5  # at a batch that other writers come before
ROWS_PER_BUCKET = 250_000  # of products, so that joining and writing one bucket takes some 200 MB


def ensure_table(spark: SparkSession, name: str, ddl: str = PRODUCTS_DDL, location: str | None = None) -> None:
    """Create a parquet catalog table if it is missing; lengths are checked when it is written."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet{place}")


def buckets_for(rows: int, least: int = 4) -> int:
    """How many buckets a table of so many rows needs, each of about ``ROWS_PER_BUCKET`` at most."""
    return max(least, -(-rows // ROWS_PER_BUCKET))


class KeyedTable:
    """A table with one row per key, changed by whole-batch commits.

    Rows are kept by hash of the key in ``buckets`` folders; choose a number that leaves one
    bucket at a size one task writes well, as `buckets_for` does. It is stored with the table, and opening the table
    with another number is an error.

    A bucket is a base file and delta files. A batch that is small beside a bucket adds a delta of
    its own rows, for which the bucket's rows with the same keys are looked up; nothing is
    rewritten. Once a bucket's deltas and the batch exceed ``delta_ratio`` times the rows of its base, the batch
    folds all into a new base, so what is rewritten stays in proportion to what arrives. Readers take the newest row of
    each key. ``delta_ratio=0`` folds with every batch.

    A commit is one small record that names every bucket's files, put in place in one atomic step;
    readers take the last record, so they see a batch wholly or not at all, and no file is
    overwritten while it is read. Tables with the same ``log`` folder can be changed by one record.
    Writers of different buckets may work side by side, see `CommitLog`; ids come from
    `reserve_ids`, so they never clash. It is a folder convention over plain parquet; where the
    catalog has a table format with row-level changes, its ``MERGE`` does this job.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        key: str,
        buckets: int,
        id_column: str | None = None,
        *,
        log: str | None = None,
        delta_ratio: float = 0.25,
    ):
        if buckets < 1:
            raise ValueError("a table has at least one bucket")
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.key, self.buckets, self.id_column, self.delta_ratio = key, buckets, id_column, delta_ratio
        self.name = self.root.rpartition("/")[2]
        self.log = CommitLog(spark, log or self.root)

    def on(self, spark: SparkSession) -> KeyedTable:
        """The same table for another session."""
        return KeyedTable(
            spark, self.root, self.schema, self.key, self.buckets, self.id_column, log=self.log.root, delta_ratio=self.delta_ratio
        )

    def _state(self, record: dict) -> dict:
        state = record["tables"].get(self.name, empty_state(self.buckets))
        if state["buckets"] != self.buckets:
            raise ValueError(f"{self.root} has {state['buckets']} buckets, not {self.buckets}")
        return state

    def latest(self) -> dict:
        """The table in the last record: ``version``, ``files`` by bucket, ``max_id``, ``facts``."""
        return self._state(self.log.last())

    def has_batch(self, batch_id: str) -> bool:
        return self.log.has_batch(batch_id)

    def max_id(self) -> int:
        """The greatest id ever stored; 0 for a new table."""
        return self.latest()["max_id"]

    # --- reading -------------------------------------------------------------------------------

    def _read(self, parts: list[tuple[str, str]], hidden: Iterable[str] = ()) -> DataFrame:
        """Rows of some (bucket, folder) parts as they are stored."""
        schema = T.StructType([*self.schema.fields, *[f for f in _HIDDEN if f.name in hidden]])
        if not parts:
            return local_table(self.spark, [], schema)
        paths = [f"{self.root}/data/{folder}/bucket={b}" for b, folder in parts]
        return self.spark.read.schema(schema).parquet(*paths)

    def _newest(self, rows: DataFrame) -> DataFrame:
        """Of the stored rows of each key the one that was written last."""
        rest = [c for c in rows.columns if c != self.key]
        best = F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), _VERSION).alias("__row")
        picked = [F.col(f"`{c}`") if c == self.key else F.col(f"__row.`{c}`").alias(c) for c in rows.columns]
        return rows.groupBy(F.col(f"`{self.key}`")).agg(best).select(*picked)

    def _present(self, rows: DataFrame, gone: bool) -> DataFrame:
        """Without the rows that were withdrawn, unless ``gone`` asks for them."""
        return rows if gone else rows.filter(~F.coalesce(F.col(_GONE), F.lit(False)))

    def _rows(
        self, state: dict, buckets: Iterable[int] | None = None, hidden: tuple[str, ...] = (), gone: bool = False
    ) -> DataFrame:
        """The rows that count in the given buckets: bases without the keys of their deltas, and the newest of these."""
        files = state["files"]
        wanted = sorted(files if buckets is None else [str(b) for b in buckets if str(b) in files], key=int)
        wanted = [b for b in wanted if files[b]["parts"]]
        folders = {b: [folder for folder, _ in files[b]["parts"]] for b in wanted}
        single = [(b, f[0]) for b, f in folders.items() if len(f) == 1]
        several = [b for b, f in folders.items() if len(f) > 1]
        columns = [*self.schema.names, *[f.name for f in _HIDDEN if f.name in hidden]]
        stored = {_GONE, *hidden}
        out = self._present(self._read(single, stored), gone).select(*columns)
        if several:
            newest = self._newest(self._read([(b, f) for b in several for f in folders[b][1:]], {_VERSION, *stored}))
            base = self._present(self._read([(b, folders[b][0]) for b in several], stored), gone)
            base = base.join(newest.select(self.key), self.key, "left_anti").select(*columns)
            kept = self._present(newest, gone).select(*columns)
            out = (out.unionByName(base) if single else base).unionByName(kept)
        return out

    def current(self, buckets: Iterable[int] | None = None) -> DataFrame:
        """The table now, or only the given buckets of it."""
        return self._rows(self.latest(), buckets)

    def _lookup(
        self, state: dict, buckets: list[int], keys: DataFrame, hidden: tuple[str, ...], gone: bool = False
    ) -> DataFrame:
        """The rows that count of some keys, all in the given buckets; other rows never leave their scan."""
        files = state["files"]
        parts = [(str(b), folder) for b in buckets for folder, _ in files[str(b)]["parts"]]
        found = self._read(parts, {_VERSION, _GONE, *hidden}).join(keys, self.key, "left_semi")
        return self._present(self._newest(found), gone).select(*self.schema.names, *hidden)

    def clashes(self, batch: DataFrame, columns: Iterable[str], update: Iterable[str] = ()) -> DataFrame:
        """Values of unique columns that merging ``batch`` (one row per key) would leave under several keys.

        One row for each: ``constraint_name`` ("unique"), ``column_name``, the ``value`` as text and
        ``n_rows``, how many rows would have it. ``update`` is as in `merge`: columns outside of it keep the stored value of a key
        that is stored. Clashes within the batch count too; nulls never clash. Nothing is written.

        Stored rows are looked up by value. The scan of each base skips row groups by their least and
        greatest value, which tells new ids from stored ones as ids rise; a semi-join leaves the rows whose
        value arrives, and only these meet the batch. Keys of the batch are looked up in their own buckets.
        """
        state, touched, update = self.latest(), self._touched(batch), set(update)
        key, value = F.col(f"`{self.key}`"), F.col("value")
        known = self._lookup(state, [b for b in sorted(touched) if str(b) in state["files"]], batch.select(key), ()).select(key)
        parts = []
        for column in columns:
            comes = batch.select(key, F.col(f"`{column}`").alias("value")).filter(value.isNotNull())
            if column not in update:
                comes = comes.join(known, self.key, "left_anti")
            low, high = comes.agg(F.min(value), F.max(value)).first()
            stored = self._rows(state).filter(F.col(f"`{column}`").between(F.lit(low), F.lit(high)))
            stays = stored.select(key, F.col(f"`{column}`").alias("value")).join(comes.select("value"), "value", "left_semi")
            if column in update:
                stays = stays.join(batch.select(key), self.key, "left_anti")
            rows = comes.select("value").unionByName(stays.select("value")).groupBy("value").agg(F.count(F.lit(1)).alias("n_rows"))
            found = rows.filter("n_rows > 1")
            parts.append(
                found.select(F.lit("unique").alias("constraint_name"), F.lit(column).alias("column_name"), value.cast("string").alias("value"), "n_rows")
            )
        if not parts:
            raise ValueError("name at least one unique column")
        return reduce(DataFrame.unionByName, parts)

    # --- ids -----------------------------------------------------------------------------------

    def reserve_ids(self, n: int, batch_id: str) -> int:
        """Reserve ``n`` ids for a batch; returns the id before the first.

        Blocks follow the greatest stored id and every block whose batch is not stored yet. Each is
        a small file that only one writer can put in place, so blocks of writers side by side never
        overlap. A batch that is run again gets its block again.
        """
        folder = f"{self.root}/ids"
        while True:
            names = sorted(x for x in list_folder(self.spark, folder) if x[0] not in "_.")
            last = json.loads(read_text(self.spark, f"{folder}/{names[-1]}")) if names else {"open": []}
            for first, upto, owner in last["open"]:
                if owner == batch_id and upto - first + 1 >= n:
                    return first - 1
            # Which blocks are settled is asked before the greatest id is read, so no stored id is missed.
            open_ = [block for block in last["open"] if not self.has_batch(block[2])]
            start = max([self.max_id(), *[upto for _, upto, _ in open_]])
            block = {"open": [*open_, [start + 1, start + n, batch_id]]}
            number = int(names[-1].partition(".")[0]) + 1 if names else 1
            if write_once(self.spark, f"{folder}/{number:012d}.json", json.dumps(block)):
                return start

    # --- writing -------------------------------------------------------------------------------

    def _bucket(self) -> Column:
        # the expression Spark partitions by, so partition i of repartition(n, key) is bucket i
        return F.pmod(F.hash(F.col(f"`{self.key}`")), F.lit(self.buckets))

    def _touched(self, batch: DataFrame) -> dict[int, int]:
        """Rows of the batch in each bucket it touches."""
        found = batch.groupBy(self._bucket().alias("bucket")).agg(F.count(F.lit(1)).alias("rows")).collect()
        return {r["bucket"]: r["rows"] for r in found}  # at most one row per bucket

    def _to_fold(self, state: dict, touched: dict[int, int]) -> list[int]:
        """The touched buckets that get a new base."""
        fold = []
        for bucket, rows in sorted(touched.items()):
            parts = state["files"].get(str(bucket), {"parts": []})["parts"]
            beside = rows + sum(n for _, n in parts[1:])
            if not parts or beside > self.delta_ratio * parts[0][1] or len(parts) >= MOST_PARTS:
                fold.append(bucket)
        return fold

    def _write(self, df: DataFrame, folder: str, measures: Mapping[str, Column]) -> dict:
        """Write rows to a new folder, one file for each bucket; returns what was measured on the way."""
        observation = Observation(f"commit {folder}")
        counted = df.observe(observation, *[m.alias(name) for name, m in measures.items()])
        columns = [F.col(f"`{c}`") for c in df.columns if c in (*self.schema.names, *[f.name for f in _HIDDEN])]
        rows = counted.select(*columns, self._bucket().alias("bucket"))
        rows.write.partitionBy("bucket").parquet(f"{self.root}/data/{folder}")
        return observation.get

    def _written(self, folder: str) -> dict[str, int]:
        """Rows of each bucket in a folder; reads no column but the bucket's."""
        if not any(n.startswith("bucket=") for n in list_folder(self.spark, f"{self.root}/data/{folder}")):
            return {}
        schema = T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType())])
        rows = self.spark.read.schema(schema).parquet(f"{self.root}/data/{folder}").groupBy("bucket").count().collect()
        return {str(r["bucket"]): r["count"] for r in rows}

    def _by_bucket(self, df: DataFrame) -> DataFrame:
        """Few rows brought together by bucket, in as many tasks as they need."""
        return df.repartition(self._bucket())

    def _change(
        self, record: dict, folded: DataFrame | None, fold: list[int], delta: DataFrame | None, measures: Mapping[str, Column], **settings
    ) -> Change:
        """Write new bases and deltas; the change that names them."""
        state, folder = self._state(record), f"v{record['version'] + 1:012d}-{uuid.uuid4().hex[:8]}"
        both = [df for df in (folded, delta) if df is not None]
        measures = {"max_id": F.max(F.col(f"`{self.id_column}`")) if self.id_column else F.lit(0).cast("long"), **measures}
        seen = self._write(both[0] if len(both) == 1 else both[0].unionByName(both[1]), folder, measures)
        written = self._written(folder)
        # A folded bucket without rows has no files.
        files: dict[str, Parts] = {str(b): [[folder, written[str(b)]]] if str(b) in written else [] for b in fold}
        for bucket, rows in written.items():
            if bucket not in files:
                files[bucket] = [*state["files"][bucket]["parts"], [folder, rows]]
        facts = {name: seen.get(name) or 0 for name in measures if name != "max_id"}
        return Change(
            self.name, self.buckets, record["version"], files, max_id=seen.get("max_id"), facts=facts, **settings
        )

    def prepare(
        self,
        batch: DataFrame,
        update: tuple[str, ...],
        stamp: Column | None = None,
        stamp_column: str | None = "updt_tmstmp",
        unless_equal: str | None = None,
        track: str | None = None,
        newer_by: str | None = None,
        withdrawn: str | None = None,
    ) -> Change:
        """Write what merging ``batch`` (one row per key) by `merge_rows` changes, for a later commit.

        Buckets to be folded are joined whole, both sides partitioned by bucket, so each task writes
        one base. For the others only stored rows with a key of the batch are read beyond their
        scan. With ``track`` each written row keeps the value of that column before the batch, see `moves`.

        ``newer_by`` names a column with the version of a row: a stored row gives way only to a greater
        version (of equal ones to the withdrawn and then the greater row), so batches may come in any
        order. ``withdrawn`` names a column of the batch that says whether its row takes the key away.
        The table keeps such a row unseen, so that an older one that comes later stays out.
        """
        if withdrawn and not newer_by:
            raise ValueError("rows are withdrawn by version, so newer_by has to name one")
        if newer_by and newer_by not in self.schema.names:
            raise ValueError(f"{self.root} has no column {newer_by} to keep versions in")
        hidden = (_VERSION, _GONE) if newer_by else (_VERSION,)
        if newer_by:
            batch = batch.withColumn(_GONE, F.coalesce(F.col(f"`{withdrawn}`").cast("boolean"), F.lit(False)) if withdrawn else F.lit(False))
            update = tuple(dict.fromkeys((newer_by, _GONE, *update)))
        record = self.log.last()
        state, touched = self._state(record), self._touched(batch)
        if not touched:
            return Change(self.name, self.buckets, record["version"])
        fold, version = self._to_fold(state, touched), record["version"] + 1
        beside = [b for b in sorted(touched) if b not in set(fold)]

        def merged(target: DataFrame, rows: DataFrame) -> DataFrame:
            was = F.col(f"`{track}`") if track else F.lit(None).cast("string")
            if newer_by:
                target = target.withColumn(_GONE, F.coalesce(_GONE, F.lit(False)))
                was = F.when(~F.col(_GONE), was)
            target = target.withColumn(_WAS, was)
            order = update if newer_by else ()
            out = merge_rows(target, rows, (self.key,), update, stamp, stamp_column, unless_equal, _ACTION, order)
            kept = F.col(_ACTION) == "keep"
            return out.withColumn(_VERSION, F.when(kept, F.col(_VERSION)).otherwise(F.lit(version).cast("long")))

        folded = delta = None
        if fold:
            own = batch if not beside else batch.filter(self._bucket().isin(fold))
            target = self._rows(state, fold, hidden, bool(newer_by)).repartition(self.buckets, self.key)
            folded = merged(target, own.repartition(self.buckets, self.key)).drop(_ACTION)
        if beside:
            own = batch if not fold else batch.filter(self._bucket().isin(beside))
            old = self._lookup(state, beside, own.select(self.key), hidden, bool(newer_by))
            delta = self._by_bucket(merged(old, own).filter(F.col(_ACTION) != "keep").drop(_ACTION))
        return self._change(record, folded, fold, delta, {})

    def moves(self, change: Change, track: str) -> DataFrame:
        """(old, new) values of the tracked column for every row that a prepared change wrote; old is null for new
        keys and new for withdrawn ones.

        Reads two columns of the files that the change itself wrote.
        """
        parts = [(b, p[-1][0]) for b, p in change.files.items() if p]
        rows = self._read(parts, (_VERSION, _WAS, _GONE)).filter(F.col(_VERSION) == change.based_on + 1)
        present = ~F.coalesce(F.col(_GONE), F.lit(False))
        return rows.select(F.col(_WAS).alias("old"), F.when(present, F.col(f"`{track}`")).alias("new"))

    def with_change(self, change: Change) -> DataFrame:
        """The table as it will be once a prepared change is committed."""
        state = self.latest()
        return self._rows({**state, "files": {**state["files"], **{b: {"parts": p} for b, p in change.files.items()}}})

    def merge(
        self,
        batch: DataFrame,
        batch_id: str,
        update: tuple[str, ...],
        stamp: Column | None = None,
        stamp_column: str | None = "updt_tmstmp",
        unless_equal: str | None = None,
        track: str | None = None,
        newer_by: str | None = None,
        withdrawn: str | None = None,
    ) -> Change:
        """`prepare` a batch and commit it; worked out again if others changed its buckets meanwhile."""
        settings = (update, stamp, stamp_column, unless_equal, track, newer_by, withdrawn)
        return retried(lambda: self._commit(self.prepare(batch, *settings), batch_id))

    def _commit(self, change: Change, batch_id: str | None) -> Change:
        self.log.commit([change], batch_id)
        return change

    def commit_empty(self, batch_id: str) -> None:
        """Record a batch without rows as committed."""
        self.log.commit([Change(self.name, self.buckets, self.log.last()["version"])], batch_id)

    def compact(self) -> None:
        """Fold the deltas of every bucket into a new base; the rows stay the same."""

        def once() -> Change | None:
            record = self.log.last()
            state = self._state(record)
            fold = [int(b) for b, own in state["files"].items() if len(own["parts"]) > 1]
            if not fold:
                return None
            rows = self._rows(state, fold, (_VERSION, _WAS, _GONE, _LIVE), gone=True).repartition(self.buckets, self.key)
            return self._commit(self._change(record, rows, fold, None, {}, same_rows=True), None)

        retried(once)

    # --- counts --------------------------------------------------------------------------------

    def prepare_counts(
        self, counts: DataFrame, mode: str = "upsert", *, kind: str = "some", covers: tuple[str, int | None] | None = None
    ) -> Change:
        """Write what fresh counts change, for a later commit.

        ``counts`` has the key and a number: the counts of ``some`` keys, of "all" there are, or
        "signed" numbers to add. A key whose true count falls to 0 keeps the last one that was
        shown; ``replace`` removes it, and takes ``some`` for all. The true count is stored beside
        the shown one, so signed numbers go on from it. The facts are ``rows``, the sum of the true
        counts, and ``names``, the number of keys with one above 0.
        """
        if mode not in ("upsert", "replace"):
            raise ValueError(f"mode must be upsert or replace, not {mode}")
        record, hidden = self.log.last(), (_VERSION, _LIVE)
        state, version = self._state(record), F.lit(record["version"] + 1).cast("long")
        (shown,) = [c for c in self.schema.names if c != self.key]
        key = F.col(f"`{self.key}`")
        given = counts.select(key, F.col(f"`{shown}`").cast("long").alias("__given"))

        def joined(old: DataFrame, new: DataFrame, kind: str) -> DataFrame:
            old = old.withColumn(_LIVE, F.coalesce(_LIVE, F.col(f"`{shown}`"))).withColumn("__stored", F.lit(True))
            before = F.coalesce(_LIVE, F.lit(0))
            live = {"signed": before + F.coalesce("__given", F.lit(0)), "some": F.coalesce("__given", _LIVE), "all": F.coalesce("__given", F.lit(0))}
            out = old.join(new, self.key, "full_outer").withColumn("__was_live", before).withColumn(_LIVE, live[kind].cast("long"))
            changed = F.col("__stored").isNull() | (F.col(_LIVE) != F.col("__was_live"))
            return out.withColumn("__changed", changed).select(
                key,
                F.when(F.col(_LIVE) > 0, F.col(_LIVE)).otherwise(F.coalesce(F.col(f"`{shown}`"), F.col(_LIVE))).alias(shown),
                _LIVE,
                F.when(F.col("__changed"), version).otherwise(F.col(_VERSION)).alias(_VERSION),
                "__was_live",
                "__changed",
            )

        def stored(rows: DataFrame) -> DataFrame:
            return rows.drop("__was_live", "__changed")

        absolute = {"rows": F.sum(_LIVE), "names": F.count_if(F.col(_LIVE) > 0)}
        if mode == "replace":
            target = self._rows(state, None, hidden).repartition(self.buckets, self.key)
            rows = joined(target, given.repartition(self.buckets, self.key), "signed" if kind == "signed" else "all")
            everything = list(range(self.buckets))
            change = self._change(record, stored(rows.filter(F.col(_LIVE) > 0)), everything, None, absolute, absolute=True, whole=True, covers=covers)
            change.files = {b: parts for b, parts in change.files.items() if parts}
            return change
        totals = None
        if kind == "all":
            totals = given.agg(F.sum("__given").alias("rows"), F.count_if(F.col("__given") > 0).alias("names")).first()
            differing = joined(self._rows(state, None, hidden), given, "all").filter("__changed")
            given, kind = differing.select(key, F.col(_LIVE).alias("__given")), "some"
        touched = self._touched(given)
        change = Change(self.name, self.buckets, record["version"], covers=covers)
        if touched:
            fold = self._to_fold(state, touched)
            beside = [b for b in sorted(touched) if b not in set(fold)]
            folded = delta = None
            if fold:
                own = given if not beside else given.filter(self._bucket().isin(fold))
                target = self._rows(state, fold, hidden).repartition(self.buckets, self.key)
                folded = joined(target, own.repartition(self.buckets, self.key), kind)
            if beside:
                own = given if not fold else given.filter(self._bucket().isin(beside))
                delta = self._by_bucket(joined(self._lookup(state, beside, own.select(self.key), hidden), own, kind).filter("__changed"))
            measures = {
                "rows": F.sum(F.col(_LIVE) - F.col("__was_live")),
                "names": F.sum((F.col(_LIVE) > 0).cast("long") - (F.col("__was_live") > 0).cast("long")),
            }
            change = self._change(record, folded, fold, delta, measures, covers=covers)
        if totals is not None:
            change.facts, change.absolute = {"rows": totals["rows"] or 0, "names": totals["names"] or 0}, True
        return change

    def merge_counts(
        self, counts: DataFrame, batch_id: str, mode: str = "upsert", *, kind: str = "some", covers: tuple[str, int | None] | None = None
    ) -> Change:
        """`prepare_counts` and commit; worked out again if others changed the same buckets meanwhile."""
        return retried(lambda: self._commit(self.prepare_counts(counts, mode, kind=kind, covers=covers), batch_id))

    # --- upkeep --------------------------------------------------------------------------------

    def remove_unused(self, keep: int = 2) -> int:
        """Delete bucket folders and records of all but the last ``keep`` versions; returns how many folders.

        Also removes what a writer that died left behind, so run it while no batch is running.
        """
        if keep < 1:
            raise ValueError("keep at least the last version")
        names = self.log.names()[-keep:]
        used = {
            (folder, b)
            for name in names
            for b, own in self._state(self.log.read(name))["files"].items()
            for folder, _ in own["parts"]
        }
        removed = 0
        for folder in list_folder(self.spark, f"{self.root}/data"):
            path = f"{self.root}/data/{folder}"
            buckets = [n for n in list_folder(self.spark, path) if n.startswith("bucket=")]
            unused = [n for n in buckets if (folder, n.removeprefix("bucket=")) not in used]
            if len(unused) == len(buckets):
                delete_path(self.spark, path)
            else:
                for name in unused:
                    delete_path(self.spark, f"{path}/{name}")
            removed += len(unused)
        self.log.remove_before(names)
        reserved = sorted(n for n in list_folder(self.spark, f"{self.root}/ids") if n[0] != ".")
        for name in reserved[:-1]:
            delete_path(self.spark, f"{self.root}/ids/{name}")
        return removed


def retried(attempt: Callable[[], Change | None]) -> Change | None:
    """Try a commit again on top of what other writers committed first."""
    for left in reversed(range(ATTEMPTS)):
        try:
            return attempt()
        except ConcurrentCommitError:
            if not left:
                raise


def commit_together(tables: list[KeyedTable], changes: list[Change], batch_id: str | None) -> dict:
    """Commit changes of tables with one log by one record: readers see all of them or none."""
    if len({t.log.root for t in tables}) != 1:
        raise ValueError("tables that are committed together share a log")
    return tables[0].log.commit(changes, batch_id)
