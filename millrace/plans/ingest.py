"""One batch from source to both target tables, with an audit event after each phase."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.errors import ConcurrentCommitError, ConstraintError, EmptySourceError, IngestError, PhaseError
from millrace.operators.aggregate import count_by
from millrace.operators.audit import SKIPPED, audit_events
from millrace.operators.merge import PRODUCT_UPDATES
from millrace.operators.quality import REQUIRED, all_present, observe_counts
from millrace.plans.transform import transform_rows
from millrace.sinks.commits import Change
from millrace.sinks.database import DatabaseTable
from millrace.sinks.files import append_audit, write_rejects
from millrace.sinks.tables import PRODUCT_LENGTHS, PRODUCT_NOT_NULL, KeyedTable, commit_together, retried
from millrace.sources import Source, read_source
from millrace.staging import Staging, local_table

_VALID = "row_is_valid"
COUNTED = "name"  # the column of the products that is counted
#: Text of a CSV row with more or fewer fields than the header; null for all others.
MALFORMED = "malformed_row"

BATCHES = T.StructType(
    [
        T.StructField("batch_status", T.StringType()),
        T.StructField("subject_area", T.StringType()),
        T.StructField("business_domain", T.StringType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("err_message", T.StringType()),
        T.StructField("logged_at", T.TimestampType()),
    ]
)


@dataclass
class BatchLog:
    """The phases a batch went through: one small row per phase."""

    spark: SparkSession
    application_id: str
    rows: list[tuple] = field(default_factory=list)

    @contextmanager
    def phase(self, verb: str, status: str, table: str, data_object: str):
        """Run a phase that sets ``count["rows"]``; log it, or log its failure and raise."""
        count = {"rows": 0}
        try:
            yield count
        except Exception as e:
            self.rows.append(("Failure", table, data_object, count["rows"], str(e), datetime.now(UTC)))
            if isinstance(e, IngestError):
                raise
            raise PhaseError(verb, count["rows"], e) from e
        self.rows.append((status, table, data_object, count["rows"], "", datetime.now(UTC)))

    def skip(self, table: str, data_object: str, batch_id: str) -> None:
        """Log that a table holds a batch already."""
        self.rows.append((SKIPPED, table, data_object, 0, f"{batch_id} is stored already", datetime.now(UTC)))

    def batches(self) -> DataFrame:
        return local_table(self.spark, self.rows, BATCHES)

    def events(self) -> DataFrame:
        return audit_events(self.batches(), self.application_id, F.col("logged_at"))


def run_ingest(
    spark: SparkSession,
    source: Source | DataFrame,
    products: KeyedTable | DatabaseTable,
    counts: KeyedTable | DatabaseTable,
    run_date: str | None = None,
    *,
    rejects_path: str,
    audit_path: str | None = None,
    batch_id: str | None = None,
    schema: T.StructType | str | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    required: tuple[str, ...] = REQUIRED,
    only_changed: bool = False,
    counts_mode: str = "upsert",
    max_lengths: Mapping[str, int] = PRODUCT_LENGTHS,
    checksum_null_text: str | None = None,
    not_null: tuple[str, ...] = PRODUCT_NOT_NULL,
    allow_empty: bool = False,
    data_object: str = "PRODUCTS",
    newer_by: str | None = None,
    withdrawn: str | None = None,
) -> BatchLog:
    """Ingest one batch and bring the counts by name up to date.

    Two keyed tables with one log are committed by one record, so a reader sees the batch in both or
    in neither, and a run that dies before it leaves neither changed. The counts move by the signed
    changes of the batch's own rows; the products are not read for them.

    The source is read once: rows are staged with their validity while they are counted. Rows
    without a required value, and CSV rows with more or fewer fields than the header, go to a
    folder of the batch below ``rejects_path``. A value that is too long for its target column, or
    missing where the target allows no null, is an error.

    A batch id that a table already holds is skipped there with an audit event, so a batch may be
    run again after a failure; the default id is the run date and the data object. An empty source
    is an error, or with ``allow_empty`` a batch of no rows, recorded as committed.

    Each batch overwrites what it finds, unless ``newer_by`` names a column of the source and of the products
    that holds a row's version, such as the time of its change: then batches may come in any order and the
    greatest version of each key stays. ``withdrawn`` names a source column that says whether a row takes its
    key away; nulls there say no. Rows without a version are rejected. Both columns take part in the checksum.
    """
    if newer_by and not isinstance(products, KeyedTable):
        raise ValueError("rows are kept by version in a KeyedTable only")
    # A row without its key or version cannot be kept.
    required = tuple(dict.fromkeys((products.key, *([newer_by] if newer_by else []), *required)))
    run_date = run_date or datetime.now(UTC).isoformat(timespec="seconds")
    batch_id = batch_id or f"{run_date} {data_object}"
    log = BatchLog(spark, spark.sparkContext.applicationId)
    staging = Staging(spark)
    stamp = F.lit(datetime.now(UTC).isoformat()).cast("timestamp")
    try:
        if products.has_batch(batch_id):
            log.skip("products", data_object, batch_id)
            before = None
        else:
            with log.phase("read", "Received", "products", data_object) as count:
                valid = _receive(
                    spark, source, schema, prepare, required, staging, count, rejects_path, batch_id, allow_empty
                )
                if withdrawn:
                    valid = valid.withColumn(withdrawn, F.coalesce(F.col(f"`{withdrawn}`").cast("boolean"), F.lit(False)))
            if not count["rows"]:
                _commit_empty(products, counts, batch_id)
                return log
            with log.phase("transform", "Transformed", "products", data_object) as count:
                rows, count["rows"] = _transform(
                    valid, run_date, staging, products, max_lengths, not_null, checksum_null_text, batch_id,
                    tuple(c for c in (newer_by, withdrawn) if c),
                )
                transformed = count["rows"]
            settings = {"stamp": stamp, "unless_equal": "record_checksum" if only_changed else None}
            if newer_by:
                settings.update(newer_by=newer_by, withdrawn=withdrawn)
            with log.phase("load", "Delivered", "products", data_object) as count:
                count["rows"] = transformed
                if _joint(products, counts):
                    facts = retried(lambda: _store_both(products, counts, rows, batch_id, counts_mode, settings))
                else:
                    before = _content(products)
                    change = products.merge(rows, batch_id, PRODUCT_UPDATES, track=COUNTED, **settings)
            if _joint(products, counts):
                _log_counts(log, facts)
                return log
        if counts.has_batch(batch_id):
            log.skip("products_agg", "products_agg", batch_id)
        else:
            moved = None if before is None or change is None else (before, change)
            _refresh_counts(products, counts, batch_id, counts_mode, log, staging, moved)
    finally:
        if audit_path and log.rows:
            append_audit(log.events(), audit_path)
        staging.clear()
    return log


def _joint(products: KeyedTable | DatabaseTable, counts: KeyedTable | DatabaseTable) -> bool:
    """Whether one record commits both tables."""
    both = isinstance(products, KeyedTable) and isinstance(counts, KeyedTable)
    return both and products.log.root == counts.log.root


def _content(products: KeyedTable | DatabaseTable) -> int | None:
    return products.latest()["content"] if isinstance(products, KeyedTable) else None


def _commit_empty(products, counts, batch_id: str) -> None:
    if _joint(products, counts):
        version = products.log.last()["version"]
        empty = [Change(t.name, t.buckets, version) for t in (products, counts)]
        commit_together([products, counts], empty, batch_id)
    else:
        products.commit_empty(batch_id)
        counts.commit_empty(batch_id)


def _signed(products: KeyedTable, change: Change) -> DataFrame:
    """By how much a change of the products moves the count of each name: +1 for a new one, -1 for an old one."""
    moves = products.moves(change, COUNTED)
    steps = moves.select(F.inline(F.array(_step("new", 1), _step("old", -1)))).filter(F.col(COUNTED).isNotNull())
    return steps.groupBy(COUNTED).agg(F.sum("no_of_products").alias("no_of_products")).filter("no_of_products <> 0")


def _step(name: str, by: int) -> Column:
    return F.struct(F.col(name).alias(COUNTED), F.lit(by).cast("long").alias("no_of_products"))


def _store_both(products: KeyedTable, counts: KeyedTable, rows: DataFrame, batch_id: str, mode: str, settings: dict) -> dict:
    """Write what the batch changes in both tables and commit them together; the facts of the counts after it.

    The counts move by what the batch's own rows say. They are counted anew only where they do not
    sum up the products as these are, such as when the counts are new and the products are not.
    """
    change, covers = products.prepare(rows, PRODUCT_UPDATES, track=COUNTED, **settings), (products.name, None)
    covered = counts.latest()["covers"].get(products.name, 0) == products.latest()["content"]
    if covered:
        made = counts.prepare_counts(_signed(products, change), mode, kind="signed", covers=covers)
    else:
        made = counts.prepare_counts(count_by(products.with_change(change), COUNTED, "no_of_products"), mode, kind="all", covers=covers)
    if made.based_on != change.based_on:
        raise ConcurrentCommitError("another writer committed while the batch was merged")
    return commit_together([products, counts], [change, made], batch_id)["tables"][counts.name]["facts"]


def _log_counts(log: BatchLog, facts: dict) -> None:
    for verb, status, fact in (("read", "Received", "rows"), ("aggregate", "Transformed", "names"), ("load", "Delivered", "names")):
        with log.phase(verb, status, "products_agg", "products_agg") as count:
            count["rows"] = facts.get(fact, 0)


def _receive(
    spark, source, schema, prepare, required, staging, count, rejects_path, batch_id, allow_empty
) -> DataFrame:
    """Read the source once into a staged table split by validity; returns the valid rows."""
    raw = source if isinstance(source, DataFrame) else read_source(spark, source, schema, MALFORMED)
    well_formed = F.lit(True)
    if MALFORMED in raw.columns:
        well_formed = F.col(MALFORMED).isNull()
    feed = raw
    if prepare:
        feed = prepare(raw)
        if MALFORMED in raw.columns and MALFORMED not in feed.columns:
            raise ConstraintError(f"prepare must keep the column {MALFORMED} of rows that could not be read")
    missing = [c for c in required if c not in feed.columns]
    if missing:
        raise ConstraintError(f"the source has no column {', '.join(missing)}")
    marked = feed.withColumn(_VALID, all_present(required) & well_formed)
    counted, seen = observe_counts(marked, f"received {batch_id}", rejected=~F.col(_VALID))
    staged = staging.write(counted, "received", (_VALID,))
    count["rows"] = seen.get["rows"]
    if not count["rows"] and not allow_empty:
        raise EmptySourceError("the source has no records")
    if seen.get["rejected"]:
        write_rejects(staged.filter(~F.col(_VALID)).drop(_VALID), rejects_path, batch_id)
    return staged.filter(F.col(_VALID)).drop(_VALID, MALFORMED)


def _transform(
    valid, run_date, staging, products, max_lengths, not_null, null_text, batch_id, version: tuple[str, ...] = ()
) -> tuple[DataFrame, int]:
    """Transform the valid rows; a value that the target's constraints refuse is an error.

    Of a key's rows in the batch the greatest in the columns of ``version``, then in the others, is kept.
    The rows are numbered from 1, and a keyed table reserves as many ids for the batch.
    """
    seen = Observation("transformed")
    keyed = isinstance(products, KeyedTable)
    offset, order_by = 0 if keyed else products.max_id(), (*version, "name", "description")
    made = transform_rows(valid, run_date, staging, offset, order_by=order_by, checksum_null_text=null_text)
    measures = {("rows", ""): F.count(F.lit(1))}
    for name, limit in max_lengths.items():
        if name in made.columns:
            measures["longer than the target column", name] = F.count_if(F.length(F.col(f"`{name}`")) > limit)
    for name in not_null:
        if name in made.columns:
            measures["null where the target allows none", name] = F.count_if(F.col(f"`{name}`").isNull())
    labelled = [c.alias(f"{kind}: {name}" if name else kind) for (kind, name), c in measures.items()]
    rows = staging.write(made.observe(seen, *labelled), "transformed")
    found = seen.get
    broken = [f"{n} values {label}" for label, n in found.items() if label != "rows" and n]
    if broken:
        raise ConstraintError(", ".join(broken))
    if keyed and found["rows"]:
        offset = products.reserve_ids(found["rows"], batch_id)
        rows = rows.withColumn("p_id", F.col("p_id") + F.lit(offset).cast("long"))
    return rows, found["rows"]


def _refresh_counts(products, counts, batch_id, mode, log, staging, moved: tuple[int, Change] | None) -> None:
    """Bring counts with a log of their own up to date, by the batch's signed moves where they summed up the
    products before it, else by counting the products anew."""
    keyed = isinstance(counts, KeyedTable) and isinstance(products, KeyedTable)
    covers = (products.name, products.latest()["content"]) if keyed else None
    if keyed and moved and counts.latest()["covers"].get(products.name, 0) == moved[0] and covers[1] <= moved[0] + 1:
        with log.phase("load", "Received", "products_agg", "products_agg") as count:
            counts.merge_counts(_signed(products, moved[1]), batch_id, mode, kind="signed", covers=covers)
            facts = counts.latest()["facts"]
            count["rows"] = facts.get("rows", 0)
        for verb, status in (("aggregate", "Transformed"), ("load", "Delivered")):
            with log.phase(verb, status, "products_agg", "products_agg") as count:
                count["rows"] = facts.get("names", 0)
        return
    with log.phase("read", "Received", "products_agg", "products_agg") as count:
        seen = Observation(f"counts {batch_id}")
        made = count_by(products.current(), COUNTED, "no_of_products")
        read, names = F.sum("no_of_products").alias("read"), F.count(F.lit(1)).alias("names")
        fresh = staging.write(made.observe(seen, read, names), "counts")
        count["rows"] = seen.get["read"] or 0
    with log.phase("aggregate", "Transformed", "products_agg", "products_agg") as count:
        count["rows"] = seen.get["names"]
    with log.phase("load", "Delivered", "products_agg", "products_agg") as count:
        settings = {"kind": "all", "covers": covers} if keyed else {}
        counts.merge_counts(fresh, batch_id, mode, **settings)
        count["rows"] = seen.get["names"]
