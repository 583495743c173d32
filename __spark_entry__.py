"""

Every query reads whole tables. Batches are whole tables split by an attribute of their rows, such
as the ship date or the part type, and every part of the split is processed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import KeyedTable, Staging
from millrace.functions import number_text, record_checksum, run_digits, run_hour, zipped_map
from millrace.job import open_tables, run_sources
from millrace.operators import (
    audit_events,
    audit_json,
    audit_summary,
    constraint_violations,
    count_by,
    count_by_sql,
    count_rows,
    error_rows,
    hierarchy_document,
    hierarchy_totals,
    latest_by_rank,
    latest_per_key,
    max_id,
    merge_counts,
    merge_rows,
    observe_counts,
    require_rows,
    valid_rows,
    with_dense_key,
    with_reject_reason,
    with_request_id,
    with_surrogate_key,
    write_document,
)
from millrace.operators.merge import PRODUCT_UPDATES
from millrace.plans import run_ingest, transform_rows
from millrace.sinks import COUNTS, PRODUCTS, DrillDown, buckets_for, ensure_table, row_changes, write_rejects
from millrace.sources import parse_sources, read_csv, read_csv_by_ranges, read_source
from millrace.streaming import ingest_new_files, read_new_files

# The training-data operators are an optional part: without their folder the rest stands alone.
try:
    import corpus_pipeline
    from millrace.llm import queries as llm
except ImportError:  # the folder, or one of the libraries it needs
    corpus_pipeline = llm = None

DAY_1 = "2021-08-07T02:00:00+00:00"
DAY_2 = "2021-08-08T02:00:00+00:00"
DAY_3 = "2021-08-09T02:00:00+00:00"
CUT = "1998-07-01"
LATE = "1998-11-25"  # the few line items shipped from here on are a small batch
LAST = "1998-11-28"
FIRST_TYPES = ("ECONOMY", "SMALL", "STANDARD")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- product feeds over the given tables -------------------------------------------------------


def events_feed(spark, sf_dir) -> DataFrame:
    return _table(spark, sf_dir, "events").select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("sku"),
        F.nullif(F.col("event_type"), F.lit("error")).alias("name"),
        F.col("props").alias("description"),
    )


def _part_columns(df: DataFrame, *further: str) -> DataFrame:
    return df.select(
        F.concat(F.col("p_brand"), F.lit("-"), F.col("p_size").cast("string")).alias("sku"),
        F.nullif(F.col("p_name"), F.lit("small ring")).alias("name"),
        F.concat(F.col("p_type"), F.lit(" "), F.col("p_partkey").cast("string")).alias("description"),
        *further,
    )


def part_feed(spark, sf_dir) -> DataFrame:
    return _part_columns(_table(spark, sf_dir, "part"))


def part_batches(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    part = _table(spark, sf_dir, "part")
    first = F.col("p_type").isin(*FIRST_TYPES)
    return _part_columns(part.filter(first)), _part_columns(part.filter(~first))


def brand_type_batches(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Keyed by brand and type and split by size: later names replace some earlier ones wholly."""
    part = _table(spark, sf_dir, "part")
    feed = part.select(
        F.concat(F.col("p_brand"), F.lit("-"), F.col("p_type")).alias("sku"),
        F.nullif(F.col("p_name"), F.lit("small ring")).alias("name"),
        F.col("p_partkey").cast("string").alias("description"),
        "p_size",
    )
    small = F.coalesce(F.col("p_size") <= 10, F.lit(False))
    return feed.filter(small).drop("p_size"), feed.filter(~small).drop("p_size")


def _lineitem_columns(df: DataFrame, *further: str) -> DataFrame:
    return df.select(
        F.concat(F.lit("O"), F.col("l_orderkey").cast("string")).alias("sku"),
        F.col("l_returnflag").alias("name"),
        F.concat(F.col("l_linestatus"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("description"),
        *further,
    )


def lineitem_feed(spark, sf_dir) -> DataFrame:
    """With two further source columns, which take part in the checksum."""
    return _lineitem_columns(_table(spark, sf_dir, "lineitem"), "l_partkey", "l_suppkey")


def lineitem_batches(spark, sf_dir, cut: str = CUT) -> tuple[DataFrame, DataFrame]:
    lineitem = _table(spark, sf_dir, "lineitem")
    early = _before(cut)
    return _lineitem_columns(lineitem.filter(early)), _lineitem_columns(lineitem.filter(~early))


def _before(date: str):
    """Shipped before a date; a row without a date belongs to the later batch, so none is lost."""
    return F.coalesce(F.col("l_shipdate") < F.lit(date).cast("timestamp"), F.lit(False))


# --- quality -----------------------------------------------------------------------------------


def q_valid_rows(spark, sf_dir):
    return valid_rows(events_feed(spark, sf_dir))


def q_error_rows(spark, sf_dir):
    return error_rows(events_feed(spark, sf_dir))


def q_reject_reason(spark, sf_dir):
    marked = with_reject_reason(part_feed(spark, sf_dir))
    return marked.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n_rows"))


def q_reject_file(spark, sf_dir):
    staging = Staging(spark)
    folder = write_rejects(error_rows(events_feed(spark, sf_dir)), staging.path("rejects"), "b1")
    return read_csv(spark, folder, "sku string, name string, description string")


def q_batch_counts(spark, sf_dir):
    feed = require_rows(events_feed(spark, sf_dir))
    counted, seen = observe_counts(feed, "received", rejected=F.col("name").isNull())
    counted.write.format("noop").mode("overwrite").save()
    found = seen.get
    return spark.createDataFrame(
        [(found["rows"], found["rejected"], found["rows"] - found["rejected"])],
        "received bigint, rejected bigint, valid bigint",
    )


def q_constraint_check(spark, sf_dir):
    return constraint_violations(
        part_feed(spark, sf_dir), unique=("sku",), not_null=("name",), max_length={"description": 11}
    )


# --- sequence, latest, checksum, keys ----------------------------------------------------------


def q_constraint_check_stored(spark, sf_dir):
    """Ids of suppliers that customers in a stored table have, whose ids a second batch changed in part."""
    schema = T.StructType([T.StructField("sku", T.StringType()), T.StructField("p_id", T.LongType())])
    table = KeyedTable(spark, Staging(spark).path("owners"), schema, "sku", 4)
    customer = _table(spark, sf_dir, "customer").withColumn("sku", F.concat(F.lit("C"), F.col("c_custkey").cast("string")))
    table.merge(customer.select("sku", F.col("c_custkey").cast("long").alias("p_id")), "b1", ("p_id",), stamp_column=None)
    moved = customer.filter("c_acctbal < 0").select("sku", (F.col("c_custkey").cast("long") + 10000000).alias("p_id"))
    table.merge(moved, "b2", ("p_id",), stamp_column=None)
    supplier = _table(spark, sf_dir, "supplier")
    batch = supplier.select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("sku"), F.col("s_suppkey").cast("long").alias("p_id"))
    return table.clashes(batch, ["p_id"])


def q_request_id(spark, sf_dir):
    return with_request_id(valid_rows(events_feed(spark, sf_dir)), DAY_1, Staging(spark))


def q_request_id_lineitem(spark, sf_dir):
    return with_request_id(lineitem_feed(spark, sf_dir), DAY_1, Staging(spark))


def q_latest_per_key(spark, sf_dir):
    staging = Staging(spark)
    return latest_per_key(with_request_id(valid_rows(events_feed(spark, sf_dir)), DAY_1, staging))


def q_latest_by_rank(spark, sf_dir):
    return latest_by_rank(lineitem_feed(spark, sf_dir), order_by=("name", "description", "l_partkey", "l_suppkey"))


def q_record_checksum(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents")
    return documents.select("doc_id", record_checksum(["source", "lang", "text"]).alias("record_checksum"))


def q_surrogate_key_contract(spark, sf_dir):
    keyed = with_surrogate_key(lineitem_feed(spark, sf_dir), offset=1000, partitions=16)
    return keyed.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("p_id").alias("n_ids"),
        (F.min("p_id") > 1000).alias("above_offset"),
    )


def q_surrogate_key_by_layout(spark, sf_dir):
    feed = valid_rows(lineitem_feed(spark, sf_dir))
    made = transform_rows(feed, DAY_1, Staging(spark), offset=1000, dense_ids=False, partitions=16)
    return made.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("p_id").alias("n_ids"),
        (F.min("p_id") > 1000).alias("above_offset"),
    )


def q_surrogate_key_dense(spark, sf_dir):
    latest = latest_per_key(valid_rows(part_feed(spark, sf_dir)), order_by=("name", "description"))
    return with_dense_key(latest, ["sku"], Staging(spark), offset=500)


def q_transform_products(spark, sf_dir):
    return transform_rows(valid_rows(part_feed(spark, sf_dir)), DAY_1, Staging(spark), offset=100)


def q_transform_lineitem(spark, sf_dir):
    return transform_rows(valid_rows(lineitem_feed(spark, sf_dir)), DAY_1, Staging(spark))


# --- aggregates --------------------------------------------------------------------------------


def _latest_parts(spark, sf_dir):
    return latest_per_key(valid_rows(part_feed(spark, sf_dir)), order_by=("name", "description"))


def q_count_by_name(spark, sf_dir):
    return count_by_sql(_latest_parts(spark, sf_dir))


def q_count_all(spark, sf_dir):
    return count_rows(_table(spark, sf_dir, "lineitem"))


def q_max_id(spark, sf_dir):
    return max_id(transform_rows(valid_rows(part_feed(spark, sf_dir)), DAY_1, Staging(spark), offset=100))


# --- merges ------------------------------------------------------------------------------------


def _merge_lineitem(spark, sf_dir, cut=CUT, **settings):
    first, second = lineitem_batches(spark, sf_dir, cut)
    staging = Staging(spark)
    stored = transform_rows(first, DAY_1, staging).withColumn("updt_tmstmp", F.lit(DAY_1).cast("timestamp"))
    target = staging.write(stored, "target")
    offset = max_id(target).first()["max_id"]
    batch = staging.write(transform_rows(second, DAY_2, staging, offset), "batch")
    stamp = F.lit(DAY_2).cast("timestamp")
    merged = merge_rows(target, batch, stamp=stamp, **settings)
    return merged.withColumn("updt_tmstmp", F.date_format("updt_tmstmp", "yyyy-MM-dd HH:mm:ss"))


def q_merge_products(spark, sf_dir):
    return _merge_lineitem(spark, sf_dir)


def q_merge_products_small(spark, sf_dir):
    return _merge_lineitem(spark, sf_dir, cut=LATE)


def q_merge_report(spark, sf_dir):
    merged = _merge_lineitem(spark, sf_dir, action="action")
    return merged.groupBy("action").agg(F.count(F.lit(1)).alias("n_rows"))


def q_merge_only_changed(spark, sf_dir):
    return _merge_flags(spark, sf_dir)


def q_merge_only_changed_nulls(spark, sf_dir):
    """With a further column that is null in some rows, so that their checksums are null too."""
    return _merge_flags(spark, sf_dir, F.nullif(F.col("l_linenumber"), F.lit(3)).cast("string").alias("line"))


def _merge_flags(spark, sf_dir, *further):
    lineitem = _table(spark, sf_dir, "lineitem")

    def flags(rows):
        sku = F.concat(F.lit("O"), F.col("l_orderkey").cast("string")).alias("sku")
        named = F.col("l_returnflag").alias("name"), F.col("l_linestatus").alias("description")
        feed = rows.select(sku, *named, *further)
        latest = latest_per_key(feed, order_by=("name", "description"))
        return latest.withColumn("record_checksum", record_checksum(feed.columns))

    target, batch = flags(lineitem.filter(_before(CUT))), flags(lineitem.filter(~_before(CUT)))
    update = tuple(c for c in target.columns if c != "sku")
    return merge_rows(target, batch, update=update, unless_equal="record_checksum", action="action")


def _count_batches(spark, sf_dir):
    first, second = brand_type_batches(spark, sf_dir)
    target = latest_per_key(valid_rows(first), order_by=("name", "description"))
    batch = latest_per_key(valid_rows(second), order_by=("name", "description"))
    merged = merge_rows(target, batch, update=("name", "description"))
    before = count_by(target, "name", "no_of_products")
    return before, count_by(merged, "name", "no_of_products")


def q_merge_agg_stale(spark, sf_dir):
    return merge_counts(*_count_batches(spark, sf_dir))


def q_merge_agg_replace(spark, sf_dir):
    return merge_counts(*_count_batches(spark, sf_dir), mode="replace")


# --- keyed tables: deltas, folds, signed counts -------------------------------------------------


def _ship_batches(spark, sf_dir) -> list[DataFrame]:
    """Nearly all line items, then those of a few late days, then those of the last days."""
    lineitem = _table(spark, sf_dir, "lineitem")
    early, late = _before(LATE), _before(LAST)
    return [_lineitem_columns(lineitem.filter(c)) for c in (early, ~early & late, ~late)]


def _merged_by_ship_date(spark, sf_dir) -> KeyedTable:
    """Three batches merged into a keyed table, the small ones beside its base; its buckets follow from their rows."""
    staging = Staging(spark)
    days = zip(_ship_batches(spark, sf_dir), (DAY_1, DAY_2, DAY_3), strict=True)
    batches = [staging.write(transform_rows(valid_rows(batch), day, staging), "batch") for batch, day in days]
    sizes = [rows.count() for rows in batches]
    products, _ = open_tables(spark, staging.root, buckets=buckets_for(sum(sizes)))
    for number, (rows, n) in enumerate(zip(batches, sizes, strict=True)):
        offset = products.reserve_ids(n, f"b{number}")
        products.merge(rows.withColumn("p_id", F.col("p_id") + offset), f"b{number}", PRODUCT_UPDATES)
    return products


def q_merge_deltas(spark, sf_dir):
    """Read from bases and deltas, the newest row of each key."""
    return _merged_by_ship_date(spark, sf_dir).current().drop("updt_tmstmp")


def q_merge_deltas_compacted(spark, sf_dir):
    """The same after every delta was folded into its base."""
    products = _merged_by_ship_date(spark, sf_dir)
    products.compact()
    return products.current().drop("updt_tmstmp")


def _sized_batches(spark, sf_dir) -> list[DataFrame]:
    """Products keyed by brand and type in three batches by size; later names replace earlier ones."""
    feed = _table(spark, sf_dir, "part").select(
        F.concat(F.col("p_brand"), F.lit("-"), F.col("p_type")).alias("sku"),
        F.nullif(F.col("p_name"), F.lit("small ring")).alias("name"),
        F.col("p_partkey").cast("string").alias("description"),
        F.coalesce("p_size", F.lit(0)).alias("p_size"),
    )
    size = F.col("p_size")
    return [feed.filter(c).drop("p_size") for c in (size <= 20, (size > 20) & (size <= 45), size > 45)]


def _signed_counts(spark, sf_dir, mode: str) -> DataFrame:
    root = Staging(spark).root
    products, counts = open_tables(spark, root, buckets=4)
    for batch, day in zip(_sized_batches(spark, sf_dir), (DAY_1, DAY_2, DAY_3), strict=True):
        run_ingest(spark, batch, products, counts, day, rejects_path=f"{root}/rejects", counts_mode=mode)
    return counts.current()


def q_signed_counts(spark, sf_dir):
    """Counts that three batches moved by the names they changed; a name of no product keeps its last."""
    return _signed_counts(spark, sf_dir, "upsert")


def q_signed_counts_replace(spark, sf_dir):
    return _signed_counts(spark, sf_dir, "replace")


# --- drill-down sums ---------------------------------------------------------------------------

FLAG_HEADERS = ["l_returnflag", "l_linestatus", "l_linenumber"]
CUSTOMER_HEADERS = ["c_nationkey", "c_mktsegment", "c_name"]


def q_hierarchy_totals(spark, sf_dir):
    return hierarchy_totals(_table(spark, sf_dir, "lineitem"), FLAG_HEADERS, "l_quantity")


def q_hierarchy_totals_nulls(spark, sf_dir):
    lineitem = _table(spark, sf_dir, "lineitem").select(
        F.nullif(F.col("l_returnflag"), F.lit("A")).alias("l_returnflag"),
        F.nullif(F.col("l_linestatus"), F.lit("O")).alias("l_linestatus"),
        F.nullif(F.col("l_linenumber"), F.lit(3)).alias("l_linenumber"),
        F.nullif(F.col("l_quantity"), F.lit(7.0)).alias("l_quantity"),
    )
    return hierarchy_totals(lineitem, FLAG_HEADERS, "l_quantity")


def q_hierarchy_totals_kept(spark, sf_dir):
    """Sums that three batches change: early line items, later ones, and a correction of all large ones."""
    lineitem = _table(spark, sf_dir, "lineitem").withColumn("l_quantity", F.col("l_quantity").cast("decimal(12,2)"))
    rows = lineitem.select(*FLAG_HEADERS, "l_quantity", "l_shipdate")
    sums = DrillDown(spark, Staging(spark).path("sums"), rows.schema, FLAG_HEADERS, "l_quantity")
    early = _before(CUT)
    sums.apply(row_changes(rows.limit(0), rows.filter(early)), "b1")
    sums.apply(row_changes(rows.limit(0), rows.filter(~early)), "b2")
    large = rows.filter("l_quantity >= 45")
    corrected = large.withColumns({"l_linestatus": F.lit("C"), "l_quantity": (F.col("l_quantity") - 40).cast("decimal(12,2)")})
    sums.apply(row_changes(large, corrected), "b3")
    return sums.current().withColumn("value", F.col("value").cast("double"))


def q_grand_total(spark, sf_dir):
    totals = hierarchy_totals(_customers(spark, sf_dir), CUSTOMER_HEADERS, "balance")
    return totals.filter("level = 0").select("value")


def q_hierarchy_tree(spark, sf_dir):
    lineitem = _table(spark, sf_dir, "lineitem")
    return hierarchy_document(lineitem, FLAG_HEADERS[:2], "l_quantity", Staging(spark))


def _customers(spark, sf_dir):
    balance = F.col("c_acctbal").cast("decimal(18,2)").alias("balance")
    return _table(spark, sf_dir, "customer").select(*CUSTOMER_HEADERS, balance)


def q_hierarchy_document(spark, sf_dir):
    return hierarchy_document(_customers(spark, sf_dir), CUSTOMER_HEADERS, "balance", Staging(spark))


def q_document_round_trip(spark, sf_dir):
    """The written document, read back line by line."""
    staging = Staging(spark)
    fragments = hierarchy_document(_customers(spark, sf_dir), CUSTOMER_HEADERS, "balance", staging)
    write_document(fragments, staging.path("document"))
    return spark.read.text(staging.path("document")).select(F.col("value").alias("fragment"))


# --- audit -------------------------------------------------------------------------------------


def _event_batches(spark, sf_dir) -> DataFrame:
    feed = events_feed(spark, sf_dir)
    valid = valid_rows(feed)
    kept = latest_per_key(valid, order_by=("name", "description"))

    def row(df, status, message):
        return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(status).alias("batch_status"),
            F.lit("products").alias("subject_area"),
            F.lit("PRODUCTS").alias("business_domain"),
            "n_rows",
            F.lit(message).alias("err_message"),
        )

    return (
        row(feed, "Received", "")
        .unionByName(row(kept, "Transformed", ""))
        .unionByName(row(kept, "Delivered", ""))
        .unionByName(row(error_rows(feed), "Rejected", "required value missing"))
    )


def _events_at_day_1(spark, sf_dir):
    return audit_events(_event_batches(spark, sf_dir), "app-1", F.lit("2021-08-07 02:00:00").cast("timestamp"))


def q_audit_events(spark, sf_dir):
    events = _events_at_day_1(spark, sf_dir)
    return events.select(
        *[c for c in events.columns if c != "businessKey"],
        F.col("businessKey")["Business_object"].alias("business_object"),
        F.col("businessKey")["Batch_count"].alias("batch_count"),
    )


def q_audit_json(spark, sf_dir):
    return audit_json(_events_at_day_1(spark, sf_dir))


def q_audit_summary(spark, sf_dir):
    return audit_summary(_event_batches(spark, sf_dir))


def q_split_zip_map(spark, sf_dir):
    part = _table(spark, sf_dir, "part")
    values = F.concat_ws("|", "p_brand", "p_type", "p_name", F.col("p_size").cast("string"))
    zipped = part.select("p_partkey", zipped_map(F.lit("label|type|label"), values).alias("m"))
    return zipped.select(
        "p_partkey",
        F.col("m")["label"].alias("label"),
        F.col("m")["type"].alias("type"),
        F.size("m").cast("long").alias("n_keys"),
    )


# --- functions, sources, whole jobs ------------------------------------------------------------


def q_parse_run_date(spark, sf_dir):
    run = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    hour = F.date_format(run_hour("run_date"), "yyyy-MM-dd HH:mm:ss").alias("run_hour")
    events = _table(spark, sf_dir, "events").select("event_id", run.alias("run_date"))
    return events.select("event_id", run_digits("run_date").alias("digits"), hour)


def q_number_text(spark, sf_dir):
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    lineitem = _table(spark, sf_dir, "lineitem")
    double = lineitem.schema["l_extendedprice"].dataType
    return lineitem.select(
        number_text("l_orderkey", lineitem.schema["l_orderkey"].dataType).alias("whole"),
        number_text(price * 1000, double).alias("large"),
        number_text(discount / 1000, double).alias("small"),
    )


def q_csv_round_trip(spark, sf_dir):
    staging = Staging(spark)
    documents = _table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    folder = write_rejects(documents, staging.path("documents"), "b1")
    return read_csv(spark, folder, documents.schema)


def q_csv_by_ranges(spark, sf_dir):
    """Documents with their line breaks and further quotes, read from byte ranges of the files."""
    staging = Staging(spark)
    quoted = F.regexp_replace("text", r"([a-z]+)\.\n", '"$1".\n')
    documents = _table(spark, sf_dir, "documents").select("doc_id", "source", "lang", quoted.alias("text"))
    folder = write_rejects(documents, staging.path("documents"), "b1")
    return read_csv_by_ranges(spark, folder, staging, documents.schema)


def q_source_dispatch(spark, sf_dir):
    config = {
        "sources": [
            {"data_object": name.upper(), "source_type": "local", "format": "parquet", "path": f"{sf_dir}/{name}.parquet"}
            for name in ("customer", "supplier", "part")
        ]
    }
    counted = [
        read_source(spark, source).agg(F.lit(source.data_object).alias("data_object"), F.count(F.lit(1)).alias("n_rows"))
        for source in parse_sources(config)
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


def _ingest_parts(spark, sf_dir, root: str) -> tuple[KeyedTable, KeyedTable]:
    products, counts = open_tables(spark, root, buckets=4)
    for batch, day in zip(part_batches(spark, sf_dir), (DAY_1, DAY_2), strict=True):
        run_ingest(spark, batch, products, counts, day, rejects_path=f"{root}/rejects", audit_path=f"{root}/audit")
    return products, counts


def q_ingest_job(spark, sf_dir):
    return _ingest_parts(spark, sf_dir, Staging(spark).root)[0].current().drop("updt_tmstmp")


def q_ingest_job_counts(spark, sf_dir):
    return _ingest_parts(spark, sf_dir, Staging(spark).root)[1].current()


def q_ingest_job_rejects(spark, sf_dir):
    root = Staging(spark).root
    _ingest_parts(spark, sf_dir, root)
    return read_csv(spark, f"{root}/rejects/*", "sku string, name string, description string")


def q_ingest_job_audit(spark, sf_dir):
    """The audit log read back: rows per phase and table over both batches."""
    root = Staging(spark).root
    _ingest_parts(spark, sf_dir, root)
    shape = "componentName string, logEvent string, status string, businessKey struct<Batch_count string>"
    events = spark.read.schema(shape).json(f"{root}/audit")
    rows = F.sum(F.col("businessKey.Batch_count").cast("long")).alias("n_rows")
    return events.groupBy("componentName", "logEvent", "status").agg(rows)


def q_catalog_table(spark, sf_dir):
    staging = Staging(spark)
    folder, name = staging.path("products"), f"products_{uuid.uuid4().hex}"
    made = transform_rows(valid_rows(part_feed(spark, sf_dir)), DAY_1, staging)
    ensure_table(spark, name, location=folder)
    made.withColumn("updt_tmstmp", F.lit(DAY_1).cast("timestamp")).write.insertInto(name)
    spark.sql(f"DROP TABLE {name}")  # the table is external: its files stay
    return spark.read.parquet(folder).drop("updt_tmstmp")


def q_csv_header_order(spark, sf_dir):
    """A CSV with its columns in another order and one more, through the whole job."""
    staging = Staging(spark)
    part = _table(spark, sf_dir, "part")
    named = _part_columns(part, "p_partkey").select("name", "sku", "description", "p_partkey")
    folder = write_rejects(named, staging.path("feed"), "all")
    config = {"sources": [{"data_object": "PRODUCTS", "path": folder}]}
    run_sources(spark, config, staging.path("lake"), buckets=4, run_date=DAY_1)
    products, _ = open_tables(spark, staging.path("lake"), buckets=4)
    return products.current().drop("updt_tmstmp")


def q_incremental_two_streams(spark, sf_dir):
    """Two inboxes with a checkpoint each, under the same default name, into one table."""
    root = Staging(spark).root
    products, counts = open_tables(spark, root, buckets=4)
    for number, (delivery, day) in enumerate(zip(part_batches(spark, sf_dir), (DAY_1, DAY_2), strict=True)):
        delivery.write.parquet(f"{root}/inbox{number}")
        ingest_new_files(
            read_new_files(spark, f"{root}/inbox{number}", delivery.schema, "parquet"),
            products,
            counts,
            f"{root}/checkpoint{number}",
            rejects_path=f"{root}/rejects",
            run_date=day,
        ).awaitTermination()
    return products.current().drop("updt_tmstmp")


def q_incremental_ingest(spark, sf_dir):
    root = Staging(spark).root
    products = KeyedTable(spark, f"{root}/products", PRODUCTS, "sku", buckets=1, id_column="p_id")
    counts = KeyedTable(spark, f"{root}/products_agg", COUNTS, "name", buckets=2)
    schema = _table(spark, sf_dir, "part").schema
    for _ in range(2):  # the second run finds nothing new
        stream = read_new_files(spark, sf_dir, schema, "parquet", pathGlobFilter="part.parquet")
        ingest_new_files(
            stream,
            products,
            counts,
            f"{root}/checkpoint",
            rejects_path=f"{root}/rejects",
            run_date=DAY_1,
            prepare=_part_columns,
        ).awaitTermination()
    return products.current().drop("updt_tmstmp")


def q_incremental_deliveries(spark, sf_dir):
    """Two deliveries into one folder, a run after each, and a run that finds nothing new."""
    root = Staging(spark).root
    products, counts = open_tables(spark, root, buckets=4)
    first, second = part_batches(spark, sf_dir)
    for delivery in (first, second, None):
        if delivery is not None:
            delivery.write.mode("append").parquet(f"{root}/inbox")
        ingest_new_files(
            read_new_files(spark, f"{root}/inbox", first.schema, "parquet"),
            products,
            counts,
            f"{root}/checkpoint",
            rejects_path=f"{root}/rejects",
            run_date=lambda number: (DAY_1, DAY_2)[number],
        ).awaitTermination()
    return products.current().drop("updt_tmstmp")


def _deliver_out_of_order(spark, sf_dir) -> tuple[KeyedTable, KeyedTable]:
    """Parts by brand and type in three deliveries by size, the oldest last; rods and rings are withdrawals."""
    root = Staging(spark).root
    products, counts = open_tables(spark, root, buckets=4, further="changed INT")
    size = F.col("p_size")
    feed = _table(spark, sf_dir, "part").select(
        F.concat(F.col("p_brand"), F.lit("-"), F.col("p_type")).alias("sku"),
        F.nullif(F.col("p_name"), F.lit("small ring")).alias("name"),
        F.col("p_partkey").cast("string").alias("description"),
        size.alias("changed"),
        F.col("p_name").rlike(" (rod|ring)$").alias("withdrawn"),
    )
    deliveries = (size > 20) & (size <= 45), size > 45, size.isNull() | (size <= 20)
    for wanted in deliveries:
        feed.filter(wanted).write.mode("append").parquet(f"{root}/inbox")
        ingest_new_files(
            read_new_files(spark, f"{root}/inbox", feed.schema, "parquet"),
            products,
            counts,
            f"{root}/checkpoint",
            rejects_path=f"{root}/rejects",
            run_date=lambda number: (DAY_1, DAY_2, DAY_3)[number],
            newer_by="changed",
            withdrawn="withdrawn",
            counts_mode="replace",
        ).awaitTermination()
    return products, counts


def q_incremental_out_of_order(spark, sf_dir):
    """The greatest version of each key, whatever the order of the deliveries; withdrawn keys are out."""
    products, _ = _deliver_out_of_order(spark, sf_dir)
    return products.current().select("sku", "name", "description", "changed", "record_checksum")


def q_incremental_withdrawn_counts(spark, sf_dir):
    """Counts by signed changes over the same deliveries."""
    return _deliver_out_of_order(spark, sf_dir)[1].current()


def entry(spark: SparkSession) -> DataFrame:
    """Products per name after keeping the latest valid row per key."""
    return q_count_by_name(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {name[2:]: function for name, function in globals().items() if name.startswith("q_")}
    return own if llm is None else own | llm.queries() | {"pipeline": corpus_pipeline.run}


# --- the same results in SQL -------------------------------------------------------------------

_EVENTS = """select concat('U', cast(user_id as varchar)) as sku, nullif(event_type, 'error') as name,
    props as description from events"""
_PART = """select p_brand || '-' || cast(p_size as varchar) as sku, nullif(p_name, 'small ring') as name,
    p_type || ' ' || cast(p_partkey as varchar) as description from part"""
_LINEITEM = """select 'O' || cast(l_orderkey as varchar) as sku, l_returnflag as name,
    l_linestatus || '-' || cast(l_linenumber as varchar) as description"""
_VALID = "sku is not null and name is not null and description is not null"
_FIRST = "p_type in ('ECONOMY', 'SMALL', 'STANDARD')"
_EARLY = f"coalesce(l_shipdate < timestamp '{CUT}', false)"
_NOT_LATE = f"coalesce(l_shipdate < timestamp '{LATE}', false)"
_DIGITS_1, _DIGITS_2, _DIGITS_3 = "'202108070200000000'", "'202108080200000000'", "'202108090200000000'"


def _transformed(feed: str, digits: str = _DIGITS_1, offset: str = "0", extra: str = "") -> str:
    """Number all rows, keep the last per key, then add checksum and key."""
    more = "".join(f", {c}" for c in extra.split())
    text = "".join(f" || cast({c} as varchar)" for c in extra.split())
    return f"""
    select cast({offset} + row_number() over (order by sku) as bigint) as p_id, sku, name, description{more},
        rpad({digits}, 20, '0') || lpad(cast(position as varchar), 12, '0') as request_id,
        md5(sku || name || description{text}) as record_checksum
    from (select *, row_number() over (partition by sku order by position desc) as place
          from (select *, row_number() over (order by sku, name, description{more}) as position
                from ({feed}) where {_VALID}))
    where place = 1"""


def _latest(feed: str) -> str:
    return f"""select sku, name, description from (
        select *, row_number() over (partition by sku order by name desc, description desc) as place
        from ({feed}) where {_VALID}) where place = 1"""


def _merge(early: str) -> str:
    return f"""
    with t as ({_transformed(_LINEITEM + " from lineitem where " + early)}),
    u as ({_transformed(_LINEITEM + " from lineitem where not " + early, _DIGITS_2, "(select max(p_id) from t)")}),
    m as (select coalesce(t.p_id, u.p_id) as p_id, coalesce(t.sku, u.sku) as sku,
        coalesce(u.name, t.name) as name, coalesce(u.description, t.description) as description,
        coalesce(u.request_id, t.request_id) as request_id,
        coalesce(u.record_checksum, t.record_checksum) as record_checksum,
        case when u.sku is null then '2021-08-07 02:00:00' else '2021-08-08 02:00:00' end as updt_tmstmp,
        case when t.sku is null then 'insert' when u.sku is null then 'keep' else 'update' end as action
        from t full outer join u on t.sku = u.sku)"""


def _three(feed: str, first: str, second: str, third: str) -> str:
    """A feed's three batches (a, b, d), and the table after the second (m) and the third (e)."""

    def after(old: str, new: str) -> str:
        kept = ", ".join(f"coalesce(u.{c}, t.{c}) as {c}" for c in ("name", "description", "request_id", "record_checksum"))
        return f"""select coalesce(t.p_id, u.p_id) as p_id, coalesce(t.sku, u.sku) as sku, {kept}
            from {old} t full outer join {new} u on t.sku = u.sku"""

    return f"""a as ({_transformed(f"{feed} where {first}")}),
    b as ({_transformed(f"{feed} where {second}", _DIGITS_2, "(select max(p_id) from a)")}), m as ({after("a", "b")}),
    d as ({_transformed(f"{feed} where {third}", _DIGITS_3, "(select max(p_id) from m)")}), e as ({after("m", "d")})"""


_BRAND_TYPE = """select p_brand || '-' || p_type as sku, nullif(p_name, 'small ring') as name,
    cast(p_partkey as varchar) as description from part"""


def _merged(feed: str, first: str) -> str:
    """Two batches of a feed, merged (m), with the counts before (before) and after (fresh)."""
    return f"""t as ({_transformed(f"{feed} where {first}")}),
    u as ({_transformed(f"{feed} where not ({first})", _DIGITS_2, "(select max(p_id) from t)")}),
    m as (select coalesce(t.p_id, u.p_id) as p_id, coalesce(t.sku, u.sku) as sku,
        coalesce(u.name, t.name) as name, coalesce(u.description, t.description) as description,
        coalesce(u.request_id, t.request_id) as request_id,
        coalesce(u.record_checksum, t.record_checksum) as record_checksum
        from t full outer join u on t.sku = u.sku),
    before as (select name, count(*) as no_of_products from t group by name),
    fresh as (select name, count(*) as no_of_products from m group by name)"""


_MERGED_PARTS = _merged(_PART, _FIRST)
_MERGED_BRANDS = _merged(_BRAND_TYPE, "p_size <= 10")
_STALE = """select name, no_of_products from fresh union all
    select name, no_of_products from before where name not in (select name from fresh)"""


def _totals(source: str, headers: list[str], value: str) -> str:
    shown = ", ".join(headers)
    level = " + ".join(f"(1 - grouping({h}))" for h in headers)
    null_above = " and ".join(f"(grouping({h}) = 1 or {h} is not null)" for h in headers)
    return f"""select cast({level} as integer) as level, {shown}, coalesce(sum({value}), 0) as value
        from ({source}) group by rollup ({shown}) having {null_above}"""


_NOT_LAST = f"coalesce(l_shipdate < timestamp '{LAST}', false)"
_SHIPPED = _three(
    _LINEITEM + " from lineitem", _NOT_LATE, f"not {_NOT_LATE} and {_NOT_LAST}", f"not {_NOT_LAST}"
)
_SIZE = "coalesce(p_size, 0)"
_SIZED = _three(_BRAND_TYPE, f"{_SIZE} <= 20", f"{_SIZE} > 20 and {_SIZE} <= 45", f"{_SIZE} > 45")

# The newest version of each key, of equal versions the withdrawn and then the greatest row.
_VERSIONS = f"""f as (select b.*, p_size as changed, coalesce(regexp_matches(p_name, ' (rod|ring)$'), false) as withdrawn
        from ({_BRAND_TYPE}) b join part on cast(p_partkey as varchar) = b.description),
    r as (select *, row_number() over (partition by sku order by changed desc, withdrawn desc, name desc,
        description desc) as place from f where sku is not null and name is not null and changed is not null),
    v as (select * from r where place = 1 and not withdrawn)"""

_LINE = "cast(nullif(l_linenumber, 3) as varchar) as line"
_CHANGED = """(u.sku is not null and (t.sku is null or u.record_checksum is null or t.record_checksum is null
    or u.record_checksum <> t.record_checksum))"""


def _flags(where: str, further: str = "") -> str:
    more = further.rpartition(" ")[2]
    feed = f"""select 'O' || cast(l_orderkey as varchar) as sku, l_returnflag as name,
        l_linestatus as description{", " if more else ""}{further} from lineitem where {where}"""
    if not more:
        return f"select *, md5(sku || name || description) as record_checksum from ({_latest(feed)})"
    return f"""select * exclude (place), md5(sku || name || description || {more}) as record_checksum from (
        select *, row_number() over (partition by sku order by name desc, description desc,
            {more} desc nulls last) as place from ({feed}) where {_VALID}) where place = 1"""


_EVENT_BATCHES = f"""
    select 'Received' as batch_status, count(*) as n_rows, '' as err_message from events
    union all select s, n, '' from (select unnest(['Transformed', 'Delivered']) as s, count(distinct sku) as n
        from ({_EVENTS}) where {_VALID} group by s)
    union all select 'Rejected', count(*), 'required value missing' from ({_EVENTS}) where not ({_VALID})"""
_AUDIT = f"""select '2021-08-07T02:00:00' as "timestamp",
    case when batch_status = 'Rejected' then err_message else batch_status end as message,
    case when batch_status = 'Rejected' then 'Batch Failure' else batch_status end as "logEvent",
    case when batch_status = 'Rejected' then 'ERROR' else 'INFO' end as "logLevel",
    'products' as "componentName", 'app-1' as "applicationId",
    case when batch_status = 'Rejected' then 'Failure' else 'success' end as status,
    'Business_object|Batch_count' as "businessKeyStructure",
    'PRODUCTS|' || cast(n_rows as varchar) as "businessKeyValue",
    'PRODUCTS' as business_object, cast(n_rows as varchar) as batch_count
    from ({_EVENT_BATCHES})"""

_TREE_TEXT = "cast(value as varchar)"


def _document(totals: str, headers: list[str]) -> str:
    """The fragments of the document in order; a node is followed by its children or by what closes."""
    depth = len(headers)
    opening = "'{\"header\":\"root\",\"field_name\":\"root' || tail || '['"
    wrapper = '{"header":"root","field_name":"root","value":"0","children":['
    cases = [f"when 0 then {opening}"]
    for level, name in enumerate(headers, 1):
        inner = wrapper if level < depth else "[]}"
        cases.append(f"""when {level} then '{{"header":"{name}","field_name":"' || cast({name} as varchar)
            || tail || '{inner}'""")
    close = "]}}"
    after = [f"when next_level = {n} then repeat('{close}', least(level, {depth - 1}) - {n} + 1) || ','" for n in range(1, depth + 1)]
    order = ", ".join(f"{h} nulls first" for h in headers)
    return f"""with n as ({totals}),
        w as (select *, row_number() over walk as position, lead(level) over walk as next_level from n
            window walk as (order by {order})),
        o as (select *, '","value":"' || {_TREE_TEXT} || '","children":' as tail from w)
        select position, case level {" ".join(cases)} end || case when next_level > level then ''
            {" ".join(after)}
            else repeat('{close}', least(level, {depth - 1})) || ']}}' end as fragment from o"""



def oracle_sql() -> dict[str, str]:
    if llm is None:
        return _oracle_sql()
    whole = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return _oracle_sql() | llm.oracle_sql() | whole


def _oracle_sql() -> dict[str, str]:
    customers = "select *, cast(c_acctbal as decimal(18, 2)) as balance from customer"
    nulled = """select nullif(l_returnflag, 'A') as l_returnflag, nullif(l_linestatus, 'O') as l_linestatus,
        nullif(l_linenumber, 3) as l_linenumber, nullif(l_quantity, 7.0) as l_quantity from lineitem"""
    corrected = """select l_returnflag, case when l_quantity >= 45 then 'C' else l_linestatus end as l_linestatus, l_linenumber,
        cast(l_quantity as decimal(12, 2)) - case when l_quantity >= 45 then 40 else 0 end as l_quantity from lineitem"""
    return {
        "valid_rows": f"select * from ({_EVENTS}) where {_VALID}",
        "error_rows": f"select * from ({_EVENTS}) where not ({_VALID})",
        "reject_reason": f"""select case when name is null then 'name null' end as reject_reason,
            count(*) as n_rows from ({_PART}) group by 1""",
        "reject_file": f"select * from ({_EVENTS}) where sku is null or name is null or description is null",
        "batch_counts": f"""select count(*) as received, count(*) - count(name) as rejected,
            count(name) as valid from ({_EVENTS})""",
        "constraint_check_stored": """select 'unique' as constraint_name, 'p_id' as column_name, cast(s_suppkey as varchar) as value,
            2::bigint as n_rows from supplier join customer on c_custkey = s_suppkey where not coalesce(c_acctbal < 0, false)""",
        "constraint_check": f"""
            select 'unique' as constraint_name, 'sku' as column_name, sku as value, count(*) as n_rows
                from ({_PART}) group by sku having count(*) > 1
            union all select 'not null', 'name', null, count(*) from ({_PART}) where name is null
            union all select 'max length', 'description', description, count(*) from ({_PART})
                where length(description) > 11 group by description""",
        "request_id": f"""select sku, name, description, rpad({_DIGITS_1}, 20, '0') ||
            lpad(cast(row_number() over (order by sku, name, description) as varchar), 12, '0') as request_id
            from ({_EVENTS}) where {_VALID}""",
        "request_id_lineitem": f"""select *, rpad({_DIGITS_1}, 20, '0') || lpad(cast(row_number()
            over (order by sku, name, description, l_partkey, l_suppkey) as varchar), 12, '0') as request_id
            from ({_LINEITEM}, l_partkey, l_suppkey from lineitem)""",
        "latest_per_key": f"select sku, name, description, request_id from ({_transformed(_EVENTS)})",
        "latest_by_rank": f"""select sku, name, description, l_partkey, l_suppkey from
            ({_transformed(_LINEITEM + ", l_partkey, l_suppkey from lineitem", extra="l_partkey l_suppkey")})""",
        "record_checksum": "select doc_id, md5(source || lang || text) as record_checksum from documents",
        "surrogate_key_contract": """select count(*) as n_rows, count(*) as n_ids, true as above_offset
            from lineitem""",
        "surrogate_key_by_layout": """select count(distinct l_orderkey) as n_rows,
            count(distinct l_orderkey) as n_ids, true as above_offset from lineitem""",
        "surrogate_key_dense": f"""select cast(500 + row_number() over (order by sku) as bigint) as p_id,
            sku, name, description from ({_latest(_PART)})""",
        "transform_products": _transformed(_PART, offset="100"),
        "transform_lineitem": _transformed(
            _LINEITEM + ", l_partkey, l_suppkey from lineitem", extra="l_partkey l_suppkey"
        ),
        "count_by_name": f"select name, count(*) as count_of_names from ({_latest(_PART)}) group by name",
        "count_all": "select count(*) as n_rows from lineitem",
        "max_id": f"select coalesce(max(p_id), 0) as max_id from ({_transformed(_PART, offset='100')})",
        "merge_products": f"{_merge(_EARLY)} select * exclude (action) from m",
        "merge_products_small": f"{_merge(_NOT_LATE)} select * exclude (action) from m",
        "merge_report": f"{_merge(_EARLY)} select action, count(*) as n_rows from m group by action",
        "merge_only_changed": f"""with t as ({_flags(_EARLY)}), u as ({_flags("not " + _EARLY)})
            select coalesce(u.sku, t.sku) as sku, coalesce(u.name, t.name) as name,
            coalesce(u.description, t.description) as description,
            coalesce(u.record_checksum, t.record_checksum) as record_checksum,
            case when t.sku is null then 'insert' when u.record_checksum <> t.record_checksum then 'update'
                else 'keep' end as action
            from t full outer join u on t.sku = u.sku""",
        "merge_only_changed_nulls": f"""with t as ({_flags(_EARLY, _LINE)}), u as ({_flags("not " + _EARLY, _LINE)})
            select coalesce(u.sku, t.sku) as sku, {", ".join(
                f"case when {_CHANGED} then u.{c} else t.{c} end as {c}"
                for c in ("name", "description", "line", "record_checksum"))},
                case when t.sku is null then 'insert' when {_CHANGED} then 'update' else 'keep' end as action
            from t full outer join u on t.sku = u.sku""",
        "merge_agg_stale": f"with {_MERGED_BRANDS} {_STALE}",
        "merge_agg_replace": f"with {_MERGED_BRANDS} select name, no_of_products from fresh",
        "merge_deltas": f"with {_SHIPPED} select * from e",
        "merge_deltas_compacted": f"with {_SHIPPED} select * from e",
        "signed_counts": f"""with {_SIZED}, n as (select 1 as step, name from a union all
                select 2, name from m union all select 3, name from e),
            c as (select step, name, count(*) as n from n group by step, name)
            select name, max_by(n, step) as no_of_products from c group by name""",
        "signed_counts_replace": f"with {_SIZED} select name, count(*) as no_of_products from e group by name",
        "hierarchy_totals": _totals("from lineitem", FLAG_HEADERS, "l_quantity"),
        "hierarchy_totals_nulls": _totals(nulled, FLAG_HEADERS, "l_quantity"),
        "hierarchy_totals_kept": f"""select * replace (cast(value as double) as value)
            from ({_totals(corrected, FLAG_HEADERS, "l_quantity")})""",
        "grand_total": f"select cast(sum(balance) as decimal(28, 2)) as value from ({customers})",
        "hierarchy_tree": _document(_totals("from lineitem", FLAG_HEADERS[:2], "l_quantity"), FLAG_HEADERS[:2]),
        "hierarchy_document": _document(_totals(customers, CUSTOMER_HEADERS, "balance"), CUSTOMER_HEADERS),
        "document_round_trip": f"""select fragment from
            ({_document(_totals(customers, CUSTOMER_HEADERS, "balance"), CUSTOMER_HEADERS)})""",
        "audit_events": _AUDIT,
        "audit_json": f"""select '{{"timestamp":"2021-08-07T02:00:00","message":"' || message || '","logEvent":"'
            || "logEvent" || '","logLevel":"' || "logLevel"
            || '","componentName":"products","applicationId":"app-1","status":"' || status
            || '","businessKeyStructure":"Business_object|Batch_count","businessKeyValue":"' || "businessKeyValue"
            || '","businessKey":{{"Business_object":"PRODUCTS","Batch_count":"' || batch_count || '"}}}}' as value
            from ({_AUDIT})""",
        "audit_summary": f"""select 'products' as subject_area,
            cast(sum(n_rows) filter (batch_status = 'Received') as bigint) as "Received",
            cast(sum(n_rows) filter (batch_status = 'Transformed') as bigint) as "Transformed",
            cast(sum(n_rows) filter (batch_status = 'Delivered') as bigint) as "Delivered",
            cast(sum(n_rows) filter (batch_status = 'Rejected') as bigint) as "Failure"
            from ({_EVENT_BATCHES})""",
        "split_zip_map": """select p_partkey, p_name as label, p_type as type, cast(2 as bigint) as n_keys
            from part""",
        "parse_run_date": """select event_id,
            regexp_replace(strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00'), '[^0-9]', '', 'g') as digits,
            strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') as run_hour from events""",
        "number_text": """select cast(l_orderkey as varchar) as whole,
            cast(l_extendedprice * 1000 as varchar) as large, cast(l_discount / 1000 as varchar) as small
            from lineitem""",
        "csv_round_trip": "select doc_id, source, lang, text from documents",
        "csv_by_ranges": """select doc_id, source, lang,
            regexp_replace(text, '([a-z]+)\\.\\n', '"\\1".\n', 'g') as text from documents""",
        "source_dispatch": """select 'CUSTOMER' as data_object, count(*) as n_rows from customer
            union all select 'SUPPLIER', count(*) from supplier union all select 'PART', count(*) from part""",
        "ingest_job": f"with {_MERGED_PARTS} select * from m",
        "ingest_job_counts": f"with {_MERGED_PARTS} {_STALE}",
        "ingest_job_rejects": f"select * from ({_PART}) where not ({_VALID})",
        "ingest_job_audit": f"""with {_MERGED_PARTS}, p(c, e, n) as (
            select 'products', 'Received', (select count(*) from part)
            union all select 'products', unnest(['Transformed', 'Delivered']),
                (select count(*) from t) + (select count(*) from u)
            union all select 'products_agg', 'Received', (select count(*) from t) + (select count(*) from m)
            union all select 'products_agg', unnest(['Transformed', 'Delivered']),
                (select count(*) from before) + (select count(*) from fresh))
            select c as "componentName", e as "logEvent", 'success' as status, n as n_rows from p""",
        "catalog_table": _transformed(_PART),
        "csv_header_order": f"""
            select p_id, sku, name, description, request_id, md5(name || sku || description || key) as record_checksum
            from (select *, split_part(description, ' ', -1) as key from ({_transformed(_PART)}))""",
        "incremental_two_streams": f"with {_MERGED_PARTS} select * from m",
        "incremental_deliveries": f"with {_MERGED_PARTS} select * from m",
        "incremental_ingest": _transformed(_PART),
        "incremental_out_of_order": f"""with {_VERSIONS} select sku, name, description, changed,
            md5(sku || name || description || changed::varchar || withdrawn::varchar) as record_checksum from v""",
        "incremental_withdrawn_counts": f"""with {_VERSIONS} select name, count(*) as no_of_products from v
            group by name""",
    }
