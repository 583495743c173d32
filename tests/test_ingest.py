import glob
import hashlib
import json
import os

import duckdb
import pytest
from conftest import plan_of
from pyspark.sql import functions as F
from test_quality import BATCH_1
from test_sinks import PRODUCTS_TABLE, factory

from millrace import KeyedTable, Staging
from millrace.errors import ConstraintError, EmptySourceError, PhaseError
from millrace.job import main, open_tables, read_config, run_sources
from millrace.plans import run_ingest, transform_rows
from millrace.sinks import COUNTS, PRODUCTS, DatabaseTable
from millrace.sources import PRODUCT_FEED, Source
from millrace.streaming import ingest_new_files, read_new_files

DAYS = [f"2021-08-0{d}T02:00:00+00:00" for d in (7, 8, 9)]
RUNS = [f"2021080{d}020000000000" for d in (7, 8, 9)]
BATCH_2 = [("s1", "Ann", "d9"), ("s4", "Bob", "n"), ("s2", "Ann", "x")]
BATCH_3 = [("s10", "Ann", "z")]


class Job:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.products = KeyedTable(spark, f"{root}/products", PRODUCTS, "sku", 2, "p_id")
        self.counts = KeyedTable(spark, f"{root}/counts", COUNTS, "name", 2)

    def run(self, rows, day, **settings):
        feed = rows if isinstance(rows, Source) else self.spark.createDataFrame(rows, PRODUCT_FEED)
        return run_ingest(
            self.spark,
            feed,
            self.products,
            self.counts,
            day,
            rejects_path=f"{self.root}/rejects",
            audit_path=f"{self.root}/audit",
            **settings,
        )

    def rows(self):
        return sorted((r.p_id, r.sku, r.name, r.description, r.request_id) for r in self.products.current().collect())

    def names(self):
        return sorted(map(tuple, self.counts.current().collect()))


@pytest.fixture
def job(spark, tmp_path):
    return Job(spark, str(tmp_path))


def test_transform_of_the_worked_batch(spark, staging):
    feed = spark.createDataFrame([r for r in BATCH_1 if None not in r], PRODUCT_FEED)
    made = transform_rows(feed, DAYS[0], staging)
    assert made.columns == ["p_id", "sku", "name", "description", "request_id", "record_checksum"]
    assert sorted(map(tuple, made.collect())) == [
        (1, "s1", "Bob", "d0", RUNS[0] + "000000000002", "2662c8b923b2699ad73cf2146cf28152"),
        (2, "s10", "Cid", "z", RUNS[0] + "000000000003", "1d123afc0f4bbc4432f8836e9774953e"),
        (3, "s2", "Ann", "x", RUNS[0] + "000000000005", "22ef9c287b56d8905d2b76493f961fe3"),
    ]


def test_transform_carries_further_columns_of_any_type(spark, staging):
    rows = [("s1", "a", "d", {"k": 1}, [2]), ("s1", "b", "d", {"k": 2}, None), ("s2", "a", "d", {}, [1, 2])]
    feed = spark.createDataFrame(rows, "sku string, name string, description string, m map<string,int>, l array<int>")
    found = {r.sku: (r.name, r.m, r.l, r.record_checksum) for r in transform_rows(feed, DAYS[0], staging).collect()}
    assert found["s1"] == ("b", {"k": 2}, None, None)
    assert found["s2"][:3] == ("a", {}, [1, 2]) and len(found["s2"][3]) == 32


def test_transform_with_ids_by_layout(spark, staging):
    feed = spark.range(300).select(F.concat(F.lit("s"), "id").alias("sku"), F.lit("n").alias("name"), F.lit("d").alias("description"))
    made = transform_rows(feed, DAYS[0], staging, offset=50, dense_ids=False, partitions=4)
    ids = [r.p_id for r in made.collect()]
    assert made.columns[0] == "p_id" and len(set(ids)) == 300 and min(ids) > 50


def test_transform_stays_in_the_jvm_and_distributed(spark, staging, monkeypatch):
    plans = []
    write = Staging.write
    monkeypatch.setattr(Staging, "write", lambda self, d, *a: plans.append(plan_of(d)) or write(self, d, *a))
    feed = spark.range(10).select(F.col("id").alias("sku"), F.col("id").alias("name"), F.col("id").alias("description"))
    plans.append(plan_of(transform_rows(feed, DAYS[0], staging)))
    for plan in plans:
        assert "Python" not in plan and "SinglePartition" not in plan
    # counting by key and numbering the slices: two exchanges, each behind a fold or a key alone
    assert plans[0].count("Exchange") <= 1 and plans[1].count("Exchange") == 1
    assert "partial_count" in plans[0] and "hashpartitioning(__slice" in plans[1] and "WindowGroupLimit" in plans[2]


def test_three_worked_batches(job):
    log = job.run(BATCH_1, DAYS[0])
    assert [(r[0], r[1], r[3]) for r in log.rows] == [
        ("Received", "products", 7),
        ("Transformed", "products", 3),
        ("Delivered", "products", 3),
        ("Received", "products_agg", 3),
        ("Transformed", "products_agg", 3),
        ("Delivered", "products_agg", 3),
    ]
    assert job.names() == [("Ann", 1), ("Bob", 1), ("Cid", 1)]
    rejects = job.spark.read.option("header", "true").csv(f"{job.root}/rejects")
    found = sorted((r.sku or "", r.name or "", r.batch_id) for r in rejects.select("*", F.col("batch_id").cast("string")).collect())
    assert [f[:2] for f in found] == [("", "Dee"), ("s3", "")]

    job.run(BATCH_2, DAYS[1])
    assert job.rows() == [
        (1, "s1", "Ann", "d9", RUNS[1] + "000000000001"),
        (2, "s10", "Cid", "z", RUNS[0] + "000000000003"),
        (3, "s2", "Ann", "x", RUNS[1] + "000000000002"),
        (6, "s4", "Bob", "n", RUNS[1] + "000000000003"),
    ]
    assert job.names() == [("Ann", 2), ("Bob", 1), ("Cid", 1)]

    job.run(BATCH_3, DAYS[2])
    assert job.names() == [("Ann", 3), ("Bob", 1), ("Cid", 1)]
    events = [json.loads(r.value) for r in job.spark.read.text(f"{job.root}/audit").collect()]
    assert len(events) == 18 and {e["status"] for e in events} == {"success"}

    job.run(BATCH_3, DAYS[2], batch_id="again", counts_mode="replace")
    assert job.names() == [("Ann", 3), ("Bob", 1)]


def test_a_batch_runs_once(job):
    job.run(BATCH_1, DAYS[0])
    before = job.products.current().collect()
    again = job.run(BATCH_1, DAYS[0])
    assert [r[:2] for r in again.rows] == [("Skipped", "products"), ("Skipped", "products_agg")]
    events = [json.loads(r.value) for r in job.spark.read.text(f"{job.root}/audit").collect()]
    assert [e["logLevel"] for e in events if e["logEvent"] == "Skipped"] == ["INFO", "INFO"]
    assert sorted(job.products.current().collect()) == sorted(before)


def test_a_batch_resumes_after_the_products_were_committed(job, monkeypatch):
    merge_counts = KeyedTable.merge_counts
    monkeypatch.setattr(KeyedTable, "merge_counts", lambda *a, **k: 1 / 0)
    with pytest.raises(PhaseError):
        job.run(BATCH_1, DAYS[0])
    monkeypatch.setattr(KeyedTable, "merge_counts", merge_counts)
    log = job.run(BATCH_1, DAYS[0])
    assert {r[1] for r in log.rows if r[0] != "Skipped"} == {"products_agg"}
    assert len(job.rows()) == 3 and len(job.names()) == 3
    assert job.products.latest()["version"] == 1


def test_an_empty_source_fails_and_is_logged(job):
    with pytest.raises(EmptySourceError):
        job.run([], DAYS[0])
    (event,) = [json.loads(r.value) for r in job.spark.read.text(f"{job.root}/audit").collect()]
    assert event["logEvent"] == "Batch Failure" and "no records" in event["message"]
    assert job.products.latest()["version"] == 0


def test_a_batch_of_rejects_only_delivers_nothing(job):
    log = job.run([("s", None, "d")], DAYS[0])
    assert [r[3] for r in log.rows] == [1, 0, 0, 0, 0, 0]
    assert job.rows() == [] and job.names() == []


def test_too_long_values_fail(job):
    with pytest.raises(ConstraintError, match="1 values longer than the target column: name"):
        job.run([("s", "n" * 71, "d")], DAYS[0])
    assert job.rows() == []
    job.run([("s", "n" * 71, "d")], DAYS[0], max_lengths={})
    assert len(job.rows()) == 1


def test_unreadable_source(job):
    with pytest.raises(PhaseError, match="could not read the batch, 0 rows in"):
        job.run(Source("X", f"{job.root}/missing.csv"), DAYS[0], schema=PRODUCT_FEED)


def test_unchanged_rows_can_be_left_alone(job):
    job.run(BATCH_1, DAYS[0])
    job.run(BATCH_2, DAYS[1], only_changed=True)
    assert {r[1]: r[4][:8] for r in job.rows()} == {
        "s1": "20210808",
        "s10": "20210807",
        "s2": "20210807",
        "s4": "20210808",
    }


def test_a_database_is_a_target_too(spark, tmp_path):
    """The sink's statements, recorded by the tasks and replayed here, are the database."""
    sent = tmp_path / "sent"
    sent.mkdir()
    connect = factory(str(sent))

    def database():
        connection = duckdb.connect()
        connection.execute(PRODUCTS_TABLE)
        connection.execute('create table products_agg (name varchar primary key, "no. of products" bigint)')
        for path in sorted(glob.glob(f"{sent}/*.commit"), key=os.path.getmtime):
            for statement, values in json.load(open(path)):
                connection.executemany(statement.replace("current_timestamp", "now()::timestamp"), values)
        return connection

    def read():
        rows = database().execute("select p_id, sku, name, description, request_id from products").fetchall()
        return spark.createDataFrame(rows, "p_id bigint, sku string, name string, description string, request_id string")

    def greatest():
        return database().execute("select max(p_id) from products").fetchone()[0]

    products = DatabaseTable("products", "sku", connect, read, greatest, mark="?", max_connections=1)
    counts = DatabaseTable("products_agg", "name", connect, None, mark="?", max_connections=1)
    for batch, day in zip((BATCH_1, BATCH_2, BATCH_3), DAYS, strict=True):
        run_ingest(spark, spark.createDataFrame(batch, PRODUCT_FEED), products, counts, day, only_changed=True, rejects_path=f"{tmp_path}/r")
    assert sorted(map(tuple, products.current().collect())) == [
        (1, "s1", "Ann", "d9", RUNS[1] + "000000000001"),
        (2, "s10", "Ann", "z", RUNS[2] + "000000000001"),
        (3, "s2", "Ann", "x", RUNS[0] + "000000000005"),
        (6, "s4", "Bob", "n", RUNS[1] + "000000000003"),
    ]
    found = database().execute("select * from products_agg order by 1").fetchall()
    assert found == [("Ann", 3), ("Bob", 1), ("Cid", 1)]
    with pytest.raises(ValueError):
        counts.merge_counts(spark.createDataFrame([], "name string, no_of_products bigint"), "b", "replace")


def test_database_reads_are_split_by_id(spark, monkeypatch):
    seen = []

    def read_table(session, options):
        seen.append(options)
        return session.createDataFrame([(41,)], "max_id bigint")

    monkeypatch.setattr("millrace.sinks.database.read_table", read_table)
    table = DatabaseTable.over_jdbc(spark, "jdbc:x", "products", "sku", None, "p_id", read_partitions=8, user="u")
    assert table.max_id() == 41
    table.current()
    assert seen[0] == {"url": "jdbc:x", "query": 'SELECT max("p_id") AS max_id FROM products', "user": "u"}
    assert seen[-1]["dbtable"] == "products" and seen[-1]["numPartitions"] == "8" and seen[-1]["upperBound"] == "41"
    DatabaseTable.over_jdbc(spark, "jdbc:x", "products_agg", "name", None).current()
    assert seen[-1] == {"url": "jdbc:x", "dbtable": "products_agg"}


def test_a_csv_source_is_read_once(job, tmp_path):
    (tmp_path / "in.csv").write_text("sku,name,description\n" + "".join(f"{s},{n},{d}\n" for s, n, d in BATCH_2))
    job.run(Source("PRODUCTS", f"{tmp_path}/in.csv"), DAYS[0])
    assert [r[1] for r in job.rows()] == ["s1", "s2", "s4"]


def test_new_files_only(spark, job, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()

    def drop(name, rows):
        (inbox / name).write_text("sku,name,description\n" + "".join(f"{s},{n},{d}\n" for s, n, d in rows))

    def go():
        stream = read_new_files(spark, str(inbox), PRODUCT_FEED, files_per_batch=1)
        ingest_new_files(
            stream, job.products, job.counts, f"{tmp_path}/ckpt", rejects_path=f"{tmp_path}/r", run_date=lambda n: DAYS[n]
        ).awaitTermination()

    drop("1.csv", [r for r in BATCH_1 if None not in r])
    go()
    assert [r[:2] for r in job.rows()] == [(1, "s1"), (2, "s10"), (3, "s2")]
    go()
    drop("2.csv", BATCH_2)
    go()
    assert [r[:3] for r in job.rows()] == [(1, "s1", "Ann"), (2, "s10", "Cid"), (3, "s2", "Ann"), (6, "s4", "Bob")]
    assert job.products.latest()["version"] == 2
    assert job.names() == [("Ann", 2), ("Bob", 1), ("Cid", 1)]


def test_the_job_runs_every_source_of_a_config(spark, tmp_path):
    for name, rows in (("a", BATCH_2), ("b", BATCH_3)):
        (tmp_path / f"{name}.csv").write_text("sku,name,description\n" + "".join(f"{s},{n},{d}\n" for s, n, d in rows))
    entries = [
        {"data_object": name.upper(), "source_type": "local", "path": f"{tmp_path}/{name}.csv", "format": "csv"}
        for name in ("a", "b")
    ]
    (tmp_path / "config.json").write_text(json.dumps({"sources": entries}))
    (tmp_path / "config.yaml").write_text(
        "sources:\n" + "".join("  - " + "\n    ".join(f"{k}: {v}" for k, v in e.items()) + "\n" for e in entries)
    )
    assert read_config(f"{tmp_path}/config.json") == read_config(f"{tmp_path}/config.yaml")
    target = f"{tmp_path}/lake"
    common = ["--config", f"{tmp_path}/config.yaml", "--target", target, "--job_run_date", DAYS[0], "--buckets", "2"]
    main([*common, "--source", "A"])
    table, counts = open_tables(spark, target, 2)
    assert [r.sku for r in table.current().orderBy("sku").collect()] == ["s1", "s2", "s4"]
    main(common)
    assert table.latest()["version"] == 2 and all(table.has_batch(f"{DAYS[0]} {x}") for x in "AB")
    assert sorted(map(tuple, counts.current().collect())) == [("Ann", 3), ("Bob", 1)]
    with pytest.raises(ValueError, match="no source"):
        run_sources(spark, {"sources": []}, target, buckets=2)
    with pytest.raises(ValueError, match="several sources of A"):
        run_sources(spark, {"sources": [entries[0], entries[0]]}, target, buckets=2)


def test_csv_columns_are_named_by_the_header(spark, job, tmp_path):
    (tmp_path / "in.csv").write_text("name,sku,size,description\nAnn,s1,9,d1\nBob,s2,,d2\nCid,s3,1,d3,more\nDee,s4\n")
    job.run(Source("PRODUCTS", f"{tmp_path}/in.csv"), DAYS[0], checksum_null_text="")
    assert [r[1:4] for r in job.rows()] == [("s1", "Ann", "d1"), ("s2", "Bob", "d2")]
    sums = {r.sku: r.record_checksum for r in job.products.current().collect()}
    assert sums == {"s1": hashlib.md5(b"Anns19d1").hexdigest(), "s2": hashlib.md5(b"Bobs2d2").hexdigest()}
    rejects = spark.read.option("header", "true").csv(f"{job.root}/rejects")
    assert {(r.sku, r.malformed_row) for r in rejects.collect()} == {("s3", "Cid,s3,1,d3,more"), ("s4", "Dee,s4")}


def test_a_file_with_other_columns_is_an_error(job, tmp_path):
    (tmp_path / "a.csv").write_text("sku,name,description\ns1,n,d\n")
    (tmp_path / "b.csv").write_text("name,sku,description\nn,s2,d\n")
    with pytest.raises(PhaseError, match="could not read"):
        job.run(Source("PRODUCTS", f"{tmp_path}/*.csv"), DAYS[0])
    (tmp_path / "c.tsv").write_text("sku,description\ns1,d\n")
    with pytest.raises(ConstraintError, match="no column name"):
        job.run(Source("PRODUCTS", f"{tmp_path}/c.tsv"), DAYS[0])


def test_a_null_checksum_is_refused(spark, job):
    feed = spark.createDataFrame([("s", "n", "d", None)], "sku string, name string, description string, size string")
    settings = {"rejects_path": f"{job.root}/rejects"}
    with pytest.raises(ConstraintError, match="null where the target allows none: record_checksum"):
        run_ingest(spark, feed, job.products, job.counts, DAYS[0], **settings)
    run_ingest(spark, feed, job.products, job.counts, DAYS[0], checksum_null_text="", **settings)
    assert len(job.rows()) == 1


def test_a_delivery_without_rows_does_not_stop_the_next(spark, job, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()

    def go():
        stream = read_new_files(spark, str(inbox), PRODUCT_FEED)
        settings = {"rejects_path": f"{tmp_path}/r", "run_date": lambda n: DAYS[n]}
        ingest_new_files(stream, job.products, job.counts, f"{tmp_path}/ckpt", **settings).awaitTermination()

    (inbox / "1.csv").write_text("sku,name,description\n")
    go()
    assert job.rows() == [] and job.products.latest()["version"] == 1
    (inbox / "2.csv").write_text("sku,name,description\ns1,Ann,d\n")
    go()
    assert [r[1] for r in job.rows()] == ["s1"] and job.names() == [("Ann", 1)]


@pytest.mark.parametrize("schema", [PRODUCT_FEED, "sku string, name string, description string"])
def test_a_stream_rejects_rows_with_other_fields_than_the_header(spark, job, tmp_path, schema):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "1.csv").write_text("sku,name,description\ns1,Ann,d\ns2,Bob, Jr,d2\ns3,Cid\ns4,\"Dee, Jr\",d4\n")
    stream = read_new_files(spark, str(inbox), schema)
    ingest_new_files(
        stream, job.products, job.counts, f"{tmp_path}/ckpt", rejects_path=f"{tmp_path}/r", run_date=DAYS[0]
    ).awaitTermination()
    assert [r[1:3] for r in job.rows()] == [("s1", "Ann"), ("s4", "Dee, Jr")]
    assert job.names() == [("Ann", 1), ("Dee, Jr", 1)]
    rejects = spark.read.option("header", "true").csv(f"{tmp_path}/r")
    assert {(r.sku, r.malformed_row) for r in rejects.collect()} == {("s2", "s2,Bob, Jr,d2"), ("s3", "s3,Cid")}


def test_two_streams_feed_one_table(spark, job, tmp_path):
    for k in range(2):
        (tmp_path / f"inbox{k}").mkdir()
        (tmp_path / f"inbox{k}/1.csv").write_text(f"sku,name,description\ns{k},n{k},d\n")
        for _ in range(2):
            stream = read_new_files(spark, f"{tmp_path}/inbox{k}", PRODUCT_FEED)
            ingest_new_files(
                stream, job.products, job.counts, f"{tmp_path}/ckpt{k}", rejects_path=f"{tmp_path}/r", run_date=DAYS[0]
            ).awaitTermination()
    assert [r[1] for r in job.rows()] == ["s0", "s1"] and job.names() == [("n0", 1), ("n1", 1)]


def test_a_replayed_batch_is_stored_once(job):
    for _ in range(2):
        job.run(BATCH_3, DAYS[2], batch_id="stream-7")
    assert len(job.rows()) == 1 and job.products.latest()["version"] == 1


def test_only_buckets_of_changed_counts_are_rewritten(spark, tmp_path):
    job = Job(spark, str(tmp_path))
    job.counts = KeyedTable(spark, f"{tmp_path}/counts", COUNTS, "name", 16, delta_ratio=0)
    job.run([(f"s{i}", f"n{i % 40}", "d") for i in range(80)], DAYS[0])
    before = set(job.counts.current().inputFiles())
    job.run([("t1", "n7", "d")], DAYS[1])
    after = set(job.counts.current().inputFiles())
    assert len(before - after) == 1 and len(after - before) == 1
    assert dict(job.names()) == {f"n{i}": 3 if i == 7 else 2 for i in range(40)}
    job.run([("t2", "n8", "d")], DAYS[2], counts_mode="replace")
    assert dict(job.names())["n8"] == 3 and len(job.names()) == 40
