import glob
import json
import os
import sys
import uuid

import duckdb
import pytest
from conftest import plan_of
from pyspark import cloudpickle
from pyspark.sql import functions as F

from millrace import KeyedTable
from millrace.errors import ConcurrentCommitError
from millrace.operators import audit_events, audit_summary
from millrace.operators.merge import PRODUCT_UPDATES
from millrace.plans.ingest import BATCHES
from millrace.sinks import (
    COUNTS,
    PRODUCTS,
    DatabaseTable,
    ensure_table,
    table_statement,
    upsert_counts,
    upsert_products,
    upsert_statement,
    write_rejects,
)
from millrace.sinks.commits import CommitLog
from millrace.sinks.tables import COUNTS_DDL, PRODUCT_LENGTHS, PRODUCT_NOT_NULL
from millrace.staging import write_once


PRODUCTS_TABLE = table_statement(
    "products", PRODUCTS, "sku", "p_id", PRODUCT_NOT_NULL, PRODUCT_LENGTHS, stamp_column="updt_tmstmp"
)

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the workers cannot import this file


class FakeConnection:
    """Stands in for a database connection: keeps what a transaction sent in a file of its own."""

    def __init__(self, folder, fail_on=None):
        self.folder, self.fail_on, self.sent = folder, fail_on, []

    def cursor(self):
        return self

    def executemany(self, statement, rows):
        if self.fail_on in {v for row in rows for v in row}:
            raise RuntimeError("refused")
        self.sent.append((statement, [list(r) for r in rows]))

    def _save(self, ending):
        with open(os.path.join(self.folder, uuid.uuid4().hex + ending), "w") as f:
            json.dump(self.sent, f)

    def commit(self):
        self._save(".commit")

    def rollback(self):
        self._save(".rollback")

    def close(self):
        pass


def factory(folder, fail_on=None):
    def connect():
        return FakeConnection(folder, fail_on)

    return connect


def sent(folder, ending="commit"):
    return [json.load(open(p)) for p in glob.glob(f"{folder}/*.{ending}")]


def products(spark, rows):
    columns = "p_id bigint, sku string, name string, description string, request_id string, record_checksum string"
    return spark.createDataFrame(rows, columns)


FIRST = [(1, "s1", "Bob's", "d0", "r1", "c1"), (2, "s2", 'A"n', "x", "r2", "c2")]
SECOND = [(3, "s1", "Ann", "d9", "q1", "c9"), (4, "s4", "; drop", "n", "q2", "c4")]


def test_upserts_bind_values_and_keep_ids(spark, tmp_path):
    database = duckdb.connect()
    database.execute(PRODUCTS_TABLE)
    for i, rows in enumerate([FIRST, SECOND]):
        folder = tmp_path / str(i)
        folder.mkdir()
        upsert_products(products(spark, rows), factory(str(folder)), mark="?", max_connections=2)
        for transaction in sent(folder):
            for statement, values in transaction:
                assert "Bob" not in statement and "drop" not in statement
                # the timestamp is set by the database under test only where it may be updated
                database.executemany(statement.replace("current_timestamp", "now()::timestamp"), values)
    found = database.execute("select p_id, sku, name, description, request_id from products order by sku").fetchall()
    assert found == [
        (1, "s1", "Ann", "d9", "q1"),
        (2, "s2", 'A"n', "x", "r2"),
        (4, "s4", "; drop", "n", "q2"),
    ]


def test_counts_statement(spark, tmp_path):
    counts = spark.createDataFrame([("Ann", 2)], "name string, count_of_names bigint")
    upsert_counts(counts, factory(str(tmp_path)), max_connections=1)
    ((statement, values),) = sent(tmp_path)[0]
    assert values == [["Ann", 2]]
    assert statement == (
        'INSERT INTO products_agg ("name", "no. of products") VALUES (%s, %s) '
        'ON CONFLICT ("name") DO UPDATE SET "no. of products" = excluded."no. of products"'
    )


def test_a_counts_table_takes_the_counts_it_was_made_for(spark, tmp_path):
    """The statement that creates the table and the one that fills it, run by a database in this process."""
    made, database = [], duckdb.connect()

    class Creating(FakeConnection):
        def execute(self, statement):
            made.append(statement)

        def commit(self):
            pass

    read = lambda: spark.createDataFrame(database.execute("select * from products_agg").fetchall(), "name string, `no. of products` bigint")
    table = DatabaseTable("products_agg", "name", lambda: Creating(str(tmp_path)), read, mark="?", max_connections=1)
    table.ensure(COUNTS, not_null=["no_of_products"])
    database.execute(made[0])
    table.connect = factory(str(tmp_path))
    for n in (1, 2):
        table.merge_counts(spark.createDataFrame([("Ann", n)], COUNTS), f"b{n}")
    for path in sorted(glob.glob(f"{tmp_path}/*.commit"), key=os.path.getmtime):
        for statement, values in json.load(open(path)):
            database.executemany(statement, values)
    assert [tuple(r) for r in table.current().collect()] == [("Ann", 2)]
    assert table.current().columns == COUNTS.names


def test_target_tables_carry_their_constraints(tmp_path):
    assert PRODUCTS_TABLE == (
        'CREATE TABLE IF NOT EXISTS products ("p_id" BIGINT PRIMARY KEY NOT NULL, "sku" VARCHAR(70) UNIQUE NOT NULL, '
        '"name" VARCHAR(70) NOT NULL, "description" VARCHAR(300) NOT NULL, "request_id" VARCHAR(40), '
        '"record_checksum" VARCHAR(45) NOT NULL, "updt_tmstmp" TIMESTAMP DEFAULT CURRENT_TIMESTAMP)'
    )
    run = []
    connection = FakeConnection(str(tmp_path))
    connection.execute = run.append
    DatabaseTable("products_agg", "name", lambda: connection, None).ensure(COUNTS, not_null=("no_of_products",))
    assert run == [
        'CREATE TABLE IF NOT EXISTS products_agg ("name" VARCHAR PRIMARY KEY, "no. of products" BIGINT NOT NULL)'
    ]


def test_names_are_quoted():
    assert '"a""b"' in upsert_statement("t", ['a"b'], 'a"b', ['a"b'])


def test_a_failed_partition_is_rolled_back(spark, tmp_path):
    with pytest.raises(Exception, match="refused"):
        upsert_products(products(spark, FIRST), factory(str(tmp_path), fail_on="s2"), max_connections=1)
    assert sent(tmp_path) == [] and len(sent(tmp_path, "rollback")) >= 1


def test_rows_are_sent_in_chunks(spark, tmp_path):
    from millrace.sinks import upsert_rows

    rows = spark.range(25).select(F.col("id").alias("k"))
    upsert_rows(rows, factory(str(tmp_path)), "s", ["k"], max_connections=1, chunk=10)
    (transaction,) = sent(tmp_path)
    assert [len(values) for _, values in transaction] == [10, 10, 5]


def test_rejects_are_kept_per_batch(spark, tmp_path):
    rows = spark.createDataFrame([("s", None, ' a "b"\nc')], "sku string, name string, description string")
    for batch in ("b1", "b2", "b2"):
        folder = write_rejects(rows, str(tmp_path), batch)
    assert sorted(os.listdir(tmp_path)) == ["batch_id=b1", "batch_id=b2"]
    back = spark.read.options(header="true", escape='"', multiLine="true").csv(folder).collect()
    assert [tuple(r) for r in back] == [("s", None, ' a "b"\nc')]


def test_catalog_tables_check_lengths(spark, tmp_path):
    ensure_table(spark, "t_products", location=f"{tmp_path}/p")
    ensure_table(spark, "t_products", location=f"{tmp_path}/p")
    ensure_table(spark, "t_counts", COUNTS_DDL, f"{tmp_path}/c")
    try:
        assert spark.table("t_counts").columns == ["name", "no. of products"]
        spark.sql("INSERT INTO t_products VALUES (1, 's', 'n', 'd', 'r', 'c', timestamp '2021-01-01')")
        with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
            spark.sql(f"INSERT INTO t_products VALUES (1, '{'s' * 71}', 'n', 'd', 'r', 'c', now())")
        assert spark.table("t_products").count() == 1
    finally:
        spark.sql("DROP TABLE t_products")
        spark.sql("DROP TABLE t_counts")


def keyed(spark, root, buckets=1, **settings):
    return KeyedTable(spark, f"{root}/t", PRODUCTS, "sku", buckets, "p_id", **settings)


def values(table):
    return sorted((r.sku, r.p_id, r.name) for r in table.current().collect())


@pytest.mark.parametrize("buckets", [1, 8])
def test_keyed_table(spark, tmp_path, buckets):
    table = keyed(spark, tmp_path, buckets)
    assert values(table) == [] and table.max_id() == 0
    table.merge(products(spark, FIRST), "b1", PRODUCT_UPDATES)
    table.merge(products(spark, SECOND), "b2", PRODUCT_UPDATES)
    assert values(table) == [("s1", 1, "Ann"), ("s2", 2, 'A"n'), ("s4", 4, "; drop")]
    assert table.max_id() == 4 and table.has_batch("b2") and not table.has_batch("b3")
    table.merge(products(spark, []), "b3", PRODUCT_UPDATES)
    assert len(values(table)) == 3 and table.max_id() == 4 and table.has_batch("b3")


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    table = keyed(spark, tmp_path, 16, delta_ratio=0)
    many = [(i, f"s{i}", "n", "d", "r", "c") for i in range(1, 201)]
    table.merge(products(spark, many), "b1", PRODUCT_UPDATES)
    before = set(table.current().inputFiles())
    table.merge(products(spark, [(201, "s7", "new", "d", "r", "c")]), "b2", PRODUCT_UPDATES)
    after = set(table.current().inputFiles())
    assert len(before - after) == 1 and len(after - before) == 1
    files = table.latest()["files"]
    (bucket,) = [b for b, own in files.items() if own["parts"][0][0].startswith("v000000000002")]
    assert int(bucket) == spark.range(1).select(F.expr("pmod(hash('s7'), 16)")).first()[0]
    assert len(values(table)) == 200


def test_each_bucket_is_one_file(spark, tmp_path):
    table = keyed(spark, tmp_path, 4, delta_ratio=0)
    many = [(i, f"s{i}", "n", "d", "r", "c") for i in range(1, 201)]
    table.merge(products(spark, many), "b1", PRODUCT_UPDATES)
    assert len(table.current().inputFiles()) == 4
    table.merge(products(spark, many[:3]), "b2", PRODUCT_UPDATES)
    assert len(table.current().inputFiles()) == 4


def test_a_bucketed_merge_shuffles_each_side_once(spark, tmp_path, monkeypatch):
    table = keyed(spark, tmp_path, 4)
    many = [(i, f"s{i}", "n", "d", "r", "c") for i in range(1, 201)]
    table.merge(products(spark, many), "b1", PRODUCT_UPDATES)
    plans, write = [], KeyedTable._write
    monkeypatch.setattr(KeyedTable, "_write", lambda self, df, *a: plans.append(plan_of(df)) or write(self, df, *a))
    products(spark, many).write.parquet(f"{tmp_path}/batch")
    table.merge(spark.read.parquet(f"{tmp_path}/batch"), "b2", PRODUCT_UPDATES)
    assert plans[0].count("Exchange") == 2 and plans[0].count("hashpartitioning(sku") == 2
    assert "FullOuter" in plans[0]


def test_unused_folders_are_removed(spark, tmp_path):
    table = keyed(spark, tmp_path, 4, delta_ratio=0)
    for n in range(4):
        rows = [(i, f"s{i}", f"n{n}", "d", "r", "c") for i in range(1, 41)]
        table.merge(products(spark, rows), f"b{n}", PRODUCT_UPDATES)
    table.merge(products(spark, [(99, "s1", "last", "d", "r", "c")]), "b4", PRODUCT_UPDATES)
    products(spark, FIRST).write.parquet(f"{tmp_path}/t/data/v00000009-dead/bucket=0")
    before = values(table)
    assert table.remove_unused(keep=2) == 3 * 4 + 1
    assert values(table) == before
    assert table.remove_unused(keep=1) == 1
    assert values(table) == before
    with pytest.raises(ValueError):
        table.remove_unused(keep=0)


def test_every_batch_is_remembered_and_one_record_says_all(spark, tmp_path):
    table = keyed(spark, tmp_path, 4)
    stored = {}
    for n in range(1, 6):
        rows = [(100 * n + i, f"s{i * n % 7}", f"n{n}", "d", "r", "c") for i in range(1, 3)]
        rows = list({r[1]: r for r in rows}.values())
        table.merge(products(spark, rows), f"b{n}", PRODUCT_UPDATES)
        for p_id, sku, name, *_ in rows:
            stored[sku] = (sku, stored[sku][1] if sku in stored else p_id, name)
    greatest = table.max_id()
    table.remove_unused(keep=1)
    assert [n for n in os.listdir(f"{tmp_path}/t/versions") if n[0] != "."] == ["000000000005.json"]
    assert values(table) == sorted(stored.values()) and table.max_id() == greatest
    assert all(table.has_batch(f"b{n}") for n in range(1, 6)) and not table.has_batch("b6")


def test_an_emptied_table_stays_empty(spark, tmp_path):
    table = KeyedTable(spark, f"{tmp_path}/c", COUNTS, "name", 2)
    table.merge_counts(spark.createDataFrame([("Ann", 2)], COUNTS), "b1")
    table.merge_counts(spark.createDataFrame([], COUNTS), "b2", "replace")
    assert table.current().collect() == []
    table.merge_counts(spark.createDataFrame([], COUNTS), "b3")
    table.merge_counts(spark.createDataFrame([("Bob", 1)], COUNTS), "b4")
    assert list(map(tuple, table.current().collect())) == [("Bob", 1)]


def test_another_number_of_buckets_is_an_error(spark, tmp_path):
    many = [(i, f"s{i}", "n", "d", "r", "c") for i in range(1, 21)]
    keyed(spark, tmp_path, 4).merge(products(spark, many), "b1", PRODUCT_UPDATES)
    for use in (lambda t: t.merge(products(spark, many), "b2", PRODUCT_UPDATES), lambda t: t.current()):
        with pytest.raises(ValueError, match="4 buckets"):
            use(keyed(spark, tmp_path, 1))
    assert len(values(keyed(spark, tmp_path, 4))) == 20


def test_a_writer_that_died_does_not_block_the_table(spark, tmp_path):
    table = keyed(spark, tmp_path, 2)
    table.merge(products(spark, FIRST), "b1", PRODUCT_UPDATES)
    # what a writer leaves that dies while it writes its record
    (tmp_path / "t/versions/_000000000002.json.0123").write_text('{"vers')
    table.merge(products(spark, SECOND), "b2", PRODUCT_UPDATES)
    assert len(values(table)) == 3 and table.latest()["version"] == 2


def test_a_file_is_written_once(spark, tmp_path):
    assert write_once(spark, f"{tmp_path}/a/b", "one") and not write_once(spark, f"{tmp_path}/a/b", "two")
    assert (tmp_path / "a/b").read_text() == "one"
    assert [n for n in os.listdir(tmp_path / "a") if not n.startswith(".")] == ["b"]


def test_unfinished_writes_are_not_seen(spark, tmp_path):
    table = keyed(spark, tmp_path)
    table.merge(products(spark, FIRST), "b1", PRODUCT_UPDATES)
    products(spark, SECOND).write.parquet(f"{tmp_path}/t/data/v00000002-dead/bucket=0")
    assert len(values(table)) == 2


def test_a_second_writer_of_a_version_fails(spark, tmp_path, monkeypatch):
    table = keyed(spark, tmp_path)
    new = table.log.last()
    table.merge(products(spark, FIRST), "b1", PRODUCT_UPDATES)
    prepare = KeyedTable.prepare

    def outdated(self, *args, **settings):
        with monkeypatch.context() as patch:
            patch.setattr(CommitLog, "last", lambda self: dict(new))
            return prepare(self, *args, **settings)

    monkeypatch.setattr(KeyedTable, "prepare", outdated)
    with pytest.raises(ConcurrentCommitError):
        table.merge(products(spark, SECOND), "b2", PRODUCT_UPDATES)


def test_counts_table(spark, tmp_path):
    table = KeyedTable(spark, f"{tmp_path}/c", COUNTS, "name", 4)
    for batch, rows in (("b1", [("Ann", 2), ("Cid", 1)]), ("b2", [("Ann", 3)])):
        table.merge_counts(spark.createDataFrame(rows, COUNTS), batch)
    assert sorted(map(tuple, table.current().collect())) == [("Ann", 3), ("Cid", 1)]
    table.merge_counts(spark.createDataFrame([("Ann", 3)], COUNTS), "b3", "replace")
    assert sorted(map(tuple, table.current().collect())) == [("Ann", 3)]


def test_audit_of_good_and_failed_batches(spark):
    rows = [
        ("Received", "products", "PRODUCTS", 7, "", None),
        ("Failure", "products", "PRODUCTS", 0, "no file", None),
        ("Delivered", "products", "PRODUCTS", 3, "", None),
    ]
    batches = spark.createDataFrame(rows, BATCHES)
    at = F.lit("2021-08-07 02:00:00.7").cast("timestamp")
    good, bad, _ = audit_events(batches, "app", at).collect()
    assert good.asDict() == {
        "timestamp": "2021-08-07T02:00:00",
        "message": "Received",
        "logEvent": "Received",
        "logLevel": "INFO",
        "componentName": "products",
        "applicationId": "app",
        "status": "success",
        "businessKeyStructure": "Business_object|Batch_count",
        "businessKeyValue": "PRODUCTS|7",
        "businessKey": {"Business_object": "PRODUCTS", "Batch_count": "7"},
    }
    assert (bad.message, bad.logEvent, bad.logLevel, bad.status) == ("no file", "Batch Failure", "ERROR", "Failure")
    summary = audit_summary(batches).first().asDict()
    assert summary == {"subject_area": "products", "Received": 7, "Transformed": None, "Delivered": 3, "Failure": 0}
