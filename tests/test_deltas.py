"""Keyed tables: deltas beside bases, signed counts, commits over two tables, writers side by side."""

import os
import random
from collections import Counter
from concurrent.futures import ThreadPoolExecutor

import pytest
from conftest import plan_of
from pyspark.sql import functions as F
from test_ingest import BATCH_1, BATCH_2, BATCH_3, DAYS
from test_sinks import keyed, products, values

import __spark_entry__ as driver
from millrace import KeyedTable
from millrace.errors import ConcurrentCommitError, PhaseError
from millrace.job import open_tables
from millrace.operators.merge import PRODUCT_UPDATES
from millrace.plans import ingest, run_ingest
from millrace.sinks import tables
from millrace.sinks.commits import CommitLog
from millrace.sources import PRODUCT_FEED


def rows(first, skus, name="n"):
    return [(first + i, sku, name, "d", "r", f"c{name}") for i, sku in enumerate(skus)]


def parquet_files(root):
    return {
        os.path.join(folder, name): os.path.getsize(os.path.join(folder, name))
        for folder, _, names in os.walk(root)
        for name in names
        if name.endswith(".parquet")
    }


def test_a_small_batch_adds_its_own_rows_only(spark, tmp_path):
    table = keyed(spark, tmp_path, 4)
    table.merge(products(spark, rows(1, [f"s{i}" for i in range(2000)])), "b1", PRODUCT_UPDATES)
    before = parquet_files(tmp_path)
    table.merge(products(spark, rows(5000, ["s7", "new"], "m")), "b2", PRODUCT_UPDATES)
    added = {f: n for f, n in parquet_files(tmp_path).items() if f not in before}
    assert 1 <= len(added) <= 2 and set(before) <= set(parquet_files(tmp_path))
    assert spark.read.parquet(*added).count() == 2
    found = {r.sku: (r.p_id, r.name) for r in table.current().collect()}
    assert len(found) == 2001 and found["s7"] == (8, "m") and found["new"] == (5001, "m") and found["s8"] == (9, "n")


def test_rows_without_a_key_of_the_batch_stay_in_their_scan(spark, tmp_path, monkeypatch):
    table = keyed(spark, tmp_path, 2)
    table.merge(products(spark, rows(1, [f"s{i}" for i in range(500)])), "b1", PRODUCT_UPDATES)
    plans, write = [], KeyedTable._write
    monkeypatch.setattr(KeyedTable, "_write", lambda self, df, *a: plans.append(plan_of(df)) or write(self, df, *a))
    products(spark, rows(900, ["s1", "s2"])).write.parquet(f"{tmp_path}/batch")
    table.merge(spark.read.parquet(f"{tmp_path}/batch"), "b2", PRODUCT_UPDATES)
    assert "BroadcastHashJoin" in plans[0] and "LeftSemi" in plans[0]


@pytest.mark.parametrize("ratio", [0, 0.25, 100])
@pytest.mark.parametrize("only_changed", [False, True])
def test_random_batches_equal_a_dictionary(spark, tmp_path, ratio, only_changed):
    random.seed(int(ratio * 4) + only_changed)
    table = keyed(spark, tmp_path, 3, delta_ratio=ratio)
    stored = {}
    for number in range(6):
        skus = random.sample(range(40), random.choice([1, 2, 25]))
        batch = [(1000 * number + k, f"s{k}", f"n{random.randrange(3)}", "d", f"r{number}", f"c{random.randrange(2)}") for k in skus]
        table.merge(products(spark, batch), f"b{number}", PRODUCT_UPDATES, unless_equal="record_checksum" if only_changed else None)
        for p_id, sku, name, _, request, checksum in batch:
            if sku not in stored or not only_changed or stored[sku][3] != checksum:
                stored[sku] = (stored[sku][0] if sku in stored else p_id, name, request, checksum)
        if number == 3:
            table.compact()
            assert all(len(own["parts"]) <= 1 for own in table.latest()["files"].values())
    found = {r.sku: (r.p_id, r.name, r.request_id, r.record_checksum) for r in table.current().collect()}
    assert found == stored and table.current().count() == len(stored)
    table.compact()
    table.remove_unused(keep=1)
    assert {r.sku: (r.p_id, r.name, r.request_id, r.record_checksum) for r in table.current().collect()} == stored


def test_deltas_are_folded_by_size_and_by_number(spark, tmp_path, monkeypatch):
    table = keyed(spark, tmp_path, 1)
    table.merge(products(spark, rows(1, [f"s{i}" for i in range(100)])), "b", PRODUCT_UPDATES)
    parts = []
    for k in range(4):
        table.merge(products(spark, rows(1000 + 10 * k, [f"t{k}-{i}" for i in range(10)])), f"b{k}", PRODUCT_UPDATES)
        parts.append([n for _, n in table.latest()["files"]["0"]["parts"]])
    assert parts == [[100, 10], [100, 10, 10], [130], [130, 10]]
    monkeypatch.setattr(tables, "MOST_PARTS", 2)
    table.merge(products(spark, rows(2000, ["u"])), "last", PRODUCT_UPDATES)
    assert [n for _, n in table.latest()["files"]["0"]["parts"]] == [141]


# --- counts ------------------------------------------------------------------------------------


class Lake:
    def __init__(self, spark, root, buckets=3, **settings):
        self.spark, self.root = spark, root
        self.products, self.counts = open_tables(spark, root, buckets, **settings)

    def run(self, batch, day, **settings):
        feed = self.spark.createDataFrame(batch, PRODUCT_FEED)
        settings = {"rejects_path": f"{self.root}/rejects", "audit_path": f"{self.root}/audit", **settings}
        return run_ingest(self.spark, feed, self.products, self.counts, day, **settings)

    def names(self):
        return dict(map(tuple, self.counts.current().collect()))

    def rows(self):
        return values(self.products)


@pytest.mark.parametrize("ratio", [0.25, 100])
@pytest.mark.parametrize("mode", ["upsert", "replace"])
def test_signed_counts_equal_a_recount_and_read_no_products(spark, tmp_path, monkeypatch, mode, ratio):
    random.seed(5)
    lake, shown, live = Lake(spark, str(tmp_path), delta_ratio=ratio), {}, {}
    recounts = []
    monkeypatch.setattr(ingest, "count_by", lambda *a: recounts.append(a))
    for number in range(5):
        batch = {f"s{random.randrange(30)}": f"n{random.randrange(5 + number)}" for _ in range(random.choice([3, 25]))}
        log = lake.run([(sku, name, "d") for sku, name in batch.items()], DAYS[0], batch_id=f"b{number}", counts_mode=mode, only_changed=True)
        live.update(batch)
        fresh = {name: list(live.values()).count(name) for name in live.values()}
        shown = fresh if mode == "replace" else {**shown, **fresh}
        assert lake.names() == shown
        assert [r[3] for r in log.rows[3:]] == [len(live), len(fresh), len(fresh)]
    assert not recounts


def test_counts_of_a_table_that_they_do_not_sum_up_are_counted_anew(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.products.merge(products(spark, [(1, "s1", "Ann", "d", "r", "c"), (2, "s2", "Bob", "d", "r", "c")]), "x", PRODUCT_UPDATES)
    lake.run([("s2", "Ann", "d"), ("s3", "Cid", "d")], DAYS[0])
    assert lake.names() == {"Ann": 2, "Cid": 1}
    lake.run([("s3", "Ann", "d")], DAYS[1])
    assert lake.names() == {"Ann": 3, "Cid": 1}


# --- commits -----------------------------------------------------------------------------------


def test_a_run_that_dies_before_its_record_changes_neither_table(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path))
    lake.run([r for r in BATCH_1 if None not in r], DAYS[0])
    before = lake.rows(), lake.names()
    with monkeypatch.context() as patch:
        patch.setattr(CommitLog, "commit", lambda *a: 1 / 0)  # both tables' files are written by then
        with pytest.raises(PhaseError):
            lake.run(BATCH_2, DAYS[1])
    reader = Lake(spark, str(tmp_path))
    assert (reader.rows(), reader.names()) == before
    log = lake.run(BATCH_2, DAYS[1])
    assert [r[:2] for r in log.rows][-1] == ("Delivered", "products_agg")
    assert lake.rows() == [("s1", 1, "Ann"), ("s10", 2, "Cid"), ("s2", 3, "Ann"), ("s4", 6, "Bob")]
    assert lake.names() == {"Ann": 2, "Bob": 1, "Cid": 1}
    lake.products.remove_unused(keep=1)
    lake.counts.remove_unused(keep=1)
    assert reader.names() == lake.names() and len(reader.rows()) == 4


def test_every_record_names_both_tables(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    for batch, day in zip(([r for r in BATCH_1 if None not in r], BATCH_2, BATCH_3), DAYS, strict=True):
        lake.run(batch, day)
    log = lake.products.log
    for name in log.names():
        record = log.read(name)
        assert record["tables"]["products_agg"]["covers"]["products"] == record["tables"]["products"]["content"]
    assert len(log.names()) == 3 and lake.products.has_batch(f"{DAYS[1]} PRODUCTS")


def bucket_of(spark, sku, n):
    return spark.sql(f"select pmod(hash('{sku}'), {n})").first()[0]


def test_writers_of_different_buckets_both_commit(spark, tmp_path):
    table = keyed(spark, tmp_path, 8)
    apart = {bucket_of(spark, f"s{i}", 8): f"s{i}" for i in range(30)}
    one, two = list(apart.values())[:2]
    first = table.prepare(products(spark, rows(1, [one])), PRODUCT_UPDATES)
    second = table.prepare(products(spark, rows(2, [two])), PRODUCT_UPDATES)
    again = table.prepare(products(spark, rows(3, [one], "late")), PRODUCT_UPDATES)
    table.log.commit([first], "b1")
    table.log.commit([second], "b2")
    with pytest.raises(ConcurrentCommitError, match="changed buckets"):
        table.log.commit([again], "b3")
    assert values(table) == sorted([(one, 1, "n"), (two, 2, "n")])
    table.merge(products(spark, rows(3, [one], "late")), "b3", PRODUCT_UPDATES)
    assert (one, 1, "late") in values(table)
    with pytest.raises(ConcurrentCommitError, match="stored already"):
        table.merge(products(spark, rows(3, [one], "late")), "b3", PRODUCT_UPDATES)


def test_a_writer_that_comes_second_works_its_batch_out_again(spark, tmp_path, monkeypatch):
    table, other = keyed(spark, tmp_path, 1), keyed(spark, tmp_path, 1)
    commit, early = CommitLog.commit, []

    def late(self, changes, batch_id):
        if batch_id == "b2" and not early:
            early.append(1)
            other.merge(products(spark, rows(1, ["s1"], "first")), "b1", PRODUCT_UPDATES)
        return commit(self, changes, batch_id)

    monkeypatch.setattr(CommitLog, "commit", late)
    table.merge(products(spark, rows(2, ["s1", "s2"], "second")), "b2", PRODUCT_UPDATES)
    assert values(table) == [("s1", 1, "second"), ("s2", 3, "second")]


def test_two_jobs_at_once_lose_nothing(spark, tmp_path):
    def job(number):
        lake = Lake(spark, str(tmp_path))
        for k in range(2):
            batch = [(f"j{number}-{k}-{i}", f"n{i % 3}", "d") for i in range(9)] + [("shared", f"of {number}", "d")]
            lake.run(batch, DAYS[k], batch_id=f"{number}-{k}", audit_path=None, rejects_path=f"{tmp_path}/r{number}")

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(job, range(2)))
    lake = Lake(spark, str(tmp_path))
    found = lake.products.current().collect()
    assert len(found) == 37 and len({r.p_id for r in found}) == 37
    names = lake.names()
    assert {n: names[n] for n in ("n0", "n1", "n2")} == {"n0": 12, "n1": 12, "n2": 12}
    (last,) = [r.name for r in found if r.sku == "shared"]
    assert names[last] == 1


def test_blocks_of_ids_never_overlap(spark, tmp_path):
    table = keyed(spark, tmp_path, 2)
    with ThreadPoolExecutor(4) as pool:
        starts = list(pool.map(lambda k: table.reserve_ids(10, f"b{k}"), range(8)))
    assert sorted(starts) == list(range(0, 80, 10))
    assert table.reserve_ids(10, "b3") == starts[3]  # run again
    table.merge(products(spark, rows(starts[3] + 1, ["a", "b"])), "b3", PRODUCT_UPDATES)
    others = max(start for k, start in enumerate(starts) if k != 3) + 10
    assert table.reserve_ids(5, "next") == max(others, starts[3] + 2)  # unused ids of a stored batch are free


def versions(spark, tmp_path, name, **settings):
    return open_tables(spark, f"{tmp_path}/{name}", 3, "changed INT", **settings)


@pytest.mark.parametrize("ratio", [0, 0.25, 100])
def test_deliveries_in_any_order_give_the_same_rows(spark, tmp_path, ratio):
    """Later and earlier versions, ties, withdrawn keys and keys that return, folded and as deltas."""
    random.seed(int(ratio * 4))
    feed = [
        (f"s{random.randrange(12)}", random.choice("abc"), str(i % 3), random.choice([1, 2, 3, 4]), random.choice([True, False, None]))
        for i in range(60)
    ] + [("s1", "x", "late", None, False), ("s99", "x", "only", 9, True)]
    deliveries = [feed[i::3] for i in range(3)]
    schema = "sku string, name string, description string, changed int, withdrawn boolean"
    seen = {}
    for order in ((0, 1, 2), (2, 1, 0), (1, 2, 0, 1)):
        tables_ = products_, counts_ = versions(spark, tmp_path, "-".join(map(str, order)), delta_ratio=ratio)
        for step, number in enumerate(order):
            batch = spark.createDataFrame(deliveries[number], schema)
            run_ingest(
                spark, batch, *tables_, DAYS[number], rejects_path=f"{tmp_path}/r{order}", batch_id=f"{step}",
                newer_by="changed", withdrawn="withdrawn", counts_mode="replace",
            )
        if order[0] == 2:
            products_.compact()
        rows_ = sorted((r.sku, r.name, r.description, r.changed, r.request_id) for r in products_.current().collect())
        seen[order] = rows_, sorted(map(tuple, counts_.current().collect()))
    wanted = {}
    for sku, name, description, changed, gone in feed:
        if changed is not None:
            wanted[sku] = max(wanted.get(sku, (0,)), (changed, bool(gone), name, description))
    kept = sorted((s, n, d, c) for s, (c, gone, n, d) in wanted.items() if not gone)
    names = [n for _, n, _, _ in kept]
    for found, counted in seen.values():
        assert [r[:4] for r in found] == kept
        assert counted == sorted((n, names.count(n)) for n in set(names))
    assert seen[0, 1, 2] == seen[2, 1, 0] == seen[1, 2, 0, 1]


def test_versions_need_a_column_of_the_table(spark, tmp_path):
    plain, _ = open_tables(spark, f"{tmp_path}/plain", 2)
    batch = products(spark, rows(1, ["s1"]))
    with pytest.raises(ValueError, match="no column changed"):
        plain.merge(batch, "b1", PRODUCT_UPDATES, newer_by="changed")
    with pytest.raises(ValueError, match="newer_by"):
        plain.merge(batch, "b1", PRODUCT_UPDATES, withdrawn="gone")


def test_a_table_without_versions_takes_what_comes(spark, tmp_path):
    """The default stays unconditional, also over a withdrawn key."""
    products_, counts_ = versions(spark, tmp_path, "t")
    schema = "sku string, name string, description string, changed int, withdrawn boolean"
    settings = {"rejects_path": f"{tmp_path}/r"}
    new, old = [("s1", "b", "d", 5, True), ("s2", "b", "d", 5, False)], [("s1", "a", "d", 1, False), ("s2", "a", "d", 1, False)]
    run_ingest(spark, spark.createDataFrame(new, schema), products_, counts_, DAYS[0], newer_by="changed", withdrawn="withdrawn", **settings)
    assert [(r.sku, r.changed) for r in products_.current().collect()] == [("s2", 5)]
    run_ingest(spark, spark.createDataFrame(old, schema).drop("withdrawn"), products_, counts_, DAYS[1], newer_by="changed", **settings)
    assert [(r.sku, r.changed) for r in products_.current().collect()] == [("s2", 5)]
    run_ingest(spark, spark.createDataFrame(old, schema).drop("withdrawn"), products_, counts_, DAYS[2], **settings)
    assert sorted((r.sku, r.name) for r in products_.current().collect()) == [("s1", "a"), ("s2", "a")]
    assert {r.name: r.no_of_products for r in counts_.current().collect()}["a"] == 2


def test_buckets_follow_the_rows():
    most = tables.ROWS_PER_BUCKET
    assert [tables.buckets_for(n) for n in (0, 4 * most, 4 * most + 1, 200 * most)] == [4, 4, 5, 200]


def ship_table(spark, folder, orders):
    """The keyed table over line items of so many orders, two of each, shipped around the cuts of the batches."""
    days = ("1998-01-01", "1998-11-26", "1998-12-01")
    items = [(i, 1 + line, "AN"[line], "O", days[(i + line) % 50 % 3 if i % 5 == 0 else 0]) for i in range(orders) for line in range(2)]
    shape = "l_orderkey long, l_linenumber int, l_returnflag string, l_linestatus string, l_shipdate string"
    made = spark.createDataFrame(items, shape).withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp"))
    made.write.parquet(f"{folder}/lineitem.parquet")
    return driver._merged_by_ship_date(spark, str(folder))


def bucket_rows(table):
    """Keys in each bucket."""
    return Counter(r[0] for r in table.current().select(table._bucket()).collect())


def test_merge_deltas_has_buckets_of_bounded_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "ROWS_PER_BUCKET", 25)
    table = ship_table(spark, tmp_path, 600)
    assert table.buckets > 20 and len(table.latest()["files"]) == table.buckets
    found = bucket_rows(table)
    assert sum(found.values()) == 600 and max(found.values()) <= 60  # 150 in each of 4 buckets before


def test_compacted_buckets_stay_of_bounded_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "ROWS_PER_BUCKET", 25)
    table = ship_table(spark, tmp_path, 600)
    before = sorted(map(tuple, table.current().collect()))
    assert any(len(own["parts"]) > 1 for own in table.latest()["files"].values())
    table.compact()
    (folds,) = {len(own["parts"]) for own in table.latest()["files"].values()}
    assert folds == 1 and table.buckets > 20 and max(bucket_rows(table).values()) <= 60
    assert sorted(map(tuple, table.current().collect())) == before
