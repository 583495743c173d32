import pytest
from conftest import plan_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import latest_by_rank, latest_per_key, merge_counts, merge_rows

SLOW = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
SCHEMA = "p_id bigint, sku string, name string, description string, request_id string, record_checksum string"


def target(spark):
    rows = [
        (1, "s1", "Bob", "d0", "r2", "c1"),
        (2, "s10", "Cid", "z", "r3", "c2"),
        (3, "s2", "Ann", "x", "r5", "c3"),
    ]
    return spark.createDataFrame(rows, SCHEMA).withColumn("updt_tmstmp", F.lit("2021-08-07").cast("timestamp"))


def batch(spark):
    rows = [
        (4, "s1", "Ann", "d9", "q1", "c9"),
        (5, "s2", "Ann", "x", "q2", "c3"),
        (6, "s4", "Bob", "n", "q3", "c4"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_worked_merge(spark):
    stamp = F.lit("2021-08-08").cast("timestamp")
    merged = merge_rows(target(spark), batch(spark), stamp=stamp, action="action")
    found = sorted((r.sku, r.p_id, r.name, r.description, r.request_id, str(r.updt_tmstmp)[:10], r.action) for r in merged.collect())
    assert found == [
        ("s1", 1, "Ann", "d9", "q1", "2021-08-08", "update"),
        ("s10", 2, "Cid", "z", "r3", "2021-08-07", "keep"),
        ("s2", 3, "Ann", "x", "q2", "2021-08-08", "update"),
        ("s4", 6, "Bob", "n", "q3", "2021-08-08", "insert"),
    ]


def test_unless_equal_keeps_unchanged_rows(spark):
    merged = merge_rows(
        target(spark), batch(spark), unless_equal="record_checksum", action="action"
    )
    found = {r.sku: (r.action, r.request_id) for r in merged.collect()}
    assert found == {"s1": ("update", "q1"), "s10": ("keep", "r3"), "s2": ("keep", "r5"), "s4": ("insert", "q3")}


def test_the_default_stamp_is_now(spark):
    merged = merge_rows(target(spark), batch(spark))
    newest = merged.filter("sku = 's4'").select(F.col("updt_tmstmp") >= F.current_timestamp() - F.expr("interval 1 hour"))
    assert newest.first()[0]


def test_null_values_overwrite(spark):
    t = spark.createDataFrame([("k", "old", 1)], "sku string, name string, extra int")
    u = spark.createDataFrame([("k", None), ("n", None)], "sku string, name string")
    merged = merge_rows(t, u, update=("name",))
    assert sorted(map(tuple, merged.collect())) == [("k", None, 1), ("n", None, None)]


KEYS = st.dictionaries(st.text("abc", max_size=2), st.integers(0, 5), max_size=8)


@SLOW
@given(old=KEYS, new=KEYS)
def test_a_merge_equals_a_dict_update(spark, old, new):
    t = spark.createDataFrame(list(old.items()), "k string, v int")
    u = spark.createDataFrame(list(new.items()), "k string, v int")
    merged = merge_rows(t, u, ("k",), ("v",))
    assert {r.k: r.v for r in merged.collect()} == {**old, **new}


def test_a_null_checksum_counts_as_a_change(spark):
    schema = "sku string, name string, record_checksum string"
    t = spark.createDataFrame([("a", "old", None), ("b", "old", "c"), ("c", "old", "c"), ("d", "old", None)], schema)
    u = spark.createDataFrame([("a", "new", None), ("b", "new", None), ("c", "new", "c"), ("d", "new", "c")], schema)
    merged = merge_rows(t, u, update=("name", "record_checksum"), unless_equal="record_checksum", action="action")
    assert {r.sku: (r.name, r.action) for r in merged.collect()} == {
        "a": ("new", "update"),
        "b": ("new", "update"),
        "c": ("old", "keep"),
        "d": ("new", "update"),
    }


def test_counts_keep_stale_values_unless_replaced(spark):
    old = spark.createDataFrame([("Ann", 2), ("Cid", 1)], "name string, n bigint")
    new = spark.createDataFrame([("Ann", 3), ("Bob", 1)], "name string, n bigint")
    assert sorted(map(tuple, merge_counts(old, new).collect())) == [("Ann", 3), ("Bob", 1), ("Cid", 1)]
    assert sorted(map(tuple, merge_counts(old, new, mode="replace").collect())) == [("Ann", 3), ("Bob", 1)]
    with pytest.raises(ValueError):
        merge_counts(old, new, mode="append")


@SLOW
@given(st.lists(st.tuples(st.sampled_from("ab"), st.text("xy", max_size=2), st.integers(0, 3)), max_size=20))
def test_latest_per_key(spark, rows):
    df = spark.createDataFrame(rows, "sku string, r string, v int")
    wanted = {}
    for sku, r, v in sorted(rows, key=lambda x: (x[1], x[2])):
        wanted[sku] = (r, v)
    assert {x.sku: (x.r, x.v) for x in latest_per_key(df, order_by=("r",)).collect()} == wanted
    assert {x.sku: (x.r, x.v) for x in latest_by_rank(df, order_by=("r", "v")).collect()} == wanted


def test_latest_keeps_map_columns(spark):
    df = spark.createDataFrame([("a", "1", {"x": 1}), ("a", "2", {"y": 2})], "sku string, r string, m map<string,int>")
    assert [r.m for r in latest_per_key(df, order_by=("r",)).collect()] == [{"y": 2}]


def test_latest_folds_ahead_of_the_shuffle(spark):
    df = spark.range(10).select(F.col("id").alias("sku"), F.col("id").alias("request_id"))
    assert "partial_max" in plan_of(latest_per_key(df))
    assert "WindowGroupLimit" in plan_of(latest_by_rank(df))
