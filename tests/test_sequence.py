import pytest
from conftest import plan_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace import Staging
from millrace.errors import SequenceOverflowError
from millrace.operators import sequence, with_dense_key, with_position, with_request_id, with_surrogate_key

SLOW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
WORDS = st.text(alphabet="abéZ_ 9", max_size=4)


def test_request_ids_of_the_worked_batch(spark, staging):
    rows = [("s1", "Ann", "d1"), ("s1", "Bob", "d0"), ("s2", "Ann", "x"), ("s2", "Ann", "x"), ("s10", "Cid", "z")]
    feed = spark.createDataFrame(rows, "sku string, name string, description string")
    made = with_request_id(feed, "2021-08-07T02:00:00+00:00", staging).collect()
    run = "20210807020000000000"
    found = sorted((r.sku, r.name, r.request_id) for r in made)
    assert found == [
        ("s1", "Ann", run + "000000000001"),
        ("s1", "Bob", run + "000000000002"),
        ("s10", "Cid", run + "000000000003"),
        ("s2", "Ann", run + "000000000004"),
        ("s2", "Ann", run + "000000000005"),
    ]


@SLOW
@given(rows=st.lists(st.tuples(WORDS, st.integers(-3, 3)), max_size=40))
def test_position_and_running_total_match_a_sort(spark, tmp_path_factory, rows):
    staging = Staging(spark, str(tmp_path_factory.mktemp("s")))
    df = spark.createDataFrame(rows, "k string, w int")
    placed = with_position(df, ["k", "w"], staging, weight="w", slices=3)
    found = [(r.k, r.w, r.position, r.running_total) for r in placed.orderBy("position").collect()]
    ordered = sorted(rows, key=lambda r: (r[0].encode(), r[1]))
    total, wanted = 0, []
    for i, (k, w) in enumerate(ordered, 1):
        total += w
        wanted.append((k, w, i, total))
    assert found == wanted


def test_nulls_come_first(spark, staging):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "k string")
    found = [r.k for r in with_position(df, ["k"], staging).orderBy("position").collect()]
    assert found == [None, "a", "b"]


def test_a_group_of_copies_is_spread_over_slices(spark, staging, monkeypatch):
    """A third of all rows are equal; no slice may take them all."""
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    written = []
    write = Staging.write
    monkeypatch.setattr(Staging, "write", lambda self, d, *a: written.append(write(self, d, *a)) or written[-1])
    placed = with_position(df, ["k"], staging, slices=8)
    assert sorted(r.position for r in placed.select("position").collect()) == list(range(1, 30_001))
    hot = {r["__slice"]: r["count"] for r in written[0].filter("k = 'hot'").groupBy("__slice").count().collect()}
    assert len(hot) >= 3 and max(hot.values()) < 8_000


def test_bounds_of_long_texts_are_short(spark, staging):
    """Texts of 100 KB that differ soon, late or not at all: cuts hold what parts two keys, not the texts."""
    long = F.repeat(F.lit("wört "), 20_000)
    k = F.when(F.col("id") % 3 == 0, F.concat(F.lit("same"), long)).otherwise(F.concat(F.lit("é/"), F.col("id").cast("string"), long))
    df = staging.write(spark.range(400).repartition(5).select(k.alias("k"), "id"), "long")
    bounds = sequence._bounds(df, [F.col("k"), F.col("id")], 8).first()["b"]
    assert 7 <= len(bounds) <= 8 and bounds == sorted(bounds, key=lambda b: (b.k0.encode(), b.k1 or 0))
    assert all(len(b.k0) <= sequence._CUT if b.k0.startswith("same") else len(b.k0) < 8 for b in bounds)
    placed = with_position(df, ["k", "id"], staging, slices=8, unique=True).select("position", "id", F.left("k", F.lit(9)).alias("k"))
    found = [r.id for r in placed.orderBy("position").collect()]
    wanted = sorted(range(400), key=lambda i: ("same" + "wört " * 2 if i % 3 == 0 else f"é/{i}wört ", i))
    assert found == wanted


@SLOW
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.text(alphabet="aé𝄞", max_size=5)), st.integers(0, 2)), max_size=60))
def test_bounds_part_the_sampled_keys(spark, rows):
    """A cut lies above the sampled key before it and not above its own."""
    df = spark.createDataFrame(rows, "k string, n int").coalesce(1)
    bounds = sequence._bounds(df, [F.col("k"), F.col("n")], 100).first()["b"]
    order = lambda k, n: ((0, b"") if k is None else (1, k.encode()), -1 if n is None else n)
    keys, cuts = sorted(order(*r) for r in rows), [order(*b) for b in bounds]
    assert len(cuts) == len(keys) and all(c <= k for c, k in zip(cuts, keys, strict=True))
    assert all(a < c or a == k for a, c, k in zip(keys, cuts[1:], keys[1:], strict=False))


def test_no_step_puts_the_rows_through_one_task(spark, staging, monkeypatch):
    plans = []
    write = Staging.write
    monkeypatch.setattr(Staging, "write", lambda self, d, *a: plans.append(plan_of(d)) or write(self, d, *a))
    df = spark.range(1000).select(F.col("id").alias("k"), F.lit(2).alias("w"))
    plans.append(plan_of(with_position(df, ["k"], staging, weight="w")))
    assert len(plans) == 2
    assert plans[0].count("Exchange") == 1 and "hashpartitioning(__slice" in plans[0]
    assert "BroadcastHashJoin" in plans[1]
    for plan in plans:
        assert "SinglePartition" not in plan and "Python" not in plan


def test_empty_input(spark, staging):
    df = spark.createDataFrame([], "k string")
    assert with_dense_key(df, ["k"], staging).collect() == []


def test_too_many_rows_for_the_digits(spark, staging):
    df = spark.createDataFrame([(1, 10**12)], "k int, w bigint")
    with pytest.raises(SequenceOverflowError):
        with_position(df, ["k"], staging, weight="w", limit=10**12)
    placed = with_position(df, ["k"], staging, weight="w").first()
    assert placed.running_total == 10**12
    many = spark.range(100).select(F.col("id").cast("string").alias("sku"))
    with pytest.raises(SequenceOverflowError):
        with_request_id(many, "2021-08-07T02:00:00+00:00", staging, ("sku",), digits=2)


def test_the_next_row_is_seen_across_slices(spark, staging):
    df = spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"))
    placed = with_position(df, ["k"], staging, ahead="v", slices=9, unique=True)
    found = {r.k: r.next_v for r in placed.collect()}
    assert found == {k: (k + 1) * 3 if k < 499 else None for k in range(500)}


def test_surrogate_key_equals_the_rdd_numbering(spark):
    df = spark.range(500).repartition(7)
    keyed = with_surrogate_key(spark.range(500), offset=40, partitions=7)
    wanted = {row.id: k + 41 for row, k in df.rdd.zipWithUniqueId().collect()}
    assert keyed.columns == ["p_id", "id"]
    assert {r.id: r.p_id for r in keyed.collect()} == wanted


def test_dense_key_follows_the_order(spark, staging):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "sku string")
    keyed = with_dense_key(df, ["sku"], staging, offset=10)
    assert sorted((r.p_id, r.sku) for r in keyed.collect()) == [(11, "a"), (12, "b"), (13, "c")]


def test_surrogate_key_by_a_unique_key_does_not_depend_on_row_order(spark):
    rows = [(f"k{i}",) for i in range(300)]
    there = with_surrogate_key(spark.createDataFrame(rows, "k string"), 7, 5, unique_key=["k"])
    back = with_surrogate_key(spark.createDataFrame(rows[::-1], "k string").repartition(3), 7, 5, unique_key=["k"])
    ids = {r.k: r.p_id for r in there.collect()}
    assert ids == {r.k: r.p_id for r in back.collect()}
    assert len(set(ids.values())) == 300 and min(ids.values()) > 5
