"""Random batches against a plain model of what the job should store."""

import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from millrace import KeyedTable, Staging
from millrace.plans import run_ingest, transform_rows
from millrace.sinks import COUNTS, PRODUCTS
from millrace.sources import PRODUCT_FEED

QUICK = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
DAYS = [f"2021-08-0{d}T02:00:00+00:00" for d in (1, 2, 3)]
# a few values only, so that keys, copies and names repeat; one key is hot
SKU = st.one_of(st.none(), st.just("hot"), st.just("hot"), st.sampled_from(["a", "b", "B", "é", "a10", "a9"]))
TEXT = st.one_of(st.none(), st.sampled_from(["x", "y", "X", "ü", "x y", "'"]))
BATCH = st.lists(st.tuples(SKU, TEXT, TEXT), min_size=1, max_size=30)


def numbered(rows, day):
    """Sort, number and keep the last row per key, one row at a time."""
    digits = "".join(c for c in day if c.isdigit()).ljust(20, "0")
    valid = sorted((r for r in rows if None not in r), key=lambda r: tuple(v.encode() for v in r))
    kept = {}
    for position, row in enumerate(valid, 1):
        kept[row[0]] = (*row, f"{digits}{position:012d}", hashlib.md5("".join(row).encode()).hexdigest())
    return [kept[k] for k in sorted(kept, key=str.encode)]


@QUICK
@given(rows=BATCH)
def test_transform_equals_the_model(spark, tmp_path_factory, rows):
    staging = Staging(spark, str(tmp_path_factory.mktemp("m")))
    feed = spark.createDataFrame([r for r in rows if None not in r], PRODUCT_FEED).repartition(3)
    made = transform_rows(feed, DAYS[0], staging, offset=7, slices=3).orderBy("p_id").collect()
    assert list(map(tuple, made)) == [(7 + i, *row) for i, row in enumerate(numbered(rows, DAYS[0]), 1)]


@QUICK
@given(batches=st.lists(BATCH, min_size=2, max_size=3), buckets=st.sampled_from([1, 3]))
def test_ingest_equals_the_model(spark, tmp_path_factory, batches, buckets):
    root = str(tmp_path_factory.mktemp("m"))
    products = KeyedTable(spark, f"{root}/p", PRODUCTS, "sku", buckets, "p_id")
    counts = KeyedTable(spark, f"{root}/c", COUNTS, "name", buckets)
    stored, names = {}, {}
    for rows, day in zip(batches, DAYS, strict=False):
        log = run_ingest(
            spark,
            spark.createDataFrame(rows, PRODUCT_FEED),
            products,
            counts,
            day,
            rejects_path=f"{root}/rejects",
        )
        offset = max((row[0] for row in stored.values()), default=0)
        kept = numbered(rows, day)
        for i, row in enumerate(kept, 1):
            stored[row[0]] = (stored[row[0]][0] if row[0] in stored else offset + i, *row)
        live = [row[2] for row in stored.values()]
        names.update({name: live.count(name) for name in live})
        assert [r[3] for r in log.rows[:3]] == [len(rows), len(kept), len(kept)]
    found = products.current().drop("updt_tmstmp").collect()
    assert sorted(map(tuple, found)) == sorted(stored.values())
    assert dict(map(tuple, counts.current().collect())) == names
    rejected = sum(None in r for rows in batches for r in rows)
    if rejected:
        files = spark.read.schema(PRODUCT_FEED).options(header="true", escape='"').csv(f"{root}/rejects/*")
        assert files.count() == rejected
