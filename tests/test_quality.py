import pytest
from pyspark.sql import functions as F

from millrace.errors import EmptySourceError
from millrace.operators import (
    constraint_violations,
    error_rows,
    observe_counts,
    require_rows,
    valid_rows,
    with_reject_reason,
)
from millrace.sources import PRODUCT_FEED

BATCH_1 = [
    ("s1", "Ann", "d1"),
    ("s1", "Bob", "d0"),
    ("s2", "Ann", "x"),
    ("s2", "Ann", "x"),
    ("s3", None, "d"),
    ("s10", "Cid", "z"),
    (None, "Dee", "q"),
]


@pytest.fixture
def feed(spark):
    return spark.createDataFrame(BATCH_1, PRODUCT_FEED)


def test_split_is_complete(feed):
    good, bad = valid_rows(feed), error_rows(feed)
    assert good.count() == 5
    assert sorted(map(str, bad.collect())) == sorted(
        ["Row(sku='s3', name=None, description='d')", "Row(sku=None, name='Dee', description='q')"]
    )


def test_required_columns_are_a_parameter(feed):
    assert valid_rows(feed, ("sku",)).count() == 6
    assert error_rows(feed, ("name",)).count() == 1


def test_reject_reason_names_every_null(spark):
    rows = spark.createDataFrame([("a", None, None), ("b", "n", "d")], PRODUCT_FEED)
    found = {r.sku: r.reject_reason for r in with_reject_reason(rows).collect()}
    assert found == {"a": "name null, description null", "b": None}


def test_empty_source_is_an_error(spark, feed):
    assert require_rows(feed) is feed
    with pytest.raises(EmptySourceError):
        require_rows(spark.createDataFrame([], PRODUCT_FEED))


def test_observed_counts_come_with_the_write(feed):
    counted, seen = observe_counts(feed, "t", rejected=F.col("name").isNull())
    counted.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 7, "rejected": 1}


def test_constraints(feed):
    broken = constraint_violations(feed, unique=("sku",), not_null=("name",), max_length={"name": 2})
    found = {(r.constraint_name, r.column_name, r.value): r.n_rows for r in broken.collect()}
    assert found == {
        ("unique", "sku", "s1"): 2,
        ("unique", "sku", "s2"): 2,
        ("not null", "name", None): 1,
        ("max length", "name", "Ann"): 3,
        ("max length", "name", "Bob"): 1,
        ("max length", "name", "Cid"): 1,
        ("max length", "name", "Dee"): 1,
    }
    with pytest.raises(ValueError):
        constraint_violations(feed)
