"""Unique columns across a batch and the stored table, against all rows after the merge."""

import random

import pytest
from pyspark.sql import functions as F

from millrace import KeyedTable

SCHEMA = "sku string, p_id bigint, code string"


@pytest.mark.parametrize("ratio", [0, 100])
@pytest.mark.parametrize("update", [(), ("p_id",), ("p_id", "code")])
def test_clashes_equal_those_of_the_merged_table(spark, tmp_path, ratio, update):
    """Stored ids that an earlier batch replaced clash with nothing, nor do those that this batch replaces."""
    chosen = random.Random(5)
    table = KeyedTable(spark, f"{tmp_path}/t", spark.createDataFrame([], SCHEMA).schema, "sku", 3, delta_ratio=ratio)

    def batch(n):
        skus = chosen.sample(range(60), n)
        return spark.createDataFrame(
            [(f"s{i}", chosen.choice([None, *range(80)]), f"c{chosen.randrange(90)}") for i in skus], SCHEMA
        )

    for i in range(2):
        table.merge(batch(30), f"b{i}", ("p_id", "code"), stamp_column=None)
    last = batch(25)
    found = {(r.column_name, r.value, r.n_rows) for r in table.clashes(last, ["p_id", "code"], update).collect()}
    stored = {r.sku: r for r in table.current().collect()}
    expected = set()
    for column in ("p_id", "code"):
        after = {sku: row[column] for sku, row in stored.items()}
        touched = {r.sku: r[column] for r in last.collect() if column in update or r.sku not in stored}
        after |= touched
        for value in set(touched.values()) - {None}:
            n = sum(v == value for v in after.values())
            if n > 1:
                expected.add((column, str(value), n))
    assert found == expected and expected


def test_an_empty_table_or_batch(spark, tmp_path):
    table = KeyedTable(spark, f"{tmp_path}/t", spark.createDataFrame([], SCHEMA).schema, "sku", 3)
    rows = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], SCHEMA)
    assert [tuple(r) for r in table.clashes(rows, ["p_id"]).collect()] == [("unique", "p_id", "1", 2)]
    assert table.clashes(rows.limit(0), ["p_id", "code"]).count() == 0
    with pytest.raises(ValueError):
        table.clashes(rows, [])


def test_the_scan_of_stored_ids_is_bounded(spark, tmp_path):
    table = KeyedTable(spark, f"{tmp_path}/t", spark.createDataFrame([], SCHEMA).schema, "sku", 1)
    stored = spark.range(100).select(F.concat(F.lit("s"), "id").alias("sku"), F.col("id").alias("p_id"), F.lit("c").alias("code"))
    table.merge(stored, "b1", (), stamp_column=None)
    new = spark.createDataFrame([("n", 500, "d")], SCHEMA)
    found = table.clashes(new, ["p_id"])
    plan = found._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(p_id,500)" in plan and "LessThanOrEqual(p_id,500)" in plan
    assert found.count() == 0
