"""Kept drill-down sums against `hierarchy_totals` over all rows."""

import random
from decimal import Decimal

import pytest

from millrace.errors import ConcurrentCommitError
from millrace.operators import hierarchy_totals
from millrace.sinks import DrillDown, row_changes

SCHEMA = "a string, b int, v decimal(10,2)"
HEADERS = ["a", "b"]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def nodes(df):
    return sorted(map(tuple, df.select("level", *HEADERS, "value").collect()), key=str)


def drill(spark, tmp_path, **settings):
    return DrillDown(spark, f"{tmp_path}/sums", frame(spark, []).schema, HEADERS, "v", **settings)


@pytest.mark.parametrize("ratio", [0, 0.25, 100])
def test_batches_with_updates_equal_the_whole(spark, tmp_path, ratio):
    """Inserts, updates that move rows to other nodes, deletions; null headers, null values, nodes that go."""
    chosen = random.Random(3)
    sums, rows = drill(spark, tmp_path, delta_ratio=ratio), []

    def row():
        value = chosen.choice([None, Decimal(0), Decimal(chosen.randrange(-500, 500)) / 100])
        return (chosen.choice(["x", "y", None, "z"]), chosen.choice([1, 2, None]), value)

    for batch in range(5):
        gone = chosen.sample(rows, len(rows) // 3) if batch < 4 else list(rows)
        come = [row() for _ in range(30 if batch < 2 else 5)] if batch < 4 else [("only", 1, None)]
        for one in gone:
            rows.remove(one)
        rows += come
        sums.apply(row_changes(frame(spark, gone), frame(spark, come)), f"b{batch}")
        whole = hierarchy_totals(frame(spark, rows), HEADERS, "v")
        assert sums.current().dtypes == whole.dtypes
        assert nodes(sums.current()) == nodes(whole)
    sums.remove_unused()
    assert nodes(sums.current()) == [(0, None, None, 0), (1, "only", None, 0), (2, "only", 1, 0)]


def test_a_batch_writes_touched_nodes_and_reads_no_stored_ones(spark, tmp_path):
    sums = drill(spark, tmp_path)
    many = [(f"n{i}", j, Decimal(1)) for i in range(200) for j in range(5)]
    sums.apply(row_changes(frame(spark, []), frame(spark, many)), "b1")
    changes = row_changes(frame(spark, [("n7", 1, Decimal(1))]), frame(spark, [("n7", 2, Decimal(4))]))
    written = sums.node_changes(changes)
    assert sums.root not in written._jdf.queryExecution().executedPlan().toString()
    assert written.count() == 4  # the whole, n7, and both of its leaves
    (parts,) = sums.apply(changes, "b2").files.values()
    assert [n for _, n in parts] == [1 + 200 + 1000, 4]


def test_nothing_changes_and_repeated_batches(spark, tmp_path):
    sums = drill(spark, tmp_path)
    assert sums.current().count() == 0
    same = frame(spark, [("x", 1, Decimal(2))])
    sums.apply(row_changes(same, same), "b1")
    assert sums.current().count() == 0
    sums.apply(row_changes(frame(spark, []), same), "b2")
    with pytest.raises(ConcurrentCommitError):
        sums.apply(row_changes(frame(spark, []), same), "b2")
    assert nodes(sums.current())[0] == (0, None, None, Decimal(2))


def test_what_cannot_be_kept_is_an_error(spark, tmp_path):
    schema = spark.createDataFrame([], "a string, v double").schema
    with pytest.raises(ValueError, match="exact"):
        DrillDown(spark, f"{tmp_path}/s", schema, ["a"], "v")
    odd = frame(spark, [("x", 1, Decimal(2))]).selectExpr("*", "2 as change")
    with pytest.raises(Exception, match="1 or -1"):
        drill(spark, tmp_path).apply(odd, "b1")
