import glob
import json
from collections import defaultdict

import pytest
from conftest import plan_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from millrace import Staging
from millrace.operators import hierarchy_document, hierarchy_totals, write_document

SLOW = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
HEADERS = ["area", "store", "item"]
ROWS = [
    ("north", "dry", "oats", 4),
    ("north", "dry", "rice", 6),
    ("north", "cold", "milk", 1),
    ("south", "dry", "oats", 2),
    ("south", "cold", "eggs", 3),
    ("south", "cold", "milk", 5),
    ("south", "live", "herbs", 7),
]
NULL_TREE = (
    '{"header":"root","field_name":"root","value":"15","children":[{"header":"a","field_name":"x","value":"3",'
    '"children":{"header":"root","field_name":"root","value":"0","children":[{"header":"b","field_name":"p",'
    '"value":"1","children":[]}]}},{"header":"a","field_name":"y","value":"4","children":{"header":"root",'
    '"field_name":"root","value":"0","children":[]}}]}'
)


@pytest.fixture
def sample(spark):
    return spark.createDataFrame(ROWS, "area string, store string, item string, value int")


def sums_by_path(rows, depth):
    """Sum per header prefix; rows count in every prefix that stops ahead of their first null."""
    sums = defaultdict(int, {(): 0})
    for *path, value in rows:
        for level in range(depth + 1):
            if None in path[:level]:
                break
            sums[tuple(path[:level])] += value or 0
    return dict(sums)


def as_tree(sums, headers, path=()):
    """The expected document, from the sums of every path."""
    level = len(path)
    below = sorted(p for p in sums if len(p) == level + 1 and p[:level] == path)
    nodes = [
        {
            "header": headers[level],
            "field_name": p[-1],
            "value": str(sums[p]),
            "children": [] if level + 1 == len(headers) else as_tree(sums, headers, p),
        }
        for p in below
    ]
    return {"header": "root", "field_name": "root", "value": "0" if path else str(sums[()]), "children": nodes}


def document(df, headers, value, staging):
    fragments = hierarchy_document(df, headers, value, staging).orderBy("position").collect()
    return "".join(f.fragment for f in fragments)


def found_totals(df, headers, value, staging=None):
    rows = hierarchy_totals(df, headers, value, staging).collect()
    found = {tuple(r[h] for h in headers[: r.level]): r.value for r in rows}
    assert len(found) == len(rows)
    return found


def test_worked_totals(sample):
    found = found_totals(sample, HEADERS, "value")
    assert found == sums_by_path(ROWS, 3)
    assert found[()] == 28 and found[("south", "cold")] == 8 and len(found) == 15


def test_worked_tree(sample, staging):
    tree = json.loads(document(sample, HEADERS, "value", staging))
    assert tree == as_tree(sums_by_path(ROWS, 3), HEADERS)
    assert [c["field_name"] for c in tree["children"]] == ["north", "south"]


def test_null_headers(spark, staging):
    rows = [("x", "p", 1), ("x", None, 2), ("y", None, 4), (None, "q", 8)]
    df = spark.createDataFrame(rows, "a string, b string, v int")
    assert document(df, ["a", "b"], "v", staging) == NULL_TREE


def test_all_headers_null(spark, staging):
    df = spark.createDataFrame([(None, None, 3)], "a string, b string, v int")
    wanted = '{"header":"root","field_name":"root","value":"3","children":[]}'
    assert document(df, ["a", "b"], "v", staging) == wanted


def test_values_print_like_numbers(spark, staging):
    df = spark.createDataFrame([("a", 2.0), ("a", None), ("b", None), ("c", 1.5e7)], "h string, v double")
    tree = json.loads(document(df, ["h"], "v", staging))
    assert tree["value"] == "15000002.0"
    assert [c["value"] for c in tree["children"]] == ["2.0", "0.0", "15000000.0"]


def test_nan_values_are_skipped(spark):
    df = spark.createDataFrame([("a", float("nan")), ("a", 2.0), ("b", float("nan"))], "h string, v double")
    assert found_totals(df, ["h"], "v") == {(): 2.0, ("a",): 2.0, ("b",): 0.0}


def test_headers_may_not_hide_the_result(sample):
    with pytest.raises(ValueError):
        hierarchy_totals(sample.withColumnRenamed("item", "level"), ["area", "level"], "value")


def test_numeric_headers_sort_as_numbers(spark, staging):
    df = spark.createDataFrame([(10, 1), (9, 1), (100, 1)], "h int, v int")
    tree = json.loads(document(df, ["h"], "v", staging))
    assert [c["field_name"] for c in tree["children"]] == ["9", "10", "100"]


KEY = st.one_of(st.none(), st.text('a"\\é\n', min_size=1, max_size=2))


@SLOW
@given(st.lists(st.tuples(KEY, KEY, KEY, st.one_of(st.none(), st.integers(-9, 9))), min_size=1, max_size=25))
def test_totals_and_document_equal_brute_force(spark, tmp_path_factory, rows):
    staging = Staging(spark, str(tmp_path_factory.mktemp("h")))
    df = spark.createDataFrame(rows, "a string, b string, c string, v int")
    headers = ["a", "b", "c"]
    sums = sums_by_path(rows, 3)
    assert found_totals(df, headers, "v") == sums
    assert found_totals(df, headers, "v", staging) == sums
    wanted = as_tree(sums, headers)
    tree = document(df, headers, "v", staging)
    assert json.loads(tree) == wanted


def test_written_document_is_one_json_text(sample, staging, tmp_path):
    write_document(hierarchy_document(sample, HEADERS, "value", staging), f"{tmp_path}/doc")
    text = "".join(open(p).read() for p in sorted(glob.glob(f"{tmp_path}/doc/part-*")))
    assert json.loads(text) == as_tree(sums_by_path(ROWS, 3), HEADERS)


def test_rows_are_read_once_and_folded_first(spark, staging, tmp_path):
    spark.createDataFrame(ROWS, [*HEADERS, "value"]).write.parquet(f"{tmp_path}/r")
    rows = spark.read.parquet(f"{tmp_path}/r")
    plan = plan_of(hierarchy_totals(rows, HEADERS, "value"))
    assert plan.count("FileScan parquet") == 1
    assert plan.index("Expand") < plan.rindex("partial_sum(")  # printed top down: the fold is below
    assert str(rows.inputFiles()[0]) not in hierarchy_totals(rows, HEADERS, "value", staging).inputFiles()
