import pytest

from millrace.errors import UnsupportedSourceError
from millrace.sources import (
    PRODUCT_FEED,
    Source,
    inline_rows,
    jdbc_options,
    parse_options,
    parse_sources,
    read_csv,
    read_source,
)

CSV = '''name,sku,description
A,s1,"line1
line2, x"
,s2,d2
"",s3,d3
B,s4
C,s5,"he said ""hi"""
D,s6,"dbl ""q"" x"
E,s7,d7,extra
'''
ORDER = "name string, sku string, description string"


@pytest.fixture
def path(tmp_path):
    file = tmp_path / "products.csv"
    file.write_text(CSV)
    return str(file)


def test_csv_edges(spark, path):
    found = {r.sku: (r.name, r.description) for r in read_csv(spark, path, ORDER).collect()}
    assert found == {
        "s1": ("A", "line1\nline2, x"),
        "s2": (None, "d2"),
        "s3": (None, "d3"),
        "s4": ("B", None),
        "s5": ("C", 'he said "hi"'),
        "s6": ("D", 'dbl "q" x'),
        "s7": ("E", "d7"),
    }


def test_reader_options_are_honoured(spark, path):
    kept = read_csv(spark, path, ORDER, {"nullValue": "\\N"}).collect()
    assert {r.sku: r.name for r in kept}["s3"] == ""
    backslash = read_csv(spark, path, ORDER, {"escape": "\\"}).collect()
    assert {r.sku: r.description for r in backslash}["s6"] == '"dbl ""q"" x"'


@pytest.mark.parametrize("share", ["16k", "128m"])
def test_one_rule_for_files_of_every_size(spark, tmp_path, share):
    """Quotes that even out in a line although a field spans lines; the file is above and below a share."""
    rows = [(f"s{i}", 'a "q"\n"b" end', "text " * 5) for i in range(2000)]
    folder = f"{tmp_path}/csv"
    frame = spark.createDataFrame(rows, PRODUCT_FEED).coalesce(1)
    frame.write.options(header="true", escape='"', ignoreTrailingWhiteSpace="false").csv(folder)
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, share)
    try:
        assert sorted(map(tuple, read_csv(spark, folder, PRODUCT_FEED).collect())) == sorted(rows)
        split = read_csv(spark, folder, PRODUCT_FEED, {"multiLine": "false"})
        assert (split.rdd.getNumPartitions() > 1) == (share == "16k")
    finally:
        spark.conf.set(key, before)


def test_the_header_names_the_columns(spark, tmp_path):
    (tmp_path / "k.csv").write_text("description,sku\n007,a\n10,c,x\n9\n")
    made = read_csv(spark, f"{tmp_path}/k.csv", malformed="bad")
    assert [f.dataType.simpleString() for f in made.schema] == ["string"] * 3
    assert sorted(map(tuple, made.collect()), key=str) == [("007", "a", None), ("10", "c", "10,c,x"), ("9", None, "9")]
    with pytest.raises(Exception, match="header"):
        read_csv(spark, f"{tmp_path}/k.csv", "sku string, description string").collect()


def test_config(spark, path):
    config = {
        "ingestion_interval": "day",
        "sources": [
            {
                "data_object": "PRODUCTS",
                "source_type": "local",
                "path": path,
                "options": "header='true', sep=',',  comment='#'",
                "format": "csv",
            }
        ],
    }
    (source,) = parse_sources(config)
    assert source.options == {"header": "true", "sep": ",", "comment": "#"}
    assert read_source(spark, source, ORDER).count() == 7
    for wrong in ("header=True", 'header="true"', "header='true' oops"):
        with pytest.raises(ValueError):
            parse_options(wrong)
    assert parse_options(None) == {} and parse_options({"a": 1}) == {"a": "1"}
    assert parse_sources({}) == []


@pytest.mark.parametrize("format", ["json", "parquet", "orc"])
def test_other_formats(spark, tmp_path, format):
    rows = inline_rows(spark, {"sku": ["a", "b"], "n": [1, 2]})
    rows.write.format(format).save(f"{tmp_path}/f")
    source = Source("X", f"{tmp_path}/f", format=format)
    assert sorted((r.sku, r.n) for r in read_source(spark, source).collect()) == [("a", 1), ("b", 2)]
    assert read_source(spark, source, "sku string").columns == ["sku"]


@pytest.mark.parametrize(
    "source", [Source("X", "p", source_type="ftp"), Source("X", "p", format="xlsx"), Source("X", None)]
)
def test_what_cannot_be_read_is_an_error(spark, source):
    with pytest.raises(UnsupportedSourceError):
        read_source(spark, source)


def test_jdbc_options():
    plain = jdbc_options("jdbc:x", "products", user="u")
    assert plain == {"url": "jdbc:x", "dbtable": "products", "user": "u"}
    split = jdbc_options("jdbc:x", "products", "p_id", 0, 1000, 8)
    assert split["numPartitions"] == "8" and split["partitionColumn"] == "p_id" and split["upperBound"] == "1000"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "products", "p_id")


def test_inline_rows_need_equal_lengths(spark):
    with pytest.raises(ValueError):
        inline_rows(spark, {"a": [1], "b": [1, 2]})
