"""Readers for files and database tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from millrace.errors import UnsupportedSourceError
from millrace.sources.config import Source, parse_options

FILE_FORMATS = ("csv", "json", "parquet", "orc", "text")
FILE_TYPES = ("local", "file")

PRODUCT_FEED = T.StructType(
    [
        T.StructField("sku", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("description", T.StringType()),
    ]
)

# How product files are written, unless a source says otherwise.
CSV_SETTINGS = {
    "header": "true",
    "delimiter": ",",
    "escape": '"',
    "quote": '"',
    "multiline": "true",
    "enforceschema": "false",
}


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    options: Mapping[str, str] | None = None,
    malformed: str | None = None,
) -> DataFrame:
    """CSV with a header, commas and quoted fields that may span lines; ``""`` escapes a quote.

    Columns are named by the header. Without a ``schema`` they are all text and nothing is
    inferred; a file whose header has other names or another order is an error, with a schema
    too. ``malformed`` names a column for the text of rows that have more or fewer fields than
    the header; it is null for all others. One rule holds for files of every size: Spark gives a
    whole file to one task while fields may span lines; say ``multiLine=false`` where none do, or
    read large files with `read_csv_by_ranges`.
    """
    settings = dict(CSV_SETTINGS)
    settings.update({name.lower(): value for name, value in (options or {}).items()})
    if schema is None:
        names = spark.read.options(**settings).csv(path).columns
        schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if malformed:
        settings["columnnameofcorruptrecord"] = malformed
        schema = T.StructType([*schema.fields, T.StructField(malformed, T.StringType())])
    return spark.read.options(**settings).schema(schema).csv(path)


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int = 1,
    **other: str,
) -> dict[str, str]:
    """Options for Spark's JDBC source.

    With a partition column the table is read by ``partitions`` tasks at once; the bounds only
    place the cuts, rows outside them are read too.
    """
    options = {"url": url, "dbtable": table, **other}
    if partition_column:
        if lower is None or upper is None:
            raise ValueError("a partitioned read needs lower and upper bounds")
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
        )
    return options


def read_table(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """A database table through Spark's JDBC source; see `jdbc_options`."""
    return spark.read.format("jdbc").options(**options).load()


def read_source(
    spark: SparkSession,
    source: Source,
    schema: T.StructType | str | None = None,
    malformed: str | None = None,
) -> DataFrame:
    """Read one described source; an unknown type or format is an error.

    ``malformed`` is the column that `read_csv` gives rows it could not read; other formats have none.
    """
    options = parse_options(source.options)
    if source.source_type == "jdbc":
        return read_table(spark, options)
    if source.source_type not in FILE_TYPES:
        raise UnsupportedSourceError(f"source type {source.source_type!r} is not supported")
    if source.format not in FILE_FORMATS:
        raise UnsupportedSourceError(f"format {source.format!r} is not supported")
    if not source.path:
        raise UnsupportedSourceError(f"source {source.data_object!r} has no path")
    if source.format == "csv":
        return read_csv(spark, source.path, schema, options, malformed)
    reader = spark.read.format(source.format).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(source.path)


def inline_rows(spark: SparkSession, columns: Mapping[str, Iterable], schema=None) -> DataFrame:
    """A small DataFrame from named column lists."""
    names = list(columns)
    return spark.createDataFrame(list(zip(*columns.values(), strict=True)), schema or names)
