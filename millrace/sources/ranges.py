"""CSV files with fields that span lines, each file read by many tasks."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.errors import UnsupportedSourceError
from millrace.sources.readers import CSV_SETTINGS, read_csv
from millrace.staging import Staging


def _stray(delimiter: str) -> str:
    """A quote between two characters that are neither quotes, delimiters nor line ends; it opens and closes nothing."""
    other = rf'[^"\r\n\x{{{ord(delimiter):x}}}]'
    return f'{other}"{other}'


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the lines of each range, and its records by both readings.

    The lines of a range arrive in order in one task. ``inner`` says whether the lines before hold an
    odd number of quotes; ``if_outside`` and ``if_inside`` count the records begun so far, should the
    range begin outside or inside a quoted field.
    """
    at, line, inner, begun = None, 0, False, [0, 0]
    for batch in batches:
        file, start, text = (batch.column(i) for i in range(3))
        odd = np.asarray(pc.count_substring(text, '"')) % 2 == 1
        starts = np.asarray(start)
        codes = np.asarray(file.dictionary_encode().indices)
        turns = np.flatnonzero((np.diff(starts) != 0) | (np.diff(codes) != 0)) + 1
        for first, end in zip([0, *turns], [*turns, len(odd)], strict=True):
            if first == end:
                continue
            here = (file[int(first)].as_py(), int(starts[first]))
            if here != at:
                at, line, inner, begun = here, 0, False, [0, 0]
            toggles = odd[first:end]
            after = np.logical_xor(np.cumsum(toggles) % 2 == 1, inner)
            before = np.concatenate([[inner], after[:-1]])
            outside, inside = begun[0] + np.cumsum(~before), begun[1] + np.cumsum(before)
            lines = line + np.arange(end - first)
            piece = [x.slice(int(first), int(end - first)) for x in (file, start, text)]
            yield pa.RecordBatch.from_arrays(
                [*piece, pa.array(lines), pa.array(before), pa.array(toggles), pa.array(outside), pa.array(inside)],
                names=["file", "start", "text", "line", "inner", "odd", "if_outside", "if_inside"],
            )
            line, inner, begun = int(lines[-1]) + 1, bool(after[-1]), [int(outside[-1]), int(inside[-1])]


_LINES = (
    "file string, start long, text string, line long, inner boolean, odd boolean, if_outside long, if_inside long"
)


def csv_records(spark: SparkSession, path: str | list[str], staging: Staging) -> DataFrame:
    """The records of CSV files as ``(file, start, record, text)``, found over byte ranges of each file.

    Quotes stand as RFC 4180 has it: around whole fields, and doubled within. Then a line break ends a
    record where the quotes before it are even in number. Spark splits the files into ranges of whole
    lines. Each range numbers its records by both readings, from outside and from inside a field, in
    one pass that is written once. The number of quotes in all ranges before says which reading holds:
    one row for each range, summed along its file. Only lines of records that span lines are brought
    together; all others are records as they stand and move nowhere. A record that spans ranges is put
    together in one task, as a record is one value. ``start`` and ``record`` are the range that a
    record begins in and its number there, from 1, blank lines included.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    meta = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")]
    staged = staging.write(lines.select(*meta, F.col("value").alias("text")).mapInArrow(_numbered, _LINES), "lines")

    ranges = staged.groupBy("file", "start").agg(
        (F.count_if("odd") % 2).alias("odd"), F.max("if_outside").alias("if_outside"), F.max("if_inside").alias("if_inside")
    )
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranges.withColumn("inside", F.coalesce(F.sum("odd").over(earlier) % 2, F.lit(0)) == 1)
    records = F.when(F.col("inside"), F.col("if_inside")).otherwise(F.col("if_outside"))
    # The record that is open where a range begins is the last one begun in a range before.
    last = F.last(F.when(records > 0, F.struct(F.col("start").alias("at"), records.alias("record"))), True).over(earlier)
    opened = placed.withColumn("open", last).filter("inside").select("file", "start", "open")

    known = staged.join(staging.write(opened, "ranges-inside"), ["file", "start"], "left")
    inside = F.col("open").isNotNull()
    known = known.select(
        "file",
        "start",
        "line",
        "text",
        (inside != F.col("inner")).alias("begins_inside"),
        "odd",
        F.when(inside, F.col("if_inside")).otherwise(F.col("if_outside")).alias("record"),
        "open",
    )
    whole = ~F.col("begins_inside") & ~F.col("odd")
    single = known.filter(whole).select("file", "start", "record", "text")
    carried = F.col("record") == 0
    parts = known.filter(~whole).select(
        "file",
        F.when(carried, F.col("open.at")).otherwise(F.col("start")).alias("begin"),
        F.when(carried, F.col("open.record")).otherwise(F.col("record")).alias("record"),
        F.struct("start", "line", "text").alias("part"),
    )
    ordered = F.transform(F.array_sort(F.collect_list("part")), lambda x: x["text"])
    joined = parts.groupBy("file", F.col("begin").alias("start"), "record").agg(F.array_join(ordered, "\n").alias("text"))
    return single.unionByName(joined)


def read_csv_by_ranges(
    spark: SparkSession,
    path: str | list[str],
    staging: Staging,
    schema: T.StructType | str | None = None,
    options: Mapping[str, str] | None = None,
    malformed: str | None = None,
) -> DataFrame:
    """What `read_csv` returns, from files of any size by as many tasks as they have byte ranges.

    Fields may span lines and ranges; see `csv_records` for how. One rule holds at every size. The
    header, the names, ``schema`` and ``malformed`` are as in `read_csv`. The files are UTF-8 and not
    compressed by a codec that cannot be split, their quote and escape characters are ``"``, and
    lines end with ``\\n`` or ``\\r\\n``, as the first line of the file does; ``\\r\\n`` is read as ``\\n`` then,
    in fields too, but for ``malformed``. Blank lines are passed over. A quote within an unquoted field is an error where
    other text stands on both sides of it; say ``read_csv`` for such files. A quote that is
    never closed makes the rest of its file one record, as it does there, without the file's last line break.
    """
    given = {name.lower(): value for name, value in (options or {}).items()}
    fixed = {"quote": '"', "escape": '"', "header": "true", "multiline": "true"}
    other = {n: v for n, v in given.items() if n in fixed and v.lower() != fixed[n]}
    if other or given.get("encoding", given.get("charset", "utf-8")).lower() != "utf-8" or "linesep" in given:
        raise UnsupportedSourceError(f"files with these options cannot be read by ranges: {options}")
    settings = {**CSV_SETTINGS, **given}
    delimiter = settings.get("sep", settings["delimiter"])
    if len(delimiter) != 1:
        raise UnsupportedSourceError(f"a delimiter of one character is needed, not {delimiter!r}")
    # As in `read_csv`, names come from the header, and a schema is checked against it.
    shape = read_csv(spark, path, schema, options).schema
    if malformed:
        settings["columnnameofcorruptrecord"] = malformed
    full = T.StructType([*shape.fields, *([T.StructField(malformed, T.StringType())] if malformed else [])])

    records = csv_records(spark, path, staging)
    stray = F.raise_error(F.concat(F.lit("a quote within an unquoted field in "), F.col("file"))).cast("string")

    # The first record of each file, past blank lines: a task sends at most one row for each file it reads.
    place = F.struct("start", "record")
    filled = ~F.col("text").isin("", "\r")
    heads = records.groupBy("file").agg(
        F.min(F.when(filled, place)).alias("place"),
        F.min_by("text", F.when(filled, place)).alias("text"),
        F.min_by(F.regexp_substr("text", F.lit(r"\r?\n|\r$")), place).alias("break"),
    )
    heads = heads.filter("place is not null").withColumn("text", F.regexp_replace("text", r"\r$", ""))
    names = F.from_csv("text", ", ".join(f"c{i} string" for i in range(len(shape))), _parser({**settings, "mode": "PERMISSIVE"}))
    expected = F.array(*[F.lit(name) for name in shape.names])
    found = F.array(*[names[f"c{i}"] for i in range(len(shape))])
    same = found == expected
    if spark.conf.get("spark.sql.caseSensitive") != "true":
        same = F.transform(found, F.lower) == F.transform(expected, F.lower)
    wrong = F.raise_error(F.concat(F.lit("another header in "), F.col("file"))).cast("long")
    starts = heads.select(
        "file",
        F.when(same, F.col("place.start")).otherwise(wrong).alias("head"),
        F.col("place.record").alias("head_record"),
        F.coalesce(F.startswith("break", F.lit("\r")), F.lit(False)).alias("returns"),
    )
    body = records.filter(filled).join(staging.write(starts, "headers"), "file")
    body = body.filter((F.col("start") != F.col("head")) | (F.col("record") != F.col("head_record")))
    body = body.withColumn("raw", F.when(F.col("returns"), F.regexp_replace("text", r"\r$", "")).otherwise(F.col("text")))
    body = body.withColumn("text", F.when(F.col("returns"), F.replace("raw", F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("raw")))
    body = body.withColumn("text", F.when(F.col("text").rlike(_stray(delimiter)), stray).otherwise(F.col("text")))
    row = F.from_csv("text", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full), _parser(settings))
    read = body.select(row.alias("row"), "raw")
    fields = {f.name: F.col(f"row.`{f.name}`") for f in full}
    if malformed:  # as it stands in the file
        fields[malformed] = F.when(fields[malformed].isNotNull(), F.col("raw"))
    return read.select(*[value.alias(name) for name, value in fields.items()])


def _parser(settings: Mapping[str, str]) -> dict[str, str]:
    """The settings that concern one record; those of whole files are dealt with already."""
    return {name: value for name, value in settings.items() if name not in ("header", "enforceschema")}
