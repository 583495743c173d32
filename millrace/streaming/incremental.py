"""Ingest only the files that arrived since the last run."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.plans.ingest import MALFORMED, run_ingest
from millrace.sinks.tables import KeyedTable
from millrace.staging import read_text


def read_new_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    format: str = "csv",
    files_per_batch: int | None = None,
    **options: str,
) -> DataFrame:
    """A streaming DataFrame over a folder of files.

    A stream's columns are fixed when it starts; CSV files whose header names others are an error.
    A CSV stream has a further column with the text of rows that have more or fewer fields than the
    header, null for all others, by which `ingest_new_files` rejects them.
    """
    defaults = {}
    if format == "csv":
        defaults = {"header": "true", "escape": '"', "multiLine": "true", "enforceSchema": "false"}
        schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        schema = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])
        options = {k: v for k, v in options.items() if k.lower() != "columnnameofcorruptrecord"}
        options["columnNameOfCorruptRecord"] = MALFORMED
    reader = spark.readStream.format(format).schema(schema).options(**{**defaults, **options})
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def ingest_new_files(
    stream: DataFrame,
    products: KeyedTable,
    counts: KeyedTable,
    checkpoint: str,
    *,
    rejects_path: str,
    run_date=None,
    **settings,
) -> StreamingQuery:
    """Run `run_ingest` on every micro-batch of what has arrived, then stop.

    A micro-batch may be handed over again after a failure. Its batch id is the stream's own id,
    which its checkpoint keeps, and the batch number, so several streams may feed one table; a
    table that holds the id already skips the batch. Files without rows are a batch of no rows.
    ``run_date`` is a text or a function of the batch number. The checkpoint must be on shared
    storage.
    """

    def one_batch(batch: DataFrame, number: int) -> None:
        stream_id = json.loads(read_text(batch.sparkSession, f"{checkpoint}/metadata"))["id"]
        date = run_date(number) if callable(run_date) else run_date
        run_ingest(
            batch.sparkSession,
            batch,
            products.on(batch.sparkSession),
            counts.on(batch.sparkSession),
            date,
            batch_id=f"{stream_id}-{number:010d}",
            rejects_path=rejects_path,
            allow_empty=True,
            **settings,
        )

    return (
        stream.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
