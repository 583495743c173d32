"""Written intermediate tables in the folder the cluster shares.

A staged table is an ordinary parquet folder. It cuts lineage, so a lost executor costs a
re-read rather than a recompute, and it fixes values (partition numbers, row positions) that a
recompute could change.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``, or a folder in its warehouse where that is unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return (configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/staging").rstrip("/")


def files_of(spark: SparkSession, path: str):
    """Hadoop's file system for a path, and the path as it takes it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def path_exists(spark: SparkSession, path: str) -> bool:
    files, folder = files_of(spark, path)
    return files.exists(folder)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; empty if there is none."""
    files, folder = files_of(spark, path)
    return [f.getPath().getName() for f in files.listStatus(folder)] if files.exists(folder) else []


def delete_path(spark: SparkSession, path: str) -> None:
    files, folder = files_of(spark, path)
    files.delete(folder, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    files, file = files_of(spark, path)
    stream = files.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole or not at all; false if it exists.

    The text goes to a file of a new name, which is then renamed without overwriting, so a writer
    that dies leaves no half file behind and only one of two writers succeeds.
    """
    jvm = spark._jvm
    files, file = files_of(spark, path)
    files.mkdirs(file.getParent())
    new = jvm.org.apache.hadoop.fs.Path(file.getParent(), f"_{file.getName()}.{uuid.uuid4().hex}")
    stream = files.create(new, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(new, file, no_options)
    except Exception:
        files.delete(new, False)
        if files.exists(file):
            return False
        raise
    return True


def local_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A DataFrame of a few rows of metadata."""
    names = [f"c{i}" for i in range(len(schema))]
    kinds = [T.StringType() if isinstance(f.dataType, T.TimestampType) else f.dataType for f in schema]
    values = [
        {n: v.isoformat() if isinstance(v, datetime) else v for n, v in zip(names, row, strict=True)} for row in rows
    ]
    shape = ", ".join(f"{n}: {kind.simpleString()}" for n, kind in zip(names, kinds, strict=True))
    made = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(values)), f"array<struct<{shape}>>")))
    return made.select(*[F.col(n).cast(f.dataType).alias(f.name) for n, f in zip(names, schema, strict=True)])


class Staging:
    """One run's private folder of staged tables, below the application's in the shared folder."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        run = f"millrace-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
        self.root = f"{(root or shared_folder(spark)).rstrip('/')}/{run}"
        self._paths: list[tuple[DataFrame, str]] = []

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def new_name(self, stem: str) -> str:
        return f"{stem}-{uuid.uuid4().hex[:12]}"

    def write(self, df: DataFrame, stem: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Write ``df`` once and return the table read back with the same schema."""
        path = self.path(self.new_name(stem))
        df.write.partitionBy(*partition_by).option("compression", "zstd").parquet(path)
        staged = self.spark.read.schema(df.schema).parquet(path)
        self._paths.append((staged, path))
        return staged

    def remove(self, *tables: DataFrame) -> None:
        """Delete staged tables that nothing reads any more."""
        for table in tables:
            for staged, path in self._paths:
                if staged is table:
                    delete_path(self.spark, path)
        self._paths = [x for x in self._paths if not any(x[0] is t for t in tables)]

    def clear(self) -> None:
        """Delete this run's folder; only call it when no DataFrame still reads from it."""
        delete_path(self.spark, self.root)


def clear_staged(spark: SparkSession) -> None:
    """Delete all that this application staged in the shared folder, when nothing reads it any more."""
    delete_path(spark, f"{shared_folder(spark)}/millrace-{spark.sparkContext.applicationId}")
