"""The corpus pipeline: stages that each apply one operator to all documents its predecessor kept.

Stages take documents with the columns ``doc_id``, ``text`` and ``source`` and any others, whatever their
names. Null ids and texts, empty and very long texts, repeated rows and empty tables are taken as each
operator's docstring says.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from millrace.llm.bpe import encode_texts, read_ranks
from millrace.llm.lines import drop_frequent_lines
from millrace.llm.minhash import link_documents, text_mark
from millrace.llm.mixing import in_mixed_order, mix_sources
from millrace.llm.quality_rules import judge_quality
from millrace.staging import Staging


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed rules keep; repeated rows are judged alike."""
    return judge_quality(docs, Staging(spark), carry=True).filter("kept").select("doc.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that five or more ids hold, except in the largest of them.

    ``n_chars``, where there is such a column, follows the text that is left.
    """
    rest = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    out = drop_frequent_lines(docs, Staging(spark), carry=rest)
    columns = {c: F.col("rest")[c] for c in rest} | {"doc_id": F.col("doc_id"), "text": F.col("text")}
    if "n_chars" in rest:
        left = F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("rest")["n_chars"])
        columns["n_chars"] = left.cast(docs.schema["n_chars"].dataType)
    return out.select(*[columns[c].alias(c) for c in docs.columns])


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group whose five-word shingles overlap by 0.8 or more: the least doc_id's.

    Null ids are the last, and of different texts under one id the least by their digest is kept. Of
    exact repeats of a row, with the same id and text, one stays. Documents without words are alone,
    so of those only repeats of one id go.
    """
    linked = link_documents(docs, Staging(spark), shingle=5, percent=80, marks=True).filter("chosen")
    keys = ["no_id", "id", "no_text", "mark"]

    def keyed(id, mark):
        return [
            id.isNull().alias("no_id"),
            F.coalesce(id, F.lit(0)).alias("id"),
            mark.isNull().alias("no_text"),
            F.coalesce(mark, F.lit(b"")).alias("mark"),
        ]

    chosen = linked.select(*keyed(F.col("doc_id"), F.col("mark"))).distinct()
    rows = docs.select(F.struct("*").alias("doc"), *keyed(F.col("doc_id").cast("long"), text_mark(F.col("text"))))
    # Repeats fold in their tasks before they move, and the join finds the rows where the fold put them.
    single = rows.groupBy(*keys).agg(F.first("doc").alias("doc"))
    return single.join(chosen, keys, "left_semi").select("doc.*")


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mixture, each source at the square root of its size."""
    mixed = mix_sources(docs, Staging(spark), power=0.5, columns=tuple(docs.columns))
    return in_mixed_order(mixed).select("doc.*")


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and digests of the ids and of the text they decode to.

    ``part`` and ``place`` are the file and the row of the mixed documents: in order of these two, the
    result follows the mixture, however Spark splits and packs the files that it reads.
    """
    tokens = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    out = encode_texts(docs, tokens, public_tokenizers.PATTERN, decode=True, also=_place(docs))
    return out.select(
        "doc_id",
        "n_tokens",
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "part",
        "place",
    )


def _place(docs: DataFrame) -> dict:
    """The number in a row's file name, and its place in the file; in the plan, where no files are read."""
    try:
        docs.select("_metadata.file_name", "_metadata.row_index")
    except AnalysisException:
        return {"part": F.lit(0).cast("long"), "place": F.monotonically_increasing_id()}
    number = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1)
    return {"part": F.coalesce(number.try_cast("long"), F.lit(0).cast("long")), "place": F.col("_metadata.row_index")}


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", minhash_near_dedup),
    ("source mixing", source_mixing),
    ("byte-level BPE", byte_bpe),
]

#: The near-duplicate groups and the tokens are beyond SQL; a test compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``, each one's result written and read again."""
    docs, staging = spark.read.parquet(f"{sf_dir}/documents.parquet"), Staging(spark)
    for name, stage in STAGES:
        docs = staging.write(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
