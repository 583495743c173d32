"""The ingest job as a command: ``spark-submit job.py --config products.yaml --target /lake``.

The config is YAML or JSON with a list of ``sources``; each is one batch of the run, in the order
given. The session is whatever ``spark-submit`` sets up.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Mapping, Sequence
from datetime import UTC, datetime

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from millrace.plans import BatchLog, run_ingest
from millrace.sinks import COUNTS, PRODUCTS, KeyedTable
from millrace.sources import parse_sources


def read_config(path: str) -> Mapping:
    """A config file on the driver's file system, YAML where PyYAML is installed, or JSON."""
    with open(path, encoding="utf-8") as file:
        text = file.read()
    if path.endswith(".json"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("reading a YAML config needs PyYAML; use JSON instead") from e
    return yaml.safe_load(text)


def open_tables(
    spark: SparkSession, target: str, buckets: int, further: str | None = None, **settings
) -> tuple[KeyedTable, KeyedTable]:
    """The products and their counts below ``target``, which one log commits together.

    ``further`` has columns that the products keep beside their own, as DDL, such as a version.
    """
    settings["log"] = f"{target}/commits"
    more = T.StructType.fromDDL(further).fields if further else []
    schema = T.StructType([*PRODUCTS.fields, *more])
    products = KeyedTable(spark, f"{target}/products", schema, "sku", buckets, "p_id", **settings)
    return products, KeyedTable(spark, f"{target}/products_agg", COUNTS, "name", buckets, **settings)


def run_sources(
    spark: SparkSession,
    config: Mapping,
    target: str,
    *,
    buckets: int,
    run_date: str | None = None,
    only: str | None = None,
    **settings,
) -> list[BatchLog]:
    """Ingest every source of a config (or ``only`` the one named) into the tables below ``target``.

    Columns of a CSV source are named by its header; all of them take part in the checksum. Every
    source is a batch of its own, named by the run date and its data object, so two sources of one
    data object are an error.
    """
    run_date = run_date or datetime.now(UTC).isoformat(timespec="seconds")
    products, counts = open_tables(spark, target, buckets)
    sources = [s for s in parse_sources(config) if only is None or s.data_object == only]
    if not sources:
        raise ValueError(f"the config has no source {only!r}" if only else "the config has no sources")
    names = [s.data_object for s in sources]
    if repeated := sorted({n for n in names if names.count(n) > 1}):
        raise ValueError(f"the config has several sources of {', '.join(repeated)}")
    return [
        run_ingest(
            spark,
            source,
            products,
            counts,
            run_date,
            batch_id=f"{run_date} {source.data_object}",
            rejects_path=f"{target}/rejects",
            audit_path=f"{target}/audit",
            data_object=source.data_object,
            **settings,
        )
        for source in sources
    ]


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="millrace")
    parser.add_argument("--config", required=True, help="YAML or JSON file with a list of sources")
    parser.add_argument("--target", required=True, help="shared folder of the target tables")
    parser.add_argument("--source", help="ingest only the source with this data object")
    parser.add_argument("--job_run_date", help="ISO date and time of the run; now if left out")
    parser.add_argument("--buckets", type=int, required=True, help="hash buckets of each target table")
    given = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("millrace").getOrCreate()
    run_sources(
        spark,
        read_config(given.config),
        given.target,
        buckets=given.buckets,
        run_date=given.job_run_date,
        only=given.source,
    )


if __name__ == "__main__":
    main()
