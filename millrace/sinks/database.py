"""Upserts into an external database, one transaction per partition, values always bound."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.readers import jdbc_options, read_table


def quote(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


_TYPES = {T.LongType: "BIGINT", T.StringType: "VARCHAR", T.TimestampType: "TIMESTAMP"}


def table_statement(
    table: str,
    schema: T.StructType,
    key: str,
    id_column: str | None = None,
    not_null: Iterable[str] = (),
    lengths: Mapping[str, int] | None = None,
    stamp_column: str | None = None,
) -> str:
    """``CREATE TABLE IF NOT EXISTS`` with the constraints that an upsert by ``key`` relies on.

    ``id_column``, or the key where there is none, is the primary key; the key is unique. The
    database fills ``stamp_column`` with the current time on insert.
    """
    columns = []
    for column in schema:
        text = f"{quote(column.name)} {_TYPES[type(column.dataType)]}"
        if column.name in (lengths or {}):
            text += f"({lengths[column.name]})"
        if column.name == (id_column or key):
            text += " PRIMARY KEY"
        elif column.name == key:
            text += " UNIQUE"
        if column.name in not_null:
            text += " NOT NULL"
        if column.name == stamp_column:
            text += " DEFAULT CURRENT_TIMESTAMP"
        columns.append(text)
    return f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(columns)})"


def run_statement(connect: Callable[[], object], statement: str) -> None:
    """Run one statement, such as a `table_statement`, from the driver."""
    connection = connect()
    try:
        connection.cursor().execute(statement)
        connection.commit()
    finally:
        connection.close()


def upsert_statement(
    table: str,
    columns: Iterable[str],
    key: str,
    update: Iterable[str],
    touch: str | None = None,
    mark: str = "%s",
    unless_equal: str | None = None,
) -> str:
    """``INSERT … ON CONFLICT (key) DO UPDATE`` with one bound parameter per column.

    ``touch`` names a timestamp column set to the database's current time on update (its default
    covers the insert). ``mark`` is the driver's parameter mark, ``%s`` or ``?``. Rows equal in
    ``unless_equal`` are left untouched.
    """
    names = list(columns)
    sets = [f"{quote(c)} = excluded.{quote(c)}" for c in update]
    if touch:
        sets.append(f"{quote(touch)} = current_timestamp")
    unchanged = ""
    if unless_equal:
        column = quote(unless_equal)
        old, new = f"{table.split('.')[-1]}.{column}", f"excluded.{column}"
        unchanged = f" WHERE {old} IS NULL OR {new} IS NULL OR {old} <> {new}"
    return (
        f"INSERT INTO {table} ({', '.join(quote(c) for c in names)}) "
        f"VALUES ({', '.join([mark] * len(names))}) "
        f"ON CONFLICT ({quote(key)}) DO UPDATE SET {', '.join(sets)}{unchanged}"
    )


def upsert_rows(
    df: DataFrame,
    connect: Callable[[], object],
    statement: str,
    columns: list[str],
    max_connections: int = 100,
    chunk: int = 1000,
) -> None:
    """Run ``statement`` for every row of ``df``, whose keys must be unique.

    ``connect`` is called in the task and returns a DB-API connection. Each partition is one
    transaction, sent ``chunk`` rows at a time; at most ``max_connections`` run at once. A task
    that is run again upserts the same rows again, which leaves the same table.
    """
    rows_only = df.select(*[F.col(f"`{c}`") for c in columns])

    def send(rows) -> None:
        values = (tuple(r) for r in rows)
        batch = list(islice(values, chunk))
        if not batch:
            return
        connection = connect()
        try:
            cursor = connection.cursor()
            while batch:
                cursor.executemany(statement, batch)
                batch = list(islice(values, chunk))
            connection.commit()
        except BaseException as e:
            try:
                connection.rollback()
            except Exception as after:
                e.add_note(f"the rollback failed too: {after}")
            raise
        finally:
            connection.close()

    rows_only.coalesce(max_connections).foreachPartition(send)  # fewer tasks than that stay as they are


PRODUCT_SINK = ["p_id", "sku", "name", "description", "request_id", "record_checksum"]
COUNT_COLUMN = "no. of products"
_IN_DATABASE = {"no_of_products": COUNT_COLUMN}  # names that differ from those of the keyed tables


def upsert_products(
    df: DataFrame,
    connect,
    table: str = "products",
    mark: str = "%s",
    max_connections: int = 100,
    unless_equal: str | None = None,
) -> None:
    """Upsert transformed products by ``sku``; an update keeps the stored ``p_id``."""
    statement = upsert_statement(
        table, PRODUCT_SINK, "sku", PRODUCT_SINK[2:], "updt_tmstmp", mark, unless_equal
    )
    upsert_rows(df, connect, statement, PRODUCT_SINK, max_connections)


def upsert_counts(
    df: DataFrame, connect, table: str = "products_agg", mark: str = "%s", max_connections: int = 100
) -> None:
    """Upsert counts by ``name`` from ``(name, count_of_names)``."""
    columns = ["name", COUNT_COLUMN]
    statement = upsert_statement(table, columns, "name", [COUNT_COLUMN], mark=mark)
    named = df.select("name", F.col("count_of_names").alias(COUNT_COLUMN))
    upsert_rows(named, connect, statement, columns, max_connections)


class DatabaseTable:
    """A products or counts table in an external database, as a target of `run_ingest`.

    ``connect`` opens a DB-API connection in a task; ``read`` returns the table as a DataFrame and
    ``read_max_id`` its greatest id. The database keeps no batch ids, so a batch that is run again
    is upserted again, which changes nothing but its timestamps.
    """

    def __init__(
        self,
        table: str,
        key: str,
        connect: Callable[[], object],
        read: Callable[[], DataFrame],
        read_max_id: Callable[[], int | None] | None = None,
        mark: str = "%s",
        max_connections: int = 100,
    ):
        self.table, self.key, self.connect, self.read = table, key, connect, read
        self.read_max_id, self.mark, self.max_connections = read_max_id, mark, max_connections

    @classmethod
    def over_jdbc(
        cls,
        spark: SparkSession,
        url: str,
        table: str,
        key: str,
        connect: Callable[[], object],
        id_column: str | None = None,
        read_partitions: int = 1,
        mark: str = "%s",
        max_connections: int = 100,
        **options: str,
    ) -> DatabaseTable:
        """Read through Spark's JDBC source, split on the id column into ``read_partitions``."""

        def greatest() -> int:
            query = f"SELECT max({quote(id_column)}) AS max_id FROM {table}"
            return read_table(spark, {"url": url, "query": query, **options}).first()["max_id"] or 0

        def read() -> DataFrame:
            if id_column is None or read_partitions == 1:
                return read_table(spark, jdbc_options(url, table, **options))
            split = jdbc_options(url, table, id_column, 0, max(greatest(), 1), read_partitions, **options)
            return read_table(spark, split)

        return cls(table, key, connect, read, greatest if id_column else None, mark, max_connections)

    def ensure(
        self, schema: T.StructType, id_column: str | None = None, not_null: Iterable[str] = (), **constraints
    ) -> None:
        """Create the table if it is missing; see `table_statement` for the constraints.

        The counts column of `COUNTS` is created under the name that `upsert_counts` writes.
        """
        named = T.StructType([T.StructField(_IN_DATABASE.get(f.name, f.name), f.dataType) for f in schema])
        filled = [_IN_DATABASE.get(name, name) for name in not_null]
        run_statement(self.connect, table_statement(self.table, named, self.key, id_column, filled, **constraints))

    def on(self, spark: SparkSession) -> DatabaseTable:
        return self

    def has_batch(self, batch_id: str) -> bool:
        return False

    def commit_empty(self, batch_id: str) -> None:
        """A batch without rows changes nothing, and the database keeps no batch ids."""

    def max_id(self) -> int:
        return (self.read_max_id() if self.read_max_id else 0) or 0

    def current(self) -> DataFrame:
        """The table, with the column names of the keyed tables."""
        return self.read().withColumnsRenamed({theirs: ours for ours, theirs in _IN_DATABASE.items()})

    def merge(self, batch: DataFrame, batch_id: str, update, stamp=None, unless_equal=None, **_) -> None:
        """Upsert a transformed batch; the database stamps the rows it touches."""
        upsert_products(batch, self.connect, self.table, self.mark, self.max_connections, unless_equal)

    def merge_counts(self, counts: DataFrame, batch_id: str, mode: str = "upsert") -> None:
        if mode != "upsert":
            raise ValueError("counts in a database are upserted, never removed")
        named = counts.withColumnRenamed("no_of_products", "count_of_names")
        upsert_counts(named, self.connect, self.table, self.mark, self.max_connections)
