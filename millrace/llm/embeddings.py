"""Near-duplicate vectors by int8 tile products with error bounds and an exact second look."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.graphs import components
from millrace.staging import Staging

TILE_BYTES = 8 << 20  # of the vectors on each side of a tile, as doubles
_STRIP = 256  # rows of a tile that are multiplied at a time
_EXACT = 1024  # dimensions whose int8 products add up exactly in single precision
_OUT = pa.schema([("cls", pa.int64()), ("other", pa.int64()), ("links", pa.int64())])


class Quantised:
    """Unit vectors as int8 multiples of a scale of their own, with the norm of what that leaves out.

    With u = scale * codes + e and |e| <= error, the true cosine of u and v differs from the
    product of the codes, scaled, by at most error_u + (1 + error_u) * error_v.
    """

    def __init__(self, vectors: np.ndarray):
        # Scaled by the largest component first, so neither very large nor very small ones lose their squares.
        self.unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
        self.unit /= np.linalg.norm(self.unit, axis=1, keepdims=True)
        self.scale = np.abs(self.unit).max(axis=1) / 127
        codes = np.rint(self.unit / self.scale[:, None])
        self.error = np.linalg.norm(self.unit - codes * self.scale[:, None], axis=1) * (1 + 1e-9) + 1e-12
        self.codes = codes.astype(np.int8)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of int8 rows: single precision holds the sums of a slice exactly."""
    total = 0.0
    for at in range(0, a.shape[1], _EXACT):
        part = a[:, at : at + _EXACT].astype(np.float32) @ b[:, at : at + _EXACT].astype(np.float32).T
        total = part if a.shape[1] <= _EXACT else total + part.astype(np.float64)
    return total


def _strip_links(a: Quantised, rows: slice, b: Quantised, threshold: float) -> np.ndarray:
    """Which pairs of some rows of ``a`` with ``b`` reach the threshold in double precision."""
    least = threshold - 1e-6 - a.error[rows] - (1 + a.error[rows]) * b.error.max()
    bound = (least / a.scale[rows])[:, None] / b.scale[None, :]
    maybe = _products(a.codes[rows], b.codes) >= bound
    some_rows, some_columns = np.flatnonzero(maybe.any(axis=1)), np.flatnonzero(maybe.any(axis=0))
    found = np.zeros(maybe.shape, bool)
    if not len(some_rows):
        return found
    one, two = np.nonzero(maybe)
    if len(one) * 8 < len(some_rows) * len(some_columns):
        exact = np.einsum("ij,ij->i", a.unit[rows][one], b.unit[two])
        found[one, two] = exact >= threshold
    else:
        corner = np.ix_(some_rows, some_columns)
        found[corner] = maybe[corner] & (a.unit[rows][some_rows] @ b.unit[some_columns].T >= threshold)
    return found


class _Forest:
    """Edges that connect what the links of a tile connect, at most one for each vector."""

    def __init__(self, n: int):
        self.parent = np.arange(n)
        self.edges: list[tuple[int, int]] = []

    def _find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = int(self.parent[x])
        return x

    def _roots(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if (up == self.parent).all():
                return up
            self.parent = up

    def add(self, links: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> None:
        while links.any():
            roots = self._roots()
            open_ = links & (roots[rows][:, None] != roots[columns][None, :])
            by_column, by_row = np.flatnonzero(open_.any(axis=0)), np.flatnonzero(open_.any(axis=1))
            if not len(by_row):
                return
            pairs = list(zip(rows[open_[:, by_column].argmax(axis=0)].tolist(), columns[by_column].tolist(), strict=True))
            pairs += zip(rows[by_row].tolist(), columns[open_[by_row].argmax(axis=1)].tolist(), strict=True)
            for x, y in pairs:
                one, two = self._find(x), self._find(y)
                if one != two:
                    self.parent[max(one, two)] = min(one, two)
                    self.edges.append((x, y))


def _tile(table: pa.Table, threshold: float) -> pa.Table:
    """Links between the two sides of a tile: counts for each vector, and a forest of edges."""
    low, high = table["low"][0].as_py(), table["high"][0].as_py()
    block = table["block"].to_numpy()
    flat = table["embedding"].combine_chunks()
    vectors = flat.values.to_numpy(zero_copy_only=False).astype(np.float64)[flat.offsets[0].as_py() :]
    vectors = vectors[: len(flat) * table["dims"][0].as_py()].reshape(len(flat), -1)
    cls, weight = table["cls"].to_numpy(), table["copies"].to_numpy()
    one, two = np.flatnonzero(block == low), np.flatnonzero(block == high)
    counts, forest = np.zeros(len(cls), np.int64), _Forest(len(cls))
    if len(one) and len(two):
        a = Quantised(vectors[one])
        b = a if low == high else Quantised(vectors[two])
        for at in range(0, len(one), _STRIP):
            rows = slice(at, min(at + _STRIP, len(one)))
            links = _strip_links(a, rows, b, threshold)
            if low == high:
                links[np.arange(rows.stop - at), np.arange(at, rows.stop)] = False
            some_rows, some = np.flatnonzero(links.any(axis=1)), np.flatnonzero(links.any(axis=0))
            links = links[np.ix_(some_rows, some)]
            counts[one[rows][some_rows]] += links @ weight[two[some]]
            if low != high:
                counts[two[some]] += links.T @ weight[one[rows][some_rows]]
            forest.add(links, one[rows][some_rows], two[some])
    met = np.flatnonzero(counts)
    edges = np.array(forest.edges, np.int64).reshape(-1, 2)
    return pa.table(
        {
            "cls": np.concatenate([cls[met], cls[edges[:, 0]]]),
            "other": pa.concat_arrays([pa.nulls(len(met), pa.int64()), pa.array(cls[edges[:, 1]])]),
            "links": np.concatenate([counts[met], np.zeros(len(edges), np.int64)]),
        },
        schema=_OUT,
    )


def link_vectors(
    vectors: DataFrame,
    staging: Staging,
    *,
    id: str = "vec_id",
    embedding: str = "embedding",
    threshold: float = 0.95,
    tile: int | None = None,
) -> DataFrame:
    """Every vector's number of near duplicates and the connected group it belongs to.

    Identical vectors are folded into one class first. The classes are spread over blocks of
    about ``tile`` (by default as many as fit `TILE_BYTES`), and each pair of blocks is one tile of the product, whose two sides are
    all a task holds. Int8 products with the error bound of `Quantised` rule out most pairs; the
    rest are computed in double precision. A tile gives each vector's count of links and a forest
    that connects what its links connect, so a group of any size leaves it as one edge for each
    vector, never as all its pairs.

    Returns ``vec_id``, ``n_links`` (other rows with a cosine of ``threshold`` or more),
    ``component_id`` (least vec_id reachable) and ``kept`` (it is the row's own). Null, empty and
    zero vectors and those with null or non-finite components link with nothing, nor do vectors of
    different lengths. Components may be of any size that a double holds. A cosine of exactly the
    threshold links. Rows with equal ids are vectors of their own. A null vec_id stays null,
    loses to any other as component_id, and is kept only if its whole group has null ids. An empty
    table gives an empty result; other columns are ignored, whatever their names.
    """
    value = F.col(f"`{embedding}`").cast("array<double>")
    plain = vectors.select(F.col(f"`{id}`").cast("long").alias("vec_id"), value.alias("embedding")).withColumn(
        "good",
        F.coalesce(
            F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists("embedding", lambda x: x != 0),
            F.lit(False),
        ),
    )
    classes = (
        plain.filter("good")
        .groupBy("embedding")
        .agg(F.count("*").alias("copies"), F.min("vec_id").alias("first_id"))
        .select(F.monotonically_increasing_id().alias("cls"), "*", F.size("embedding").alias("dims"))
    )
    classes = staging.write(classes, "classes")
    size = classes.agg(F.count("*").alias("n"), F.coalesce(F.max("dims"), F.lit(1)).alias("dims")).first()
    tile = tile or max(256, TILE_BYTES // (8 * size["dims"]))
    blocks = max(1, -(-size["n"] // tile))
    block = F.pmod(F.xxhash64("cls"), F.lit(blocks))
    tiled = (
        classes.withColumn("block", block)
        .withColumn("partner", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        .select(
            "cls",
            "copies",
            "dims",
            "block",
            "embedding",
            F.least("block", "partner").alias("low"),
            F.greatest("block", "partner").alias("high"),
        )
    )
    found = tiled.groupBy("low", "high", "dims").applyInArrow(
        lambda table: _tile(table, threshold), "cls long, other long, links long"
    )
    found = staging.write(found, "links")
    groups = components(
        found.filter("other is not null").select(F.col("cls").alias("a"), F.col("other").alias("b")), staging
    )
    counts = found.groupBy("cls").agg(F.sum("links").alias("links"))
    joined = (
        classes.join(counts, "cls", "left")
        .join(groups.withColumnRenamed("node", "cls"), "cls", "left")
        .withColumn("component", F.coalesce("component", "cls"))
    )
    least = joined.groupBy("component").agg(F.min("first_id").alias("component_id"))
    known = joined.join(least, "component").select(
        "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    linked = plain.filter("good").join(known, "embedding").select("vec_id", "n_links", "component_id")
    alone = plain.filter("not good").select("vec_id", F.lit(0).cast("long"), "vec_id")
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
