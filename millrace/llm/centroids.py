"""Exact centroid clustering of integer vectors; Ptolemaic pivots rule out most centroids."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.vectors import is_finite, list_column, rows_of
from millrace.staging import Staging

PIVOTS = 6  # vectors of which every pair gives a bound
FOLDS = 64  # partial sums of a cluster are folded in so many groups, and the driver adds those up
_BLOCK = 4096  # vectors compared at a time
_LONG = (1 << 63) - 1
_ROUNDING = 1e-15  # more than the relative error of any step of a bound


def _room(dims: int) -> int:
    """Components up to this size have squared distances, and sums over a block, that fit 64 bits."""
    return isqrt((1 << 62) // max(1, dims)) // 2


def _exact(x: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Squared distances of integer rows to integer rows, or to one."""
    apart = x - centroid
    return (apart * apart).sum(axis=1)


@dataclass
class Pivots:
    """Fixed vectors, pairs of them, and the distance between the two of each pair.

    By Ptolemy's inequality the distance of x and c is at least
    ``|d(x,p) d(c,s) - d(x,s) d(c,p)| / d(p,s)`` for any two pivots p and s.
    """

    at: np.ndarray
    pairs: list[tuple[int, int, float]]

    @classmethod
    def spread(cls, start: np.ndarray, most: int) -> Pivots:
        """Up to ``most`` different vectors of ``start``, each far from those before it."""
        chosen = [0] if len(start) else []
        while chosen and len(chosen) < most:
            near = np.min([_exact(start, start[i]) for i in chosen], axis=0)
            if not near.max():
                break
            chosen.append(int(near.argmax()))
        at = start[chosen]
        apart = [(p, s, float(np.sqrt(float(_exact(at[p : p + 1], at[s])[0])))) for p, s in combinations(range(len(at)), 2)]
        return cls(at, apart)

    def distances(self, x: np.ndarray) -> np.ndarray:
        columns = [np.sqrt(_exact(x, p).astype(np.float64)) for p in self.at]
        return np.stack(columns, axis=1) if columns else np.zeros((len(x), 0))

    def bounds(self, x_far: np.ndarray, c_far: np.ndarray) -> np.ndarray:
        """For each vector and centroid a number that their true distance is not below."""
        least = np.zeros((len(x_far), len(c_far)))
        for p, s, apart in self.pairs:
            one = x_far[:, p, None] * c_far[None, :, s]
            two = x_far[:, s, None] * c_far[None, :, p]
            bound = np.abs(one - two) - _ROUNDING * (one + two)
            np.maximum(least, bound * ((1 - _ROUNDING) / apart), out=least)
        return least


def nearest(x: np.ndarray, x_far: np.ndarray, centroids: np.ndarray, pivots: Pivots) -> tuple[np.ndarray, np.ndarray, int]:
    """Each row's nearest centroid (ties: the smaller number), its squared distance, and how many were computed.

    The centroid with the least bound is computed first; of the others only those whose bound does
    not exceed what is found by then.
    """
    bound = pivots.bounds(x_far, pivots.distances(centroids))
    who = bound.argmin(axis=1)
    best = _exact(x, centroids[who])
    first, least, computed = who.copy(), bound * bound * (1 - 4 * _ROUNDING), len(x)
    for c in range(len(centroids)):
        rows = np.flatnonzero((first != c) & (least[:, c] <= best))
        if len(rows):
            found = _exact(x[rows], centroids[c])
            better = (found < best[rows]) | ((found == best[rows]) & (c < who[rows]))
            best[rows[better]], who[rows[better]] = found[better], c
            computed += len(rows)
    return who, best, computed


def _nearest_of_any_size(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for values beyond 64-bit arithmetic, in whole numbers of Python."""
    all_ = np.stack([_exact(x, c) for c in centroids])
    who = np.array([min(range(len(centroids)), key=column.__getitem__) for column in all_.T], np.int64)
    return who, all_[who, np.arange(len(x))]


def _assigned(x: np.ndarray, far: np.ndarray, centroids: np.ndarray, pivots: Pivots | None):
    """(rows, cluster, squared distance) of each block of whole-number rows given as doubles."""
    room = _room(x.shape[1])
    for at in range(0, len(x), _BLOCK):
        own = x[at : at + _BLOCK]
        if pivots is not None and np.abs(own).max(initial=0) <= room:
            own = own.astype(np.int64)
            yield own, *nearest(own, far[at : at + _BLOCK], centroids, pivots)[:2]
        else:
            own = _whole(own)
            yield own, *_nearest_of_any_size(own, centroids.astype(object))


def _whole(x: np.ndarray) -> np.ndarray:
    """Doubles without fraction as Python's whole numbers."""
    out = np.empty(x.shape, object)
    out[...] = [[int(v) for v in row] for row in x.tolist()]
    return out


def _fits(values: np.ndarray, dims: int) -> bool:
    return all(abs(int(v)) <= _room(dims) for v in values.ravel())


def _sums(vectors: DataFrame, centroids: np.ndarray, pivots: Pivots | None) -> list[tuple[int, list[int]]]:
    """Each cluster's number of vectors and componentwise sums under the nearest centroid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [0] * len(centroids)
        sums = [np.zeros(centroids.shape[1], object) for _ in centroids]
        for batch in batches:
            for x, who, _ in _assigned(rows_of(batch.column(0)), rows_of(batch.column(1)), centroids, pivots):
                for c in np.unique(who):
                    own = x[who == c]
                    counts[c] += len(own)
                    sums[c] = sums[c] + own.sum(axis=0).astype(object)
        fold = TaskContext.get().partitionId() % FOLDS
        met = [c for c, n in enumerate(counts) if n]
        text = [json.dumps([int(v) for v in sums[c]]) for c in met]
        yield pa.RecordBatch.from_arrays(
            [pa.array(met, pa.int32()), pa.array([fold] * len(met), pa.int32()), pa.array([counts[c] for c in met], pa.int64()), pa.array(text, pa.string())],
            ["cluster", "fold", "n", "sums"],
        )

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = [sum(column) for column in zip(*map(json.loads, frame["sums"]), strict=True)]
        return pd.DataFrame({"cluster": frame["cluster"][:1], "n": [int(frame["n"].sum())], "sums": [json.dumps(total)]})

    partial = vectors.select("x", "far").mapInArrow(run, "cluster int, fold int, n long, sums string")
    folded = partial.groupBy("cluster", "fold").applyInPandas(add, "cluster int, n long, sums string")
    out = [(0, [0] * centroids.shape[1]) for _ in centroids]
    for row in folded.collect():  # at most FOLDS rows for each centroid
        n, sums = out[row["cluster"]]
        out[row["cluster"]] = (n + row["n"], [a + b for a, b in zip(sums, json.loads(row["sums"]), strict=True)])
    return out


def cluster_vectors(
    vectors: DataFrame,
    staging: Staging,
    *,
    id: str = "vec_id",
    embedding: str = "embedding",
    dims: int = 64,
    scale: int = 64,
    clusters: int = 16,
    rounds: int = 3,
    pivots: int = PIVOTS,
) -> DataFrame:
    """Cluster vectors around ``clusters`` centroids by exact rounds of whole-number means.

    A vector of ``dims`` components becomes the whole numbers ``floor(scale * x)``. The first
    centroids are the vectors whose id has the least sha256 of ``1:<id>``, in that order. A round
    assigns each vector to its nearest centroid, ties to the smaller number, and replaces the
    centroid of every cluster that has vectors by ``floor(sum / count)``; then vectors are assigned once more.

    Every vector's distances to a few fixed pivots, spread among the first centroids, are staged
    with it once. In each round Ptolemy's inequality over pairs of pivots bounds the distance to
    every centroid from below, rounded down; only centroids whose bound does not exceed the best
    distance found are computed, in 64-bit whole numbers. A block of vectors, or centroids, too
    large for these are compared with every centroid in whole numbers of any size.

    Only the first centroids and a bounded number of partial sums reach the driver; a cluster that
    holds most vectors is one partial sum of each task.

    Returns ``vec_id``, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia`` (sums
    of distances over the cluster and over all) and ``centroid_sha256`` (of the final centroid's
    components joined by commas). Vectors that are null, of another length, or hold null or
    non-finite components (also after scaling) are left out. Repeated rows and ids are vectors of
    their own; of equal hashes the least vector comes first, and null ids only make a first
    centroid where there are too few others. With fewer vectors there are fewer centroids; an
    empty table gives an empty result. Distances and sums that exceed 64 bits are null. Other
    columns are ignored, whatever their names.
    """
    value = F.transform(F.col(f"`{embedding}`").cast("array<double>"), lambda c: F.lit(float(scale)) * c)
    scaled = vectors.select(F.col(f"`{id}`").cast("long").alias("vec_id"), value.alias("x"))
    kept = scaled.filter((F.size("x") == dims) & is_finite(F.col("x")))
    hashed = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    first = kept.orderBy(hashed.asc_nulls_last(), "x").limit(clusters).select("x").collect()
    if not first:
        empty = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return vectors.sparkSession.createDataFrame([], empty)
    start = _whole(np.floor(np.array([r["x"] for r in first])))
    model = Pivots.spread(start.astype(np.int64), pivots) if _fits(start, dims) else None

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.floor(rows_of(batch.column(1)))
            far = np.zeros((len(x), len(model.at) if model else 0))
            if model:
                usable = np.abs(x).max(axis=1, initial=0) <= _room(dims)
                far[usable] = model.distances(x[usable].astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), list_column(x), list_column(far)], ["vec_id", "x", "far"])

    staged = staging.write(kept.mapInArrow(prepare, "vec_id long, x array<double>, far array<double>"), "vectors")
    centroids = start
    for _ in range(rounds):
        now, usable = _model(centroids, model)
        sums = _sums(staged, now, usable)
        centroids = np.array([[s // n for s in total] if n else list(old) for (n, total), old in zip(sums, centroids, strict=True)], object)
    now, usable = _model(centroids, model)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_assigned(rows_of(batch.column(1)), rows_of(batch.column(2)), now, usable))
            who = np.concatenate([w for _, w, _ in found]) if found else np.zeros(0)
            squares = [int(d) if d <= _LONG else None for _, _, own in found for d in own]
            columns = [batch.column(0), pa.array(who.astype(np.int32)), pa.array(squares, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    assigned = staging.write(staged.mapInArrow(assign, "vec_id long, cluster int, distance long"), "assigned")
    totals = assigned.groupBy("cluster").agg(_total("distance").alias("cluster_inertia"), F.count_if(F.col("distance").isNull()).alias("gaps"))
    totals = totals.collect()  # one row for each centroid
    whole = sum(int(r["cluster_inertia"] or 0) for r in totals)
    if any(r["gaps"] for r in totals):
        whole = None
    rows = [
        (r["cluster"], _as_long(None if r["gaps"] else int(r["cluster_inertia"])), _as_long(whole), _digest(centroids[r["cluster"]]))
        for r in totals
    ]
    table = vectors.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    joined = assigned.join(F.broadcast(table), "cluster")  # a row for each centroid
    return joined.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _model(centroids: np.ndarray, pivots: Pivots | None) -> tuple[np.ndarray, Pivots | None]:
    """The centroids as 64-bit numbers and the pivots, or as they are and none where they are too large."""
    if pivots is None or not _fits(centroids, centroids.shape[1]):
        return centroids, None
    return centroids.astype(np.int64), pivots


def _total(column: str) -> Column:
    return F.sum(F.col(column).cast("decimal(38,0)"))


def _as_long(value: int | None) -> int | None:
    return value if value is not None and value <= _LONG else None


def _digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(v)) for v in centroid).encode()).hexdigest()
