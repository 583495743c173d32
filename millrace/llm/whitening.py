"""Whitening by the leading eigenvectors of the covariance, found by spectrum slicing."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.vectors import is_finite, list_column, rows_of
from millrace.staging import Staging

_BLOCK_BYTES = 32 << 20  # of vectors centred at a time
_TILE = 64  # columns of the covariance in one row of a task's partial sums
_EPS = float(np.finfo(np.float64).eps)


@dataclass
class Factors:
    """``P (A - shift I) Pᵀ = L D Lᵀ`` with 1 by 1 and 2 by 2 blocks in D, by Bunch-Kaufman pivoting."""

    lower: np.ndarray
    blocks: list[tuple[int, np.ndarray]]
    order: np.ndarray

    @classmethod
    def of(cls, matrix: np.ndarray, shift: float) -> Factors:
        a = matrix - shift * np.eye(len(matrix))
        n, at, blocks = len(a), 0, []
        lower, order = np.eye(n), np.arange(n)
        limit = (1 + 17**0.5) / 8
        tiny = _EPS * max(float(np.abs(matrix).max(initial=0)), 1e-290)

        def swap(i: int, j: int) -> None:
            if i != j:
                a[[i, j]] = a[[j, i]]
                a[:, [i, j]] = a[:, [j, i]]
                lower[[i, j], :at] = lower[[j, i], :at]
                order[[i, j]] = order[[j, i]]

        while at < n:
            size, below = 1, np.abs(a[at + 1 :, at])
            if len(below):
                r = at + 1 + int(below.argmax())
                most = below.max()
                if abs(a[at, at]) < limit * most:
                    beside = np.abs(a[r, at:])
                    beside[r - at] = 0
                    if abs(a[at, at]) * beside.max() < limit * most * most:
                        if abs(a[r, r]) >= limit * beside.max():
                            swap(at, r)
                        else:
                            swap(at + 1, r)
                            size = 2
            end = at + size
            d = a[at:end, at:end].copy()
            if size == 1 and abs(d[0, 0]) < tiny:
                d[0, 0] = tiny  # an eigenvalue at the shift itself counts as above it
            part = np.linalg.solve(d, a[end:, at:end].T).T
            lower[end:, at:end] = part
            a[end:, end:] -= part @ a[at:end, end:]
            blocks.append((at, d))
            at = end
        return cls(lower, blocks, order)

    def above(self) -> int:
        """How many eigenvalues lie above the shift: by Sylvester's law, the positive ones of D."""
        return sum(int((np.linalg.eigvalsh(d) > 0).sum()) for _, d in self.blocks)

    def solve(self, b: np.ndarray) -> np.ndarray:
        x = b[self.order].astype(np.float64)
        for i in range(len(x)):
            x[i + 1 :] -= self.lower[i + 1 :, i] * x[i]
        for at, d in self.blocks:
            x[at : at + len(d)] = np.linalg.solve(d, x[at : at + len(d)])
        for i in range(len(x) - 1, -1, -1):
            x[i] -= self.lower[i + 1 :, i] @ x[i + 1 :]
        out = np.empty_like(x)
        out[self.order] = x
        return out


def _bracket(matrix: np.ndarray, number: int, low: float, high: float, least: float) -> tuple[float, float, bool]:
    """An interval that holds the eigenvalue of this number, and whether it holds no other.

    Halved by inertia counts until the eigenvalue is alone, or the interval is as narrow as rounding.
    """
    above_low, above_high = len(matrix), 0
    while not (above_low == number and above_high == number - 1) and high - low > least:
        middle = (low + high) / 2
        count = Factors.of(matrix, middle).above()
        if count >= number:
            low, above_low = middle, count
        else:
            high, above_high = middle, count
    return low, high, above_low == number and above_high == number - 1


def leading_eigenpairs(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` greatest positive eigenvalues of a covariance, falling, and unit eigenvectors as rows.

    Inertia counts of shifted LDLᵀ factors isolate each eigenvalue by its number. Rayleigh quotient
    iteration then converges from a solve at the interval's middle; a quotient that leaves the interval is
    thrown away and the interval halved further. Counts just below and above the result certify its
    number. Of eigenvalues equal up to rounding, which no count can part, any orthonormal vectors are found.
    Eigenvalues that rounding could have made of 0 are left out.
    """
    n, size = len(matrix), float(np.abs(matrix).sum(axis=1).max(initial=0))  # no eigenvalue is larger
    values, vectors = [], []
    if not size:
        return np.zeros(0), np.zeros((0, n))
    scaled, noise = matrix / size, 4 * n * _EPS
    draw = np.random.default_rng(13)
    positive = Factors.of(scaled, noise).above()
    for number in range(1, min(most, positive) + 1):
        low, high = noise, 1 + noise
        while True:
            low, high, alone = _bracket(scaled, number, low, high, noise)
            value, vector = _rayleigh(scaled, (low + high) / 2, vectors, draw.normal(size=n), noise, alone)
            if low - noise <= value <= high + noise:
                break
            if high - low <= noise:
                raise ArithmeticError(f"no eigenvector for eigenvalue {number} of the covariance")
            middle = (low + high) / 2
            if Factors.of(scaled, middle).above() >= number:
                low = middle
            else:
                high = middle
        if not Factors.of(scaled, value + 2 * noise).above() < number <= Factors.of(scaled, value - 2 * noise).above():
            raise ArithmeticError(f"eigenvalue {number} of the covariance could not be certified")
        values.append(value * size)
        vectors.append(vector)
    return np.array(values), np.array(vectors).reshape(len(values), n)


def _rayleigh(
    matrix: np.ndarray, shift: float, found: list, vector: np.ndarray, noise: float, alone: bool
) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration from a shift, orthogonal to the eigenvectors found so far.

    The shift stays where it is for eigenvalues that the counts could not part.
    """

    def clean(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            for f in found:
                v = v - (f @ v) * f
            v = v / np.sqrt(v @ v)
        return v

    factors = Factors.of(matrix, shift)
    vector = clean(factors.solve(clean(factors.solve(clean(vector)))))
    for _ in range(30):
        value = float(vector @ matrix @ vector)
        rest = matrix @ vector - value * vector
        if np.sqrt(rest @ rest) <= noise / 16:
            break
        if alone:
            factors = Factors.of(matrix, value)
        vector = clean(factors.solve(vector))
    return value, vector


@dataclass
class Whitening:
    """The fit of the vectors of one length."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def project(self, x: np.ndarray) -> np.ndarray:
        """Centred rows on the components, each over the root of its eigenvalue."""
        return self.centred(x) @ (self.vectors / np.sqrt(self.values)[:, None]).T

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - S / n``: the whole part of the mean first, which is exact, then the rest."""
        whole = np.array([s // self.n for s in self.sums], np.float64)
        rest = np.array([s % self.n / self.n for s in self.sums], np.float64)
        return (x - whole) - rest

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sums over dimensions of ``(n x - S)**2`` in whole numbers, in 64 bits where they fit."""
        most = self.n * (int(np.abs(x).max(initial=0)) if x.size else 0) + max(map(abs, self.sums), default=0)
        if most * most * max(1, x.shape[1]) < 1 << 63:
            apart = x * self.n - np.array(self.sums, np.int64)
            return (apart * apart).sum(axis=1).tolist()
        return [sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums, strict=True)) for row in x.tolist()]


def _per_length(lists: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, rows) of the lists of each length above 0."""
    lengths = np.asarray(pa.compute.list_value_length(lists))
    for length in np.unique(lengths[lengths > 0]):
        at = np.flatnonzero(lengths == length)
        yield int(length), at, rows_of(lists.take(pa.array(at)))


def _sums(fit: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Number and exact componentwise sums of the fit list, for each length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in batches:
            for dims, _, x in _per_length(batch.column(0)):
                n, sums = total.get(dims, (0, np.zeros(dims, object)))
                safe = np.abs(x.astype(np.float64)).max() < 2**62 / len(x)
                total[dims] = (n + len(x), sums + (x.sum(axis=0).astype(object) if safe else x.astype(object).sum(axis=0)))
        for dims, (n, sums) in total.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([dims] * dims, pa.int32()),
                    pa.array(range(dims), pa.int32()),
                    pa.array([n] * dims, pa.int64()),
                    pa.array([str(int(s)) for s in sums], pa.string()),
                ],
                ["dims", "place", "n", "s"],
            )

    rows = (
        fit.mapInArrow(run, "dims int, place int, n long, s string")
        .groupBy("dims", "place")
        .agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
        .orderBy("dims", "place")
        .collect()  # a row for each dimension
    )
    out: dict[int, tuple[int, list[int]]] = {}
    for row in rows:
        out.setdefault(row["dims"], (row["n"], []))[1].append(int(row["s"]))
    return out


def _covariances(fit: DataFrame, fits: dict[int, Whitening]) -> dict[int, np.ndarray]:
    """Covariance of the fit list for each length: centred in doubles, multiplied, added up by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for dims, _, x in _per_length(batch.column(0)):
                step = max(1, _BLOCK_BYTES // (8 * dims))
                for at in range(0, len(x), step):
                    centred = fits[dims].centred(x[at : at + step].astype(np.float64))
                    total[dims] = total.get(dims, 0.0) + centred.T @ centred
        for dims, sums in total.items():
            for at in range(0, dims, _TILE):
                tile = np.zeros((dims, _TILE))
                tile[:, : min(_TILE, dims - at)] = sums[:, at : at + _TILE]
                first = [pa.array([v] * dims, pa.int32()) for v in (dims, at)]
                columns = [*first, pa.array(range(dims), pa.int32()), *[pa.array(c) for c in np.ascontiguousarray(tile.T)]]
                yield pa.RecordBatch.from_arrays(columns, ["dims", "first", "place", *[f"v{i}" for i in range(_TILE)]])

    shape = ", ".join(f"v{i} double" for i in range(_TILE))
    rows = (
        fit.mapInArrow(run, f"dims int, first int, place int, {shape}")
        .groupBy("dims", "first", "place")
        .agg(*[F.sum(f"v{i}").alias(f"v{i}") for i in range(_TILE)])
        .collect()  # the covariance itself
    )
    out = {dims: np.zeros((dims, dims)) for dims in fits}
    for row in rows:
        wide = min(_TILE, row["dims"] - row["first"])
        out[row["dims"]][row["place"], row["first"] : row["first"] + wide] = row[3 : 3 + wide]
    return {dims: (m + m.T) / (2 * fits[dims].n) for dims, m in out.items()}


def _identity_errors(fit: DataFrame, fits: dict[int, Whitening], most: int) -> dict[int, float]:
    """For each length the largest entry of the whitened fit list's covariance minus the identity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dims, _, x in _per_length(batch.column(0)):
                columns = list(fits[dims].project(x.astype(np.float64)).T)
                columns += [np.zeros(len(x))] * (most - len(columns))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dims] * len(x), pa.int32()), *[pa.array(np.ascontiguousarray(c)) for c in columns]],
                    ["dims", *[f"w{i}" for i in range(most)]],
                )

    pairs = [(i, j) for i in range(most) for j in range(i + 1)]
    shape = ", ".join(f"w{i} double" for i in range(most))
    rows = (
        fit.mapInArrow(run, f"dims int, {shape}")
        .groupBy("dims")
        .agg(*[F.covar_pop(f"w{i}", f"w{j}").alias(f"c{i}_{j}") for i, j in pairs])
        .collect()  # a row for each length
    )
    return {
        row["dims"]: max((abs(row[f"c{i}_{j}"] - (i == j)) for i, j in pairs if i < len(fits[row["dims"]].values)), default=0.0)
        for row in rows
    }


def whiten_vectors(
    vectors: DataFrame, staging: Staging, *, id: str = "vec_id", embedding: str = "embedding", scale: int = 256, most: int = 4
) -> DataFrame:
    """Every vector on the ``most`` leading components of the covariance, each scaled to variance 1.

    A component c becomes the whole number ``floor(scale * c)``. The covariance V of the distinct
    vectors x (n of them, S their sums, divisor n) is added up by Spark from products of
    centred blocks, and only sums by dimension and V itself reach the driver, where
    `leading_eigenpairs` slices its spectrum. A vector that a third of all rows repeat is one of the fit list.

    Returns for each row and component ``vec_id``, ``component`` from 1 by falling eigenvalue e,
    ``n``, ``deviation`` (the sum of ``(n x - S)**2`` in whole numbers, decimal, null beyond 38
    digits), ``whitened`` (x - S / n on the component over the root of e), ``explained`` (e over the
    trace of V) and ``identity_error`` (largest absolute entry of the whitened fit list's covariance minus
    the identity). Rows whose vector is null, empty, or holds null or non-finite entries (also after
    scaling) are left out. Vectors of each length are fitted apart. Directions without variance are no
    components, so one distinct vector gives no rows, and few give fewer components. Entries beyond
    64 bits take the nearest 64-bit number. Repeated rows and null ids are rows like others; an
    empty table gives an empty result. Other columns are ignored, whatever their names.
    """
    value = F.transform(F.col(f"`{embedding}`").cast("array<double>"), lambda c: F.lit(float(scale)) * c)
    scaled = vectors.select(F.col(f"`{id}`").cast("long").alias("vec_id"), value.alias("x"))
    edge = float(1 << 63)
    low, high = F.lit(-(1 << 63)), F.lit((1 << 63) - 1)
    whole = F.transform("x", lambda c: F.when(c >= edge, high).when(c < -edge, low).otherwise(F.floor(c).cast("long")))
    kept = scaled.filter(is_finite(F.col("x")) & (F.size("x") > 0)).select("vec_id", whole.alias("x"))
    fit = staging.write(kept.select("x").distinct(), "fit")
    fits = {dims: Whitening(n, sums, np.zeros(0), np.zeros((0, dims)), 0.0) for dims, (n, sums) in _sums(fit).items()}
    for dims, matrix in _covariances(fit, fits).items():
        own = fits[dims]
        own.values, own.vectors = leading_eigenpairs(matrix, most)
        own.trace = float(np.trace(matrix))
    errors = _identity_errors(fit, fits, most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dims, at, x in _per_length(batch.column(1)):
                own, rows = fits[dims], len(at)
                k = len(own.values)
                if not k:
                    continue
                deviations = [str(d) if d < 10**38 else None for d in own.deviations(x)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(at)),
                        pa.array([own.n] * rows, pa.int64()),
                        pa.array(deviations, pa.string()),
                        list_column(own.project(x.astype(np.float64))),
                        list_column(np.tile(own.values / own.trace, (rows, 1))),
                        pa.array([errors[dims]] * rows, pa.float64()),
                    ],
                    ["vec_id", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    shape = "vec_id long, n long, deviation string, whitened array<double>, explained array<double>, identity_error double"
    rows = kept.mapInArrow(run, shape).select("*", F.posexplode("whitened").alias("place", "value"))
    return rows.select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        "n",
        F.col("deviation").cast("decimal(38,0)").alias("deviation"),
        F.col("value").alias("whitened"),
        F.col("explained")[F.col("place")].alias("explained"),
        "identity_error",
    )
