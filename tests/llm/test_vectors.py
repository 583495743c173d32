"""Clustering, neighbours and whitening of vectors against brute force."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import neighbours
from millrace.llm.centroids import Pivots, cluster_vectors, nearest
from millrace.llm.neighbours import column_blocks, least_partial, nearest_vectors, rotation, scan
from millrace.llm.whitening import Factors, leading_eigenpairs, whiten_vectors

TYPE = "vec_id long, embedding array<double>, x string, cls string, list string"
BAD = [None, [], [None, 1.0, 2.0, 3.0], [math.nan, 1.0, 2.0, 3.0], [math.inf, 0.0, 0.0, 0.0], [1.0, 2.0]]


def table(spark, rows):
    return spark.createDataFrame([(k, e, "x", "y", "z") for k, e in rows], TYPE).repartition(3)


def sample(n, dims=4, seed=1):
    draw = np.random.default_rng(seed)
    base = draw.normal(size=(12, dims)) * 3
    return [(i, (base[i % 12] + draw.normal(size=dims)).tolist()) for i in range(n)]


# --- clustering --------------------------------------------------------------------------------


def plain_clusters(rows, clusters, rounds, scale=64):
    """The contract in whole numbers of Python, every distance computed."""
    kept = [
        (k, [math.floor(scale * v) for v in e])
        for k, e in rows
        if e and len(e) == 4 and all(v is not None and math.isfinite(v) for v in e)
    ]
    key = [(k is None, hashlib.sha256(f"1:{k}".encode()).hexdigest() if k is not None else "", x) for k, x in kept]
    centroids = [x for *_, x in sorted(key)][:clusters]

    def near(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), i) for i, c in enumerate(centroids))

    for _ in range(rounds):
        found = [near(x)[1] for _, x in kept]
        for c in range(len(centroids)):
            own = [x for (_, x), f in zip(kept, found, strict=True) if f == c]
            if own:
                centroids[c] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    found = [near(x) for _, x in kept]
    total, out = sum(d for d, _ in found), []
    for (k, _), (d, c) in zip(kept, found, strict=True):
        own = sum(e for e, f in found if f == c)
        digest = hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()
        out.append((k, c, *(v if v < 1 << 63 else None for v in (d, own, total)), digest))
    return sorted(out, key=repr)


@pytest.mark.parametrize("case", ["plain", "awkward", "few", "huge"])
def test_clusters_match_whole_numbers(spark, staging, case):
    rows = sample(400)
    if case == "awkward":  # null ids, repeated rows and ids, ties, one vector in a third of all rows
        rows += [(None, rows[3][1]), (5, rows[5][1]), (5, rows[9][1]), *[(1000 + i, rows[0][1]) for i in range(250)]]
        rows += [(2000 + i, [0.5 * (i % 3), 0.0, 0.0, -0.0]) for i in range(30)] + [(3000 + i, e) for i, e in enumerate(BAD)]
    if case == "few":
        rows = [*rows[:5], (None, rows[1][1]), (7, None)]
    if case == "huge":
        rows += [(9000, [1e30, -1e30, 0.0, 1.0]), (9001, [1e300, 1.0, 1.0, 1.0]), (9002, [3e7, 0.0, 0.0, 0.0])]
    out = cluster_vectors(table(spark, rows), staging, dims=4, clusters=16, rounds=3).collect()
    assert sorted(map(tuple, out), key=repr) == plain_clusters(rows, 16, 3)


def test_nothing_to_cluster(spark, staging):
    out = cluster_vectors(table(spark, [(i, e) for i, e in enumerate(BAD)]), staging, dims=4)
    assert out.count() == 0 and cluster_vectors(table(spark, []), staging, dims=4).count() == 0


@pytest.mark.parametrize("dims", [1, 2, 64])
def test_ptolemaic_bounds_hold_and_save_work(dims):
    draw = np.random.default_rng(dims)
    centres = draw.integers(-3000, 3000, (16, dims))
    x = (centres[draw.integers(0, 16, 2000)] + draw.integers(-40, 40, (2000, dims))).astype(np.int64)
    pivots = Pivots.spread(centres, 6)
    bound = pivots.bounds(pivots.distances(x), pivots.distances(centres))
    true = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert (bound * bound <= true).all()
    who, best, computed = nearest(x, pivots.distances(x), centres, pivots)
    assert (who == true.argmin(axis=1)).all() and (best == true.min(axis=1)).all()
    assert computed < 0.5 * true.size


# --- neighbours --------------------------------------------------------------------------------


def plain_neighbours(rows, most, every):
    usable = [(k, np.array(e, float)) for k, e in rows if e and all(v is not None and math.isfinite(v) for v in e) and any(e)]
    out = {}
    for i, (k, q) in enumerate(usable):
        if k is not None and k % every == 0:
            found = [
                (-(q * x).sum(), j is None, j or 0) for n, (j, x) in enumerate(usable) if n != i and len(x) == len(q)
            ]
            out.setdefault(k, []).append(
                [(r, None if e[1] else e[2], pytest.approx(-e[0], abs=1e-12)) for r, e in enumerate(sorted(found)[:most], 1)]
            )
    return out


def found_neighbours(out):
    lists = {}
    for row in out.collect():
        lists.setdefault(row["query_id"], []).append((row["rank"], row["vec_id"], row["score"]))
    return {k: sorted(v, key=lambda r: r[0]) for k, v in lists.items()}


@pytest.mark.parametrize("tile", [neighbours.TILE_BYTES, 1])
def test_neighbours_reach_their_recall(spark, staging, monkeypatch, tile):
    monkeypatch.setattr("millrace.llm.neighbours.TILE_BYTES", tile)
    draw = np.random.default_rng(4)
    rows = [(i, (e * float(draw.uniform(0.5, 2))).tolist()) for i, e in enumerate(draw.normal(size=(3000, 24)))]
    got = found_neighbours(nearest_vectors(table(spark, rows), staging, F.col("vec_id") % 20 == 0))
    wanted = plain_neighbours(rows, 20, 20)
    assert set(got) == set(wanted)
    hits = [len({v for _, v, _ in got[k]} & {v for _, v, _ in wanted[k][0]}) for k in wanted]
    assert sum(hits) / (20 * len(wanted)) >= 0.9
    for k, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, 21)) and k not in {v for _, v, _ in found}
        assert all(s == pytest.approx(np.dot(rows[k][1], rows[v][1]), abs=1e-12) for _, v, s in found)
        assert [s for _, _, s in found] == sorted((s for _, _, s in found), reverse=True)


def test_awkward_neighbours_are_exact_where_all_is_probed(spark, staging):
    """Null ids, copies of a vector in a third of the rows, ids used twice, zero and broken vectors, other lengths."""
    rows = sample(90, seed=2) + [(1000 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(60)] + [(None, [9.0, 9.0, 9.0, 9.0])]
    rows += [(7, [1.0, 2.0, 3.0, 4.0]), (20, [5.0, -1.0, 0.0, 2.0]), (4000, [0.0] * 4), (4020, None)]
    rows += [(5000 + 20 * i, e) for i, e in enumerate(BAD)] + [(6000, [3.0]), (6001, [-2.0]), (6020, [1e300, 1e300])]
    out = nearest_vectors(table(spark, rows), staging, F.col("vec_id") % 20 == 0, recall=1.0, deviations=40.0)
    got, wanted = found_neighbours(out), plain_neighbours(rows, 20, 20)
    for k, lists in wanted.items():
        if len(lists) == 1:
            assert got.get(k, []) == lists[0], k
    both = sorted((x for own in wanted[20] for x in own), key=lambda x: (x[0], -x[2].expected))
    assert sorted(got[20], key=lambda x: (x[0], -x[2])) == both  # two rows of one id, a list each
    assert len(got[6000]) == 1 and set(got) == {k for k, lists in wanted.items() if any(lists)}


def test_no_vectors_to_search(spark, staging):
    assert nearest_vectors(table(spark, []), staging, F.col("vec_id") % 20 == 0).count() == 0
    assert nearest_vectors(table(spark, [(1, [1.0]), (2, [2.0])]), staging, F.col("vec_id") % 20 == 0).count() == 0


def test_scan_abandons_most_columns_and_loses_little():
    draw = np.random.default_rng(6)
    x, queries = draw.normal(size=(6000, 128)), draw.normal(size=(40, 128))
    true = np.argsort(-(queries @ x.T), axis=1)[:, :10]
    for floor, share in ((np.full(40, -np.inf), 0.85), (np.sort(queries @ x[:600].T, axis=1)[:, -10], 0.7)):
        one, two, score, read = scan(queries, floor, x, np.arange(6000), 10, 2.5)
        hits = sum(len(set(two[one == i]) & set(true[i])) for i in range(40))
        assert hits >= 0.97 * 400 and read < share * 40 * 6000 * 128
    assert np.allclose(score, (queries[one] * x[two]).sum(axis=1))


def test_partial_products_follow_the_hypothesis():
    """Under a random rotation few pairs fall below the bound for their own cosine."""
    dims, draw = 64, np.random.default_rng(8)
    x, y = draw.normal(size=(2, 4000, dims))
    y = 0.7 * x + 0.7 * y
    x, y = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (x, y))
    turn = rotation(dims)
    assert np.abs(turn @ turn.T - np.eye(dims)).max() < 1e-12
    cosine, partial = (x * y).sum(axis=1), ((x @ turn) * (y @ turn)).cumsum(axis=1)
    for _, read in column_blocks(dims):
        below = (partial[:, read - 1] < least_partial(cosine, read, dims, 3.0)).mean()
        assert below < 0.01, read
        if read < dims:
            assert (partial[:, read - 1] < least_partial(cosine, read, dims, 0.5)).mean() > 0.1


# --- whitening ---------------------------------------------------------------------------------


def check_whitened(rows, out, dims):
    kept = [
        (k, [math.floor(256 * v) for v in e])
        for k, e in rows
        if e and len(e) == dims and all(v is not None and math.isfinite(v) for v in e)
    ]
    distinct = sorted({tuple(x) for _, x in kept})
    n, sums = len(distinct), [sum(column) for column in zip(*distinct, strict=True)]
    centred = np.array([[x - s / n for x, s in zip(row, sums, strict=True)] for row in distinct])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    components = [i for i in range(min(4, dims)) if values[i] > 1e-11 * max(values[0], 1e-300)]
    own = [r for r in out if r["vec_id"] in {k for k, _ in kept}]
    assert len(own) == len(kept) * len(components)
    for i in components:
        found = sorted((r["vec_id"] is None, r["vec_id"] or 0, float(r["deviation"]), r["whitened"]) for r in own if r["component"] == i + 1)
        wanted = []
        for k, x in kept:
            deviation = sum((n * v - s) ** 2 for v, s in zip(x, sums, strict=True))
            wanted.append((k is None, k or 0, float(deviation), float((np.array([v - s / n for v, s in zip(x, sums, strict=True)]) @ vectors[:, i]) / values[i] ** 0.5)))
        for sign in (1, -1):
            turned = sorted((*w[:3], sign * w[3]) for w in wanted)
            if np.allclose([f[3] for f in found], [w[3] for w in turned], atol=1e-8):
                assert [f[:3] for f in found] == [w[:3] for w in turned]
                break
        else:
            raise AssertionError(i)
    for r in own:
        assert r["n"] == n and r["identity_error"] < 1e-9
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / np.trace(covariance), rel=1e-9)


@pytest.mark.parametrize("case", ["plain", "awkward", "few", "large"])
def test_whitening_matches_plain(spark, staging, case):
    rows = sample(300, seed=3)
    if case == "awkward":
        rows += [(None, rows[3][1]), (5, rows[9][1]), *[(1000 + i, rows[0][1]) for i in range(200)]]
        rows += [(3000 + i, e) for i, e in enumerate(BAD)]
    if case == "few":
        rows = [*rows[:3], (9, rows[1][1])]
    if case == "large":
        rows = [(k, [v * 1e9 for v in e]) for k, e in rows]
    out = whiten_vectors(table(spark, rows), staging).collect()
    assert [c for c, _ in whiten_vectors(table(spark, rows[:2]), staging).dtypes][:2] == ["vec_id", "component"]
    check_whitened(rows, [r for r in out if case != "awkward" or r["vec_id"] is None or r["vec_id"] < 3000], 4)
    assert not [r for r in out if case == "awkward" and (r["vec_id"] or 0) >= 3000]  # one vector of two components


def test_nothing_to_whiten(spark, staging):
    assert whiten_vectors(table(spark, []), staging).count() == 0
    assert whiten_vectors(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None)]), staging).count() == 0


def test_inertia_counts_and_solutions():
    draw = np.random.default_rng(0)
    for n in (1, 2, 3, 7, 30):
        a = draw.normal(size=(n, n))
        a += a.T
        values = np.linalg.eigvalsh(a)
        for shift in [*((values[1:] + values[:-1]) / 2), values[0] - 1, values[-1] + 1]:
            factors = Factors.of(a, shift)
            assert factors.above() == (values > shift).sum()
            b = draw.normal(size=n)
            assert np.allclose(a @ (x := factors.solve(b)) - shift * x, b, atol=1e-6)


def test_eigenpairs_of_hard_spectra():
    draw = np.random.default_rng(2)
    for n, spectrum in [(9, [5, 5, 5, 1]), (20, [3] * 20), (6, [1, 1 - 1e-9, 1 - 2e-9, 0.5]), (12, [7, 1e-3]), (5, [0] * 5), (1, [4])]:
        values = np.array((spectrum + [0.0] * n)[:n])
        q = np.linalg.qr(draw.normal(size=(n, n)))[0]
        for size in (1e-30, 1.0, 1e30):
            matrix = (q * values) @ q.T * size
            matrix = (matrix + matrix.T) / 2
            found, vectors = leading_eigenpairs(matrix, 4)
            wanted = values[:4][values[:4] > 0]
            assert np.allclose(found / size, wanted, rtol=1e-12)
            assert np.allclose(vectors @ vectors.T, np.eye(len(wanted)), atol=1e-12)
            assert np.abs(matrix @ vectors.T - vectors.T * found).max(initial=0) < 1e-13 * size * max(spectrum) + 1e-300
