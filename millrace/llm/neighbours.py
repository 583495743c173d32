"""Approximate nearest neighbours: probed lists scanned by column blocks of rotated vectors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.vectors import is_finite, rows_of
from millrace.staging import Staging

MOST_LISTS = 2048
SAMPLED = 32  # sampled vectors for each list
LEAST_SAMPLE = 4096
SAMPLE_BYTES = 64 << 20  # of the sample that the lists are fitted to, as doubles
PILOTS = 4096  # sampled vectors, a sixteenth of all at most, that give a query its first threshold
JUDGES = 256  # sampled vectors that set how many lists are probed
TILE_BYTES = 16 << 20  # of the vectors on each side of a tile, as doubles
_ROWS, _QUERIES = 1024, 256  # vectors and queries compared at a time
_FIRST = 8  # dimensions in the first column block; each further block doubles what has been read
_DRAW = 1_000_000_007
_NO_ID = (1 << 63) - 1  # orders a null id last


def unit_rows(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows without zero rows at length 1, and their lengths."""
    most = np.abs(x).max(axis=1, keepdims=True)
    scaled = x / most
    length = np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))
    return scaled / length, (most * length)[:, 0]


_rotations: dict[int, np.ndarray] = {}


def rotation(dims: int) -> np.ndarray:
    """A random orthogonal matrix, the same everywhere; remembers the last."""
    if dims not in _rotations:
        turn, upper = np.linalg.qr(np.random.default_rng(dims).normal(size=(dims, dims)))
        _rotations.clear()
        _rotations[dims] = turn * np.sign(np.diag(upper))
    return _rotations[dims]


def column_blocks(dims: int) -> list[tuple[int, int]]:
    cuts, at = [0], _FIRST
    while at < dims:
        cuts.append(at)
        at *= 2
    return list(zip(cuts, [*cuts[1:], dims], strict=True))


def least_partial(cosine: np.ndarray, read: int, dims: int, deviations: float) -> np.ndarray:
    """What the product of ``read`` of ``dims`` columns must reach, or ``cosine`` is unlikely to hold.

    Under a random rotation the partial product of unit vectors with this cosine has the mean
    ``cosine * read / dims`` and the variance below; the hypothesis that the whole product reaches
    it is given up so many standard deviations under the mean. Of all columns the test is exact.
    """
    if read == dims:
        return cosine - 1e-9
    square = np.minimum(cosine * cosine, 1.0)
    left = read * (dims - read) / (dims * (dims + 2.0))
    spread = np.sqrt(left * (2 * square / dims + (1 - square) / (dims - 1)))
    return np.where(cosine > 1 + 1e-9, np.inf, np.where(cosine < -1, -np.inf, cosine * (read / dims) - deviations * spread))


def _best(query: np.ndarray, score: np.ndarray, lead: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the ``most`` best entries of each query, and the rank of each among its own."""
    order = np.lexsort((lead, -score, query))
    own = query[order]
    rank = np.arange(len(order)) - np.searchsorted(own, own)
    return order[rank < most], rank[rank < most]


def scan(
    queries: np.ndarray, floor: np.ndarray, x: np.ndarray, lead: np.ndarray, most: int, deviations: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query, row, product) of the ``most`` largest products of each query that reach its ``floor``.

    Queries and rows are rotated and read a column block at a time. The first block is a product of
    all pairs; after each block, pairs whose partial product says that they stay below the query's
    threshold are abandoned, and only the others read on. The threshold rises to the last of the
    best after every strip of rows. Also returns how many columns of pairs were read.
    """
    dims = x.shape[1]
    blocks, turn = column_blocks(dims), rotation(dims)
    (q_unit, q_length), (x_unit, x_length) = unit_rows(queries), unit_rows(x)
    # One array for each column block: rows read it without touching the other columns.
    q_turned = [np.ascontiguousarray((q_unit @ turn)[:, a:b]) for a, b in blocks]
    x_turned = [np.ascontiguousarray((x_unit @ turn)[:, a:b]) for a, b in blocks]
    out, read = [], 0
    for q_at in range(0, len(queries), _QUERIES):
        some = slice(q_at, q_at + _QUERIES)
        threshold = floor[some].copy()
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        for at in range(0, len(x), _ROWS):
            strip = slice(at, at + _ROWS)
            with np.errstate(over="ignore", invalid="ignore"):
                wanted = threshold[:, None] / (q_length[some, None] * x_length[None, strip])
            partial = q_turned[0][some] @ x_turned[0][strip].T
            read += partial.size * (blocks[0][1] - blocks[0][0])
            one, two = np.nonzero(partial >= least_partial(wanted, blocks[0][1], dims, deviations))
            partial, wanted = partial[one, two], wanted[one, two]
            for (a, b), q_block, x_block in zip(blocks[1:], q_turned[1:], x_turned[1:], strict=True):
                partial = partial + np.einsum("ij,ij->i", q_block[some][one], x_block[strip][two])
                read += len(one) * (b - a)
                alive = partial >= least_partial(wanted, b, dims, deviations)
                one, two, partial, wanted = one[alive], two[alive], partial[alive], wanted[alive]
            if not len(one):
                continue
            with np.errstate(over="ignore", invalid="ignore"):
                score = (queries[some][one] * x[strip][two]).sum(axis=1)
            alive = score >= threshold[one]
            held = tuple(
                np.concatenate(pair) for pair in zip(held, (one[alive], two[alive] + at, score[alive]), strict=True)
            )
            kept, rank = _best(held[0], held[2], lead[held[1]], most)
            held = tuple(h[kept] for h in held)
            full = rank == most - 1
            threshold[held[0][full]] = np.maximum(threshold[held[0][full]], held[2][full])
        out.append((held[0] + q_at, *held[1:]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), 0
    return *(np.concatenate(parts) for parts in zip(*out, strict=True)), read


@dataclass
class Lists:
    """The lists of the vectors of one length: their directions, and how many a query probes."""

    directions: np.ndarray
    probes: int
    pilots: np.ndarray
    pilot_ids: tuple[np.ndarray, np.ndarray]  # class and leading id of each pilot
    sizes: np.ndarray | None = None

    def number(self, x: np.ndarray) -> np.ndarray:
        """The list of each vector: that of the nearest direction."""
        return (unit_rows(x)[0] @ self.directions.T).argmax(axis=1)

    def probed(self, x: np.ndarray, least: int) -> list[np.ndarray]:
        """The lists each query probes, nearest first, and more where these hold fewer than ``least`` vectors."""
        order = np.argsort(-(unit_rows(x)[0] @ self.directions.T), axis=1, kind="stable")
        enough = (np.cumsum(self.sizes[order], axis=1) < least).sum(axis=1) + 1
        return [own[: max(self.probes, n)] for own, n in zip(order, enough, strict=True)]


def fit_lists(x: np.ndarray, lists: int, most: int, recall: float, rounds: int = 8) -> tuple[np.ndarray, int]:
    """Directions of lists by spherical k-means over a sample, and the probes that reach the recall there.

    A part of the sample searches the whole of it: the probes are the least number of nearest lists
    that hold ``recall`` of its true neighbours. Neighbours among all vectors are nearer than those
    in a sample, so they lie in fewer lists.
    """
    unit = unit_rows(x)[0]
    directions = unit[np.random.default_rng(5).permutation(len(unit))[:lists]].copy()
    for _ in range(rounds):
        who = np.concatenate([(unit[at : at + 8192] @ directions.T).argmax(axis=1) for at in range(0, len(unit), 8192)])
        total = np.zeros_like(directions)
        np.add.at(total, who, unit)
        length = np.sqrt((total * total).sum(axis=1))
        directions[length > 0] = total[length > 0] / length[length > 0, None]
    who = np.concatenate([(unit[at : at + 8192] @ directions.T).argmax(axis=1) for at in range(0, len(unit), 8192)])
    judges = min(JUDGES, len(x))
    with np.errstate(over="ignore", invalid="ignore"):
        score = np.nan_to_num(x[:judges] @ x.T, nan=-np.inf)
    score[np.arange(judges), np.arange(judges)] = -np.inf
    near = np.argpartition(-score, min(most, len(x) - 1) - 1, axis=1)[:, : min(most, len(x) - 1)] if len(x) > 1 else np.zeros((1, 0), int)
    place = np.argsort(np.argsort(-(unit[:judges] @ directions.T), axis=1), axis=1)
    needed = np.sort(place[np.arange(len(near))[:, None], who[near]].ravel())
    if not len(needed):
        return directions, 1
    return directions, int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)]) + 1


def _fitted(classes: DataFrame, most: int, recall: float) -> dict[int, Lists]:
    """Lists for every vector length, from a bounded sample."""
    counts = {r["dims"]: r["n"] for r in classes.groupBy("dims").agg(F.count("*").alias("n")).collect()}
    drawn = F.lit(False)
    for dims, n in counts.items():
        room = max(256, SAMPLE_BYTES // (8 * dims))
        size = min(room, max(LEAST_SAMPLE, SAMPLED * min(isqrt(n), MOST_LISTS)))
        drawn |= (F.col("dims") == dims) & (F.pmod(F.xxhash64("cls", F.lit("sample")), F.lit(_DRAW)) < int(min(1.0, size / n) * _DRAW) + 1)
    table = classes.filter(drawn).select("dims", "cls", "lead", "embedding").toArrow()
    out = {}
    for dims, n in counts.items():
        own = table.filter(pa.compute.equal(table["dims"], dims)).sort_by("cls").combine_chunks()
        x = rows_of(own["embedding"].combine_chunks()).astype(np.float64) if len(own) else np.ones((1, dims))
        cls, lead = (own[c].to_numpy() for c in ("cls", "lead"))
        order = np.random.default_rng(3).permutation(len(own))
        x = x[order] if len(own) else x
        lists = max(1, min(isqrt(n), MOST_LISTS, len(x)))
        directions, probes = fit_lists(x, lists, most, recall)
        pilots = order[: min(PILOTS, n // 16)]
        out[dims] = Lists(directions, probes, x[: len(pilots)], (cls[pilots], lead[pilots]))
    return out


def _per_length(batch: pa.RecordBatch, dims: str, embedding: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, rows as doubles) of the vectors of each length in a batch."""
    lengths = batch.column(dims).to_numpy()
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        yield int(length), at, rows_of(batch.column(embedding).take(pa.array(at))).astype(np.float64)


def nearest_vectors(
    vectors: DataFrame,
    staging: Staging,
    queries: Column,
    *,
    id: str = "vec_id",
    embedding: str = "embedding",
    most: int = 20,
    recall: float = 0.97,
    deviations: float = 2.5,
) -> DataFrame:
    """The ``most`` rows with the largest inner product for every row whose id meets ``queries``.

    ``queries`` is a condition on ``vec_id``. Identical vectors are folded into one class with its
    least ids. Classes are dealt over lists by direction; the lists, about the square root of
    the classes and at most ``MOST_LISTS``, are fitted to a bounded sample, and every class is indexed. A
    query probes the nearest lists, as many as hold ``recall`` of the true neighbours inside the
    sample. List and queries meet in tiles of bounded size: a list that holds a third of all rows is
    cut into many, and so are the queries that probe it. `scan` reads rotated vectors by column
    blocks and abandons candidates whose partial products fail a test at ``deviations`` standard
    deviations. Bounded pilots of the sample give each query its first threshold.

    Returns ``query_id``, ``rank`` from 1, ``vec_id`` and ``score``: the product of the original
    vectors in double precision, largest first, ties to the smaller vec_id, null ids last. A row is
    no candidate of its own, but other rows with its id or vector are. Vectors that are null,
    zero, empty, or hold null or non-finite components take no part, and only vectors of equal length
    meet; a product that is not a number is no result. A repeated query row gives its result again.
    Fewer candidates give fewer rows, an empty table none. Other columns are ignored.
    """
    kind = vectors.schema[embedding].dataType.elementType.simpleString()
    value = F.col(f"`{embedding}`").cast(f"array<{kind if kind == 'float' else 'double'}>")
    plain = vectors.select(F.col(f"`{id}`").cast("long").alias("vec_id"), value.alias("embedding")).filter(
        is_finite(F.col("embedding").cast("array<double>")) & F.exists("embedding", lambda x: x != 0)
    )
    named = F.struct(F.col("vec_id").isNull().alias("unnamed"), F.col("vec_id"))
    place = F.row_number().over(W.partitionBy("embedding").orderBy(F.col("vec_id").asc_nulls_last()))
    classes = (
        plain.withColumn("place", place)
        .filter(F.col("place") <= most + 1)
        .groupBy("embedding")
        .agg(F.sort_array(F.collect_list(named)).alias("ids"))
        .select(
            F.monotonically_increasing_id().alias("cls"),
            F.size("embedding").alias("dims"),
            F.coalesce(F.col("ids")[0]["vec_id"], F.lit(_NO_ID)).alias("lead"),
            "ids",
            "embedding",
        )
    )
    classes = staging.write(classes, "classes")
    asked = plain.filter(F.coalesce(queries, F.lit(False))).join(classes.select("cls", "dims", "embedding"), "embedding")
    asked = staging.write(asked.withColumnRenamed("cls", "query"), "asked")
    model = _fitted(classes, most, recall)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = np.zeros(batch.num_rows, np.int32)
            for dims, at, x in _per_length(batch, "dims", "embedding"):
                number[at] = model[dims].number(x)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(number)], [*batch.schema.names, "list"])

    shape = f"cls long, dims int, lead long, embedding array<{kind if kind == 'float' else 'double'}>"
    index = staging.write(
        classes.select("cls", "dims", "lead", "embedding").mapInArrow(deal, f"{shape}, list int"), "index"
    )
    for lists in model.values():
        lists.sizes = np.zeros(len(lists.directions), np.int64)
    for row in index.groupBy("dims", "list").count().collect():  # a row for each list
        model[row["dims"]].sizes[row["list"]] = row["count"]

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            floor, lists, found = np.full(n, -np.inf), [None] * n, [[] for _ in range(n)]
            for dims, at, x in _per_length(batch, "dims", "embedding"):
                own = model[dims]
                for i, chosen in zip(at, own.probed(x, most + 1), strict=True):
                    lists[i] = chosen.tolist()
                if not len(own.pilots):
                    continue
                cls, lead = own.pilot_ids
                one, two, score, _ = scan(x, np.full(len(x), -np.inf), own.pilots, lead, most + 1, deviations)
                for i, j, s in zip(at[one].tolist(), two.tolist(), score.tolist(), strict=True):
                    found[i].append({"cls": int(cls[j]), "lead": int(lead[j]), "score": s})
                    if len(found[i]) == most + 1:
                        floor[i] = s  # they come best first, so this is the last of the best
            pairs = pa.array(found, pa.list_(pa.struct([("cls", pa.int64()), ("lead", pa.int64()), ("score", pa.float64())])))
            columns = [*batch.columns, pa.array(floor), pa.array(lists, pa.list_(pa.int32())), pairs]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "floor", "lists", "found"])

    asking = asked.groupBy("query").agg(F.first("dims").alias("dims"), F.first("embedding").alias("embedding"))
    kinds = f"query long, dims int, embedding array<{kind if kind == 'float' else 'double'}>, floor double, lists array<int>"
    probes = staging.write(asking.mapInArrow(probe, f"{kinds}, found array<struct<cls:long,lead:long,score:double>>"), "probes")

    each = probes.select(F.col("query").alias("cls"), "dims", "floor", "embedding", F.explode("lists").alias("list"))
    side = F.greatest(F.lit(256), F.floor(F.lit(TILE_BYTES) / (8 * F.col("dims"))))
    sizes = (
        index.groupBy("dims", "list").agg(F.count("*").alias("rows"))
        .join(each.groupBy("dims", "list").agg(F.count("*").alias("queries")), ["dims", "list"])
        .select("dims", "list", F.ceil(F.col("rows") / side).cast("int").alias("parts"), F.ceil(F.col("queries") / side).cast("int").alias("blocks"))
    )
    sizes = F.broadcast(staging.write(sizes, "sizes"))  # a row for each list
    columns = ["dims", "list", "part", "block", "is_query", "cls", "lead", "floor", "embedding"]
    one = (
        index.join(sizes, ["dims", "list"])
        .withColumn("part", F.pmod(F.xxhash64("cls"), "parts").cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("*", F.lit(False).alias("is_query"), F.lit(0.0).alias("floor"))
    )
    two = (
        each.join(sizes, ["dims", "list"])
        .withColumn("block", F.pmod(F.xxhash64("cls"), "blocks").cast("int"))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("*", F.lit(True).alias("is_query"), F.lit(0).cast("long").alias("lead"))
    )

    def meet(table: pa.Table) -> pa.Table:
        asks = table["is_query"].combine_chunks()
        left, right = table.filter(asks), table.filter(pa.compute.invert(asks))
        x, q = (rows_of(t["embedding"].combine_chunks()).astype(np.float64) for t in (right, left))
        lead = right["lead"].to_numpy()
        i, j, score, _ = scan(q, left["floor"].to_numpy(), x, lead, most + 1, deviations)
        return pa.table(
            {"query": left["cls"].to_numpy()[i], "cls": right["cls"].to_numpy()[j], "lead": lead[j], "score": score}
        )

    tiles = one.select(*columns).unionByName(two.select(*columns)).groupBy("dims", "list", "part", "block")
    found = tiles.applyInArrow(meet, "query long, cls long, lead long, score double")
    piloted = probes.select("query", F.explode("found").alias("f")).select("query", "f.cls", "f.lead", "f.score")
    both = staging.write(found.unionByName(piloted), "found")
    ranked = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "lead"))
    best = both.dropDuplicates(["query", "cls"]).withColumn("place", ranked).filter(F.col("place") <= most + 1)
    entry = F.struct((-F.col("score")).alias("below"), "id.unnamed", "id.vec_id", F.col("cls"))
    rows = (
        best.join(classes.select("cls", F.explode("ids").alias("id")), "cls")
        .groupBy("query")
        .agg(F.sort_array(F.collect_list(entry)).alias("all"))  # at most most + 1 ids of as many classes
        .select("query", F.slice("all", 1, most + 1).alias("all"))
    )
    own = F.array_position(
        F.transform("all", lambda e: e["vec_id"].eqNullSafe(F.col("query_id")) & (e["cls"] == F.col("query"))), F.lit(True)
    )
    others = F.slice(F.filter("all", lambda e, i: i != F.col("own") - 1), 1, most)
    return (
        asked.select("query", F.col("vec_id").alias("query_id"))
        .join(rows, "query")
        .withColumn("own", own)
        .select("query_id", F.posexplode(others).alias("at", "e"))
        .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "e.vec_id", (-F.col("e.below")).alias("score"))
    )
