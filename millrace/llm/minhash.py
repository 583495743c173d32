"""Near-duplicate documents by circulant MinHash, banding and exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.graphs import components
from millrace.llm.hashing import Windows, mix64, word_hashes, words
from millrace.staging import Staging

BANDS, ROWS = 36, 6
GRID = 256  # documents on a side of a cell when members of a bucket's groups are compared
_PIECE = 1 << 20  # bytes of text hashed at a time
_BLOCK = 1 << 15  # shingles permuted at a time
_SHARED = 4096  # shingles of an incidence block
_U32 = np.uint32


def shingle_sets(texts: list[bytes | None], size: int) -> list[np.ndarray]:
    """Each text's distinct ``size``-word shingles as sorted 64-bit hashes.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased; a text with fewer words has
    its whole sequence as one shingle, and one without words has none.
    """
    out: list[np.ndarray] = []
    at = 0
    while at < len(texts):
        upto, n = at, 0
        while upto < len(texts) and (n == 0 or n + len(texts[upto] or b"") <= _PIECE):
            n += len(texts[upto] or b"") + 1
            upto += 1
        body = b"".join((t or b"").lower() + b"\n" for t in texts[at:upto])
        data = np.frombuffer(body, np.uint8)
        end = np.cumsum([len(t or b"") + 1 for t in texts[at:upto]]) - 1
        starts, ends = words(data)
        hashes = word_hashes(data, starts, ends)
        shingles = Windows(hashes)(size)
        last = np.searchsorted(starts, end)
        first = np.append(0, last[:-1])
        for low, high in zip(first.tolist(), last.tolist(), strict=True):
            if high - low >= size:
                out.append(np.unique(shingles[low : high - size + 1]))
            elif high > low:
                out.append(Windows(hashes[low:high])(high - low))
            else:
                out.append(np.zeros(0, np.uint64))
        at = upto
    return out


# Two permutations of the 32-bit numbers, each by a pair of odd multipliers.
_PLACING, _RANKING = (_U32(0x85EBCA6B), _U32(0xC2B2AE35)), (_U32(0x7FEB352D), _U32(0x846CA68B))


def _permute(x: np.ndarray, by: tuple) -> np.ndarray:
    """A permutation of the 32-bit numbers, in place."""
    x ^= x >> _U32(16)
    x *= by[0]
    x ^= x >> _U32(15)
    x *= by[1]
    x ^= x >> _U32(16)
    return x


def signatures(sets: list[np.ndarray], length: int) -> np.ndarray:
    """Circulant MinHash of non-empty sets.

    Shingles, cut to 32 bits of their hash, are placed by a first permutation of the 32-bit numbers.
    Coordinate k is the least value of a second permutation, shifted circularly by k, over the
    set's places; so two permutations give all coordinates.
    """
    out = np.full((len(sets), length), np.iinfo(_U32).max, _U32)
    size = np.array([len(s) for s in sets])
    placed = _permute(np.concatenate(sets).astype(_U32), _PLACING) if len(sets) else np.zeros(0, _U32)
    begin = np.cumsum(size) - size
    for at in range(0, len(placed), _BLOCK):
        block = placed[at : at + _BLOCK]
        low = np.searchsorted(begin, at, "right") - 1
        high = np.searchsorted(begin, at + len(block))
        cuts = np.maximum(begin[low:high] - at, 0)
        for k in range(length):
            own = np.minimum.reduceat(_permute(block + _U32(k), _RANKING), cuts)
            np.minimum(out[low:high, k], own, out=out[low:high, k])
    return out


def _jaccard(one: np.ndarray, two: np.ndarray) -> tuple[int, int]:
    """Sizes of the intersection and the union of two sorted sets."""
    at = np.searchsorted(one, two)
    at[at == len(one)] = 0
    both = int((one[at] == two).sum()) if len(one) else 0
    return both, len(one) + len(two) - both


def text_mark(text: Column) -> Column:
    """A digest that tells texts apart; with the id it stands for a row, and for repeats of that row."""
    return F.unhex(F.md5(text.cast("binary")))


def _plain(docs: DataFrame, id: str, text: str) -> DataFrame:
    whole = F.col(f"`{text}`")
    return docs.select(
        F.col(f"`{id}`").cast("long").alias("doc_id"), whole.cast("binary").alias("text"), text_mark(whole).alias("mark")
    )


def _first(id: str, mark: str) -> Column:
    """A value that orders rows by id, null ids last, and then by their text's mark."""
    return F.struct(F.col(id).isNull().alias("unnamed"), F.col(id), F.col(mark))


def _sketches(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """For each row: the text's mark, set size, 128-bit digest of the set, and one key for each band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = mix64(np.arange(1, bands + 1, dtype=np.uint64))
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = shingle_sets(part.column(1).to_pylist(), size)
                full = [i for i, s in enumerate(sets) if len(s)]
                signature = signatures([sets[i] for i in full], bands * rows).reshape(len(full), bands, rows)
                sums = np.zeros((len(full), bands), np.uint64)
                for r in range(rows):
                    sums = mix64(sums + signature[:, :, r] + np.uint64(r + 1)) if len(full) else sums
                keys = (sums ^ salt).astype(np.int64)
                n = np.array([len(s) for s in sets], np.int64)
                digest = np.zeros((2, len(sets)), np.int64)
                for i in full:
                    mixed = mix64(sets[i])
                    digest[0, i] = np.bitwise_xor.reduce(mixed).astype(np.int64)
                    digest[1, i] = mix64(mixed + np.uint64(1)).sum().astype(np.int64)
                held = np.zeros(len(sets), np.int64)
                held[full] = bands
                offsets = pa.array(np.append(0, np.cumsum(held)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(2),
                        pa.array(n),
                        pa.array(digest[0]),
                        pa.array(digest[1]),
                        pa.ListArray.from_arrays(offsets, pa.array(keys.ravel())),
                    ],
                    ["doc_id", "mark", "n", "d1", "d2", "keys"],
                )

    return docs.mapInArrow(run, "doc_id long, mark binary, n long, d1 long, d2 long, keys array<long>")


def _sets(docs: DataFrame, classes: DataFrame, needed: DataFrame, size: int) -> DataFrame:
    """(cls, shingles) of the needed classes, from the text of each one's first row.

    A row is found by its id and its text's mark, so rows that share an id, or have none, do not
    meet the classes of each other.
    """
    wanted = classes.join(needed, "cls").select("cls", "first.doc_id", "first.mark")
    same = docs["doc_id"].eqNullSafe(wanted["doc_id"]) & (docs["mark"] == wanted["mark"])
    rows = docs.join(wanted, same).select("cls", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = shingle_sets(part.column(1).to_pylist(), size)
                shingles = pa.array([s.tobytes() for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), shingles], ["cls", "shingles"])

    # Repeats of the row give the same set.
    return rows.mapInArrow(run, "cls long, shingles binary").dropDuplicates(["cls"])


def _measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Exact sizes of intersection and union for (a, b) pairs of classes."""
    joined = pairs.join(sets.select(F.col("cls").alias("b"), F.col("shingles").alias("two")), "b").join(
        sets.select(F.col("cls").alias("a"), F.col("shingles").alias("one")), "a"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [
                _jaccard(np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64))
                for one, two in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            ]
            both, either = np.array(sizes, np.int64).reshape(-1, 2).T
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(both), pa.array(either)], ["a", "b", "both", "either"])

    return joined.select("a", "b", "one", "two").mapInArrow(run, "a long, b long, both long, either long")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    return _measured(pairs, sets).filter(F.col("both") * 100 >= F.col("either") * percent).select("a", "b")


def _grouped(classes: DataFrame, links: DataFrame, staging: Staging) -> DataFrame:
    """(cls, component) of every class, its own where it has no links."""
    groups = components(links, staging).withColumnRenamed("node", "cls")
    return classes.select("cls").join(groups, "cls", "left").withColumn("component", F.coalesce("component", "cls"))


def _overlaps(sets: list[np.ndarray], one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Sizes of all intersections of some sets with some others, by products of incidence blocks."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, which, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.cumsum(counts > 1) - 1  # a shingle of one set alone adds to no intersection
    owner, which = owner[counts[which] > 1], shared[which[counts[which] > 1]]
    order = np.argsort(which, kind="stable")
    owner, which = owner[order], which[order]
    total = np.zeros((len(one), len(two)), np.float32)
    for at in range(0, int(which[-1]) + 1 if len(which) else 0, _SHARED):
        own = slice(*np.searchsorted(which, (at, at + _SHARED)))
        block = np.zeros((len(sets), _SHARED), np.float32)
        block[owner[own], which[own] - at] = 1
        total += block[one] @ block[two].T
    return total


def _cell_links(table: pa.Table, percent: int) -> pa.Table:
    """Links between members of different groups in two blocks of a bucket: a forest of them."""
    low, high = table["low"][0].as_py(), table["high"][0].as_py()
    block, cls, group = (table[c].to_numpy() for c in ("block", "cls", "component"))
    size = table["n"].to_numpy()
    one, two = np.flatnonzero(block == low), np.flatnonzero(block == high)
    small, large = np.minimum.outer(size[one], size[two]), np.maximum.outer(size[one], size[two])
    open_ = (group[one][:, None] != group[two][None, :]) & (100 * small >= percent * large)
    if low == high:
        open_ = np.triu(open_)
    some, others = np.flatnonzero(open_.any(axis=1)), np.flatnonzero(open_.any(axis=0))
    a, b = [], []
    if len(some):
        one, two = one[some], two[others]
        members = np.unique(np.concatenate([one, two]))
        sets = [np.frombuffer(s, np.uint64) for s in table["shingles"].take(pa.array(members)).to_pylist()]
        both = _overlaps(sets, np.searchsorted(members, one), np.searchsorted(members, two))
        either = size[one][:, None] + size[two][None, :] - both
        rows, columns = np.nonzero(open_[np.ix_(some, others)] & (100 * both >= percent * either))
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while parent.setdefault(x, x) != x:
                x = parent[x]
            return x

        for i, j in zip(one[rows].tolist(), two[columns].tolist(), strict=True):
            first, second = find(int(group[i])), find(int(group[j]))
            if first != second:
                parent[max(first, second)] = min(first, second)
                a.append(cls[i])
                b.append(cls[j])
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def link_documents(
    docs: DataFrame,
    staging: Staging,
    *,
    id: str = "doc_id",
    text: str = "text",
    shingle: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
    marks: bool = False,
) -> DataFrame:
    """Groups of documents whose shingle sets overlap by ``percent`` of their union or more.

    Documents with equal sets are one class. Circulant MinHash signatures are cut into bands, and
    classes that agree in a band share a bucket. Every class is first compared, on the full sets,
    with one least class of its buckets, then with the least class of every bucket in which the
    two are not in one group yet; a bucket costs at most as many comparisons as it has members.
    Where a bucket still holds several groups, members of different groups are compared in cells
    of two bounded blocks, each of which gives a forest of the links it finds; the blocks of the
    largest group there only meet those of the others. So no pair that
    shares a bucket goes unchecked unless its documents are connected already, and pairs inside a
    large group of copies are never made.

    With the default bands a pair at exactly 0.8 shares no bucket with a probability of 2e-5, and
    less above. Returns ``doc_id``, ``n_shingles``, ``component_id`` (least doc_id of the group)
    and ``kept``. Null and empty texts, and those without words, have no shingles and link with
    nothing. Rows that share an id and the text link as copies. A null id stays null, loses to any
    other as component_id, and is kept only if its group has no other id.

    With ``marks`` there are also ``mark`` (`text_mark` of the row's text) and ``chosen``: true for
    one document of each group, the least by (doc_id, mark) with null ids last, and for exact
    repeats of its row, with the same id and text. It is true for rows that have no shingles.
    """
    plain = _plain(docs, id, text)
    sketched = staging.write(_sketches(plain, shingle, bands, rows), "sketches")
    classes = (
        sketched.filter("n > 0")
        .groupBy("d1", "d2", "n")
        .agg(F.min(_first("doc_id", "mark")).alias("first"), F.first("keys").alias("keys"), F.count("*").alias("copies"))
        .withColumn("cls", F.monotonically_increasing_id())
    )
    classes = staging.write(classes, "classes")
    entries = classes.select("cls", "n", F.explode("keys").alias("key"))
    buckets = (
        entries.groupBy("key")
        .agg(F.count("*").alias("members"), F.min(F.struct("cls", "n")).alias("least"))
        .filter("members > 1")
        .select("key", F.col("least.cls").alias("b"), F.col("least.n").alias("n_b"))
    )
    members = staging.write(
        entries.join(buckets, "key").filter("cls <> b").select("key", F.col("cls").alias("a"), "b", "n", "n_b"),
        "members",
    )
    sets = staging.write(_sets(plain, classes, _ends(members), shingle), "sets")
    near = (F.col("n") * 100 >= F.col("n_b") * percent) & (F.col("n_b") * 100 >= F.col("n") * percent)
    first = members.filter(near).groupBy("a").agg(F.min("b").alias("b"))
    first = staging.write(first, "pairs")
    links = staging.write(_linked(first, sets, percent), "links")
    groups = staging.write(_grouped(classes, links, staging), "groups")

    apart = (
        members.filter(near)
        .join(groups.select(F.col("cls").alias("a"), F.col("component").alias("group_a")), "a")
        .join(groups.select(F.col("cls").alias("b"), F.col("component").alias("group_b")), "b")
        .filter("group_a <> group_b")
    )
    second = staging.write(apart.select("a", "b").distinct().join(first, ["a", "b"], "left_anti"), "pairs")
    links = links.unionByName(staging.write(_linked(second, sets, percent), "links"))
    groups = staging.write(_grouped(classes, links, staging), "groups")

    rest = entries.join(groups, "cls")
    mixed = (
        rest.groupBy("key")
        .agg(F.count("*").alias("members"), F.min("component").alias("least"), F.max("component").alias("most"))
        .filter("members > 2 and least <> most")  # two members have been compared
        .select("key")
    )
    rest = staging.write(rest.join(mixed, "key"), "rest")
    # No pair inside one group is needed, so the blocks of a bucket's largest group only meet the
    # blocks of all others, numbered from 0 on; these meet each other too.
    groups_in = rest.groupBy("key", "component").agg(F.count("*").alias("size"))
    largest = groups_in.groupBy("key").agg(F.max(F.struct("size", "component")).alias("hub"), F.sum("size").alias("all"))
    hubs = F.ceil(F.col("hub.size") / GRID).cast("int")
    others = F.ceil((F.col("all") - F.col("hub.size")) / GRID).cast("int")
    draw, in_hub = F.xxhash64("cls"), F.col("component") == F.col("hub.component")
    block = F.when(in_hub, others + F.pmod(draw, hubs)).otherwise(F.pmod(draw, others)).cast("int")
    last = F.when(in_hub, others).otherwise(others + hubs) - 1
    celled = (
        rest.join(largest, "key")
        .select("key", "cls", "component", "n", block.alias("block"), F.explode(F.sequence(F.lit(0), last)).alias("partner"))
        .withColumn("low", F.least("block", "partner"))
        .withColumn("high", F.greatest("block", "partner"))
        .join(sets, "cls")
        .select("key", "cls", "component", "n", "block", "low", "high", "shingles")
    )
    found = celled.groupBy("key", "low", "high").applyInArrow(lambda t: _cell_links(t, percent), "a long, b long")
    groups = components(links.unionByName(staging.write(found.distinct(), "links")), staging)
    staging.remove(members, sets, first, second, rest)
    joined = classes.join(groups.withColumnRenamed("node", "cls"), "cls", "left").withColumn(
        "component", F.coalesce("component", "cls")
    )
    least = joined.groupBy("component").agg(F.min("first").alias("least"))
    known = joined.join(least, "component").select("d1", "d2", "n", "least")
    own = ["doc_id", "n", "mark"]
    out = sketched.select(*own, "d1", "d2")
    linked = out.filter("n > 0").join(known, ["d1", "d2", "n"]).select(*own, "least")
    alone = out.filter("n = 0").select(*own, _first("doc_id", "mark").alias("least"))
    kept = F.col("doc_id").eqNullSafe(F.col("least.doc_id"))
    return linked.unionByName(alone).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.col("least.doc_id").alias("component_id"),
        kept.alias("kept"),
        *(["mark", (kept & F.col("mark").eqNullSafe(F.col("least.mark"))).alias("chosen")] if marks else []),
    )
