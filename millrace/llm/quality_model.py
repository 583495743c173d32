"""A quality classifier over random-indexing word vectors, with calibrated probabilities."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.hashing import word_hashes

WORDS = 1 << 15  # words with a vector of their own: the most frequent ones
LEAST = 5  # times that a word must occur for one
DIMS, NEIGHBOURS = 32, 2
FEATURES = 2 * DIMS + 5
_PIECE = 4 << 20  # bytes of text taken at a time, whole texts
_SPLIT = 1 << 17  # tokens whose vectors are held at a time
_COUNTED = 1 << 20  # different words that a task counts before it sends them on
_DRAW = 1_000_000_007

# Words are runs of letters (every byte above 127 counts as one), of digits, or of other signs.
_KIND = np.full(256, 3, np.uint8)
_KIND[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
_KIND[0x30:0x3A] = 2
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = _KIND[0x80:] = 1


class Tokens:
    """The words of some texts: their hashes, the text of each, and how many each text has."""

    def __init__(self, texts: list[bytes | None]):
        data = np.frombuffer(b"".join((t or b"") + b"\n" for t in texts), np.uint8)
        kind = _KIND[data]
        edge = np.flatnonzero(np.append(True, kind[1:] != kind[:-1])) if len(kind) else np.zeros(0, np.int64)
        starts, ends = edge, np.append(edge[1:], len(data))
        word = kind[starts] != 0
        starts, ends = starts[word], ends[word]
        self.hash = word_hashes(data, starts, ends)
        close = np.cumsum([len(t or b"") + 1 for t in texts])
        self.text = np.searchsorted(close, starts, "right")
        self.counts = np.bincount(self.text, minlength=len(texts))


def pieces(texts: list[bytes | None]) -> Iterator[slice]:
    """Consecutive texts of a few megabytes together; a longer one is a piece of its own."""
    at = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t or b"") > _PIECE:
            yield slice(at, i)
            at, size = i, 0
        size += len(t or b"") + 1
    if at < len(texts):
        yield slice(at, len(texts))


def index_vector(word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The index vectors of words, drawn by their hashes: the place of the +1 and the place of the -1."""
    plus = (word % np.uint64(DIMS)).astype(np.int64)
    return plus, (plus + 1 + ((word >> np.uint64(32)) % np.uint64(DIMS - 1)).astype(np.int64)) % DIMS


@dataclass
class WordVectors:
    """Unit vectors of words in order of their hashes, and a zero vector for all other words at the end."""

    words: np.ndarray
    vectors: np.ndarray

    def number(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.words, hashes)
        known = at < len(self.words)
        known[known] = self.words[at[known]] == hashes[known]
        return np.where(known, at, len(self.words))


def _frequent(plain: DataFrame, most: int) -> np.ndarray:
    """Hashes of the ``most`` most frequent words, in order; every text is counted whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts, size = [], [], 0

        def fold() -> tuple[np.ndarray, np.ndarray]:
            kinds, place = np.unique(np.concatenate(words), return_inverse=True)
            return kinds, np.bincount(place, np.concatenate(counts)).astype(np.int64)

        def row(kinds: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(kinds.view(np.int64)), pa.array(n)], ["word", "n"])

        for batch in batches:
            texts = batch.column(0).to_pylist()
            for piece in pieces(texts):
                kinds, n = np.unique(Tokens(texts[piece]).hash, return_counts=True)
                words.append(kinds)
                counts.append(n)
                size += len(kinds)
                if size > 2 * _COUNTED:
                    kinds, n = fold()
                    if len(kinds) > _COUNTED:
                        yield row(kinds, n)
                        kinds, n = kinds[:0], n[:0]
                    words, counts, size = [kinds], [n], len(kinds)
        if size:
            yield row(*fold())

    found = plain.mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST)
    rows = found.orderBy(F.desc("n"), "word").limit(most).select("word").toArrow()  # the vocabulary, of a bounded size
    return np.sort(rows["word"].to_numpy().view(np.uint64))


def word_vectors(docs: DataFrame, *, text: str = "text", most: int = WORDS) -> WordVectors:
    """Random-indexing vectors of the ``most`` most frequent words that occur ``LEAST`` times or more.

    Words are whole, and as they are written. Every word of any frequency has an index vector drawn
    by its hash; each task adds up, for the words of the vocabulary, the index vectors of their
    neighbours over all its texts, and Spark adds up the tasks. Only the vocabulary and its vectors,
    ``most`` rows at most, reach the driver. Null and empty texts have no words, repeated rows
    count again, and an empty table gives no vectors; other columns are ignored.
    """
    plain = docs.select(F.col(f"`{text}`").cast("binary").alias("text"))
    known = WordVectors(_frequent(plain, most), np.zeros((0, DIMS)))
    n = len(known.words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n + 1) * DIMS, np.int64)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for piece in pieces(texts):
                tokens = Tokens(texts[piece])
                number, (plus, minus) = known.number(tokens.hash), index_vector(tokens.hash)
                for step in range(1, NEIGHBOURS + 1):
                    near = np.flatnonzero(tokens.text[step:] == tokens.text[:-step])
                    for own, other in ((near, near + step), (near + step, near)):
                        row = number[own] * DIMS
                        total += np.bincount(row + plus[other], minlength=total.size)
                        total -= np.bincount(row + minus[other], minlength=total.size)
        rows = total.reshape(-1, DIMS)[:n]
        met = np.flatnonzero(rows.any(axis=1))
        if len(met):
            columns = [pa.array(met)] + [pa.array(rows[met, i]) for i in range(DIMS)]
            yield pa.RecordBatch.from_arrays(columns, ["number", *[f"v{i}" for i in range(DIMS)]])

    sums = ", ".join(f"v{i} long" for i in range(DIMS))
    found = (
        plain.mapInArrow(run, f"number long, {sums}")
        .groupBy("number")
        .agg(*[F.sum(f"v{i}").alias(f"v{i}") for i in range(DIMS)])
        .toArrow()  # at most a row for each word of the vocabulary
    )
    known.vectors = np.zeros((n + 1, DIMS))
    if len(found):
        own = np.stack([found[f"v{i}"].to_numpy() for i in range(DIMS)], axis=1).astype(np.float64)
        length = np.sqrt((own * own).sum(axis=1, keepdims=True))
        known.vectors[found["number"].to_numpy()] = own / np.maximum(length, 1e-9)
    return known


def pooled(texts: list[bytes | None], vectors: WordVectors) -> np.ndarray:
    """Each whole text's word vectors pooled: their mean and spread, and how alike neighbours are.

    The last places hold the concentration of the words, the mean products of vectors one and two
    words apart, the share of words without a vector, and the length.
    """
    out = np.zeros((len(texts), FEATURES))
    for piece in pieces(texts):
        tokens = Tokens(texts[piece])
        number, text, n = vectors.number(tokens.hash), tokens.text, tokens.counts
        own = out[piece]
        sums, squares, alike = np.zeros((len(n), DIMS)), np.zeros((len(n), DIMS)), np.zeros((2, len(n)))
        for at in range(0, len(text), _SPLIT):
            end = min(at + _SPLIT, len(text))
            v = vectors.vectors[number[at : end + 2]]
            t = text[at:end]
            first = np.flatnonzero(np.append(True, t[1:] != t[:-1]))
            sums[t[first]] += np.add.reduceat(v[: end - at], first, axis=0)
            squares[t[first]] += np.add.reduceat(v[: end - at] ** 2, first, axis=0)
            for step in (1, 2):
                last = min(end, len(text) - step) - at
                if last > 0:
                    product = np.einsum("ij,ij->i", v[:last], v[step : step + last])
                    product *= text[at : at + last] == text[at + step : at + step + last]
                    alike[step - 1] += np.bincount(text[at : at + last], product, minlength=len(n))
        # Runs of one word among the sorted words of a text.
        order = np.lexsort((tokens.hash, text))
        word, t = tokens.hash[order], text[order]
        first = np.flatnonzero(np.append(True, (word[1:] != word[:-1]) | (t[1:] != t[:-1]))) if len(t) else np.zeros(0, np.int64)
        times = np.diff(np.append(first, len(t))).astype(np.float64)
        often = np.bincount(t[first], times * times, minlength=len(n)) if len(t) else np.zeros(len(n))
        some = np.maximum(n, 1)
        mean = sums / some[:, None]
        own[:, :DIMS] = mean
        own[:, DIMS : 2 * DIMS] = np.sqrt(np.maximum(squares / some[:, None] - mean * mean, 0))
        own[:, -5] = np.sqrt(often) / some
        for step in (1, 2):
            own[:, -5 + step] = alike[step - 1] / np.maximum(n - step, 1)
        own[:, -2] = np.bincount(text[number == len(vectors.words)], minlength=len(n)) / some
        own[:, -1] = np.log1p(n) / 10
    return out


class TwoLayerNet:
    """Standardised inputs, a hidden layer of tanh units, a logit divided by a temperature."""

    def __init__(self, size: int, hidden: int = 32, seed: int = 11):
        draw = np.random.default_rng(seed)
        self.mean, self.scale, self.temperature = np.zeros(size), np.ones(size), 1.0
        self.params = {
            "w1": draw.normal(0, size**-0.5, (size, hidden)),
            "b1": np.zeros(hidden),
            "w2": draw.normal(0, hidden**-0.5, hidden),
            "b2": np.zeros(1),
        }

    def logits(self, x: np.ndarray) -> np.ndarray:
        p = self.params
        return np.tanh(((x - self.mean) / self.scale) @ p["w1"] + p["b1"]) @ p["w2"] + p["b2"]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 30, rate: float = 0.01, decay: float = 1e-4):
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        z, p = (x - self.mean) / self.scale, self.params
        draw, step = np.random.default_rng(3), 0
        m, v = ({k: np.zeros_like(a) for k, a in p.items()} for _ in range(2))
        for epoch in range(epochs):
            order = draw.permutation(len(z))
            for at in range(0, len(order), 64):
                own, step = order[at : at + 64], step + 1
                hidden = np.tanh(z[own] @ p["w1"] + p["b1"])
                error = (1 / (1 + np.exp(-np.clip(hidden @ p["w2"] + p["b2"], -40, 40))) - y[own]) / len(own)
                back = error[:, None] * p["w2"] * (1 - hidden * hidden)
                grads = {"w1": z[own].T @ back, "b1": back.sum(axis=0), "w2": hidden.T @ error}
                grads["b2"] = error.sum(keepdims=True)
                speed = rate * (1 - epoch / epochs) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                for k, g in grads.items():
                    g = g + decay * p[k]
                    m[k] += 0.1 * (g - m[k])
                    v[k] += 0.001 * (g * g - v[k])
                    p[k] -= speed * m[k] / (np.sqrt(v[k]) + 1e-8)
        return self

    def calibrate(self, x: np.ndarray, y: np.ndarray):
        """The temperature with the least log loss on rows that the weights were not fitted to."""
        logits = self.logits(x)
        grid = np.exp(np.linspace(-2, 3, 101))
        loss = [np.logaddexp(0, np.where(y > 0, -logits, logits) / t).mean() for t in grid]
        self.temperature = float(grid[int(np.argmin(loss))])
        return self


def train_quality_model(
    docs: DataFrame,
    labels: DataFrame,
    vectors: WordVectors,
    learn: Column,
    *,
    id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample: int = 20_000,
) -> TwoLayerNet:
    """Fit the network on about ``sample`` labelled ids for which ``learn`` holds.

    The ids are drawn by a hash at a rate that follows from their count. Four of five fit the
    weights, the fifth the temperature. Null ids and labels are not learned from; an id with
    several labels takes the one that most have (1 if as many have either), and one with several rows,
    repeated or not, is learned from once. Texts are read whole, null ones as empty. Without
    labels or documents every text gets one half. Other columns are ignored.
    """
    known = (
        labels.filter(learn & F.col(f"`{id}`").isNotNull() & F.col(f"`{label}`").isNotNull())
        .groupBy(F.col(f"`{id}`").cast("long").alias("id"))
        .agg((F.avg(F.col(f"`{label}`").cast("double")) >= 0.5).cast("int").alias("y"))
    )
    n = known.count()
    net = TwoLayerNet(FEATURES)
    if not n:
        net.params["w2"][:] = 0
        return net
    draw = F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(_DRAW))
    known = known.filter(draw < int(min(1.0, sample / n) * _DRAW) + 1)
    plain = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{text}`").cast("binary").alias("text"))
    rows = plain.join(F.broadcast(known), "id").select("id", "y", "text")  # the sample's size is bounded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x.tobytes() for x in pooled(batch.column(2).to_pylist(), vectors)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], ["id", "y", "x"])

    once = rows.mapInArrow(run, "id long, y int, x binary").groupBy("id", "y").agg(F.min("x").alias("x"))
    found = sorted(tuple(r) for r in once.collect())  # a row for each drawn id
    if not found:
        net.params["w2"][:] = 0
        return net
    x = np.array([np.frombuffer(r[2]) for r in found])
    y = np.array([r[1] for r in found], np.float64)
    held = np.array([zlib.crc32(b"fold %d" % r[0]) % 5 == 0 for r in found])
    if held.all() or not held.any():
        return net.fit(x, y)
    return net.fit(x[~held], y[~held]).calibrate(x[held], y[held])


def score_quality(
    docs: DataFrame, vectors: WordVectors, net: TwoLayerNet, *, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id`` and ``score`` of every row: the calibrated probability of label 1 for the whole text.

    Null and empty texts have no words and get the score of a text without words; very long ones are read
    whole, a bounded number of words at a time. Repeated rows get equal scores, a null id stays null, an
    empty table gives an empty result, and other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                scores = net(pooled(batch.column(1).to_pylist(), vectors))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["doc_id", "score"])

    plain = docs.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("text"))
    return plain.mapInArrow(run, "doc_id long, score double")
