"""Language identification with a byte convolutional network."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTHS = (2, 3, 4)
UNKNOWN = "und"


class ByteCNN:
    """Byte embedding, filters of several widths, max pooling over the window, softmax."""

    def __init__(self, languages: list[str], window: int, filters: int = 16, size: int = 8, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.languages, self.window, self.filters, self.size = languages, window, filters, size
        top, total = max(WIDTHS), filters * len(WIDTHS)
        # One filter bank of the largest width; narrower filters are zero beyond their own width.
        self.mask = np.zeros((top * size, total), np.float32)
        for i, width in enumerate(WIDTHS):
            self.mask[: width * size, i * filters : (i + 1) * filters] = 1
        self.params = {
            "embed": draw.normal(0, 0.5, (256, size)).astype(np.float32),
            "conv": (draw.normal(0, 0.3, self.mask.shape) * self.mask).astype(np.float32),
            "bias": np.zeros(total, np.float32),
            "out": draw.normal(0, 0.1, (total, len(languages))).astype(np.float32),
            "shift": np.zeros(len(languages), np.float32),
        }

    def _columns(self, windows: np.ndarray) -> np.ndarray:
        n, top = len(windows), max(WIDTHS)
        embedded = self.params["embed"][windows]
        view = np.lib.stride_tricks.sliding_window_view(embedded.reshape(n, -1), top * self.size, axis=1)
        return np.ascontiguousarray(view[:, :: self.size])

    def logits(self, windows: np.ndarray) -> np.ndarray:
        p, total = self.params, self.filters * len(WIDTHS)
        out = np.empty((len(windows), len(self.languages)), np.float32)
        for at in range(0, len(windows), 128):
            columns = self._columns(windows[at : at + 128])
            n, steps, _ = columns.shape
            found = (columns.reshape(n * steps, -1) @ p["conv"]).reshape(n, steps, total)
            out[at : at + 128] = np.maximum(found.max(axis=1) + p["bias"], 0) @ p["out"] + p["shift"]
        return out

    def fit(self, windows: np.ndarray, labels: np.ndarray, epochs: int = 8, rate: float = 0.01, seed: int = 7):
        """Adam on the cross entropy, over windows in a fixed random order."""
        draw, p, top, size = np.random.default_rng(seed), self.params, max(WIDTHS), self.size
        mean = {k: np.zeros_like(v) for k, v in p.items()}
        square = {k: np.zeros_like(v) for k, v in p.items()}
        step = 0
        for epoch in range(epochs):
            order = draw.permutation(len(windows))
            for at in range(0, len(order), 32):
                own = order[at : at + 32]
                x, y = windows[own], labels[own]
                columns = self._columns(x)
                n, steps, _ = columns.shape
                found = columns.reshape(n * steps, -1) @ p["conv"]
                found = found.reshape(n, steps, -1)
                where = found.argmax(axis=1)
                pooled = np.take_along_axis(found, where[:, None, :], 1)[:, 0] + p["bias"]
                active = np.maximum(pooled, 0)
                scores = active @ p["out"] + p["shift"]
                scores = np.exp(scores - scores.max(axis=1, keepdims=True))
                error = scores / scores.sum(axis=1, keepdims=True)
                error[np.arange(n), y] -= 1
                error /= n
                back = (error @ p["out"].T) * (pooled > 0)
                rows = columns[np.arange(n)[:, None], where]  # window, filter, bytes x size
                grads = {
                    "out": active.T @ error,
                    "shift": error.sum(axis=0),
                    "bias": back.sum(axis=0),
                    "conv": np.einsum("nf,nfk->kf", back, rows) * self.mask,
                    "embed": np.zeros_like(p["embed"]),
                }
                to_bytes = (back[:, :, None] * p["conv"].T[None]).reshape(n, -1, top, size)
                seen = x[np.arange(n)[:, None, None], where[:, :, None] + np.arange(top)]
                np.add.at(grads["embed"], seen, to_bytes)
                step += 1
                speed = rate * (1 - epoch / epochs) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                for k, g in grads.items():
                    mean[k] += 0.1 * (g - mean[k])
                    square[k] += 0.001 * (g * g - square[k])
                    p[k] -= (speed * mean[k] / (np.sqrt(square[k]) + 1e-7)).astype(np.float32)
        return self


def cut(text: bytes, window: int) -> np.ndarray:
    """All windows of a text, the last one ending at its end; a short text is padded with zeros."""
    data = np.frombuffer(text, np.uint8)
    if len(data) <= window:
        return np.pad(data, (0, window - len(data)))[None]
    whole = len(data) // window
    out = data[: whole * window].reshape(whole, window)
    return out if whole * window == len(data) else np.vstack([out, data[-window:]])


def train_language_model(
    docs: DataFrame,
    learn: Column,
    *,
    text: str = "text",
    lang: str = "lang",
    window: int = 128,
    per_language: int = 1500,
) -> ByteCNN:
    """Fit the network on about ``per_language`` windows of each language among rows where ``learn``.

    The sample is bounded by that parameter times the number of languages: different texts are drawn at
    a rate that follows from how many each language has, by a hash of the text, and a drawn text gives one
    window at a place its hash chooses, however many copies of it there are. Null texts and languages, and texts without a letter, are
    not learned from. Without any row to learn from, every prediction is ``und``.
    """
    usable = learn & F.col(f"`{lang}`").isNotNull() & F.col(f"`{text}`").rlike(r"\p{L}")
    rows = docs.filter(usable).select(
        F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"), F.xxhash64(f"`{text}`").alias("h")
    )
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("h", 0.01).alias("n")).collect()}
    if not counts:
        return ByteCNN([UNKNOWN], window)
    spot = F.pmod("h", F.lit(1_000_000_007))
    drawn = F.lit(False)
    for name, n in counts.items():
        share = min(1.0, per_language / n)
        drawn |= (F.col("lang") == name) & (spot < int(share * 1_000_000_007) + 1)
    place = 1 + F.pmod(F.shiftright("h", 20), F.greatest(F.length("text") - window, F.lit(1)))
    piece = F.lower(F.substr("text", place.cast("int"), F.lit(window)))
    found = rows.filter(drawn).groupBy("lang", "h").agg(F.min(piece).alias("piece")).collect()  # copies fold in their tasks
    sample = sorted((r["lang"], r["piece"]) for r in found)
    languages = sorted(counts)
    windows = np.vstack([cut(p.encode()[:window], window) for _, p in sample])
    labels = np.array([languages.index(name) for name, _ in sample])
    return ByteCNN(languages, window).fit(windows, labels)


def predict_language(
    docs: DataFrame, model: ByteCNN, *, id: str = "doc_id", text: str = "text", also: dict[str, Column] | None = None
) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` of every whole text, with further columns ``also``.

    A text is lower-cased and cut into windows of fixed length; the network runs over batches of
    windows, and a text's scores are the softmax of the mean over all its windows. ``score`` is
    the probability of ``lang_pred``. A null text, or one without a letter, is ``und`` with score 0.
    Repeated rows are predicted alike, of equal scores the first language in order of its name wins, a null id
    stays null, and an empty table gives an empty result; other columns are ignored.
    """
    also = also or {}
    has_letter = F.coalesce(F.col(f"`{text}`").rlike(r"\p{L}"), F.lit(False))
    plain = docs.select(
        F.when(has_letter, F.lower(F.col(f"`{text}`"))).cast("binary").alias("text"),
        F.col(f"`{id}`").cast("long").alias("doc_id"),
        *[c.alias(name) for name, c in also.items()],
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))

            def settle(rows: list[int], windows: list[np.ndarray], names=names, scores=scores) -> None:
                logits = model.logits(np.vstack(windows)).astype(np.float64)
                ends = np.cumsum([len(w) for w in windows])
                for row, low, high in zip(rows, [0, *ends[:-1]], ends, strict=True):
                    odds = logits[low:high].mean(axis=0)
                    chance = np.exp(odds - odds.max())
                    names[row] = model.languages[int(chance.argmax())]
                    scores[row] = chance.max() / chance.sum()

            rows, windows, size = [], [], 0
            for i, t in enumerate(texts):
                if t is None or model.languages == [UNKNOWN]:
                    continue
                rows.append(i)
                windows.append(cut(t, model.window))
                size += len(windows[-1])
                if size >= 4096:
                    settle(rows, windows)
                    rows, windows, size = [], [], 0
            if rows:
                settle(rows, windows)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(names), pa.array(scores)], [*batch.schema.names[1:], "lang_pred", "score"]
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema[1:])
    return plain.mapInArrow(run, f"{schema}, lang_pred string, score double")
