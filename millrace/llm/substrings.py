"""Substring deduplication: words covered by windows that occur again are removed."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.chunks import (
    CHUNK_BYTES,
    PARTS_TYPE,
    Chunk,
    Repeats,
    by_shard,
    note_batch,
    over_chunks,
    pack,
    split_note,
    to_chunks,
    total_bytes,
)
from millrace.llm.hashing import Windows, cover, runs_of, word_hashes, words
from millrace.staging import Staging

_OUT = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64())])


def level_lengths(window: int, least: int = 9) -> list[int]:
    """Window lengths that at most double from one level to the next and end at ``window``."""
    lengths = [window]
    while lengths[0] > least:
        lengths.insert(0, -(-lengths[0] // 2))
    return lengths


class _Words:
    """A chunk's words, their window hashes and the bounds of each document among them."""

    def __init__(self, chunk: Chunk):
        starts, ends = words(chunk.data)
        self._make = lambda seed: Windows(word_hashes(chunk.data, starts, ends, seed))
        self._windows: dict[int, Windows] = {}
        self.first = np.searchsorted(starts, chunk.start)
        self.counts = np.searchsorted(starts, chunk.end) - self.first
        self.left = np.repeat(self.first + self.counts, self.counts) - np.arange(len(starts))

    def windows(self, at: np.ndarray, length: int, seed: int) -> np.ndarray:
        if seed not in self._windows:
            self._windows[seed] = self._make(seed)
        return self._windows[seed](length)[at]


class _Level:
    """One exchange: windows of some length are asked about, by hashes of a seed."""

    def __init__(self, length: int, seed: int, keys: Repeats):
        self.length, self.seed, self.keys = length, seed, keys

    def places(self, whole: np.ndarray, window: int) -> np.ndarray:
        """Where the level's windows start that lie inside a candidate of the full length."""
        return np.flatnonzero(cover(np.flatnonzero(whole), window - self.length + 1, len(whole)))

    def ask(self, chunk: Chunk, text: _Words, whole: np.ndarray, window: int) -> Iterator[pa.RecordBatch]:
        """Questions for the shards, and the candidates as a note; nothing if there are none."""
        if whole.any():
            yield note_batch(chunk, np.packbits(whole))
            yield from self.keys.ask(chunk, text.windows(self.places(whole, window), self.length, self.seed))

    def left(self, text: _Words, window: int, reply: list[tuple[int, bytes]]) -> np.ndarray:
        """Which of the candidates in the note are left after the answers.

        A window of the full length can only occur again if each shorter window in it does, so a
        level keeps just the windows inside such stretches.
        """
        size = len(text.left)
        note, reply = split_note(reply)
        if note is None:
            return np.zeros(size, bool)
        whole = np.unpackbits(note[0], count=size).astype(bool)
        at = self.places(whole, window)
        repeated = np.zeros(size, bool)
        repeated[at], _ = self.keys.flags(text.windows(at, self.length, self.seed), reply)
        return whole & runs_of(repeated, window - self.length + 1)


def remove_repeated_windows(
    docs: DataFrame, staging: Staging, *, id: str = "doc_id", text: str = "text", window: int = 35,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Remove every word that lies in a ``window``-word sequence found more than once.

    Levels of doubling window length: on the first, all windows of about a quarter of the length
    are exchanged; a longer window is asked about only where all shorter ones inside it are
    repeated, and nothing is sent once no candidate is left. Short windows travel as a few bits
    more than their number needs, the full length as 64-bit hashes of windows whose halves are
    both known to repeat. What these call repeated is asked once more by independent 64-bit hashes, so
    a window is removed by 128 bits. The candidates left travel with the answers, so no level is worked out twice.

    Returns one row per row: ``doc_id``, ``text`` (kept words joined by one space), ``n_words``,
    ``n_removed``. Null and empty texts have no words and give an empty text; a null id stays
    null. Texts of any length are processed whole; one longer than a chunk is a chunk of its own. Repeated
    rows are documents of their own, so their windows count as repeats. An empty table gives an empty
    result. Other columns are ignored, whatever their names.
    """
    steps = [(length, 0) for length in level_lengths(window)] + [(window, 1)]
    packed = pack(docs, staging, id, text, chunk_bytes)
    size = total_bytes(packed)
    few = min(64, max(40, math.ceil(math.log2(size + 1)) + 8))
    last: _Level | None = None
    answers: list[DataFrame] = []  # of the last level alone; what was known before is in the notes
    for i, (length, seed) in enumerate(steps):
        level = _Level(length, seed, Repeats(size // 6, 64 if length == window else min(64, few + 8 * i)))

        def ask(chunk: Chunk, replies: list, level=level, last=last):
            if last is None or replies[0]:
                found = _Words(chunk)
                whole = found.left >= window if last is None else last.left(found, window, replies[0])
                yield from level.ask(chunk, found, whole, window)

        parts = over_chunks(packed, ask, PARTS_TYPE, answers)
        answers = [to_chunks(by_shard(parts, level.keys.reduce), staging)]
        last = level

    def finish(chunk: Chunk, replies: list) -> Iterator[pa.RecordBatch]:
        found = _Words(chunk)
        whole = last.left(found, window, replies[0])
        removed = cover(np.flatnonzero(whole), window, len(whole))
        gone = np.zeros(len(removed) + 1, np.int64)
        np.cumsum(removed, out=gone[1:])
        n_removed = gone[found.first + found.counts] - gone[found.first]
        texts = []
        for i in range(len(chunk)):
            kept = chunk.text(i).split()
            if n_removed[i]:
                kept = compress(kept, ~removed[found.first[i] : found.first[i] + found.counts[i]])
            texts.append(b" ".join(kept))
        yield pa.RecordBatch.from_arrays(
            [chunk.id_array(), pa.array(texts, pa.binary()).view(pa.string()), pa.array(found.counts), pa.array(n_removed)],
            schema=_OUT,
        )

    return over_chunks(packed, finish, "doc_id long, text string, n_words long, n_removed long", answers)
