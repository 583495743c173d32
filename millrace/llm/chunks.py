"""Documents packed into chunks, and an exchange of sorted hashes between chunks.

A chunk is one row that holds a few megabytes of whole documents, compressed. Chunks are written
once to the shared folder, so their ids and contents are the same in every later pass and after
the loss of an executor.

The exchange asks, for every distinct hash of a chunk, what the other chunks know of it. A chunk
sends its hashes sorted and delta-coded, cut into shards of the hash range; a shard answers each
chunk in the chunk's own order. A hash crosses the network in two to six bytes and at most once
for each chunk, however often it occurs, so a very frequent value loads no task. Shards are as
many as the data asks for, so a shard is of bounded size. What a chunk has worked out already it may
send along as a note to itself, which comes back among the answers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.staging import Staging

#: Stands for a null doc_id inside chunks; it orders before every other id.
NULL_ID = -(1 << 63)
CHUNK_BYTES = 4 << 20
SHARD_KEYS = 2 << 20

_CHUNK = "chunk long, n_bytes long, ids binary, lengths binary, body binary, rest binary"
_CHUNK_ARROW = pa.schema(
    [("chunk", pa.int64()), ("n_bytes", pa.int64())]
    + [(name, pa.binary()) for name in ("ids", "lengths", "body", "rest")]
)
PARTS = pa.schema([("shard", pa.int64()), ("chunk", pa.int64()), ("part", pa.binary())])
PARTS_TYPE = "shard long, chunk long, part binary"


class Chunk:
    """Whole documents, one after the other; a line break follows each text.

    ``present`` is false for null texts. ``start`` and ``end`` bound each text in ``body``.
    """

    def __init__(self, number: int, ids: bytes, lengths: bytes, body: bytes, rest: bytes | None):
        self.number = number
        self.ids = np.frombuffer(ids, np.int64)
        size = np.frombuffer(lengths, np.int64)
        self.present = size >= 0
        self.end = np.cumsum(np.maximum(size, 0) + 1) - 1
        self.start = self.end - np.maximum(size, 0)
        self.body = zstandard.decompress(body)
        self.data = np.frombuffer(self.body, np.uint8)
        self._rest = rest

    def __len__(self) -> int:
        return len(self.ids)

    def text(self, i: int) -> bytes:
        return self.body[self.start[i] : self.end[i]]

    def id_array(self) -> pa.Array:
        return pa.array(self.ids, mask=self.ids == NULL_ID)

    def rest(self) -> pa.Array:
        """The columns that were packed along, as a struct column in document order."""
        return pa.ipc.open_stream(self._rest).read_all().combine_chunks().to_struct_array().combine_chunks()


def pack(
    docs: DataFrame,
    staging: Staging,
    id: str = "doc_id",
    text: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Write ``docs`` as chunks of about ``chunk_bytes``; a longer text is a chunk of its own.

    ``carry`` names columns that travel along unread, whatever they are called.
    """
    from_docs = docs.select(
        F.col(f"`{id}`").cast("long").alias("a"),
        F.col(f"`{text}`").cast("binary").alias("b"),
        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)],
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        zip_ = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            ids = batch.column(0).fill_null(NULL_ID).to_numpy()
            texts = batch.column(1).to_pylist()
            size = np.array([-1 if t is None else len(t) for t in texts], np.int64)
            at = 0
            while at < len(texts):
                upto = int(np.searchsorted(np.cumsum(size[at:] + 1), chunk_bytes, "right")) + at
                upto = max(upto, at + 1)
                body = b"".join((t or b"") + b"\n" for t in texts[at:upto])
                rest = None
                if carry:
                    sink = pa.BufferOutputStream()
                    part = batch.slice(at, upto - at).select(range(2, batch.num_columns))
                    options = pa.ipc.IpcWriteOptions(compression="zstd")
                    with pa.ipc.new_stream(sink, part.schema, options=options) as out:
                        out.write_batch(part)
                    rest = sink.getvalue().to_pybytes()
                row = [
                    [(task << 33) + made],
                    [len(body)],
                    [ids[at:upto].tobytes()],
                    [size[at:upto].tobytes()],
                    [zip_.compress(body)],
                    [rest],
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, f.type) for v, f in zip(row, _CHUNK_ARROW, strict=True)], schema=_CHUNK_ARROW
                )
                made, at = made + 1, upto

    return staging.write(from_docs.mapInArrow(run, _CHUNK), "chunks")


def total_bytes(packed: DataFrame) -> int:
    return packed.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]


def over_chunks(
    packed: DataFrame,
    work: Callable[[Chunk, list], Iterator[pa.RecordBatch]],
    schema: str,
    answers: list[DataFrame] | None = None,
) -> DataFrame:
    """Apply ``work(chunk, replies)`` to every chunk; ``replies`` has what each exchange answered it.

    An answer is a list of (shard, part) pairs, empty if no shard had anything to say.
    """
    answers = answers or []
    joined = packed
    for i, answer in enumerate(answers):
        # The same plan at every size: the answers grow with the chunks, so they are never broadcast.
        joined = joined.join(answer.withColumnRenamed("answer", f"answer{i}").hint("merge"), "chunk", "left")
    n = len(answers)
    joined = joined.select("chunk", "ids", "lengths", "body", "rest", *[f"answer{i}" for i in range(n)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                number, *parts = [batch.column(k)[i].as_py() for k in range(5)]
                replies = []
                for k in range(n):
                    found = batch.column(5 + k)[i].as_py() or []
                    replies.append([(x["shard"], x["part"]) for x in found])
                yield from work(Chunk(number, *parts), replies)

    return joined.mapInArrow(run, schema)


def parts_batch(shards: list[int], chunks: list[int], parts: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(shards, pa.int64()), pa.array(chunks, pa.int64()), pa.array(parts, pa.binary())],
        schema=PARTS,
    )


def note_batch(chunk: Chunk, *arrays: np.ndarray) -> pa.RecordBatch:
    """A chunk's note to itself, under a shard number below 0 that no other chunk has."""
    return parts_batch([~chunk.number], [chunk.number], [encode(*arrays)])


def split_note(reply: list[tuple[int, bytes]]) -> tuple[list[np.ndarray] | None, list[tuple[int, bytes]]]:
    """A chunk's note, if it left one, and what the shards answered."""
    notes = [part for shard, part in reply if shard < 0]
    return (decode(notes[0]) if notes else None), [x for x in reply if x[0] >= 0]


def by_shard(parts: DataFrame, reduce: Callable[[list[int], list[bytes]], Iterator[tuple[int, bytes]]]):
    """Give each shard's parts, one from each chunk, to ``reduce``; it yields (chunk, part) pairs. Notes pass unread."""

    def run(key, frame):
        if key[0] < 0:
            return frame
        frame = frame.sort_values("chunk", kind="stable")
        found = list(reduce(frame["chunk"].tolist(), frame["part"].tolist()))
        return pd.DataFrame(
            {
                "shard": [int(key[0])] * len(found),
                "chunk": [c for c, _ in found],
                "part": [p for _, p in found],
            }
        )

    return parts.groupBy("shard").applyInPandas(run, PARTS_TYPE)


def to_chunks(replies: DataFrame, staging: Staging) -> DataFrame:
    """Write the replies, gathered for each chunk; a chunk gets at most one part from each shard."""
    gathered = replies.groupBy("chunk").agg(F.collect_list(F.struct("shard", "part")).alias("answer"))
    return staging.write(gathered, "answers")


def shards_for(keys: int, shard_keys: int = SHARD_KEYS) -> int:
    return max(1, -(-keys // shard_keys))


def filled_shards(sorted_keys: np.ndarray, shards: int, bits: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """The shards that a chunk's sorted ``bits``-bit keys fall into, and where the slice of each begins.

    Shards cut the range of the keys evenly. The second array has one place more, the end. Work and
    memory follow the keys, not the number of shards.
    """
    kept = min(bits, 32)
    shard = ((sorted_keys >> np.uint64(bits - kept)) * np.uint64(shards)) >> np.uint64(kept)
    begin = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])[: len(shard)])
    return shard[begin].astype(np.int64), np.append(begin, len(shard))


def slice_of(shard: int, filled: tuple[np.ndarray, np.ndarray]) -> slice:
    """Where the keys of one filled shard lie."""
    at = int(np.searchsorted(filled[0], shard))
    return slice(int(filled[1][at]), int(filled[1][at + 1]))


def encode(*arrays: np.ndarray) -> bytes:
    """Arrays of integers as compressed byte planes; planes without a set bit take no room."""
    out = [len(arrays).to_bytes(1, "little")]
    for a in arrays:
        planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T
        used = [i for i in range(a.itemsize) if planes[i].any()]
        out.append(
            len(a).to_bytes(8, "little") + a.dtype.str.encode().ljust(4) + bytes([len(used)]) + bytes(used)
        )
        out += [planes[i].tobytes() for i in used]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def decode(blob: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.decompress(blob), 1, []
    for _ in range(raw[0]):
        n, kind = int.from_bytes(raw[at : at + 8], "little"), np.dtype(raw[at + 8 : at + 12].decode().strip())
        used = raw[at + 13 : at + 13 + raw[at + 12]]
        at += 13 + len(used)
        planes = np.zeros((n, kind.itemsize), np.uint8)
        for i in used:
            planes[:, i] = np.frombuffer(raw, np.uint8, n, at)
            at += n
        out.append(planes.view(kind).reshape(n))
    return out


def encode_sorted(keys: np.ndarray) -> np.ndarray:
    """The differences of sorted keys, the first key first."""
    return np.diff(keys, prepend=np.zeros(1, keys.dtype))


def decode_sorted(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps, dtype=steps.dtype)


class Repeats:
    """Which of a chunk's keys occur more than once anywhere, asked with ``bits`` bits of each key.

    Fewer bits make smaller messages and some false repeats, never a missed one. A key may come in
    several forms, such as an anchor in several surroundings. Keys with ``dense`` forms or more, all
    chunks' forms added, and ``FEW`` or more for each chunk that holds the key, are told apart.
    """

    FEW = 4

    def __init__(self, total: int, bits: int, dense: int | None = None):
        self.bits, self.dense, self.shards = bits, dense, shards_for(total)

    def _sorted(self, keys: np.ndarray):
        return np.unique(keys >> np.uint64(64 - self.bits), return_inverse=True, return_counts=True)

    def _forms(self, place: np.ndarray, counts: np.ndarray, form: Callable[[np.ndarray], np.ndarray]):
        """The places of keys with ``FEW`` forms or more in this chunk, and how many forms each has."""
        own = np.flatnonzero(counts[place] >= self.FEW)
        keys, forms = place[own], form(own)
        order = np.lexsort((forms, keys))
        keys, forms = keys[order], forms[order]
        new = np.append(True, (keys[1:] != keys[:-1]) | (forms[1:] != forms[:-1]))[: len(keys)]
        several, number = np.unique(keys[new], return_counts=True)
        return several[number >= self.FEW], number[number >= self.FEW]

    def ask(
        self, chunk: Chunk, keys: np.ndarray, form: Callable[[np.ndarray], np.ndarray] | None = None
    ) -> Iterator[pa.RecordBatch]:
        """Parts for the shards; ``form`` gives a hash of the form of the keys at some places."""
        if form:
            distinct, place, counts = self._sorted(keys)
            several, number = self._forms(place, counts, form)
        else:
            distinct = np.sort(keys >> np.uint64(64 - self.bits))
            distinct = distinct[np.append(True, distinct[1:] != distinct[:-1])[: len(distinct)]]
            several = number = np.zeros(0, np.int64)
        numbers, edges = filled_shards(distinct, self.shards, self.bits)
        parts = []
        for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            own = slice(*np.searchsorted(several, [low, high]))
            parts.append(encode(encode_sorted(distinct[low:high]), several[own] - low, number[own]))
        if parts:
            yield parts_batch(numbers.tolist(), [chunk.number] * len(parts), parts)

    def reduce(self, chunks: list[int], parts: list[bytes]) -> Iterator[tuple[int, bytes]]:
        asked = [decode(p) for p in parts]
        keys = [decode_sorted(steps) for steps, _, _ in asked]
        both = np.sort(np.concatenate(keys))
        begin = np.flatnonzero(np.append(True, both[1:] != both[:-1]))
        counts = np.diff(np.append(begin, len(both)))
        both = both[begin]
        dense = np.zeros(len(both), bool)
        if self.dense is not None:
            forms = np.zeros(len(both), np.int64)
            for own, (_, several, number) in zip(keys, asked, strict=True):
                forms[np.searchsorted(both, own[several])] += number
            dense = forms >= np.maximum(self.dense, self.FEW * counts)
        told = (counts > 1) | dense
        shared, dense = both[told], dense[told]
        if not len(shared):
            return
        # Each chunk's keys are looked up among the shared ones, not these in every chunk, so the work follows the keys.
        for chunk, own in zip(chunks, keys, strict=True):
            at = np.minimum(np.searchsorted(shared, own), len(shared) - 1)
            held = shared[at] == own
            if held.any():
                yield chunk, encode(np.packbits(held), np.packbits(held & dense[at]))

    @staticmethod
    def any_dense(reply: list[tuple[int, bytes]]) -> bool:
        return any(decode(part)[1].any() for _, part in reply)

    def flags(self, keys: np.ndarray, reply: list[tuple[int, bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """For the keys that were asked: whether each occurs elsewhere, here or in another chunk, and is dense."""
        distinct, place, counts = self._sorted(keys)
        found = np.zeros((2, len(distinct)), bool)
        found[0] = counts > 1
        filled = filled_shards(distinct, self.shards, self.bits)
        for shard, part in reply:
            own = slice_of(shard, filled)
            for row, bits in zip(found, decode(part), strict=True):
                row[own] |= np.unpackbits(bits, count=own.stop - own.start).astype(bool)
        return found[0][place], found[1][place]
