"""Line deduplication through sharded minimal perfect hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.chunks import (
    CHUNK_BYTES,
    NULL_ID,
    PARTS_TYPE,
    Chunk,
    by_shard,
    decode,
    decode_sorted,
    encode,
    encode_sorted,
    filled_shards,
    over_chunks,
    pack,
    parts_batch,
    shards_for,
    slice_of,
    to_chunks,
    total_bytes,
)
from millrace.llm.perfect_hash import PerfectHash
from millrace.staging import Staging

_SPACE = b" \t\n\r\x0b\x0c"
_KEEP, _LAST, _DROP = 0, 1, 2  # a key's lines stay, stay in the chunk's largest doc_id, or go


def line_key(line: bytes, least: int) -> bytes | None:
    """The stripped, lower-cased line, or None if it has fewer than ``least`` code points."""
    key = line.strip(_SPACE)
    if len(key) < least or (len(key) < 4 * least and len(key.decode("utf-8", "replace")) < least):
        return None
    return key.lower()


class _Lines:
    """A chunk's distinct keys in order of their hashes, and the largest ``copies`` ids that hold each."""

    def __init__(self, chunk: Chunk, least: int, copies: int):
        seen: dict[int, int] = {}
        docs: list[set[int]] = []
        self.keys: list[list[int]] = []  # for each document and line the key's number, or -1
        self.lines: list[list[bytes]] = []
        for i in range(len(chunk)):
            lines = chunk.text(i).split(b"\n")
            own = []
            for line in lines:
                key = line_key(line, least)
                if key is None:
                    own.append(-1)
                    continue
                number = seen.setdefault(xxhash.xxh3_128_intdigest(key), len(docs))
                if number == len(docs):
                    docs.append(set())
                docs[number].add(i)
                own.append(number)
            self.lines.append(lines)
            self.keys.append(own)
        high = np.fromiter((h >> 64 for h in seen), np.uint64, len(seen))
        low = np.fromiter((h & 0xFFFFFFFF for h in seen), np.uint32, len(seen))
        order = np.lexsort((low, high))
        self.hash, self.print = high[order], low[order]
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.arange(len(order))
        ids = chunk.ids.tolist()
        held = [sorted({ids[i] for i in docs[k]})[-copies:] for k in order]
        self.n_ids = np.array([len(h) for h in held], np.int64)
        self.ids = np.array([i for h in held for i in h], np.int64)
        self.first_id = np.append(0, np.cumsum(self.n_ids))
        self.last = self.ids[self.first_id[1:] - 1] if len(held) else np.zeros(0, np.int64)


def _reducer(copies: int):
    def reduce(chunks: list[int], parts: list[bytes]) -> Iterator[tuple[int, bytes]]:
        asked = []
        for part in parts:
            steps, prints, n_ids, ids = decode(part)
            asked.append((decode_sorted(steps), prints, n_ids, ids))
        keys, prints, n_ids, ids = (np.concatenate(x) for x in zip(*asked, strict=True))
        # Arrays over the distinct hashes; the fingerprint tells apart keys that share a hash.
        distinct = np.unique(keys)
        number = PerfectHash(distinct)
        at = number(keys)
        fingerprint = np.zeros(len(distinct), np.uint32)
        fingerprint[at] = prints
        own = np.repeat(prints == fingerprint[at], n_ids)
        holder, ids = np.repeat(at, n_ids)[own], ids[own]
        newest = np.full(len(distinct), NULL_ID, np.int64)
        np.maximum.at(newest, holder, ids)
        # An id counts once for a key, in however many chunks and rows it holds it.
        order = np.lexsort((ids, holder))
        holder, ids = holder[order], ids[order]
        new = np.append(True, (holder[1:] != holder[:-1]) | (ids[1:] != ids[:-1]))[: len(holder)]
        total = np.bincount(holder[new], minlength=len(distinct))
        for chunk, (k, p, n, i) in zip(chunks, asked, strict=True):
            at, last = number(k), i[np.cumsum(n) - 1]
            frequent = (total[at] >= copies) & (fingerprint[at] == p)
            if frequent.any():
                verdict = np.where(frequent, np.where(newest[at] == last, _LAST, _DROP), _KEEP)
                yield chunk, encode(verdict.astype(np.uint8))

    return reduce


def drop_frequent_lines(
    docs: DataFrame,
    staging: Staging,
    *,
    id: str = "doc_id",
    text: str = "text",
    least_chars: int = 40,
    copies: int = 5,
    carry: tuple[str, ...] = (),
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Drop lines whose key occurs under ``copies`` or more doc_ids, except in the largest of them.

    A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` with A-Z lower-cased; keys below
    ``least_chars`` code points are kept wherever they are. Each chunk sends its distinct key
    hashes with the largest ``copies`` ids that hold each, once for each key, so a line that a third of
    all documents hold costs a few ids for each chunk. A shard builds a minimal perfect hash over
    its distinct hashes, with compact arrays of fingerprints, counts and last ids, and the chunks'
    keys probe these. Keys are told apart by 96 bits of hash.

    Returns ``doc_id``, ``text``, ``n_lines`` (before dropping), ``n_dropped`` and, with
    ``carry``, a struct ``rest`` of those columns. A null or empty text is one empty line and
    gives an empty text; very long texts are read whole. Rows with equal ids, repeated ones among them,
    are one document, and all rows of the largest id keep their lines. Rows without an id are one document
    too, which orders before all others. An empty table gives an empty result.
    """
    packed = pack(docs, staging, id, text, chunk_bytes, carry)
    shards = shards_for(total_bytes(packed) // 40)

    def ask(chunk: Chunk, _) -> Iterator[pa.RecordBatch]:
        found = _Lines(chunk, least_chars, copies)
        full, edges = filled_shards(found.hash, shards)
        parts = []
        for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            own = slice(low, high)
            ids = found.ids[found.first_id[own.start] : found.first_id[own.stop]]
            parts.append(encode(encode_sorted(found.hash[own]), found.print[own], found.n_ids[own], ids))
        if parts:
            yield parts_batch(full.tolist(), [chunk.number] * len(parts), parts)

    parts = over_chunks(packed, ask, PARTS_TYPE)
    answers = to_chunks(by_shard(parts, _reducer(copies)), staging)

    def finish(chunk: Chunk, replies: list) -> Iterator[pa.RecordBatch]:
        found = _Lines(chunk, least_chars, copies)
        filled = filled_shards(found.hash, shards)
        verdict = np.zeros(len(found.hash) + 1, np.uint8)  # the last entry serves lines without a key
        for shard, part in replies[0]:
            verdict[slice_of(shard, filled)] = decode(part)[0]
        texts, n_lines, n_dropped = [], [], []
        for i, (lines, keys) in enumerate(zip(found.lines, found.keys, strict=True)):
            where = np.array(keys, np.int64)
            where = np.where(where < 0, len(found.hash), found.place[where] if len(found.place) else -1)
            own = verdict[where]
            last = np.append(found.last, 0)[where]
            drop = (own == _DROP) | ((own == _LAST) & (last != chunk.ids[i]))
            n_lines.append(len(lines))
            n_dropped.append(int(drop.sum()))
            texts.append(b"\n".join(x for x, gone in zip(lines, drop, strict=True) if not gone))
        columns = [chunk.id_array(), pa.array(texts, pa.binary()).view(pa.string()), pa.array(n_lines), pa.array(n_dropped)]
        names = ["doc_id", "text", "n_lines", "n_dropped"]
        if carry:
            columns.append(chunk.rest())
            names.append("rest")
        yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, text string, n_lines long, n_dropped long"
    if not carry:
        return over_chunks(packed, finish, schema, [answers])
    rest = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)]).schema
    out = over_chunks(packed, finish, f"{schema}, rest {rest.simpleString()}", [answers])
    named = F.struct(*[F.col("rest")[f"c{i}"].alias(c) for i, c in enumerate(carry)])
    return out.withColumn("rest", named)
