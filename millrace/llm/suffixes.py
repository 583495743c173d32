"""Suffix-array deduplication of byte strings that start earlier elsewhere."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.chunks import (
    CHUNK_BYTES,
    PARTS_TYPE,
    Chunk,
    Repeats,
    by_shard,
    decode,
    encode,
    over_chunks,
    pack,
    parts_batch,
    shards_for,
    to_chunks,
    total_bytes,
)
from millrace.llm.hashing import byte_prefix, mix64, window_hash
from millrace.staging import Staging

GRAM = 32  # bytes of the string that an anchor starts with
_FINER = 4  # shards of single windows for each shard of stretches
_PIECE = 1 << 17  # window starts hashed at a time
SHARD_BYTES = 8 << 20
_OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text", pa.binary()),
        ("n_bytes", pa.int64()),
        ("n_removed", pa.int64()),
        ("n_spans", pa.int64()),
        ("spans", pa.list_(pa.list_(pa.int64()))),
    ]
)


# --- sorting -----------------------------------------------------------------------------------


class BlindTrie:
    """Orders distinct byte strings of one length: nodes hold where strings part, leaves the strings.

    An insertion walks down by the bytes at the branching places alone, compares with the one leaf
    it ends at, and splits the path where the two strings part.
    """

    def __init__(self):
        self.root = None

    def insert(self, s: bytes) -> None:
        if self.root is None:
            self.root = s
            return
        node = self.root
        while not isinstance(node, bytes):
            node = node[1].get(s[node[0]]) or next(iter(node[1].values()))
        differ = int.from_bytes(s, "big") ^ int.from_bytes(node, "big")
        if not differ:
            return
        depth = len(s) - (differ.bit_length() + 7) // 8
        parent, below = None, self.root
        while not isinstance(below, bytes) and below[0] < depth:
            parent, below = below, below[1][s[below[0]]]
        if not isinstance(below, bytes) and below[0] == depth:
            below[1][s[depth]] = s
            return
        split = (depth, {node[depth]: below, s[depth]: s})
        if parent is None:
            self.root = split
        else:
            parent[1][s[parent[0]]] = split

    def in_order(self) -> Iterator[bytes]:
        stack = [self.root] if self.root is not None else []
        while stack:
            node = stack.pop()
            if isinstance(node, bytes):
                yield node
            else:
                stack += [node[1][c] for c in sorted(node[1], reverse=True)]


def deep_shallow_order(rows: np.ndarray, shallow: int) -> np.ndarray:
    """The order of equally long byte rows: multikey quicksort to ``shallow`` bytes, then blind tries.

    The quicksort takes eight bytes at a time as one big-endian key and goes on only inside groups
    that still agree. A group that agrees in all shallow bytes is ordered by a blind trie over its
    distinct rows. Equal rows keep their order.
    """
    n, width = rows.shape
    group = np.zeros(n, np.int64)  # place of the first row of each row's group
    order = np.arange(n)
    for at in range(0, min(shallow, width), 8):
        keys = rows[:, at : at + 8].copy().view(">u8")[:, 0].astype(np.uint64)
        size = np.bincount(group, minlength=n + 1)[group]
        open_ = np.flatnonzero(size[order] > 1)  # places of the order that are not settled
        if not len(open_):
            return order
        own = order[open_]
        sort = np.lexsort((keys[own], group[own]))
        own = own[sort]
        order[open_] = own
        new = np.ones(len(own), bool)
        new[1:] = (keys[own[1:]] != keys[own[:-1]]) | (group[own[1:]] != group[own[:-1]])
        group[own] = open_[np.maximum.accumulate(np.where(new, np.arange(len(own)), 0))]
    firsts = group[order]
    bounds = np.flatnonzero(np.append(firsts[1:] != firsts[:-1], True)) + 1 if n else np.zeros(0, np.int64)
    begin = 0
    for end in bounds.tolist():
        if end - begin > 1:
            members: dict[bytes, list[int]] = {}
            for r in order[begin:end].tolist():
                members.setdefault(rows[r, shallow:].tobytes(), []).append(r)
            if len(members) > 1:
                trie = BlindTrie()
                for s in members:
                    trie.insert(s)
                order[begin:end] = [r for s in trie.in_order() for r in members[s]]
        begin = end
    return order


def common_prefix(rows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each place of the order, how many bytes its row shares with the row before it."""
    out = np.zeros(len(order), np.int64)
    if len(order) > 1:
        differ = rows[order[1:]] != rows[order[:-1]]
        out[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return out


# --- anchors -----------------------------------------------------------------------------------


class _Anchors:
    """The places of a chunk that its windows are filed under.

    Of the ``GRAM``-byte strings inside a window, the one with the least hash is the window's
    anchor, so equal windows have equal anchors at equal places. Neighbouring windows mostly share
    one: ``low`` and ``high`` are the first and last window start of each anchor at ``at``.
    """

    def __init__(self, chunk: Chunk, window: int):
        found = [
            self._piece(chunk, at, min(at + _PIECE, len(chunk.data) - window + 1), window)
            for at in range(0, len(chunk.data) - window + 1, _PIECE)
        ]
        empty = [np.zeros(0, np.int64)] * 4 + [np.zeros(0, np.uint64)]
        self.at, self.low, self.high, self.row, self.keys = (
            np.concatenate(x) for x in zip(empty, *found, strict=True)
        )

    @staticmethod
    def _piece(chunk: Chunk, first: int, last: int, window: int) -> tuple[np.ndarray, ...]:
        """The anchors of the windows that start from ``first`` up to ``last``."""
        data = chunk.data[first : last + window - 1]
        sums = byte_prefix(data)
        places = np.arange(len(data) - GRAM + 1)
        hashes = window_hash(sums, places, places + GRAM)
        span = window - GRAM + 1
        ranked = (hashes & np.uint64(0xFFFFFFFF00000000)) | places.astype(np.uint64)
        pad = -len(ranked) % span
        blocks = np.concatenate([ranked, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, span)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        starts = np.arange(last - first)
        least = np.minimum(behind[starts], ahead[starts + span - 1]) & np.uint64(0xFFFFFFFF)
        # Windows must end inside the document they start in; whole documents are taken at a time.
        docs = slice(max(0, np.searchsorted(chunk.start, first, "right") - 1), np.searchsorted(chunk.start, last))
        low = np.maximum(chunk.start[docs] - first, 0)
        high = np.minimum(chunk.end[docs] - window + 1, last) - first
        size = np.maximum(high - low, 0)
        row = np.repeat(np.arange(len(chunk))[docs], size)
        starts = np.repeat(low - (np.cumsum(size) - size), size) + np.arange(size.sum())
        least = least[starts].astype(np.int64)
        new = np.ones(len(starts), bool)
        new[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1])
        begin = np.flatnonzero(new)
        final = np.append(begin[1:], len(starts))[: len(begin)] - 1
        return least[begin] + first, starts[begin] + first, starts[final] + first, row[begin], mix64(hashes[least[begin]])


class _Stretches:
    """What a chunk files: runs of windows that share an anchor, from ``low`` to ``high``, and their keys."""

    def __init__(self, low, high, at, row, keys):
        self.low, self.high, self.at, self.row, self.keys = low, high, at, row, keys

    @staticmethod
    def of(anchors: _Anchors, own: np.ndarray) -> _Stretches:
        return _Stretches(anchors.low[own], anchors.high[own], anchors.at[own], anchors.row[own], anchors.keys[own])

    def windows(self, chunk: Chunk, window: int) -> _Stretches:
        """Each window as a stretch of its own, under a key of all its bytes."""
        size = self.high - self.low + 1
        first = np.repeat(self.low - (np.cumsum(size) - size), size) + np.arange(size.sum())
        keys = mix64(window_hash(byte_prefix(chunk.data), first, first + window))
        return _Stretches(first, first, np.repeat(self.at, size), np.repeat(self.row, size), keys)

    def only(self, own: np.ndarray) -> _Stretches:
        return _Stretches(self.low[own], self.high[own], self.at[own], self.row[own], self.keys[own])


def _surroundings(chunk: Chunk, anchors: _Anchors, window: int):
    """Hashes of the stretches around some anchors; equal stretches have equal ones."""

    def form(own: np.ndarray) -> np.ndarray:
        if not len(own):
            return np.zeros(0, np.uint64)
        low = anchors.low[own]
        offset = mix64((anchors.at[own] - low).astype(np.uint64))
        return window_hash(byte_prefix(chunk.data), low, anchors.high[own] + window) ^ offset

    return form


def _entries(chunk: Chunk, found: _Stretches, window: int, first_shard: int, shards: int):
    """Parts with one entry for each distinct stretch, with its first occurrence, and the other occurrences.

    Later occurrences of the same stretch in this chunk are only listed behind it: whatever the
    other chunks hold, all their windows start earlier here.
    """
    rank = np.empty(len(chunk), np.int64)
    rank[np.argsort(chunk.ids, kind="stable")] = np.arange(len(chunk))
    found = found.only(np.lexsort((found.low, rank[found.row])))
    body, seen = chunk.body, {}
    low, high, at = found.low.tolist(), found.high.tolist(), found.at.tolist()
    first, later = [], []
    for i in range(len(low)):
        key = (body[low[i] : high[i] + window], at[i] - low[i])
        number = seen.setdefault(key, len(first))
        if number == len(first):
            first.append(i)
        else:
            later.append(i)
    sent = found.only(np.array(first, np.int64))
    shard = (sent.keys % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    numbers, begin = np.unique(shard[order], return_index=True)
    parts = []
    for s, i, j in zip(numbers.tolist(), begin.tolist(), [*begin[1:].tolist(), len(order)], strict=False):
        a = sent.only(order[i:j])
        text = b"".join(body[x:y] for x, y in zip(a.low.tolist(), (a.high + window).tolist(), strict=True))
        part = encode_text(
            text,
            (a.high - a.low).astype(np.int32),
            (a.at - a.low).astype(np.int32),
            chunk.ids[a.row],
            a.row.astype(np.int32),
            a.low - chunk.start[a.row],
        )
        parts.append((first_shard + s, part))
    return parts, found.only(np.array(later, np.int64))


def encode_text(text: bytes, *arrays: np.ndarray) -> bytes:
    import zstandard

    head = encode(*arrays)
    return len(head).to_bytes(8, "little") + head + zstandard.compress(text, 3)


def decode_text(part: bytes) -> tuple[np.ndarray, list[np.ndarray]]:
    import zstandard

    n = int.from_bytes(part[:8], "little")
    return np.frombuffer(zstandard.decompress(part[8 + n :]), np.uint8), decode(part[8 : 8 + n])


def _later_windows(text, size, offset, window: int) -> np.ndarray:
    """Which windows of which entries equal a window of an earlier entry; entries come in order.

    ``text`` holds the entries' bytes one after the other; entry i has ``size[i] + 1`` windows and
    its anchor at ``offset[i]``. Returns a matrix: entry by how far its window starts before the anchor.
    """
    n, most = len(size), window - GRAM + 1
    begin = np.cumsum(size + window) - (size + window)

    def side(place: np.ndarray, length: np.ndarray, step: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Order and shared bytes of what follows (or, with step -1, precedes) the anchors."""
        width = -(-width // 8) * 8
        rows = np.zeros((n, width), np.uint8)
        for j in range(width):
            own = np.flatnonzero(length > j)
            rows[own, j] = text[place[own] + step * j]
        order = deep_shallow_order(rows, GRAM + 16 if step > 0 else 16)
        return order, common_prefix(rows, order)

    anchor = begin + offset
    right, right_shared = side(anchor, size + window - offset, 1, window)
    left, left_shared = side(anchor - 1, offset, -1, most)
    later = np.zeros((n, most), bool)
    for before in range(most):
        own = np.flatnonzero((offset - size <= before) & (before <= offset))
        if len(own) < 2:
            continue
        same_right, same_left = np.empty(n, np.int64), np.empty(n, np.int64)
        same_right[right] = np.cumsum(right_shared < window - before)
        same_left[left] = np.cumsum(left_shared < before) if before else 0
        key = same_right[own] * (n + 1) + same_left[own]
        sort = np.argsort(key, kind="stable")
        later[own[sort[1:]], before] = key[sort[1:]] == key[sort[:-1]]
    return later


def _reducer(window: int):
    def reduce(chunks: list[int], parts: list[bytes]) -> Iterator[tuple[int, bytes]]:
        texts, columns, source = [], [], []
        for k, part in enumerate(parts):
            text, arrays = decode_text(part)
            texts.append(text)
            columns.append(arrays)
            source.append(np.full(len(arrays[0]), k))
        size, offset, ids, row, start = (np.concatenate(x).astype(np.int64) for x in zip(*columns, strict=True))
        source = np.concatenate(source)
        text = np.concatenate(texts)
        order = np.lexsort((start, row, source, ids))
        begin = np.cumsum(size + window) - (size + window)
        length = (size + window)[order]
        to = np.cumsum(length) - length
        text = text[np.repeat(begin[order] - to, length) + np.arange(len(text))]
        size, offset, row, start, source = (x[order] for x in (size, offset, row, start, source))
        later = _later_windows(text, size, offset, window)
        entry, before = np.nonzero(later)
        if not len(entry):
            return
        at = start[entry] + offset[entry] - before
        whose = source[entry]
        sort = np.argsort(whose, kind="stable")
        bounds = np.searchsorted(whose[sort], np.arange(len(chunks) + 1))
        for k, chunk in enumerate(chunks):
            own = sort[bounds[k] : bounds[k + 1]]
            if len(own):
                r, p = row[entry[own]], at[own]
                by = np.lexsort((p, r))
                r, p = r[by], p[by]
                new = np.append(True, (r[1:] != r[:-1]) | (p[1:] != p[:-1] + 1))
                first = np.flatnonzero(new)
                last = np.append(first[1:], len(p)) - 1
                yield chunk, encode(r[first].astype(np.int32), p[first], p[last] - p[first])

    return reduce


def remove_earlier_strings(
    docs: DataFrame,
    staging: Staging,
    *,
    id: str = "doc_id",
    text: str = "text",
    window: int = 100,
    chunk_bytes: int = CHUNK_BYTES,
    dense: int = 4096,
) -> DataFrame:
    """Remove every byte covered by a ``window``-byte string that also starts earlier.

    A suffix array over all places would be many times the input, so only suffixes at anchors are
    sorted: places chosen by content, about one in thirty bytes, such that each window holds one
    and equal windows hold equal ones at equal places. Anchors whose first bytes occur once
    anywhere are dropped by an exchange of hashes. The stretches around the others meet in shards;
    there the suffixes to the right and the reversed prefixes to the left of the anchors are put
    in order, multikey quicksort first and blind tries below its shallow depth. Two windows are
    equal where both orders show enough shared bytes, which compares the bytes themselves.

    An anchor in ``dense`` different stretches or more, and on average four or more for each chunk
    that holds it, such as the edge of a passage of very many documents or a mark-up attribute, is
    not filed as a whole: each of its windows is a stretch of its own, under a hash of all its
    bytes. Windows whose hash occurs once are dropped by another exchange, and the others meet in
    the shards of their hashes and go through the same sort. So what meets under one key is at most
    ``dense`` stretches or a few for each chunk, whatever the texts.

    Returns ``doc_id``, ``text`` (remaining bytes, binary because a cut may split a character),
    ``n_bytes``, ``n_removed``, ``n_spans`` and ``spans`` (start and end of each maximal removed
    run in the text's bytes). "Earlier" is a smaller doc_id, or an earlier start in one document;
    a null id orders first, rows with equal ids (repeated rows too) by their place in the input
    files. Null texts are empty, an empty table gives an empty one, and a very long text is a chunk
    of its own that is never cut. Other columns are ignored, whatever their names.
    """
    packed = pack(docs, staging, id, text, chunk_bytes)
    size = total_bytes(packed)
    bits = min(64, max(44, math.ceil(math.log2(size + 1)) + 8))
    seen, singles = Repeats(size // 30, bits, dense), Repeats(size // 8, 64)
    shards = shards_for(size, SHARD_BYTES)
    spans_shard = shards * (1 + _FINER)

    def ask(chunk: Chunk, _):
        anchors = _Anchors(chunk, window)
        if len(anchors.keys):
            yield from seen.ask(chunk, anchors.keys, _surroundings(chunk, anchors, window))

    answers = to_chunks(by_shard(over_chunks(packed, ask, PARTS_TYPE), seen.reduce), staging)

    def ask_windows(chunk: Chunk, replies: list):
        if seen.any_dense(replies[0]):
            anchors = _Anchors(chunk, window)
            own = np.flatnonzero(seen.flags(anchors.keys, replies[0])[1])
            yield from singles.ask(chunk, _Stretches.of(anchors, own).windows(chunk, window).keys)

    asked = over_chunks(packed, ask_windows, PARTS_TYPE, [answers])
    window_answers = to_chunks(by_shard(asked, singles.reduce), staging)

    def gather(chunk: Chunk, replies: list):
        anchors = _Anchors(chunk, window)
        if not len(anchors.keys):
            return
        repeated, many = seen.flags(anchors.keys, replies[0])
        whole = _Stretches.of(anchors, np.flatnonzero(repeated & ~many))
        parts, copies = _entries(chunk, whole, window, 0, shards)
        copies = [copies]
        if many.any():
            each = _Stretches.of(anchors, np.flatnonzero(many)).windows(chunk, window)
            each = each.only(np.flatnonzero(singles.flags(each.keys, replies[1])[0]))
            more, again = _entries(chunk, each, window, shards, shards * _FINER)
            parts, copies = parts + more, [*copies, again]
        for c in copies:
            if len(c.low):
                spans = encode(c.row.astype(np.int32), c.low - chunk.start[c.row], c.high - c.low)
                parts.append((spans_shard, spans))
        if parts:
            yield parts_batch([s for s, _ in parts], [chunk.number] * len(parts), [p for _, p in parts])

    gathered = staging.write(over_chunks(packed, gather, PARTS_TYPE, [answers, window_answers]), "contexts")
    met = by_shard(gathered.filter(F.col("shard") < spans_shard), _reducer(window))
    spans = to_chunks(met.union(gathered.filter(F.col("shard") == spans_shard)), staging)
    staging.remove(gathered)

    def finish(chunk: Chunk, replies: list):
        n = len(chunk.data)
        change = np.zeros(n + 1, np.int64)
        for _, part in replies[0]:
            row, start, more = decode(part)
            begin = chunk.start[row] + start
            np.add.at(change, begin, 1)
            np.add.at(change, begin + more + window, -1)
        removed = np.cumsum(change[:-1]) > 0
        edge = np.diff(removed.astype(np.int8), prepend=0, append=0)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        low, high = np.searchsorted(starts, chunk.start), np.searchsorted(starts, chunk.end)
        texts, n_removed, spans = [], [], []
        for i in range(len(chunk)):
            own = list(zip(starts[low[i] : high[i]].tolist(), ends[low[i] : high[i]].tolist(), strict=True))
            at, kept, base = int(chunk.start[i]), [], int(chunk.start[i])
            for s, e in own:
                kept.append(chunk.body[at:s])
                at = e
            kept.append(chunk.body[at : chunk.end[i]])
            texts.append(b"".join(kept))
            n_removed.append(sum(e - s for s, e in own))
            spans.append([[s - base, e - base] for s, e in own])
        yield pa.RecordBatch.from_arrays(
            [
                chunk.id_array(),
                pa.array(texts, pa.binary()),
                pa.array(chunk.end - chunk.start),
                pa.array(n_removed, pa.int64()),
                pa.array((high - low).astype(np.int64)),
                pa.array(spans, _OUT.field("spans").type),
            ],
            schema=_OUT,
        )

    schema = "doc_id long, text binary, n_bytes long, n_removed long, n_spans long, spans array<array<long>>"
    return over_chunks(packed, finish, schema, [spans])
