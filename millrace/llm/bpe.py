"""Byte-level BPE encoding and decoding through a sentencepiece model made from a rank file."""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Piece types and field numbers of the model file's format; fixed values.
_NORMAL, _UNKNOWN, _BPE = 1, 2, 2
#: Bytes stand for the characters from here on, so that a piece is a string of plain letters.
_FIRST = 0x100
_BYTE_CHARS = {b: _FIRST + b for b in range(256)}

CACHE_ENTRIES = 1 << 17
CACHED_LETTERS = 64  # longer pre-tokens are encoded anew each time
_ROWS = 250  # documents taken at a time
LONG_TEXT = 1 << 20


def read_ranks(path: str) -> list[bytes]:
    """Tokens in order of their ranks, from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError(f"{path}: ranks are not the numbers from 0 on")
    return [ranks[i] for i in range(len(ranks))]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int | float) -> bytes:
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def _mapped(token: bytes) -> str:
    return token.decode("latin-1").translate(_BYTE_CHARS)


def bpe_model(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model whose piece ids are the ranks; normalisation leaves text alone."""
    piece = lambda text, score, kind: _field(1, _field(1, text.encode()) + _field(2, score) + _field(3, kind))
    out = [piece(_mapped(t), -float(rank), _NORMAL) for rank, t in enumerate(tokens)]
    out.append(piece("<unk>", 0.0, _UNKNOWN))
    out.append(_field(2, _field(3, _BPE) + _field(4, len(tokens) + 1) + _field(40, len(tokens))))
    out.append(_field(3, _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)))
    return b"".join(out)


class Encoder:
    """Ids of whole texts, as little-endian unsigned 32-bit integers."""

    def __init__(self, tokens: list[bytes], model: bytes, pattern: str):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.pattern = regex.compile(pattern)
        self.ranks = {t: i for i, t in enumerate(tokens)}
        self.cache: dict[str, bytes] = {}

    def _encode(self, pieces: list[str]) -> list[bytes]:
        raw = [p.encode() for p in pieces]
        found = self.model.encode([_mapped(r) for r in raw], num_threads=1)
        # A pre-token that is a token itself is that token, whether or not merges lead to it.
        ids = [[self.ranks[r]] if r in self.ranks else f for r, f in zip(raw, found, strict=True)]
        return [np.array(i, "<u4").tobytes() for i in ids]

    def _ids(self, pieces: list[str]) -> bytes:
        try:
            return b"".join(map(self.cache.__getitem__, pieces))
        except KeyError:
            missing = list({p for p in pieces if p not in self.cache})
        if len(self.cache) + len(missing) > CACHE_ENTRIES:
            self.cache.clear()
            missing = list(set(pieces))
        made = dict(zip(missing, self._encode(missing), strict=True))
        self.cache.update((p, ids) for p, ids in made.items() if len(p) <= CACHED_LETTERS)
        return b"".join([made[p] if p in made else self.cache[p] for p in pieces])

    def __call__(self, text: str) -> bytes:
        if len(text) < LONG_TEXT:
            return self._ids(self.pattern.findall(text))
        groups = batched((m[0] for m in self.pattern.finditer(text)), 1 << 16)
        return b"".join(self._ids(list(g)) for g in groups)


def _decoded(ids: bytes | None, table: list[bytes]) -> bytes:
    return b"".join(map(table.__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))


def _table(tokens: list[bytes]) -> list[bytes]:
    """The bytes of each id: its piece's characters, mapped back to the bytes they stand for."""
    back = {_FIRST + b: b for b in range(256)}
    return [_mapped(t).translate(back).encode("latin-1") for t in tokens]


def encode_texts(
    docs: DataFrame,
    tokens: list[bytes],
    pattern: str,
    *,
    id: str = "doc_id",
    text: str = "text",
    decode: bool = False,
    also: dict[str, Column] | None = None,
) -> DataFrame:
    """Encode every whole text: each match of ``pattern`` by itself, by the merges of ``tokens``.

    Returns ``doc_id``, ``ids`` (little-endian unsigned 32-bit integers) and ``n_tokens`` for every
    row, with ``decode`` also ``decoded``, as `decode_ids` makes it, in the same tasks, and columns
    ``also``. A null text encodes as an empty one; a null id stays null; repeated rows are encoded each;
    an empty table gives an empty result; other columns are ignored. The model is
    made once from the vocabulary and travels with the tasks (some 2 MB, as large as the
    vocabulary). Each task remembers at most ``CACHE_ENTRIES`` pre-tokens and takes a long text
    some ten thousand pre-tokens at a time.
    """
    model = bpe_model(tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, table = Encoder(tokens, model, pattern), _table(tokens) if decode else []
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                ids = [encode(t or "") for t in part.column(1).to_pylist()]
                columns = [part.column(0), pa.array(ids, pa.binary()), pa.array([len(i) // 4 for i in ids], pa.int64())]
                if decode:
                    columns.append(pa.array([_decoded(i, table) for i in ids], pa.binary()))
                columns += part.columns[2:]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "ids", "n_tokens", *(["decoded"] if decode else []), *(also or {})]
    own = F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")
    plain = docs.select(*own, *[c.alias(name) for name, c in (also or {}).items()])
    more = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in plain.schema[2:])
    return plain.mapInArrow(run, "doc_id long, ids binary, n_tokens long" + (", decoded binary" if decode else "") + more)


def decode_ids(encoded: DataFrame, tokens: list[bytes]) -> DataFrame:
    """Add ``decoded``, the bytes of ``ids``: each id's piece, mapped back to the bytes it stands for.

    Null or empty ``ids`` decode to no bytes; an id outside the vocabulary is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(tokens)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                texts = pa.array([_decoded(i, table) for i in part.column(1).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, texts], [*part.schema.names, "decoded"])

    return encoded.select("doc_id", "ids", "n_tokens").mapInArrow(
        run, "doc_id long, ids binary, n_tokens long, decoded binary"
    )
