"""Byte-level BPE encoding and decoding with a sentencepiece model.

The vocabulary is a file of token bytes with ranks.  From it alone a
sentencepiece BPE model is serialised: every byte is written as one printable
character, a token is the string of its bytes' characters, its score is minus
its rank and the normalisation is the identity.  The model then joins the best
scored pair first, leftmost on ties, which is the pair of the smallest rank.
Nothing is trained.

A text is cut into pre-tokens by array operations on code points; equal
pre-tokens of a batch are encoded once and remembered by their worker.  A
pre-token that is itself a token is that token, also where merges would not
reach it.  Decoding maps ids back to their characters and these to bytes.

Defined cases: a NULL text is an empty one and has no ids; rows repeat as they
come; NULL ids decode to no bytes; columns other than the key and the text take
no part; an empty table gives an empty result.  The ids of a row are bytes, four
for each id in little-endian order, as array loaders map them.  A text of any
length goes through in steps that end between pre-tokens.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from casebook.llm import tokens

#: Decoded bytes that leave a worker at once.
OUT_BYTES = 1 << 22

#: The character of each byte: those of byte-level vocabularies, all printable.
CHARS = {byte: char for char, byte in tokens.byte_characters().items()}
#: The piece that stands for unknown characters; of no byte, so never used.
UNKNOWN = "⁇"


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to ranks, from a file of base64 tokens and ranks."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


# ------------------------------------------------------------- the model's file


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out + bytes([n]))


def _field(number: int, value: bytes | int | float | str) -> bytes:
    """One protocol-buffer field: integers as varints, floats in four bytes."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    data = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(data)) + data


def spelled(token: bytes) -> str:
    """The piece of a token: one character for each byte."""
    return "".join(map(CHARS.__getitem__, token))


def model(ranks: dict[bytes, int]) -> bytes:
    """A serialised sentencepiece BPE model in which piece i is the token of rank i.

    Ranks without a token get unused pieces, so that ids and ranks agree.  The
    unknown piece comes last.
    """
    # Fixed values, from sentencepiece's public model schema: fields of a model
    # (pieces 1, trainer 2, normaliser 3), of a piece (piece 1, score 2, type 3),
    # of the trainer (model type 3 with 2 for BPE, unknown id 40, others 41 to
    # 43), of the normaliser (name 1, dummy prefix 3, extra spaces 4, escapes 5);
    # types of pieces.
    normal, unknown, unused = 1, 2, 5
    by_rank = {rank: token for token, rank in ranks.items()}
    size = max(by_rank, default=-1) + 1
    out = bytearray()
    for i in range(size):
        token = by_rank.get(i)
        piece = _field(1, spelled(token) if token else f"⁈{i}") + _field(2, float(-i))
        out += _field(1, piece + _field(3, normal if token else unused))
    out += _field(1, _field(1, UNKNOWN) + _field(2, float(-size)) + _field(3, unknown))
    none = (1 << 64) - 1  # minus one: no such id
    trainer = b"".join([_field(3, 2), _field(40, size), *(_field(k, none) for k in (41, 42, 43)),
                        _field(45, UNKNOWN)])
    normaliser = _field(1, "identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return bytes(out + _field(2, trainer) + _field(3, normaliser))


# -------------------------------------------------------------------- the codec


class Codec(tokens.Encoder):
    """Ids of texts by the ranks in ``path``."""

    def __init__(self, path: str):
        import sentencepiece
        ranks = read_ranks(path)
        self.whole = {token: rank for token, rank in ranks.items() if len(token) > 1}
        processor = sentencepiece.SentencePieceProcessor(model_proto=model(ranks))
        self.merges = lambda pieces: processor.encode(pieces, num_threads=1)
        self.special: dict[str, int] = {}
        self._forget()

    def merged(self, pieces: list[str]) -> list[list[int]]:
        """The ids of each pre-token."""
        raw = [p.encode("utf-8", "surrogatepass") for p in pieces]
        out: list = [None if r not in self.whole else [self.whole[r]] for r in raw]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(rest, self.merges([spelled(raw[i]) for i in rest])):
            out[i] = ids
        return out


class Decoder:
    """Bytes of ids by the ranks in ``path``: each piece's characters, mapped back.

    It holds the pieces' bytes alone, since the workers that decode are others
    than those that encode.
    """

    def __init__(self, path: str):
        back = tokens.byte_characters()
        pieces = {rank: spelled(token) for token, rank in read_ranks(path).items()}
        token = [bytes(map(back.__getitem__, pieces.get(i, ""))) for i in range(max(pieces, default=-1) + 1)]
        self.size_of = np.fromiter(map(len, token), np.int64, len(token))
        self.start_of = np.cumsum(self.size_of) - self.size_of
        self.bytes_of = np.frombuffer(b"".join(token), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of a run of ids."""
        size = self.size_of[ids]
        ends = np.cumsum(size)
        return self.bytes_of[np.repeat(self.start_of[ids] - ends + size, size)
                             + np.arange(ends[-1] if len(ends) else 0)].tobytes()


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """The encoder of this worker process for ``path``."""
    return Codec(path)


@lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    """The decoder of this worker process for ``path``."""
    return Decoder(path)


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, ids in tokens.encoded(batch.column("text"), path, codec(path)):
            yield pa.record_batch({
                "doc_id": batch.column("doc_id").slice(lo, len(ids)),
                "n_tokens": pa.array(list(map(len, ids)), pa.int64()),
                "ids": pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary())})


def _decoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held, size, lo = [], 0, 0
        for row, ids in enumerate(batch.column("ids")):
            held.append(decoder(path).decode(np.frombuffer(ids.as_py() or b"", "<u4")))
            size += len(held[-1])
            if size >= OUT_BYTES or row == batch.num_rows - 1:
                cut = batch.slice(lo, len(held))
                yield pa.record_batch({**{c: cut.column(c) for c in ("doc_id", "n_tokens", "ids")},
                                       "decoded": pa.array(held, pa.binary())})
                held, size, lo = [], 0, row + 1


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids) of every row of ``docs`` by the vocabulary at ``path``."""
    rows = docs.selectExpr(f"`{key}` as doc_id", f"`{text}` as text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(lambda batches: _encoded(batches, path),
                           f"doc_id {kind}, n_tokens bigint, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The rows of ``encode`` with the bytes of their ids as ``decoded``."""
    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(
        lambda batches: _decoded(batches, path),
        f"doc_id {kind}, n_tokens bigint, ids binary, decoded binary")
