"""Byte-pair token ids of whole texts, batch by batch.

The vocabulary splits a text into pieces (a word with its leading space, a run
of digits, of other signs, of white space) and merges inside pieces only, so
the ids of a text are those of its pieces in a row.  Pieces are found for a
whole batch by array operations on code points and looked up by hash in a
memo; only pieces not seen before go to the ``tokenizers`` library.
"""

from __future__ import annotations

import itertools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken

from casebook.llm.common import mix

#: Pieces that a worker remembers; then it starts afresh.
MEMO_PIECES = 400_000
#: Code points of one array step; a longer document is cut into several.
STEP_CHARS = 1 << 19

LETTER, DIGIT, OTHER, SPACE = 0, 1, 2, 3
# The contractions that the vocabulary splits off.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")

_state: dict[str, object] = {}


def _kinds() -> np.ndarray:
    """The class of every code point, in the tables of the tokenizer libraries.

    Both libraries have the same tables; other ones follow other versions of
    Unicode.  A vocabulary of single bytes returns exactly what a pattern matches.
    """
    if "kinds" not in _state:
        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        kinds = np.full(0x110000, OTHER, np.uint8)
        for kind, pattern in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+"), (SPACE, r"\s+")):
            found = tiktoken.Encoding("bytes", pat_str=pattern, special_tokens={}, mergeable_ranks={
                bytes([b]): b for b in range(256)}).encode_ordinary(every)
            kinds[np.frombuffer(bytes(found).decode().encode("utf-32-le"), np.uint32)] = kind
        _state["kinds"] = kinds
    return _state["kinds"]


def pieces(points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Starts of the pieces of texts that lie side by side at ``bounds``."""
    n = len(points)
    kind = _kinds()[points]
    edge = np.zeros(n + 1, bool)  # the first code point of a text
    edge[bounds] = True
    new = np.ones(n, bool)
    new[1:] = (kind[1:] != kind[:-1]) | edge[1:n]
    space = kind == SPACE
    # Before something solid, the last code point of white space parts from the
    # run: a plain space joins what follows, anything else stands alone.
    ahead = np.zeros(n, bool)
    ahead[:-1] = space[:-1] & ~space[1:] & ~edge[1:n]
    start = new | ahead
    joined = np.zeros(n, bool)
    joined[1:] = ahead[:-1] & (points[:-1] == 0x20)
    start &= ~joined
    # An apostrophe that is a piece by itself may take the next letters.
    mark = np.flatnonzero((points == 0x27) & start)
    mark = mark[mark + 1 < n]
    mark = mark[new[mark + 1] & (kind[mark + 1] == LETTER) & ~edge[mark + 1]]
    for at in mark.tolist():
        tail = points[at:at + 3].tobytes().decode("utf-32-le")
        hit = next((c for c in CONTRACTIONS if tail.startswith(c)), None)
        if hit and not edge[at + 1:at + len(hit)].any():
            start[at + 1:at + len(hit)] = False
            if at + len(hit) < n:
                start[at + len(hit)] |= kind[at + len(hit)] == LETTER
    return np.flatnonzero(start)


def byte_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable bytes stand for themselves, the others for the code points from
    256 on, in order.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(other)}}


def _ranks(spec: dict) -> dict[bytes, int] | None:
    """Token bytes to ids, if ids follow the order of the merges."""
    vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
    if any(vocab.get("".join(m)) != 256 + i for i, m in enumerate(pairs)):
        return None
    letters = byte_characters()
    return {bytes(letters[c] for c in token): i for token, i in vocab.items()
            if i < 256 + len(pairs)}


def _special(spec: dict) -> dict[str, int] | None:
    """Strings that are ids of their own, if they match wherever they stand."""
    added = spec.get("added_tokens") or []
    if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or not t.get("special") for t in added):
        return None
    return {t["content"]: t["id"] for t in added}


class Encoder:
    """Token ids by the vocabulary file at ``path``, as the library's plain call gives them.

    A special token's string in a text is that token, and the text around it is
    encoded as separate texts.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ranks, self.special = _ranks(spec), _special(spec)
        if ranks and self.special is not None:
            merge = tiktoken.Encoding("merges", pat_str=r"(?s).+", mergeable_ranks=ranks,
                                      special_tokens={}).encode_ordinary
            self.merged = lambda pieces: list(map(merge, pieces))
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer
            model = Tokenizer.from_file(path)
            self.special = {}
            self.merged = lambda pieces: [
                e.ids for e in model.encode_batch(pieces, add_special_tokens=False)]
        self._forget()

    def _forget(self) -> None:
        self.memo: dict[int, int] = {}
        self.pool = np.zeros(1 << 20, np.uint32)
        self.at = np.zeros(1 << 16, np.int64)
        self.size = np.zeros(1 << 16, np.int64)
        self.used = 0

    def _learn(self, hashes: list[int], pieces: list[str]) -> None:
        ids = self.merged(pieces)
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        k, n, total = len(self.memo), len(ids), int(size.sum())
        while k + n > len(self.at):
            self.at, self.size = (np.concatenate((x, np.zeros_like(x))) for x in (self.at, self.size))
        while self.used + total > len(self.pool):
            self.pool = np.concatenate((self.pool, np.zeros_like(self.pool)))
        self.pool[self.used:self.used + total] = np.fromiter(
            itertools.chain.from_iterable(ids), np.uint32, total)
        self.at[k:k + n] = self.used + np.cumsum(size) - size
        self.size[k:k + n] = size
        self.used += total
        self.memo.update(zip(hashes, range(k, k + n)))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds) of a few texts, one after the other."""
        joined = "".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        bounds = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) for t in texts], out=bounds[1:])
        if not len(points):
            return np.zeros(0, np.uint32), bounds
        start = pieces(points, bounds)
        end = np.append(start[1:], len(points))
        hashes = _point_hashes(points, start, end)
        known, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        keys = known.tolist()
        fresh = [i for i, h in enumerate(keys) if h not in self.memo]
        if len(self.memo) + len(fresh) > MEMO_PIECES and self.memo:
            self._forget()
            fresh = range(len(keys))
        at = first[fresh] if len(fresh) else first[:0]
        self._learn([keys[i] for i in fresh],
                    [joined[a:b] for a, b in zip(start[at].tolist(), end[at].tolist())])
        row = np.fromiter(map(self.memo.__getitem__, keys), np.int64, len(keys))[back]
        size = self.size[row]
        cut = np.zeros(len(row) + 1, np.int64)
        np.cumsum(size, out=cut[1:])
        ids = self.pool[np.repeat(self.at[row] - cut[:-1], size) + np.arange(cut[-1])]
        return ids, cut[np.searchsorted(start, bounds)]


_CODES = np.random.Generator(np.random.PCG64(5)).integers(1, 1 << 63, 0x110000, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _point_hashes(points: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each piece: sums of codes times powers of an odd base."""
    n = len(points)
    power = _state.get("power")
    if power is None or len(power[0]) < n + 1:
        power = []
        for base in (_BASE, np.uint64(pow(int(_BASE), -1, 1 << 64))):
            p = np.full(max(n, STEP_CHARS) + 1, base, np.uint64)
            p[0] = 1
            power.append(np.multiply.accumulate(p))
        _state["power"] = power
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_CODES[points] * power[0][:n], out=total[1:])
    return mix((total[end] - total[start]) * power[1][start] + (end - start).astype(np.uint64))


def encoder(path: str) -> Encoder:
    """The encoder of this worker process for ``path``."""
    if _state.get("path") != path:
        _state["path"], _state["encoder"] = path, Encoder(path)
    return _state["encoder"]


#: A place where pieces part whatever else the text holds: solid before white
#: space, or a plain letter or digit before a plain sign.
_PART = re.compile(r"(?<=\S)(?=[ \t\n])|(?<=[A-Za-z0-9\u3041-\u3096\u4e00-\u9fa5\uac00-\ud7a3])"
                   r"(?=[!-&(-/:-@\u3001\u3002\uff0c])")


def _cut(text: str, size: int) -> Iterator[str]:
    """``text`` in parts of ``size`` code points or more whose ids are those of the whole."""
    lo = 0
    while len(text) - lo > size:
        m = _PART.search(text, lo + size)
        if not m:
            break
        yield text[lo:m.start()]
        lo = m.start()
    yield text[lo:]


def _whole(model: Encoder, text: str, size: int) -> np.ndarray:
    """The ids of a text that is long or holds special tokens."""
    out, strings = [np.zeros(0, np.uint32)], sorted(model.special, key=len, reverse=True)
    parts = re.split("(" + "|".join(map(re.escape, strings)) + ")", text) if strings else [text]
    for part in parts:
        if part in model.special:
            out.append(np.array([model.special[part]], np.uint32))
        else:
            out += [model.encode([p])[0] for p in _cut(part, size)]
    return np.concatenate(out)


def encoded(column: pa.Array, path: str, model: Encoder | None = None,
            step_chars: int = STEP_CHARS) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, ids of each row) for runs of a text column; NULL counts as empty."""
    model = model or encoder(path)
    rows = column.fill_null("").to_pylist()
    apart = [len(r) > step_chars or any(t in r for t in model.special) for r in rows]
    lo = 0
    while lo < len(rows):
        if apart[lo]:
            yield lo, [_whole(model, rows[lo], step_chars)]
            lo += 1
            continue
        hi, chars = lo + 1, len(rows[lo])
        while hi < len(rows) and not apart[hi] and chars + len(rows[hi]) <= step_chars:
            chars += len(rows[hi])
            hi += 1
        ids, bounds = model.encode(rows[lo:hi])
        yield lo, [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        lo = hi
