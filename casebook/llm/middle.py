"""Fill-in-middle transformation of whole texts, batch by batch in pyarrow.compute.

A text is cut into units (a run of ASCII letters, or any other single code
point).  Two hashed cuts part the units into prefix, middle and suffix, which
are written out of order around markers so that a model learns to fill gaps:

* ``psm``: ``<P>`` prefix ``<S>`` suffix ``<M>`` middle
* ``spm``: ``<S>`` suffix ``<P>`` prefix ``<M>`` middle
* ``plain``: the text as it is

All texts of a batch go through one pipeline: a regular expression marks the
end of each unit, a split makes list arrays, the lists are flattened with their
parent indices, ordinals within a document give each unit its role, and the
units of one role are filtered, rebuilt into lists and joined.  A text longer
than ``STEP_BYTES`` goes through in segments that end between units, first for
their counts, then for their roles, so the arrays of a step stay that small.

Defined cases: a NULL text is an empty one; an empty text, and one that holds a
marker, is plain (n counts its units all the same); a NULL key hashes like an
empty string; rows repeat as they come, each by itself; columns other than the
key and the text take no part, so their names cannot clash; an empty table gives
an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from casebook.llm.common import STEP_BYTES, texts

#: Markers before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 texts, this many stay plain; of 100 others, this many are ``spm``.
PLAIN_PERCENT, SPM_PERCENT = 10, 20
#: Part of the hashed key; another one cuts elsewhere.
SEED = "1"

#: Bytes of one unit of UTF-8, and the byte that no UTF-8 has, put after it.
_UNIT = rb"([A-Za-z]+|[^A-Za-z\x80-\xBF][\x80-\xBF]*)"
_END = b"\xff"
_MARKED = "|".join(map(re.escape, (PREFIX, SUFFIX, MIDDLE)))


def _units(segments: pa.Array) -> pa.ListArray:
    """The units of non-empty binary segments, as lists."""
    ended = pc.replace_substring_regex(segments, pattern=_UNIT, replacement=rb"\1" + _END)
    return pc.split_pattern(pc.binary_slice(ended, 0, -1), pattern=_END)


def _parts(units: pa.ListArray, doc: np.ndarray, before: np.ndarray, cuts: np.ndarray) -> list[pa.Array]:
    """Prefix, middle and suffix (binary) of each document.

    ``doc`` is the document of each list, ``before`` the units that a document
    had in earlier steps, ``cuts`` the two cuts of each document.
    """
    flat, parent = pc.list_flatten(units), doc[pc.list_parent_indices(units).to_numpy()]
    size = np.bincount(parent, minlength=len(before))
    ordinal = np.arange(len(parent)) - np.repeat(np.cumsum(size) - size - before, size)
    role = (ordinal >= cuts[0][parent]).astype(np.int8) + (ordinal >= cuts[1][parent])
    out = []
    for r in range(3):
        chosen = role == r
        ends = np.cumsum(np.bincount(parent[chosen], minlength=len(before)))
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), flat.filter(pa.array(chosen)))
        out.append(pc.binary_join(lists, b""))
    return out


def _cuts(n: np.ndarray, hashes: list[np.ndarray]) -> np.ndarray:
    return np.sort(np.stack([h % (n + 1) for h in hashes]), axis=0)


def _short(column: pa.Array, hashes: list[np.ndarray]) -> tuple[np.ndarray, list[pa.Array]]:
    """Unit counts and parts of texts that fit one step."""
    blobs = column.cast(pa.binary())
    filled = np.flatnonzero(pc.binary_length(blobs).to_numpy())
    units = _units(blobs.take(pa.array(filled)))
    n = np.zeros(len(column), np.int64)
    n[filled] = pc.list_value_length(units).to_numpy()
    return n, _parts(units, filled, np.zeros(len(column), np.int64), _cuts(n, hashes))


def segments(blob: bytes, size: int) -> Iterator[bytes]:
    """The blob in segments of ``size`` bytes or more that end between units."""
    step = re.compile(rb"(?s).{1,%d}[A-Za-z]*[\x80-\xBF]*" % size)
    return (m.group() for m in step.finditer(blob))


def _long(text: str, hashes: list[np.ndarray], size: int) -> tuple[np.ndarray, list[pa.Array]]:
    """The same of one text that is longer than a step."""
    blob, one = text.encode(), np.zeros(1, np.int64)
    counts = [len(_units(pa.array([s]))[0]) for s in segments(blob, size)]
    n = np.array([sum(counts)])
    cuts, before, parts = _cuts(n, hashes), 0, [[], [], []]
    for s, count in zip(segments(blob, size), counts):
        for held, part in zip(parts, _parts(_units(pa.array([s])), one, np.array([before]), cuts)):
            held.append(part[0].as_py())
        before += count
    return n, [pa.array([b"".join(p)], pa.binary()) for p in parts]


def _rearranged(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, raw, _ in texts(batch.column("text"), size):
            rows = batch.slice(lo, hi - lo)
            column = rows.column("text").cast(pa.string()).fill_null("")
            hashes = [rows.column(f"h{i}").to_numpy() for i in (1, 2, 3, 4)]
            n, parts = (_long(column[0].as_py(), hashes[:2], size) if len(raw) > size and hi == lo + 1
                        else _short(column, hashes[:2]))
            prefix, middle, suffix = (p.cast(pa.string()) for p in parts)
            plain = pc.or_(pc.match_substring_regex(column, _MARKED),
                           pa.array((n == 0) | (hashes[2] % 100 >= 100 - PLAIN_PERCENT)))
            spm = pa.array(hashes[3] % 100 < SPM_PERCENT)
            join = pc.binary_join_element_wise
            yield pa.record_batch({
                "doc_id": rows.column("doc_id"),
                "n": pa.array(n),
                "form": pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm")),
                "prefix_chars": pc.if_else(plain, None, pc.utf8_length(prefix).cast(pa.int64())),
                "middle_chars": pc.if_else(plain, None, pc.utf8_length(middle).cast(pa.int64())),
                "output": pc.if_else(plain, column, pc.if_else(
                    spm, join(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle, ""),
                    join(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle, ""))),
            })


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text",
              step_bytes: int = STEP_BYTES) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row of ``docs``.

    ``n`` counts units; the code points of prefix and middle are NULL where the
    form is plain.  The cuts depend on the key and the number of units alone.
    """
    digest = F.sha2(F.concat(F.lit(SEED + ":"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    hashed = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), *(
        F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint").alias(f"h{i + 1}") for i in range(4)))
    kind = hashed.schema["doc_id"].dataType.simpleString()
    return hashed.mapInArrow(
        lambda batches: _rearranged(batches, step_bytes),
        f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that ``transform`` made ``output`` of.

    A text with a marker is plain, and no marker can overlap another one, so
    the markers of the other forms are the only ones in their output.
    """
    part = F.split(output, _MARKED, -1)
    return (F.when(form == "psm", F.concat(part[1], part[3], part[2]))
            .when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output))
