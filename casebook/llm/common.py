"""Helpers shared by the corpus operators: storage, text batches, hashing."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from casebook.session import checkpoint_dir

#: Bytes of text that one numpy step handles; longer documents take several where it matters.
STEP_BYTES = 1 << 20

# --------------------------------------------------------------------- storage


_scope: ContextVar[str | None] = ContextVar("scope", default=None)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under that of the scope, or else under the session's shared checkpoint folder."""
    top = _scope.get() or f"{checkpoint_dir(spark).rstrip('/')}/corpus"
    return f"{top}/{uuid.uuid4().hex}/{name}"


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """What operators store meanwhile is removed at the end.

    Operators return plans over the tables that they stored, so a result must
    be written, to a folder from outside, before the scope ends.
    """
    folder = scratch(spark, "scope")
    token = _scope.set(folder)
    try:
        yield
    finally:
        _scope.reset(token)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def saved(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` to shared storage, a new folder if none is named, and read it back.

    Later stages then read files instead of recomputing, and a lost executor
    costs no more than the tasks it was running.
    """
    path = path or scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def joined_back(df: DataFrame, summary: DataFrame, *keys: str) -> DataFrame:
    """``df`` joined to a table that was aggregated by the same ``keys``.

    An aggregate and a join by the same keys would share one stage, and Spark
    splits skewed partitions only of joins that read plain shuffles.  One more
    key, derived from the others, gives the join shuffles of its own.
    """
    more = F.xxhash64(*keys)
    return (df.withColumn("_more", more).join(summary.withColumn("_more", more), [*keys, "_more"])
            .drop("_more"))


def extended(schema: T.StructType, **columns: str) -> T.StructType:
    """A copy of ``schema`` with more columns, given as name="type"."""
    more = T.StructType.fromDDL(", ".join(f"`{n}` {k}" for n, k in columns.items()))
    return T.StructType(schema.fields + more.fields)


# ---------------------------------------------------------------- text batches


def texts(column: pa.Array | pa.ChunkedArray, step: int = STEP_BYTES,
          ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of documents as (first, end, bytes, offsets); NULL counts as empty.

    ``bytes`` holds the UTF-8 of documents ``first`` to ``end - 1`` without
    gaps and ``offsets`` their bounds, so one numpy step covers many short
    documents.  A run has ``step`` bytes at most unless one document is longer.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + step, "right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi, raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def in_arrow(step: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table | None]):
    """A ``mapInArrow`` function that applies ``step`` to every batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = step(batch) if batch.num_rows else None
            if isinstance(out, pa.Table):
                yield from out.to_batches()
            elif out is not None:
                yield out
    return run


def groups(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """The runs of equal ``keys`` (bigint columns without NULL) in sorted batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy() for k in keys]
        cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1
        if held and any(held[-1].column(k)[-1].as_py() != c[0] for k, c in zip(keys, cols)):
            cuts = np.concatenate(([0], cuts))
        lo = 0
        for c in cuts.tolist():
            if c > lo:
                held.append(batch.slice(lo, c - lo))
            if held:
                yield pa.Table.from_batches(held)
            held, lo = [], c
        held.append(batch.slice(lo))
    if held:
        yield pa.Table.from_batches(held)


# --------------------------------------------------------------------- hashing

#: Base and byte codes of the rolling hash, from a fixed generator.
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_UNBASE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_CODES = np.random.Generator(np.random.PCG64(20240229)).integers(
    1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = []
_FULL = (1 << 64) - 1

#: The white space that separates words: space and \t \n \v \f \r.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _power() -> list[np.ndarray]:
    """Powers of the base and of its inverse, for the positions of one step."""
    if not _powers:
        for base in (_BASE, _UNBASE):
            p = np.full(STEP_BYTES + 1, base, np.uint64)
            p[0] = 1
            _powers.append(np.multiply.accumulate(p))
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (the splitmix64 finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; equal bytes, equal hash.

    Running sums are taken step by step and kept only where a span begins or
    ends, so a text of any length needs memory for its spans and one step.
    """
    up, down = _power()
    if len(buf) <= STEP_BYTES:
        total = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(_CODES[buf] * up[:len(buf)], out=total[1:])
        sums = (total[ends] - total[starts]) * down[starts]
    else:
        places = np.unique(np.concatenate((starts, ends)))
        at = np.empty(len(places), np.uint64)
        back = np.empty(len(places), np.uint64)
        before = np.uint64(0)
        for lo in range(0, len(buf) + 1, STEP_BYTES):
            step = buf[lo:lo + STEP_BYTES]
            total = np.zeros(len(step) + 1, np.uint64)
            scale, unscale = (np.uint64(pow(int(b), lo, _FULL + 1)) for b in (_BASE, _UNBASE))
            np.cumsum(_CODES[step] * up[:len(step)], out=total[1:])
            total = total * scale + before
            a, b = np.searchsorted(places, (lo, lo + STEP_BYTES))
            at[a:b] = total[places[a:b] - lo]
            back[a:b] = down[places[a:b] - lo] * unscale
            before = total[-1]
        i, j = np.searchsorted(places, starts), np.searchsorted(places, ends)
        sums = (at[j] - at[i]) * back[i]
    return mix(sums + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, bounds) of the words; document i has words bounds[i]:bounds[i+1]."""
    n = len(buf)
    solid = ~SPACE[buf]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    before = np.empty(n, bool)
    after = np.empty(n, bool)
    if n:
        before[0] = True
        np.logical_not(solid[:-1], out=before[1:])
        after[-1] = True
        np.logical_not(solid[1:], out=after[:-1])
    starts = np.flatnonzero(solid & (before | first[:-1]))
    ends = np.flatnonzero(solid & (after | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def windows(hashes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of every run of ``width`` words within one document."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.zeros(n, np.uint64)
    for k in range(width):
        h = h * np.uint64(0xFF51AFD7ED558CCD) + hashes[k:k + n]
    whole = np.ones(n, bool)
    for k in range(1, width):  # a window that begins k words before a later bound crosses it
        at = bounds[1:-1] - k
        whole[at[(at >= 0) & (at < n)]] = False
    at = np.flatnonzero(whole)
    return mix(h[at]), at


def doc_of(at: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The document of each word index."""
    return np.searchsorted(bounds, at, "right") - 1
