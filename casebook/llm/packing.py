"""Packing by minimum bin slack over the multiset of remaining lengths.

Documents are cut into pieces of ``WINDOW`` tokens; what is left over is shorter.
How many pieces there are of each length is all that packing needs: a table of
``WINDOW`` numbers, however large the corpus.  For one window after the other, a
bitset subset-sum over that multiset finds the fill closest to capacity that
holds the longest piece left, and backtracking gives the count of each length.
The same pattern is used as often as the counts allow.  A piece then finds its
sequence from its length and its rank among the pieces of that length, with
ranks counted in buckets, so that no task sees all pieces of a common length.

Defined cases: NULL or empty text is the end token alone; rows that repeat are
packed each; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from casebook.llm.common import saved
from casebook.llm.tokens import encoded

WINDOW = 1024
#: The token that closes every document.
END = 0
#: Buckets in which the pieces of one length are ranked.
BUCKETS = 512


def _uses(counts: np.ndarray, longest: int, room: int) -> dict[int, int]:
    """The multiset with ``longest`` in it whose sum comes closest to ``room``.

    Bit s of ``reach`` says that some choice so far sums to s.  The states
    before each length are kept to walk back from the best sum.
    """
    mask, reach, trail = (1 << (room + 1)) - 1, 1 << longest, []
    for length in np.flatnonzero(counts[:room - longest + 1])[::-1].tolist():
        n = min(int(counts[length]) - (length == longest), (room - longest) // length)
        trail.append((length, n, reach))
        step = 1
        while n > 0:  # 1, 2, 4, ... and the rest: any number up to n
            take = min(step, n)
            reach |= reach << (take * length) & mask
            n -= take
            step *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    uses = {longest: 1}
    for length, n, before in reversed(trail):
        k = next(k for k in range(n + 1) if before >> (total - k * length) & 1) if n > 0 else 0
        if k:
            uses[length] = uses.get(length, 0) + k
            total -= k * length
    return uses


def patterns(counts: np.ndarray) -> list[tuple[int, dict[int, int]]]:
    """(repeats, uses of each length) until no piece is left."""
    counts = counts.copy()
    room = len(counts) - 1
    out = []
    while counts.any():
        longest = int(np.flatnonzero(counts)[-1])
        uses = _uses(counts, longest, room)
        repeats = min(int(counts[k]) // n for k, n in uses.items())
        for k, n in uses.items():
            counts[k] -= repeats * n
        out.append((repeats, uses))
    return out


def plan(counts: np.ndarray) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, rank after, first sequence, uses, offset) of all patterns."""
    rank = np.zeros(len(counts), np.int64)
    sequence, out = 0, []
    for repeats, uses in patterns(counts):
        offset = 0
        for length in sorted(uses, reverse=True):
            n, lo = uses[length], int(rank[length])
            out.append((length, lo, lo + repeats * n, sequence, n, offset))
            rank[length] += repeats * n
            offset += n * length
        sequence += repeats
    return out


def pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): each document cut to windows."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    end = np.array([END], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            row, start, length, crc, total = [], [], [], [], []
            for lo, ids in encoded(batch.column(1), tokenizer):
                for i, own in enumerate(ids, lo):
                    raw, n = own.astype("<u4", copy=False).tobytes() + end, len(own) + 1
                    for at in range(0, n, window):
                        row.append(i)
                        start.append(at)
                        length.append(min(window, n - at))
                        crc.append(zlib.crc32(raw[4 * at:4 * (at + window)]))
                        total.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), *(pa.array(x, pa.int64()) for x in (
                    start, length, crc, total))],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return rows.mapInArrow(cut, "doc_id bigint, start bigint, length bigint, "
                                "ids_crc32 bigint, doc_tokens bigint")


def assign(parts: DataFrame, window: int = WINDOW, buckets: int = BUCKETS) -> DataFrame:
    """``parts`` with sequence_id and offset; ``parts`` should be a written table.

    The driver gets ``window`` counts.  The plan it sends back has a few rows
    per length at most, hence the broadcast.
    """
    spark = parts.sparkSession
    key = ["doc_id", "start", "ids_crc32", "doc_tokens"]
    parts = parts.withColumn("_bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)))
    sizes = parts.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    sizes = saved(sizes, "sizes")  # window * buckets rows at most
    counts = np.zeros(window + 1, np.int64)
    for length, n in sizes.groupBy("length").agg(F.sum("_n")).collect():
        counts[length] = n
    columns = "_len bigint, _lo bigint, _hi bigint, _sequence bigint, _uses bigint, _offset bigint"
    steps = F.broadcast(spark.createDataFrame(plan(counts), columns))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(F.col("length").alias("_l"), F.col("_bucket").alias("_b"), F.coalesce(
        F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("length", "_bucket").orderBy(*key))
    ranked = (parts.withColumn("_within", within - 1)
              .join(sizes, (F.col("length") == F.col("_l")) & (F.col("_bucket") == F.col("_b")))
              .withColumn("_rank", F.col("_before") + F.col("_within")))
    j = F.col("_rank") - F.col("_lo")
    return (ranked.join(steps, (F.col("length") == F.col("_len")) & (F.col("_rank") >= F.col("_lo"))
                        & (F.col("_rank") < F.col("_hi")))
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                    (F.col("_sequence") + F.call_function("div", j, F.col("_uses"))).alias("sequence_id"),
                    (F.col("_offset") + j % F.col("_uses") * F.col("length")).alias("offset")))


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW) -> DataFrame:
    """Every document in sequences of ``window`` tokens at most."""
    return assign(saved(pieces(docs, tokenizer, window), "pieces"), window)
