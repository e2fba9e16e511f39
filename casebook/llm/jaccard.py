"""N-gram Jaccard join with Bayesian pruning of candidates.

Documents with the same words in the same order are copies and enter as one
text.  Texts that agree on all rows of a MinHash band share a bucket.  In a
bucket, pairs are compared MinHash value by MinHash value and dropped as soon
as the posterior probability that their similarity reaches the threshold falls
below ``TOLERANCE``.  What survives joins texts into components, small enough
to hold shingles in; there the pairs are pruned in the same way, and every pair
that is left is verified on the exact shingle sets.

No pair is ever a row: a block of texts is compared as a matrix and gives one
row per text, with its links and one edge towards its group.  Large buckets and
components are split into blocks, and every pair of blocks is a task of its own.

Shingles are runs of ``SHINGLE`` words, as 64-bit hashes; a shorter document is
one shingle.  Defined cases: NULL text counts as empty; documents without words
are copies of each other; rows that repeat are copies; NULL ids take part, and
a class takes its name from its smallest id that is not NULL, or else a negative
one from its first digest; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from casebook.llm.common import (doc_of, extended, free_name, groups, in_arrow, joined_back,
                                 mix, saved, span_hashes, texts, windows, words)
from casebook.llm.components import components

SHINGLE = 5
THRESHOLD = Fraction(4, 5)
#: Bands of MinHash values: at similarity 0.8 a pair misses all of them with 5e-8.
BANDS = 32
ROWS = 4
VALUES = BANDS * ROWS
#: Posterior probability below which a pair is dropped.
TOLERANCE = 1e-6
#: MinHash values that one step of the comparison reads.
STEP = 16
#: Texts of a block: of MinHash values only, and with their shingles.
BUCKET_BLOCK = 4096
TEXT_BLOCK = 512

_rng = np.random.Generator(np.random.PCG64(77))
_MULT = _rng.integers(1, 1 << 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _rng.integers(0, 1 << 63, VALUES, dtype=np.uint64)


def fewest_matches(threshold: float, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """(values compared, matches below which a pair is dropped), step by step.

    With a uniform prior, the posterior after m matches in n values is a Beta
    distribution, whose upper tail at t is the chance that a Binomial(n + 1, t)
    is m at most.
    """
    out = []
    for n in range(STEP, VALUES + 1, STEP):
        below, m = 0.0, -1
        while below < tolerance:
            m += 1
            below += math.comb(n + 1, m) * threshold**m * (1 - threshold)**(n + 1 - m)
        out.append((n, m))
    return out


# ------------------------------------------------------------------- signatures


def shingles(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of all shingles, document by document."""
    grams, at = windows(hashes, bounds, SHINGLE)
    doc = doc_of(at, bounds)
    count = np.diff(bounds)
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    if len(short):
        h = np.zeros(len(short), np.uint64)
        for k in range(SHINGLE - 1):
            has = count[short] > k
            h[has] = mix(h[has] * np.uint64(31) + hashes[bounds[short[has]] + k])
        doc = np.concatenate((doc, short))
        order = np.argsort(doc, kind="stable")
        grams, doc = np.concatenate((grams, h))[order], doc[order]
    return grams, doc


def signatures(grams: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """MinHash values of ``n`` documents; all ones where there is no shingle."""
    out = np.full((n, VALUES), 0xFFFFFFFF, np.uint32)
    if len(grams):
        head = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
        rows = doc[head]
        work = np.empty_like(grams)
        for k in range(VALUES):
            np.multiply(grams, _MULT[k], out=work)
            work += _PLUS[k]
            out[rows, k] = np.minimum.reduceat(work, head) >> np.uint64(32)
    return out


def _digest(raw: bytes) -> bytes:
    return hashlib.blake2b(b" ".join(raw.split()), digest_size=16).digest()


def _rows(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.xxhash64(F.coalesce(text, F.lit(""))).alias("crc"), text.alias("text"))


def signed(docs: DataFrame) -> DataFrame:
    """(doc_id, crc, digest, signature) of every row; ``crc`` hashes the text as it is."""
    rows = _rows(docs)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        digests, values = [], []
        for _, _, buf, offsets in texts(batch.column(2)):
            starts, ends, bounds = words(buf, offsets)
            grams, doc = shingles(span_hashes(buf, starts, ends), bounds)
            n = len(offsets) - 1
            values += [row.tobytes() for row in signatures(grams, doc, n)]
            raw, at = buf.tobytes(), offsets.tolist()
            digests += [_digest(raw[at[i]:at[i + 1]]) for i in range(n)]
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:2], pa.array(digests, pa.binary()), pa.array(values, pa.binary())],
            ["doc_id", "crc", "digest", "signature"])

    return rows.mapInArrow(in_arrow(step), "doc_id bigint, crc bigint, digest binary, signature binary")


# -------------------------------------------------------------------- candidates


def survivors(left: np.ndarray, right: np.ndarray, steps: list[tuple[int, int]]) -> np.ndarray:
    """Which (left, right) pairs are never dropped, as a matrix of booleans."""
    alive = np.ones((len(left), len(right)), bool)
    for lo in range(0, len(left), 64):
        block = left[lo:lo + 64]
        match = np.zeros((len(block), len(right)), np.int16)
        cols = np.arange(len(right))
        for n, least in steps:
            at = slice(n - STEP, n)
            match[:, cols] += (block[:, None, at] == right[None, cols, at]).sum(2, dtype=np.int16)
            keep = match >= least
            alive[lo:lo + 64] &= keep
            cols = np.flatnonzero(alive[lo:lo + 64].any(0))
            if not len(cols):
                break
    return alive


def _reach(values: np.ndarray, steps: list[tuple[int, int]]) -> np.ndarray:
    """A component number for each row, over the pairs that survive.

    A row once reached is not compared again from the other side, so a block of
    texts that are all alike takes one pass.
    """
    label = np.full(len(values), -1)
    left = np.arange(len(values))
    for seed in range(len(values)):
        if label[seed] >= 0:
            continue
        label[seed] = seed
        left, queue = left[left != seed], [np.array([seed])]
        while queue and len(left):
            found = left[survivors(values[queue.pop()], values[left], steps).any(0)]
            if len(found):
                label[found] = seed
                left = np.setdiff1d(left, found, assume_unique=True)
                queue.append(found)
    return label


def _tiles(members: DataFrame, key: str, number: str, size: str, block: int) -> DataFrame:
    """``members`` dealt to every pair of blocks (i, j) of their group, i <= j."""
    blocks = F.ceil(F.col(size) / F.lit(block)).cast("bigint")
    own = F.pmod(F.xxhash64(number), F.col("_blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_blocks") - 1))
    return (members.withColumn("_blocks", blocks).withColumn("own", own)
            .withColumn("_other", other)
            .withColumn("i", F.least("own", "_other")).withColumn("j", F.greatest("own", "_other"))
            .drop("_blocks", "_other")
            .repartition(key, "i", "j").sortWithinPartitions(key, "i", "j", "own", number))


def _candidates(known: DataFrame, threshold: float) -> DataFrame:
    """Edges (u, v) whose components hold every pair that bands and pruning leave."""
    band = F.col("band")
    bands = (known.select("number", "signature", F.explode(F.expr(
                f"sequence(0, {BANDS - 1})")).alias("band"))
             .select("number", F.xxhash64(band, F.substring("signature", band * ROWS * 4 + 1,
                                                            F.lit(ROWS * 4))).alias("bucket")))
    same = [F.bit_xor(F.xxhash64("number", F.lit(k))) for k in (0, 1)]
    shared = (bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), same[0].alias("a"),
                                          same[1].alias("b"))
              .where("size > 1")
              .groupBy("size", "a", "b").agg(F.min("bucket").alias("bucket"))  # one bucket per set of texts
              .select("bucket", "size"))
    members = (bands.join(shared, "bucket").join(known.select("number", "signature"), "number"))
    steps = fewest_matches(threshold)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u, v = [], []
        for group in groups(batches, "bucket", "i", "j"):
            number = group.column("number").to_numpy()
            raw = b"".join(group.column("signature").to_pylist())
            label = _reach(np.frombuffer(raw, np.uint32).reshape(-1, VALUES), steps)
            other = label != np.arange(len(label))
            u.append(number[other])
            v.append(number[label[other]])
            if len(u) >= 4096:
                yield pa.record_batch({"u": np.concatenate(u), "v": np.concatenate(v)})
                u, v = [], []
        if u:
            yield pa.record_batch({"u": np.concatenate(u), "v": np.concatenate(v)})

    return _tiles(members, "bucket", "number", "size", BUCKET_BLOCK).mapInArrow(
        link, "u bigint, v bigint")


# ------------------------------------------------------------------ verification


def _sets(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The distinct shingles of each text, sorted."""
    out = []
    for _, _, buf, offsets in texts(column):
        starts, ends, bounds = words(buf, offsets)
        grams, doc = shingles(span_hashes(buf, starts, ends), bounds)
        cuts = np.searchsorted(doc, np.arange(len(offsets)))
        out += [np.unique(grams[cuts[i]:cuts[i + 1]]) for i in range(len(offsets) - 1)]
    return out


def overlaps(sets: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of all intersections: products of the incidence matrix, slab by slab."""
    n = len(sets)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    _, col, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[col] > 1
    rank = np.cumsum(count > 1) - 1
    row, col = row[shared], rank[col[shared]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    out = np.zeros((n, n), np.int64)
    for lo in range(0, int((count > 1).sum()), width):
        a, b = np.searchsorted(col, (lo, lo + width))
        slab = np.zeros((n, width), np.float32)
        slab[row[a:b], col[a:b] - lo] = 1
        out += (slab @ slab.T).astype(np.int64)
    return out


def linked(sets: list[np.ndarray], values: np.ndarray, side: np.ndarray, across: bool,
           threshold: Fraction, steps: list[tuple[int, int]]) -> np.ndarray:
    """The symmetric matrix of verified links among the texts of a task.

    ``across``: only pairs with one text on either ``side`` belong to this task.
    """
    if across:
        a, b = (np.flatnonzero(side == x) for x in (side.min(), side.max()))
        alive = np.zeros((len(side), len(side)), bool)
        alive[np.ix_(a, b)] = survivors(values[a], values[b], steps)
        alive |= alive.T
    else:
        alive = survivors(values, values, steps)
    np.fill_diagonal(alive, False)
    rows = np.flatnonzero(alive.any(1))
    out = np.zeros_like(alive)
    if len(rows):
        size = np.array([len(sets[r]) for r in rows])
        both = overlaps([sets[r] for r in rows])
        whole = size[:, None] + size[None, :] - both
        out[np.ix_(rows, rows)] = both * threshold.denominator >= whole * threshold.numerator
        out &= alive
    return out


def _least_linked(links: np.ndarray, number: np.ndarray) -> np.ndarray:
    """The smallest number that each text of a task reaches by links."""
    out = np.full(len(number), -1, np.int64)
    for seed in np.argsort(number, kind="stable").tolist():
        if out[seed] < 0:
            front = np.array([seed])
            while len(front):
                out[front] = number[seed]
                front = np.flatnonzero(links[front].any(0) & (out < 0))
    return out


def _verified(docs: DataFrame, known: DataFrame, parts: DataFrame, threshold: Fraction) -> DataFrame:
    """(u, v, docs, texts) per text and task: an edge towards its group, and its links."""
    sizes = parts.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    members = (joined_back(parts, sizes, "root").withColumnRenamed("node", "number")
               .join(known, "number"))
    # The hash of the text keeps rows of one id, or without any, apart; of rows
    # that repeat in both one is sent on.
    rows = _rows(docs)
    members = (rows.join(members, (rows["crc"] == members["lead_crc"])
                         & rows["doc_id"].eqNullSafe(members["least_id"]))
               .select("root", "size", "number", "digest", "signature", "copies", "text")
               .dropDuplicates(["number"]))
    steps = fewest_matches(float(threshold))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, "root", "i", "j"):
            number = group.column("number").to_numpy()
            text = [t or "" for t in group.column("text").to_pylist()]
            new = np.concatenate(([True], number[1:] != number[:-1]))
            own = [_digest(t.encode()) == d for t, d in zip(text, group.column("digest").to_pylist())]
            take: dict[int, int] = {}
            for at, (x, ok) in enumerate(zip(number.tolist(), own)):
                if ok:  # a row of another text with the same hash is not this text
                    take.setdefault(x, at)
            if len(take) < 2:
                continue
            group = group.take(list(take.values()))
            number = group.column("number").to_numpy()
            copies = group.column("copies").to_numpy()
            side = group.column("own").to_numpy()
            i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
            raw = b"".join(group.column("signature").to_pylist())
            links = linked(_sets(group.column("text")),
                           np.frombuffer(raw, np.uint32).reshape(-1, VALUES), side, i != j,
                           threshold, steps)
            has = np.flatnonzero(links.any(1))
            if len(has):
                yield pa.record_batch({
                    "u": number[has], "v": _least_linked(links, number)[has],
                    "docs": (links[has] @ copies), "texts": links[has].sum(1)})

    return _tiles(members, "root", "number", "size", TEXT_BLOCK).mapInArrow(
        verify, "u bigint, v bigint, docs bigint, texts bigint")


# ------------------------------------------------------------------------- join


def join(docs: DataFrame, threshold: Fraction = THRESHOLD) -> DataFrame:
    """The classes of similar documents, one row per row of ``docs``.

    Returns doc_id, digest (of the words), class_id, n_links (other documents
    with at least ``threshold`` in common), n_text_links (the same, copies
    counted once), n_copies (rows with the same words) and keeper_digest, which
    with class_id names the one document of the class that a filter keeps.
    """
    rows = saved(signed(docs), "signed")
    lead = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "crc"))
    known = (rows.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"), lead.alias("lead"),
                                        F.first("signature").alias("signature"))
             .select("digest", "copies", F.col("lead.doc_id").alias("least_id"),
                     F.col("lead.crc").alias("lead_crc"), "signature")
             .withColumn("number", F.monotonically_increasing_id()))
    known = saved(known, "texts")
    parts = saved(components(_candidates(known, float(threshold))), "parts")
    found = saved(_verified(docs, known, parts, threshold), "links")
    roots = components(found.select("u", "v"))
    links = found.groupBy("u").agg(F.sum("docs").alias("docs"), F.sum("texts").alias("texts"))
    grouped = (known.select("number", "digest", "copies", "least_id")
               .join(links, F.col("number") == F.col("u"), "left")
               .join(roots, F.col("number") == F.col("node"), "left")
               .withColumn("root", F.coalesce("root", "number")))
    grouped = saved(grouped.select("digest", "copies", "least_id", "root", "number",
                                   F.coalesce("docs", F.lit(0)).alias("docs"),
                                   F.coalesce("texts", F.lit(0)).alias("texts")), "grouped")
    first = F.struct(F.col("least_id").isNull().alias("none"), "least_id", "digest")
    names = grouped.groupBy("root").agg(F.min(first).alias("first"))
    grouped = joined_back(grouped, names, "root").select(
        "digest", F.coalesce("first.least_id", F.shiftrightunsigned(F.xxhash64("first.digest"), 1)
                             .bitwiseOR(F.lit(-1 << 63))).alias("class_id"),
        (F.col("docs") + F.col("copies") - 1).alias("n_links"),
        F.col("texts").alias("n_text_links"), F.col("copies").alias("n_copies"),
        F.col("first.digest").alias("keeper_digest"))
    return rows.select("doc_id", "digest").join(grouped, "digest").select(
        "doc_id", "digest", "class_id", "n_links", "n_text_links", "n_copies", "keeper_digest")


def one_of_each(docs: DataFrame, threshold: Fraction = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each class: the one with the smallest id."""
    keepers = (join(docs, threshold)
               .where((F.col("digest") == F.col("keeper_digest"))
                      & (F.col("doc_id").eqNullSafe(F.col("class_id"))
                         | (F.col("doc_id").isNull() & (F.col("class_id") < 0))))
               .select("doc_id", "digest").distinct())
    own = docs.columns
    at_text = [c.lower() for c in own].index("text")
    name = free_name(docs, "_digest")

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        digests = [_digest((t or "").encode()) for t in batch.column(at_text).to_pylist()]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.binary())],
                                          [*own, name])

    tagged = docs.mapInArrow(in_arrow(step), extended(docs.schema, **{name: "binary"}))
    kept = tagged.join(keepers, (tagged[name] == keepers["digest"])
                       & tagged["doc_id"].eqNullSafe(keepers["doc_id"]), "left_semi")
    return kept.dropDuplicates([name, "doc_id"]).select(*own)
