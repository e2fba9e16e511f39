"""Spelling variants: words one edit apart, by blocked Gram matrices.

``words`` counts the words of whole texts.  ``variants`` finds, for each word,
the words that differ from it by one inserted, deleted or replaced code point,
and the commoner spelling that it is probably a variant of.

A word becomes the vector of its letter counts.  One replaced letter changes two
counts by one and one inserted letter changes one, so words one edit apart have
a squared distance of two at most and lengths one apart at most.  A matrix
product of two blocks of vectors gives the squared distances of all their pairs
at once; pairs of at most two are compared letter by letter.

Blocks meet only where they can hold such pairs.  Letters are dealt into
``GROUPS`` classes; a cell holds the words with the same count of letters in
each class, hence of one length.  An edit moves a word to the same cell, to one
of the cells with one letter of another class instead, or to one of the cells of
the next length with one letter more; each word visits these cells, each pair of
cells once.  A cell of over ``BLOCK`` words is cut into blocks by hash, which its
visitors see one after the other, so a task holds one block and one batch of
visitors.  Pairs never leave a task: it sends, for each word, how many near words
it saw and the commonest of them.

Defined cases: a NULL text has no words; a NULL key is spelled as an empty string
where it decides on a deletion; rows repeat as they come and each counts; columns
other than the key and the text take no part; among near words of equal counts
the first in code-point order is the form; an empty table gives an empty result.
Long texts are searched in segments that end between words.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from casebook.llm.common import saved

#: The letters of a word, as a pattern.
LETTERS = r"[A-Za-zÀ-ÿ]"
#: Words have at least so many code points and occurrences.
MIN_CHARS, MIN_COUNT = 6, 5
#: Where this divides the checksum of an occurrence, one of its letters is left out.
SLIP = 199
#: A form occurs at least so many times as often as its variant.
RATIO = 5

#: Code points of one segment of a text, at least.
SEGMENT = 60_000
#: Classes of letters that cells tell apart.
GROUPS = 6
#: Words of a block of one cell, on average; visitors that one product takes.
BLOCK, VISITORS = 2048, 4096

#: A word in its cell; a visitor of the same length; one that is a letter shorter.
HOME, SAME, SHORT = 0, 1, 2


# ------------------------------------------------------------------------ words


def words(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): the words of all texts with their occurrences."""
    long = rf"(?s).{{1,{SEGMENT}}}{LETTERS}*"
    segments = F.when(F.length("text") <= SEGMENT, F.array("text")).otherwise(
        F.regexp_extract_all("text", F.lit(long), F.lit(0)))
    rows = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), F.col(text).alias("text"))
    runs = (rows.where("text is not null").select("id", F.explode(segments).alias("text"))
            .select("id", F.explode(F.regexp_extract_all(
                "text", F.lit(f"{LETTERS}{{{MIN_CHARS},}}"), F.lit(0))).alias("run"))
            .select("id", F.translate("run", string.ascii_uppercase, string.ascii_lowercase).alias("run")))
    check = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (F.col("check") % F.length("run")).cast("int")
    slipped = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    return (runs.withColumn("check", check)
            .select(F.when(F.col("check") % SLIP == 0, slipped).otherwise(F.col("run")).alias("word"))
            .where(F.length("word") >= MIN_CHARS)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_COUNT))


# ------------------------------------------------------------------------ cells


def _class_counts(word: Column) -> list[Column]:
    """The number of letters of each class; a code point's class is its remainder."""
    letters = [*map(ord, string.ascii_lowercase), *range(0xC0, 0x100)]
    return [F.length(word) - F.length(F.translate(word, "".join(chr(c) for c in letters if c % GROUPS == g), ""))
            for g in range(GROUPS)]


def _visits(counts: list[Column]) -> Column:
    """The cells that a word goes to, each with its role there."""
    def cell(role: int, more: int | None = None, less: int | None = None) -> Column:
        moved = [(c + ((g == more) - (g == less))).cast("string") for g, c in enumerate(counts)]
        return F.struct(F.concat_ws(",", *moved).alias("cell"), F.lit(role).alias("role"))

    own = [cell(HOME)]
    longer = [cell(SHORT, more=g) for g in range(GROUPS)]
    swapped = [F.when(counts[h] > 0, cell(SAME, more=g, less=h)) for g in range(GROUPS) for h in range(g + 1, GROUPS)]
    return F.array_compact(F.array(*own, *longer, *swapped))


def _dealt(counted: DataFrame) -> DataFrame:
    """(id, block, role, word, n): who meets whom, in order within a task."""
    classes = [f"c{g}" for g in range(GROUPS)]
    sized = counted.select("word", "n", *(c.alias(n) for c, n in zip(_class_counts(F.col("word")), classes)))
    cells = saved(sized.groupBy(F.concat_ws(",", *(F.col(c).cast("string") for c in classes)).alias("cell"))
                  .agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
                  .withColumn("id", F.monotonically_increasing_id()), "cells")
    visits = (sized.select("word", "n", F.explode(_visits([F.col(c) for c in classes])).alias("visit"))
              .select("word", "n", "visit.cell", "visit.role").join(cells, "cell"))
    home = F.pmod(F.xxhash64("word"), F.col("blocks").cast("bigint")).cast("int")
    first = F.when(F.col("role") == HOME, home).otherwise(F.lit(0))
    return (visits.withColumn("first", first)
            .withColumn("block", F.explode(F.sequence("first", F.col("blocks") - 1)))
            .withColumn("role", F.when((F.col("role") == HOME) & (F.col("block") > F.col("first")), SAME)
                        .otherwise(F.col("role")))
            .select("id", "block", "role", "word", "n")
            .repartition("id", "block").sortWithinPartitions("id", "block", "role"))


# --------------------------------------------------------------------- products


def _points(batch: pa.Table | pa.RecordBatch, length: int) -> np.ndarray:
    """The code points of words of one length, a row for each."""
    joined = "".join(batch.column("word").to_pylist())
    return np.frombuffer(joined.encode("utf-32-le"), np.uint32).reshape(-1, length)


def _letter_counts(points: np.ndarray) -> np.ndarray:
    """A column for each letter: a to z, then U+00C0 to U+00FF."""
    n, wide = len(points), 26 + 64
    column = np.where(points < 0xC0, points.astype(np.int64) - ord("a"), points.astype(np.int64) - 0xC0 + 26)
    return np.bincount((column + np.arange(n)[:, None] * wide).ravel(), minlength=n * wide).reshape(n, wide)


def close_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of two count matrices at a squared distance of two at most.

    One product of widened matrices gives all negated squared distances.  They
    are whole numbers, exact in float32 below 2^24 and in float64 above.
    """
    kind = np.float32 if max(a.sum(1).max(), b.sum(1).max()) < 2000 else np.float64
    used = np.flatnonzero(a.any(axis=0))
    left = np.empty((len(a), len(used) + 2), kind)
    right = np.empty((len(b), len(used) + 2), kind)
    left[:, :-2], right[:, :-2] = 2 * a[:, used], b[:, used]
    left[:, -2], right[:, -2] = -1, (b * b).sum(1)
    left[:, -1], right[:, -1] = -(a * a).sum(1), 1
    hits = np.flatnonzero((left @ right.T).ravel() >= -2)
    return hits // len(b), hits % len(b)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of code points are one edit apart; ``b`` may be one shorter."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(1) == 1
    length = b.shape[1]
    front = np.logical_and.accumulate(a[:, :length] == b, axis=1).sum(1)
    back = np.logical_and.accumulate((a[:, 1:] == b)[:, ::-1], axis=1).sum(1)
    return front + back >= length


class _Side:
    """Words of one length, with their vectors."""

    def __init__(self, batch: pa.Table | pa.RecordBatch, length: int):
        self.word, self.n = batch.column("word"), batch.column("n").to_numpy()
        self.points = _points(batch, length)
        self.counts = _letter_counts(self.points)


def _seen(i: np.ndarray, j: np.ndarray, a: _Side, b: _Side) -> pa.RecordBatch | None:
    """For the words of ``a``: how many of ``b`` are near, and the commonest."""
    near = b.word.take(pa.array(j)).to_numpy(zero_copy_only=False).astype(str)
    order = np.lexsort((near, -b.n[j], i))
    who, first, count = np.unique(i[order], return_index=True, return_counts=True)
    best = order[first]
    return pa.record_batch({"word": a.word.take(pa.array(who)), "n_near": pa.array(count, pa.int64()),
                            "best_n": pa.array(b.n[j[best]], pa.int64()), "best": pa.array(near[best].tolist(), pa.string())})


def _met(a: _Side, b: _Side, own: bool) -> Iterator[pa.RecordBatch]:
    """What two sides see of each other; ``own`` tells that they are one side."""
    i, j = close_pairs(a.counts, b.counts)
    if own:
        i, j = i[i < j], j[i < j]
    good = np.concatenate([one_edit(a.points[i[k:k + 65536]], b.points[j[k:k + 65536]])
                           for k in range(0, len(i), 65536)] or [np.zeros(0, bool)])
    i, j = i[good], j[good]
    if len(i):
        yield _seen(i, j, a, b)
        yield _seen(j, i, b, a)


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of near words, block by block of sorted rows."""
    cell, held, home = None, [], None

    def settled() -> _Side | None:
        table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        return _Side(table, len(table.column("word")[0].as_py()))

    for batch in batches:
        marks = [batch.column(c).to_numpy() for c in ("id", "block", "role")]
        cuts = np.flatnonzero(np.any([m[1:] != m[:-1] for m in marks], axis=0)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            if lo == hi:
                continue
            rows = batch.slice(lo, hi - lo)
            if cell != (marks[0][lo], marks[1][lo]):
                if held:
                    home = settled()
                    yield from _met(home, home, True)
                cell, held, home = (marks[0][lo], marks[1][lo]), [], None
            if marks[2][lo] == HOME:
                held.append(rows)
                continue
            if home is None:
                if not held:  # a block without words of its own
                    continue
                home, held = settled(), []
                yield from _met(home, home, True)
            length = home.points.shape[1] - (marks[2][lo] == SHORT)
            for k in range(0, rows.num_rows, VISITORS):
                yield from _met(home, _Side(rows.slice(k, VISITORS), length), False)
    if held:
        home = settled()
        yield from _met(home, home, True)


# ------------------------------------------------------------------------ forms


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words that have a form: the last form that a chain reaches.

    Counts grow by ``RATIO`` along a chain, so its length is bounded by their
    logarithm; each round doubles the steps taken.
    """
    top = forms.agg(F.max("form_n")).first()[0] or 1
    steps = max(1, math.floor(math.log(top, RATIO)))
    now = saved(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(math.ceil(math.log2(steps))):
        further = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = saved(now.join(further, "root", "left")
                    .select("word", F.coalesce("further", "root").alias("root")), "roots")
    return now


def variants(counted: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every row of ``counted``.

    ``counted`` has (word, n) with distinct words of the letters a to z and
    U+00C0 to U+00FF and n of 1 or more.
    """
    counted = saved(counted.select("word", "n"), "words")
    seen = _dealt(counted).mapInArrow(_near, "word string, n_near bigint, best_n bigint, best string")
    best = F.struct((-F.col("best_n")).alias("minus"), F.col("best").alias("word"))
    per_word = (counted.select("word", "n", F.lit(0).cast("bigint").alias("n_near"),
                               F.lit(None).cast("bigint").alias("best_n"), F.lit(None).cast("string").alias("best"))
                .unionByName(seen.withColumn("n", F.lit(None).cast("bigint")))
                .groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"),
                                     F.min(F.when(F.col("best_n").isNotNull(), best)).alias("best")))
    close = -F.col("best.minus") >= RATIO * F.col("n")
    named = saved(per_word.select("word", "n", "n_near", F.when(close, F.col("best.word")).alias("form"),
                                  F.when(close, -F.col("best.minus")).alias("form_n")), "forms")
    roots = _roots(named.where("form is not null"))
    return named.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
