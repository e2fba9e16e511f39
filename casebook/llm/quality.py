"""Quality rules: word statistics, then a hashed n-gram likelihood ratio.

Two multinomials over hashed byte n-grams are compared: one counted on trusted
target documents, all of them, and one on the whole raw corpus.  A document's score is the sum,
over its n-grams, of the log ratio of the two smoothed probabilities, divided by
their number and ``PRIOR_GRAMS`` more, which pull short texts towards 0; else its
length cancels out.  Every document is held against the same threshold, which
follows from the scores of the trusted documents.

Defined cases: NULL text counts as empty; a document without n-grams scores 0;
one without words fails the base rule, whatever the n-grams of its white space
score; repeated rows are counted and judged one by one; an
empty table gives an empty result; without trusted documents every score is 0.
A label row with NULL in ``doc_id`` marks nothing; a document is trusted only
if none of its label rows says otherwise.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from casebook.llm.common import (SPACE, STEP_BYTES, doc_of, extended, in_arrow, saved, span_hashes,
                                 texts, windows, words)

#: Hash buckets of the two multinomials; bounds everything the driver holds.
BUCKETS = 1 << 16
#: The threshold lies this far below this quantile of the trusted documents' own
#: scores: what is rejected is half as likely, n-gram for n-gram, as they are.
QUANTILE = 0.01
MARGIN = math.log(2)
#: Pseudo-count of every bucket.
SMOOTHING = 1.0
#: Bins of one pass over the scores on the way to the quantile.
QUANTILE_BINS = 4096
#: Length of the n-grams, in bytes.  Parts of words recur in any text of a
#: language, so that few trusted documents are enough.
ORDER = 3
#: n-grams of prior weight with ratio 0, so that short texts are judged mildly.
PRIOR_GRAMS = 40

# Fixed values of the base rule.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
REPEAT_WINDOW = 5
SYMBOLS = b"#*$%&|<>"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def _counts(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many bytes of each document are marked."""
    return np.diff(np.searchsorted(np.flatnonzero(marks), offsets))


def _distinct(keys: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Distinct keys of each document."""
    order = np.lexsort((keys, doc))
    k, d = keys[order], doc[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
    return np.bincount(d[new], minlength=n)


def measure(buf: np.ndarray, offsets: np.ndarray, hashes: np.ndarray, starts: np.ndarray,
            ends: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """The base measures of every document of a run."""
    n = len(offsets) - 1
    # Of the code points, those in words are all but the white space.
    chars = _counts(((buf & 0xC0) != 0x80) & ~SPACE[buf], offsets)

    newline = np.flatnonzero(buf == 10)
    line = np.unique(np.concatenate((offsets[:-1], newline + 1)))
    line = line[line < len(buf)]
    doc = np.searchsorted(offsets, line, "right") - 1
    stop = np.append(newline, len(buf))[np.searchsorted(newline, line)]
    stop = np.minimum(stop, offsets[doc + 1])
    worded = np.searchsorted(starts, stop) > np.searchsorted(starts, line)
    line, stop, doc = line[worded], stop[worded], doc[worded]
    dup_lines = np.bincount(doc, minlength=n) - _distinct(span_hashes(buf, line, stop), doc, n)

    grams, at = windows(hashes, bounds, REPEAT_WINDOW)
    owner = doc_of(at, bounds)
    order = np.lexsort((grams, owner))
    g, o = grams[order], owner[order]
    same = (g[1:] == g[:-1]) & (o[1:] == o[:-1])
    twice = np.zeros(len(g), bool)
    twice[1:] |= same
    twice[:-1] |= same
    cover = np.zeros(len(hashes) + 1, np.int64)
    hit = at[order[twice]]
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + REPEAT_WINDOW, -1)
    return {"n_words": np.diff(bounds), "word_chars": chars,
            "n_symbols": _counts(_SYMBOL[buf], offsets), "n_dup_lines": dup_lines,
            "n_repeat_words": _sums(np.cumsum(cover)[:-1] > 0, bounds)}


def grams(buf: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, document) of the n-grams of a run."""
    h, _ = windows(buf.astype(np.uint64), offsets, ORDER)
    per_doc = np.maximum(np.diff(offsets) - (ORDER - 1), 0)
    return (h % np.uint64(buckets)).astype(np.int64), np.repeat(np.arange(len(per_doc)), per_doc)


def gram_steps(buf: np.ndarray, offsets: np.ndarray, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same as ``grams``, step by step where one document is longer than a step."""
    if len(offsets) > 2 or len(buf) <= STEP_BYTES:
        yield grams(buf, offsets, buckets)
        return
    for lo in range(0, len(buf), STEP_BYTES):
        step = buf[lo:lo + STEP_BYTES + ORDER - 1]
        yield grams(step, np.array([0, len(step)]), buckets)


def trusted_ids(labels: DataFrame, rows: int | None = None) -> DataFrame:
    """The trusted documents: labelled good and not toxic, all of them.

    ``rows`` asks for a sample instead, the first by hash of the id; a bound on
    the hash, set from their number, leaves about twice ``rows`` of them to sort.
    """
    good = (F.coalesce(F.col("quality") == 1, F.lit(False))
            & F.coalesce(F.col("toxic") == 0, F.lit(False)))
    ids = (labels.where(F.col("doc_id").isNotNull())
           .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
           .agg(F.min(good.cast("int")).alias("_good"))
           .where("_good = 1").select("doc_id"))
    if rows is None:
        return ids
    point = F.md5(F.col("doc_id").cast("string"))
    bound = min(1 << 32, (2 * rows << 32) // max(1, ids.count()))
    return (ids.where(F.conv(F.substring(point, 1, 8), 16, 10).cast("bigint") < bound)
            .orderBy(point, "doc_id").limit(rows))


def documents_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, text) of every row of ``docs`` with one of ``ids``."""
    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .join(ids.select("doc_id"), "doc_id", "left_semi"))


def gram_counts(docs: DataFrame, buckets: int) -> np.ndarray:
    """n-grams of all documents by hash bucket.

    They are summed per task before the shuffle; ``buckets`` rows reach the driver.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, buf, offsets in texts(batch.column(0)):
                for bucket, _ in gram_steps(buf, offsets, buckets):
                    total += np.bincount(bucket, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.record_batch({"bucket": at.astype(np.int32), "n": total[at]})

    rows = (docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "bucket int, n bigint")
            .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow())
    total = np.zeros(buckets)
    total[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return total


def ratios(docs: DataFrame, own: DataFrame, buckets: int) -> np.ndarray:
    """Log ratio of target (``own``) to raw probability of each hash bucket."""
    target = gram_counts(own, buckets)
    if not target.sum():
        return np.zeros(buckets, np.float32)
    raw = gram_counts(docs, buckets)
    p = (target + SMOOTHING) / (target.sum() + SMOOTHING * buckets)
    q = (raw + SMOOTHING) / (raw.sum() + SMOOTHING * buckets)
    return (np.log(p) - np.log(q)).astype(np.float32)


def fit(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The model of ``docs`` with the documents of the ids ``trusted`` as target."""
    return ratios(docs, documents_of(docs, trusted), buckets)


def quantile(values: DataFrame, q: float, bins: int = QUANTILE_BINS) -> float | None:
    """The exact quantile of a column of finite doubles, interpolated like ``percentile``.

    Counts by bins narrow the range around a rank until its ends are equal, so
    ``bins`` rows a pass reach the driver, whatever the number of values.
    """
    v = F.col(values.columns[0])
    n, least, most = values.agg(F.count(v), F.min(v), F.max(v)).first()
    if not n:
        return None

    def ranked(k: int) -> float:
        lo, hi, below = least, most, 0
        while lo < hi:
            place = F.least(F.floor((v - lo) / (hi - lo) * bins), F.lit(bins - 1)).alias("bin")
            for r in (values.where(v.between(lo, hi)).groupBy(place)
                      .agg(F.count(v).alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"))
                      .orderBy("bin").collect()):
                if k < below + r.n:
                    lo, hi = r.lo, r.hi
                    break
                below += r.n
        return lo

    at = q * (n - 1)
    lower, upper = math.floor(at), math.ceil(at)
    if lower == upper:
        return ranked(lower)
    return (upper - at) * ranked(lower) + (at - lower) * ranked(upper)


def least_score(own: DataFrame, model: np.ndarray) -> float:
    """``MARGIN`` below the ``QUANTILE`` of the scores of ``own``, exactly."""
    scores = saved(judge(own, model, 0.0).select("score"), "scores")
    return (quantile(scores, QUANTILE) or 0.0) - MARGIN


def threshold_of(docs: DataFrame, trusted: DataFrame, model: np.ndarray) -> float:
    """The threshold that follows from the documents of the ids ``trusted``."""
    return least_score(documents_of(docs, trusted), model)


def judge(docs: DataFrame, model: np.ndarray, threshold: float) -> DataFrame:
    """``docs`` with the base measures, ``score``, ``base_failed`` and ``kept``.

    An own column of one of these names is replaced.
    """
    new = (*MEASURES, "score", "base_failed", "kept")
    own = [c for c in docs.columns if c.lower() not in new]
    docs = docs.withColumn("text", F.col("text").cast("string")).select(*(f"`{c}`" for c in own))
    at_text = [c.lower() for c in own].index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        ratio = shared.value
        parts: dict[str, list[np.ndarray]] = {c: [] for c in (*MEASURES, "score")}
        for _, _, buf, offsets in texts(batch.column(at_text)):
            starts, ends, bounds = words(buf, offsets)
            hashes = span_hashes(buf, starts, ends)
            n = len(offsets) - 1
            for c, v in measure(buf, offsets, hashes, starts, ends, bounds).items():
                parts[c].append(v)
            total, number = np.zeros(n), np.zeros(n, np.int64)
            for bucket, doc in gram_steps(buf, offsets, len(ratio)):
                total += np.bincount(doc, ratio[bucket], minlength=n)
                number += np.bincount(doc, minlength=n)
            parts["score"].append(total / (number + PRIOR_GRAMS))
        cols = {c: np.concatenate(v) for c, v in parts.items()}
        failed = ((cols["n_words"] < MIN_WORDS)
                  | (100 * cols["n_repeat_words"] > MAX_REPEAT_PERCENT * cols["n_words"]))
        arrays = [batch.column(i) for i in range(len(own))]
        arrays += [pa.array(cols[c], pa.int64()) for c in MEASURES]
        arrays += [pa.array(cols["score"]), pa.array(failed),
                   pa.array(~failed & (cols["score"] >= threshold))]
        return pa.RecordBatch.from_arrays(arrays, [*own, *new])

    schema = extended(docs.schema, **dict.fromkeys(MEASURES, "bigint"), score="double",
                      base_failed="boolean", kept="boolean")
    return docs.mapInArrow(in_arrow(step), schema)


def _fitted(docs: DataFrame, labels: DataFrame, threshold: float | None,
            buckets: int = BUCKETS) -> tuple[np.ndarray, float]:
    trusted = saved(trusted_ids(labels), "trusted")
    own = saved(documents_of(docs, trusted), "own")
    model = ratios(docs, own, buckets)
    return model, least_score(own, model) if threshold is None else threshold


def rate(docs: DataFrame, labels: DataFrame, threshold: float | None = None,
         buckets: int = BUCKETS) -> DataFrame:
    """Fit on the whole of ``docs`` and judge every document of it."""
    return judge(docs, *_fitted(docs, labels, threshold, buckets))


def kept(docs: DataFrame, labels: DataFrame, threshold: float | None = None) -> DataFrame:
    """The documents that pass, with the columns of ``docs``."""
    model, threshold = _fitted(docs, labels, threshold)
    plain = [c if c.lower() == "text" else f"_c{i}" for i, c in enumerate(docs.columns)]
    return (judge(docs.toDF(*plain), model, threshold).where("kept")
            .select(*plain).toDF(*docs.columns))
