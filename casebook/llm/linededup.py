"""Line dedup: chunks and passages of lines that repeat are kept once.

A rolling hash over the hashes of neighbouring lines chooses the chunk bounds,
so an inserted or deleted line moves only the bounds next to it.  A line of
``LONG_LINE`` words or more is a chunk of its own.  Only chunks of two lines
with words, or one long line, take part: short single lines are left alone.

Bounds at the edge of a passage depend on the lines around it, so more chunks
take part that overlap those: from each line on, and back from each line, the
shortest run of lines with ``LONG_LINE`` words, and the whole document.  Any
passage of ``LONG_LINE`` words or more is covered by the runs inside it alone,
whatever stands around it and however its lines are cut.

Chunks that occur more than once in the whole corpus, compared by SHA-256, stay
where they come first (smallest doc_id, then text hash, then position) and go
everywhere else; a chunk that overlaps its own first place in a document, as in
a line repeated many times, stays.  A line goes only for an equal line before
it, so one copy of everything is left.

Defined cases: NULL text has no chunks and stays NULL; an empty table gives an
empty result; rows that repeat in both doc_id and text are treated alike, so
each keeps what the other keeps; NULL ids sort first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from casebook.llm.common import (free_name, in_arrow, joined_back, mix, saved, span_hashes,
                                 texts, words)

#: A bound follows a line when the rolling hash is 0 modulo this.
DIVISOR = 2
#: Lines under the rolling hash.
WINDOW = 2
#: Words from which one line makes a chunk of its own.
LONG_LINE = 50
#: Share of a document's bytes that must be left of it when passages went.
LEAST_LEFT = 0.2
#: Lines with words that any other chunk needs.
MIN_LINES = 2


def chunks(buf: np.ndarray, offsets: np.ndarray, divisor: int = DIVISOR,
           long_line: int = LONG_LINE) -> tuple[np.ndarray, ...]:
    """(document, start, end, hash, lines) of the chunks that take part, by place.

    Offsets are bytes of the run; ``end`` excludes the closing line feed.
    Chunks overlap: see the module.
    """
    newline = np.flatnonzero(buf == 10)
    begin = np.sort(np.concatenate((offsets[:-1], newline + 1)))
    doc = np.repeat(np.arange(len(offsets) - 1),
                    np.diff(np.searchsorted(newline, offsets)) + 1)
    stop = np.minimum(np.append(newline, len(buf))[
        np.minimum(np.searchsorted(newline, begin), len(newline))], offsets[doc + 1])
    starts, _, _ = words(buf, offsets)
    n_words = np.searchsorted(starts, stop) - np.searchsorted(starts, begin)
    hashes = span_hashes(buf, begin, stop)

    first = np.ones(len(begin), bool)
    first[1:] = doc[1:] != doc[:-1]
    rolling = hashes.copy()
    near = hashes.copy()
    inside = np.ones(len(begin), bool)
    for _ in range(WINDOW - 1):
        inside = inside & ~first
        near = np.concatenate((near[:1], near[:-1]))
        rolling = np.where(inside, rolling * np.uint64(0xFF51AFD7ED558CCD) + near, rolling)
        first = np.concatenate(([True], first[:-1]))
    lengthy = n_words >= long_line
    cut = mix(rolling) % np.uint64(divisor) == 0
    new = np.ones(len(begin), bool)
    new[1:] = (doc[1:] != doc[:-1]) | cut[:-1] | lengthy[:-1] | lengthy[1:]

    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(begin)) - 1
    worded = np.zeros(len(begin) + 1, np.int64)
    np.cumsum(n_words > 0, out=worded[1:])
    lines = worded[tail + 1] - worded[head]
    part = (lines >= MIN_LINES) | lengthy[head]
    runs = [(head[part], tail[part])]

    total = np.zeros(len(begin) + 1, np.int64)
    np.cumsum(n_words, out=total[1:])
    some = np.flatnonzero(n_words > 0)
    runs.append((some, np.searchsorted(total, total[some] + long_line) - 1))
    runs.append((np.searchsorted(total, total[some + 1] - long_line, "right") - 1, some))
    head = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    tail = np.append(head[1:], len(begin)) - 1
    part = (worded[tail + 1] - worded[head] >= MIN_LINES) | (total[tail + 1] - total[head] >= long_line)
    runs.append((head[part], tail[part]))

    head, tail = (np.concatenate(side) for side in zip(*runs))
    within = (head >= 0) & (tail < len(begin))
    head, tail = head[within], tail[within]
    same = doc[head] == doc[tail]
    head, tail = np.divmod(np.unique(head[same] * len(begin) + tail[same]), len(begin))
    lines = worded[tail + 1] - worded[head]
    return doc[head], begin[head], stop[tail], span_hashes(buf, begin[head], stop[tail]), lines


def _key() -> list[Column]:
    """What tells rows apart: the id and a hash of the text."""
    return [F.col("doc_id").cast("bigint").alias("id"), F.xxhash64("text").alias("crc")]


def _occurrences(docs: DataFrame) -> DataFrame:
    """A row per chunk that takes part: its place and digest."""
    rows = docs.select(*_key(), F.col("text").cast("string").alias("text"))

    def step(batch: pa.RecordBatch) -> pa.Table | None:
        out = []
        for lo, hi, buf, offsets in texts(batch.column(2)):
            doc, begin, end, _, lines = chunks(buf, offsets)
            raw = memoryview(buf.tobytes())
            digest, leads = [], []
            ends: dict[tuple[int, bytes], int] = {}  # where a chunk's first place in a document ends
            for d, b, e in zip(doc.tolist(), begin.tolist(), end.tolist()):
                digest.append(hashlib.sha256(raw[b:e]).digest())
                leads.append(b < ends.setdefault((d, digest[-1]), e))
            at = pa.array(lo + doc)
            out.append(pa.table({
                "id": batch.column(0).take(at), "crc": batch.column(1).take(at),
                "begin": pa.array(begin - offsets[doc]), "end": pa.array(end - offsets[doc]),
                "lines": pa.array(lines), "leads": pa.array(leads, pa.bool_()),
                "digest": pa.array(digest, pa.binary())}))
        return pa.concat_tables(out) if out else None

    return rows.mapInArrow(in_arrow(step), "id bigint, crc bigint, begin bigint, end bigint, "
                                           "lines bigint, leads boolean, digest binary")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(id, crc, spans): what goes from each document, as sorted byte spans.

    Chunks overlap, so their SHA-256 goes over the network instead of them, and
    Spark's partial aggregation leaves one row per chunk and task before the
    shuffle, however often a chunk repeats.
    """
    found = saved(_occurrences(docs), "chunks")
    keepers = (found.groupBy("digest")
               .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "crc")).alias("keeper"))
               .where("n > 1").select("digest", "keeper"))
    places = joined_back(found, keepers, "digest")
    stays = (F.col("leads") & F.col("id").eqNullSafe(F.col("keeper.id"))
             & (F.col("crc") == F.col("keeper.crc")))
    return (places.where(~stays).groupBy("id", "crc")
            .agg(F.sort_array(F.collect_set(F.struct("begin", "end", "lines"))).alias("spans")))


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``text`` without the lines under ``spans`` (sorted, each of whole lines; may overlap)."""
    stays, at = [], 0
    for begin, end in spans:
        if begin > at:
            stays.append(text[at:begin - 1])
        at = max(at, end + 1)
    if at <= len(text):
        stays.append(text[at:])
    return b"\n".join(stays)


def joined(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(begin, end, lines) of the runs of lines under ``spans``, which may overlap."""
    runs: list[list[int]] = []
    for begin, end in spans:
        if runs and begin <= runs[-1][1] + 1:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([begin, end])
    return [(b, e, sum(1 for x in text[b:e].split(b"\n") if x.split())) for b, e in runs]


def dedup(docs: DataFrame, join_runs: bool = False) -> DataFrame:
    """``docs`` with shorter texts, and ``removed``: the chunks that went.

    ``removed`` lists (begin, end, lines) in bytes of the former text, and is
    empty where nothing went.  Chunks may overlap; with ``join_runs`` it lists
    the runs of lines that they make up, each apart from the next.  An own
    column of that name is replaced.
    """
    own = [c for c in docs.columns if c.lower() != "removed"]
    at_text = [c.lower() for c in own].index("text")
    names = {c: free_name(docs, f"_{c}") for c in ("id", "crc")}
    rows = (docs.withColumn("text", F.col("text").cast("string")).select(*(f"`{c}`" for c in own))
            .withColumns({names[k]: c for k, c in zip(("id", "crc"), _key())}))
    spans = repeated_spans(docs.select("doc_id", "text"))
    marked = rows.join(spans, rows[names["id"]].eqNullSafe(spans["id"])
                       & (rows[names["crc"]] == spans["crc"]), "left")
    kind = "array<struct<begin:bigint,end:bigint,lines:bigint>>"
    marked = marked.select(*(rows[f"`{c}`"] for c in own), F.coalesce(
        spans["spans"], F.array().cast(kind)).alias("removed"))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = batch.column(len(own))
        hit = np.flatnonzero(np.asarray(pa.compute.list_value_length(spans)) > 0).tolist()
        if not hit:
            return batch
        text = batch.column(at_text).to_pylist()
        runs: list[list[dict]] = [[] for _ in text]
        for i in hit:
            cut = [(s["begin"], s["end"]) for s in spans[i].as_py()]
            raw = text[i].encode()
            text[i] = without(raw, cut).decode()
            if join_runs:
                runs[i] = [dict(zip(("begin", "end", "lines"), r)) for r in joined(raw, cut)]
        arrays = batch.columns
        arrays[at_text] = pa.array(text, arrays[at_text].type)
        if join_runs:
            arrays[len(own)] = pa.array(runs, spans.type)
        return pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    return marked.mapInArrow(in_arrow(step), marked.schema)


def deduped(docs: DataFrame) -> DataFrame:
    """``docs`` after dedup with ``n_chars`` renewed; documents left without text go.

    So do those that keep less than ``LEAST_LEFT`` of their bytes: all but a
    shred of them stands in documents before, so they are near copies of these,
    and a later stage could no longer see that.  A document that had no text to
    begin with stays as it was.
    """
    plain = [c if c.lower() in ("text", "doc_id") else f"_c{i}" for i, c in enumerate(docs.columns)]
    size = next((p for p, c in zip(plain, docs.columns) if c.lower() == "n_chars"), None)
    out = dedup(docs.toDF(*plain), join_runs=True)
    gone = F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, x: n + x["end"] - x["begin"] + 1)
    kept = F.octet_length("text")
    out = out.where((F.size("removed") == 0) | ((kept > 0) & (kept >= LEAST_LEFT * (kept + gone))))
    if size:
        kind = out.schema[size].dataType
        out = out.withColumn(size, F.when(F.size("removed") == 0, F.col(size))
                             .otherwise(F.length("text").cast(kind)))
    return out.select(*plain).toDF(*docs.columns)
