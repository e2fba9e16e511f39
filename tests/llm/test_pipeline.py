"""The pipeline, stage by stage, against plain Python on each stage's own input."""

import hashlib
import os
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from casebook.llm import linededup, mixing, quality
from casebook.llm.common import saved, scope, scratch
from casebook.session import checkpoint_dir
from tests.llm.test_text_operators import base, classes, grams, ids_of, kept_lines, split

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The rows before and after every stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = saved(stage(spark, docs, SF), name)
        out[name] = docs
    return out


def tuples(df):
    return [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in df.collect()]


def test_all_but_the_last_return_the_columns_of_documents(stages):
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert stages[name].dtypes == stages["documents"].dtypes


def test_quality_stage(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit(stages["documents"], quality.trusted_ids(labels))
    trusted = {r.doc_id for r in labels.where("quality = 1 and toxic = 0").collect()}
    scores = {}
    for row in tuples(stages["documents"]):
        g = grams(row[1] or "", len(model))
        scores[row] = sum(map(float, model[g])) / (len(g) + quality.PRIOR_GRAMS)
    threshold = np.quantile([v for row, v in scores.items() if row[0] in trusted], 0.01) - np.log(2)
    want = []
    for row, score in scores.items():
        m = base(row[1])
        if m[0] >= 10 and 100 * m[4] <= 20 * m[0] and score >= threshold:
            want.append(row)
    assert sorted(tuples(stages["quality_rules"])) == sorted(want) and 0 < len(want) < 200


def test_quality_stage_counts_every_trusted_document(spark, tmp_path):
    """500 trusted documents that come after 20,000 others by hash are no junk."""
    ids = sorted(range(20_500), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    plain, late = (" ".join(2 * c + x for x in "abcdefghijkl") for c in "gz")
    docs = spark.createDataFrame([(i, plain if k < 20_000 else late) for k, i in enumerate(ids)],
                                 "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, 1, 0) for i in ids], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.quality_rules(spark, docs, str(tmp_path)).count() == len(ids)


def test_line_dedup_stage(stages):
    data = tuples(stages["quality_rules"])
    cut, where = kept_lines(data)
    first = {c: min(data[i][0] for i, _ in at) for c, at in where.items() if len(at) > 1}
    want = []
    for row, chunks in zip(data, cut):
        seen, spans = set(), []
        for c, b, e in chunks:
            if c in first and (first[c] != row[0] or c in seen):
                spans.append((b, e))
            seen.add(c)
        text = linededup.without(row[1].encode(), spans).decode()
        if not spans or text and len(text.encode()) >= linededup.LEAST_LEFT * len(row[1].encode()):
            want.append((row[0], text, row[2], row[3], len(text) if spans else row[4]))
    assert sorted(tuples(stages["line_dedup"])) == sorted(want) and want != data


def test_near_duplicates_stage(stages):
    data = tuples(stages["line_dedup"])
    keep = {c for _, c, *_ in classes(data)}
    assert sorted(tuples(stages["near_duplicates"])) == sorted(r for r in data if r[0] in keep)


def test_mixing_stage(stages):
    data = tuples(stages["near_duplicates"])
    md5 = lambda *x: hashlib.md5(":".join(map(str, x)).encode()).hexdigest()
    tokens, docs = Counter(), defaultdict(list)
    for row in data:
        n = len(split(row[1]))
        tokens[row[3]] += n
        docs[row[3]].append((md5(mixing.SEED, row[0], md5(row[1])), n, row))
    ratio, low, high = max(tokens.values()) / min(tokens.values()), 0.0, 1.0
    for _ in range(mixing.LEVELS * mixing.ROUNDS):
        mid = (low + high) / 2
        low, high = (mid, high) if ratio ** (1 - mid) > mixing.MAX_REPEATS else (low, mid)
    want = Counter()
    for s, own in docs.items():
        total = round(tokens[s] * (max(tokens.values()) / tokens[s]) ** (1 - high))
        blocks = -(-len(own) // mixing.BLOCK_DOCS)
        for epoch in range(total // tokens[s] + 1):
            left = total - epoch * tokens[s]
            order = sorted(own, key=lambda d: (
                md5(mixing.SEED, "block", epoch, s, int(d[0][:8], 16) * blocks >> 32),
                md5(mixing.SEED, "doc", epoch, d[0])))
            for _, n, row in order:
                if left > 0:
                    want[row] += 1
                left -= n
    assert Counter(tuples(stages["mixing"])) == want


def test_packing_stage_and_run(spark, stages):
    rows = stages["packing"].collect()
    want = Counter()
    for doc_id, text, *_ in tuples(stages["mixing"]):
        ids = np.array(ids_of(text), "<u4")
        for at in range(0, len(ids), 1024):
            part = ids[at:at + 1024]
            want[doc_id, at, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == want
    fill = Counter()
    for r in rows:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 1024
    top = f"{checkpoint_dir(spark)}/corpus"
    before = set(os.listdir(top))
    again = corpus_pipeline.run(spark, SF)
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, rows))
    left = [os.listdir(f"{top}/{d}") for d in set(os.listdir(top)) - before]
    assert sorted(x for names in left for x in names) == sorted(n for n, _ in corpus_pipeline.STAGES)


def test_a_scope_removes_what_was_stored_in_it(spark):
    path = scratch(spark, "kept")
    with pytest.raises(ValueError), scope(spark):
        inner = saved(spark.range(3), "inner")
        saved(inner, "kept", path)
        files = inner.inputFiles()
        raise ValueError
    assert not any(os.path.exists(f.removeprefix("file://")) for f in files)
    assert spark.read.parquet(path).count() == 3


def test_of_near_copies_in_lines_one_stays_whole(spark):
    """Three documents of 20 lines that differ in a word: line dedup leaves no shreds of two of them."""
    rng = np.random.default_rng(6)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 6))
    data, whole = [], []
    for g in range(20):
        lines = [[word() for _ in range(12)] for _ in range(20)]
        for k in range(3):
            copy = [list(x) for x in lines]
            copy[5 + k][3] = f"edit{k}"
            text = "\n".join(" ".join(x) for x in copy)
            data.append((3 * g + k, text, "en", "s", len(text)))
        whole.append(data[-3][:2])
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)
    out = stages["near_duplicates"](spark, saved(stages["line_dedup"](spark, docs, SF), "near"), SF)
    assert sorted((r.doc_id, r.text) for r in out.collect()) == whole


def test_of_exact_copies_one_stays_whole(spark):
    rng = np.random.default_rng(5)
    line = lambda n: " ".join("".join(rng.choice(list("abcdefghij"), 6)) for _ in range(n))
    sizes = [(20, 30, 25), (9,) * 12, (60, 4, 70, 3), (3, 8), (2, 5, 4, 1, 6, 3), (5, 70, 6, 6, 6)]
    data, whole = [], []
    for n, lines in enumerate(sizes):
        whole.append((10 * n, "\n".join(line(k) for k in lines)))
        data += [(10 * n + k, whole[-1][1], "en", "s", len(whole[-1][1])) for k in range(4)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)
    out = stages["near_duplicates"](spark, saved(stages["line_dedup"](spark, docs, SF), "copies"), SF)
    assert sorted((r.doc_id, r.text) for r in out.collect()) == whole
