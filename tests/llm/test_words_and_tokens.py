"""Spelling variants, fill-in-middle and byte-level BPE against brute force and the libraries."""

import base64
import hashlib
import random
import re
import string
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from casebook.llm import bpe, middle, queries, spelling, tokens
from tests.conftest import rows

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string"


@pytest.fixture(scope="module")
def corpus():
    """Words with slips, NULLs, empties, markers, repeated rows, long texts, odd code points."""
    rng = random.Random(11)
    stems = ["".join(rng.choice("aeiourstlné") for _ in range(rng.randint(5, 11))) for _ in range(60)]
    def word():
        w = rng.choice(stems[:rng.randint(1, 60)])
        if rng.random() < 0.2:
            k = rng.randrange(len(w))
            w = w[:k] + rng.choice(["", "x", "ÿ", w[k] * 2]) + w[k + 1:]
        return w.upper() if rng.random() < 0.1 else w
    texts = [None, "", " ", "<P>", "a <S> b", "x<M", "été × ÷ ÀÉÎ", "\U0001F600" * 9, "a\x00b\nc\td"]
    texts += [" ".join(word() for _ in range(rng.choice([1, 8, 90, 300]))) for _ in range(120)]
    texts += ["q" * 9000, "abcdefg" * 2000, "é" * 5000, " ".join(word() for _ in range(12000))]
    data = [(i, t, "en") for i, t in enumerate(texts)]
    return data + [data[20], data[20], (None, texts[21], None), (None, None, None), (77, texts[22], "de")]


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, DOCS).repartition(3)


# ---------------------------------------------------------------------- spelling


def counted(data):
    lower = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    out = Counter()
    for i, text, *_ in data:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 6:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= 5}


def edits(a, b):
    """The plain edit distance."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def spelled(words):
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and v != w and edits(v, w) == 1] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 5 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


def found(df):
    return rows(df, "word", "form", "root", "n", "n_near", "form_n")


def sorted_rows(data):
    return sorted(data, key=lambda r: tuple((v is not None, v) for v in r))


def test_words_and_variants_equal_brute_force(docs, corpus):
    words = counted(corpus)
    clash = docs.withColumn("word", F.lit(1)).withColumn("n", F.lit("x")).withColumn("id", F.lit(2))
    got = spelling.words(clash)
    assert {r.word: r.n for r in got.collect()} == words
    out = spelled(words)
    assert any(r[1] for r in out) and any(r[4] > 1 for r in out)
    assert found(spelling.variants(got)) == sorted_rows(out)


@pytest.fixture(scope="module")
def hard_words():
    """Chains of forms, ties, anagrams, one letter many times, words of 300 letters."""
    out = {"aaaaaa": 5, "aaaaaab": 25, "aaaaabb": 26, "aaaaabbc": 130, "aaaaabbcd": 700, "abbbbb": 5,
           "abbbbc": 25, "abbbbd": 25, "abcdef": 9, "fedcba": 90, "abcdfe": 500, "z" * 300: 5,
           "z" * 299: 40, "z" * 299 + "y": 300, "ÀÀÀÀÀÀ": 6, "àÀÀÀÀÀ": 30}
    rng = random.Random(2)
    for _ in range(400):  # many words of few letters: crowded cells
        out["".join(rng.choice("ab") for _ in range(rng.randint(6, 11)))] = rng.randint(5, 3000)
    return out


@pytest.mark.parametrize("block", [2048, 3])
def test_variants_in_blocks_equal_brute_force(spark, hard_words, block, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK", block)
    df = spark.createDataFrame(list(hard_words.items()), "word string, n long").repartition(4)
    assert found(spelling.variants(df)) == sorted_rows(spelled(hard_words))


def test_each_pair_of_cells_meets_once(spark):
    """Two near words meet in exactly one cell."""
    pairs = [("planet", "planets"), ("planet", "plbnet"), ("planet", "elanet"), ("zebras", "zebra")]
    for a, b in pairs:
        visits = spark.createDataFrame([(a,), (b,)], "word string").select(
            "word", F.explode(spelling._visits(spelling._class_counts(F.col("word")))).alias("v")).select("word", "v.*")
        home = {r.word: r.cell for r in visits.where("role = 0").collect()}
        seen = [(r.word, r.cell) for r in visits.collect() if r.role != 0]
        meets = (home[a] == home[b]) + ((a, home[b]) in seen) + ((b, home[a]) in seen)
        assert meets == 1


def test_one_edit_and_close_pairs():
    rng = random.Random(5)
    for long, short in ((8, 8), (8, 7), (1, 1), (2, 1)):
        a = ["".join(rng.choice("abc") for _ in range(long)) for _ in range(60)]
        b = ["".join(rng.choice("abc") for _ in range(short)) for _ in range(70)]
        pa_, pb = (np.array([list(map(ord, w)) for w in x], np.uint32) for x in (a, b))
        i, j = (x.ravel() for x in np.indices((60, 70)))
        assert spelling.one_edit(pa_[i], pb[j]).tolist() == [edits(a[x], b[y]) == 1 for x, y in zip(i, j)]
        got = set(zip(*(x.tolist() for x in spelling.close_pairs(*map(spelling._letter_counts, (pa_, pb))))))
        near = {(x, y) for x in range(60) for y in range(70)
                if sum((a[x].count(c) - b[y].count(c)) ** 2 for c in "abc") <= 2}
        assert got == near


def test_no_words(spark):
    empty = spark.createDataFrame([], DOCS)
    assert found(spelling.variants(spelling.words(empty))) == []
    one = spark.createDataFrame([("single", 7)], "word string, n long")
    assert found(spelling.variants(one)) == [("single", None, "single", 7, 0, None)]


# ---------------------------------------------------------------- fill in middle


def moved(i, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    digest = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[k:k + 8], 16) for k in range(0, 32, 8)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, mid, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return i, n, "plain", None, None, text
    if h[3] % 100 < 20:
        return i, n, "spm", len(prefix), len(mid), f"<S>{suffix}<P>{prefix}<M>{mid}"
    return i, n, "psm", len(prefix), len(mid), f"<P>{prefix}<S>{suffix}<M>{mid}"


@pytest.mark.parametrize("step", [1 << 20, 64, 3])
def test_middle_equals_brute_force_and_restores(docs, corpus, step):
    odd = docs.select(F.col("doc_id").alias("key"), F.col("text").alias("body"), F.lit(1).alias("n"),
                      F.lit(2).alias("h1"), F.lit("x").alias("doc_id"), F.lit("y").alias("text"))
    if step == 3:
        odd = odd.where("length(body) < 400 or body is null")
        corpus = [r for r in corpus if len(r[1] or "") < 400]
    got = middle.transform(odd, "key", "body", step_bytes=step)
    back = got.withColumn("back", middle.restored(F.col("output"), F.col("form")))
    want = [(*(m := moved(i, t)), t or "") for i, t, *_ in corpus]
    assert {m[2] for m in want} == {"plain", "psm", "spm"}
    assert rows(back) == sorted_rows(want)


def test_segments_end_between_units():
    rng = random.Random(8)
    for _ in range(300):
        text = "".join(rng.choice("abcde  \né×中\U0001F600") for _ in range(rng.randint(0, 60)))
        parts = [s.decode() for s in middle.segments(text.encode(), rng.randint(1, 9))]
        units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
        assert [u for p in parts for u in re.findall(r"[A-Za-z]+|[^A-Za-z]", p)] == units


def test_middle_of_an_empty_table(spark):
    assert middle.transform(spark.createDataFrame([], DOCS)).collect() == []


# --------------------------------------------------------------------- byte BPE


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, special_tokens={},
                             mergeable_ranks=bpe.read_ranks(queries.ranks()))


def test_ids_and_bytes_equal_the_library(docs, corpus, library):
    out = bpe.decode(bpe.encode(docs, queries.ranks()), queries.ranks())
    got = Counter((r.doc_id, r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in out.collect())
    want = Counter()
    for i, text, *_ in corpus:
        ids = library.encode_ordinary(text or "")
        want[i, len(ids), np.array(ids, "<u4").tobytes(), (text or "").encode()] += 1
    assert got == want


def test_random_texts_in_steps_equal_the_library(library):
    rng = random.Random(6)
    points = [*range(0x20, 0xD7FF), *range(0xE000, 0x10FFFF)]
    signs = "ab 'stdrev \n\t019é中文\xa0\u3000\U0001F600<|>.,_-\x1c\x85\x00\u0300\u093f\u0932"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    texts += ["".join(chr(rng.choice(points)) for _ in range(40)) for _ in range(1000)]
    texts += [" " * 3000, "ab" * 4000, "<|endoftext|> x", bpe.UNKNOWN * 9]
    codec = bpe.codec(queries.ranks())
    for step in (1 << 19, 16):
        got = [ids for _, part in tokens.encoded(pa.array(texts), "", codec, step) for ids in part]
        assert [g.tolist() for g in got] == [library.encode_ordinary(t) for t in texts]
        assert [bpe.decoder(queries.ranks()).decode(g).decode() for g in got] == texts


def test_the_model_joins_by_rank_and_whole_pieces_win(tmp_path):
    """A token that merges do not reach, a token over two joins, and ranks with a gap."""
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 300, b"bc": 257, b"xyz": 260, b"abc": 310}
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % r for t, r in ranks.items()))
    import sentencepiece
    import tiktoken
    sp = sentencepiece.SentencePieceProcessor(model_proto=bpe.model(ranks))
    assert sp.get_piece_size() == 312 and sp.is_unknown(311) and sp.is_unused(256)
    library = tiktoken.Encoding("own", pat_str=r"\w+", mergeable_ranks=ranks, special_tokens={})
    pieces = ["abcab", "xyz", "xyzx", "abc", "bcab", "a"]
    got = bpe.Codec(str(path)).merged(pieces)
    assert got == [library.encode_ordinary(p) for p in pieces]
    assert got[0] == [310, 300] and got[1] == [260]


def test_bpe_of_an_empty_table(spark):
    assert bpe.decode(bpe.encode(spark.createDataFrame([], DOCS), queries.ranks()), queries.ranks()).collect() == []


# ------------------------------------------------------------------ whole tables


@pytest.mark.parametrize("name", ["op11_spelling", "op12_fill_in_middle", "op13_byte_bpe"])
def test_queries_on_given_rows(spark, library, name):
    given = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = rows(queries.QUERIES[name](spark, SF))
    sha = lambda b: hashlib.sha256(b).hexdigest()
    if name == "op11_spelling":
        lower = {w: n for w, n in counted(given).items()}
        near = {r[0]: r for r in got}
        assert {w: r[3] for w, r in near.items()} == lower
        chosen = random.Random(1).sample(sorted(lower), 40)
        for w in chosen:
            assert near[w][4] == sum(abs(len(v) - len(w)) < 2 and v != w and edits(v, w) == 1 for v in lower)
    elif name == "op12_fill_in_middle":
        want = [(*(m := moved(i, t))[:5], sha(m[5].encode()), sha((t or "").encode())) for i, t in given]
        assert got == sorted_rows(want)
    else:
        want = []
        for i, t in given:
            ids = library.encode_ordinary(t or "")
            want.append((i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha((t or "").encode())))
        assert got == sorted_rows(want)
