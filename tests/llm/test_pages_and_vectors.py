"""Operators over ``pages`` and ``embeddings`` against brute force."""

import base64
import gzip
import hashlib
import random
import re
import time
from collections import Counter, defaultdict
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F

from casebook.llm import ann, extraction, warc
from casebook.llm.common import scratch
from tests.conftest import rows

SF = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string"


# ------------------------------------------------------------------------ vectors


def nearest(data, k):
    fine = [(i, np.array(v, float)) for i, v in data if i is not None and v is not None and len(v)
            and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for q in {i for i, _ in fine if i % 10 == 0}:
        best = {}
        for i, v in fine:
            for j, w in fine:
                if i == q and j != q and len(v) == len(w):
                    s = 0.0
                    for a, b in zip(v, w):
                        s += (a - b) * (a - b)
                    best[j] = min(best.get(j, np.inf), float(np.sqrt(s)))
        order = sorted((d, j) for j, d in best.items())[:k]
        out += [(q, r, j, d) for r, (d, j) in enumerate(order, 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(7)
    data = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(120)]
    data += [(i + 120, data[i][1]) for i in range(30)]  # ties
    data += [(200 + i, data[0][1]) for i in range(40)]  # one very common vector
    data += [(300, None), (310, [0.0] * 8), (320, [float("nan")] + [1.0] * 7), (330, [1.0] * 3),
             (340, [float("inf")] + [1.0] * 7), (350, [None] + [1.0] * 7), (None, [1.0] * 8), (301, []),
             (331, [2.0] * 3), (5, data[5][1]), (10, [0.5] * 8), (7, [0.25] * 8)]
    return data


@pytest.mark.parametrize("exponent", [160, -160, 307])
def test_very_large_and_small_vectors_find_all_ranks(spark, exponent):
    rng = np.random.default_rng(5)
    data = [(i, (rng.normal(size=8) * 10.0 ** exponent).tolist()) for i in range(200)]
    data += [(i + 200, rng.normal(size=8).tolist()) for i in range(20)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = rows(ann.nearest(df.where("vec_id % 100 = 0"), df, k=10, query_block=2, row_block=16))
    big = [(i, np.array(v, np.longdouble)) for i, v in data]
    want = []
    for q, v in big:
        if q % 100 == 0:
            near = sorted((float(np.sqrt(((v - w) ** 2).sum())), i) for i, w in big if i != q)[:10]
            want += [(q, r, i, d) for r, (d, i) in enumerate(near, 1)]
    assert [g[:3] for g in got] == [w[:3] for w in sorted(want)]
    assert np.allclose([g[3] for g in got], [w[3] for w in sorted(want)], rtol=1e-12)


def test_tasks_of_the_tiles_are_bounded(spark, vectors):
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    plan = ann.nearest(df, df, query_block=1, row_block=1)._jdf.queryExecution().executedPlan().toString()
    most = ann.TASKS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = [int(n) for n in re.findall(r"hashpartitioning\(i#\w+, g#\w+, dim#\w+, (\d+)\)", plan)]
    assert counts and max(counts) <= most


@pytest.mark.parametrize("blocks", [(4096, 1024), (5, 9), (7, 2)])
def test_nearest_equals_brute_force(spark, vectors, blocks):
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumn("rank", F.lit(1))
    got = ann.nearest(df.where("vec_id % 10 = 0"), df, k=7, query_block=blocks[0], row_block=blocks[1])
    assert rows(got) == nearest(vectors, 7)


def test_few_candidates_and_empty_tables(spark):
    schema = "vec_id long, embedding array<float>"
    two = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 4.0])], schema)
    assert [tuple(r)[:3] for r in ann.nearest(two.where("vec_id = 0"), two).collect()] == [(0, 1, 1)]
    none = spark.createDataFrame([], schema)
    assert ann.nearest(none, none).count() == 0 and ann.nearest(none, two).count() == 0


def test_rounding_bounds_hold():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 16)) * np.exp(rng.normal(size=(200, 1)) * 3)
    values, scale, square, rest = ann.quantised(x)
    back = values * scale[:, None]
    exact = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    near = np.sqrt(((back[:, None] - back[None]) ** 2).sum(2))
    assert (np.abs(exact - near) <= rest[:, None] + rest[None] + 1e-9).all()


# --------------------------------------------------------------------- extraction


class Article(HTMLParser):
    """The blocks of h1 and p inside article: enough for the given pages."""

    def __init__(self):
        super().__init__()
        self.inside, self.out = False, [""]

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        if tag in ("h1", "p", "article"):
            self.out.append("")
        elif tag == "br":
            self.out[-1] += " "

    def handle_endtag(self, tag):
        if tag in ("h1", "p", "article"):
            self.out.append("")
        if tag == "article":
            self.inside = False

    def handle_data(self, data):
        if self.inside:
            self.out[-1] += data


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in extraction.extract(pages).collect()}
    for r in pages.collect():
        p = Article()
        p.feed(r.html)
        assert got[r.page_id] == "\n\n".join(b for b in (" ".join(x.split()) for x in p.out) if b)


@pytest.mark.parametrize("html, text", [
    ("", ""),
    ("plain  text\n here", "plain text here"),
    ("<p>a&nbsp;&amp;amp; &lt;b&gt;<p>c<br>d</p>", "a &amp; <b>\n\nc d"),
    ("<title>t</title><style>p{}</style><script>'</p>'</script><p>x</p><!-- y --><noscript>z</noscript>", "x"),
    ("<nav>n</nav><header>h</header><aside>a</aside><main><h1>T</h1><p>One <b>two</b>.</p></main>"
     "<footer>f</footer>", "T\n\nOne two."),
    ("<div class='cookie-notice'>We</div><div id=sideBar>s</div><div role=navigation>m</div><p>ok</p>", "ok"),
    ("<article><header><h1>H</h1></header><form>f<input></form><ul><li>a<li>b</ul>"
     "<section class=comments><p>c</p></section><div class='ad'>x</div>end</article><p>out</p>",
     "H\n\na\n\nb\n\nend"),
    ("<article><p>one<p>two <a href='x>y'>link</a></article>", "one\n\ntwo link"),
    ("<body class='has-sidebar'><p>x<table><tr><td>1<td>2<tr><td>3</table>", "x\n\n1\n\n2\n\n3"),
    ("<div><a href=1>all</a> <a href=2>links</a></div><p>Text with <a href=3>a link</a> in it.</p>",
     "Text with a link in it."),
    ("<p>a < b and c > d</p><p hidden>no</p><p style='display: none'>no</p>", "a < b and c > d"),
    ("<article class=comment>c</article><p>x &#8364; &unknown; &copy</p>", "x € &unknown; ©"),
    ("<p>unclosed <b>bold<div>next", "unclosed bold\n\nnext"),
    ("<p>cut <a href=\"x", "cut"),
])
def test_markup(html, text):
    assert "\n\n".join(extraction.blocks(html)) == text


BODY = "<h1>Title</h1><p>The whole of a long article stands here.</p>"


@pytest.mark.parametrize("html", [
    f"<article class='post has-sidebar'>{BODY}</article>",
    f"<div id=content class='with-sidebar'><article>{BODY}</article></div><p>out</p>",
    f"<div class='elementor-widget-container'>{BODY}</div>",
    f"<div class='widget'><div class=sidebar><article>{BODY}</article></div></div><div>out</div>",
    f"<article class='comment-status-open social'>{BODY}</article><p>out</p>",
    f"<div class='sidebar'>{BODY}</div>",
    f"<main><p></p><div class='widget'><article>{BODY}</article></div></main>",
    f"<main>{BODY}<div class='related'><article>Teaser</article></div></main>",
    f"<div class='comments'>{BODY}</div>",
    "<article><div class='article-header'><h1>Title</h1></div><section class='related-work'>"
    "<p>The whole of a long article stands here.</p></section></article>",
    "<article><div class=header><h1>Title</h1></div><p>The <span class=ad>ad</span>whole of a long "
    "article stands here.</p><div class='comments-area'><article>No, it is otherwise, says a reader</article>"
    "</div><div class='related-posts'>Others</div></article>",
    f"{BODY}<div class='siteHeader'>Site</div><div class='related'><article>Teaser</article></div>"
    "<div id='left-sidebar'>s</div><ul class='main-menu'><li>m</ul><div class='div-gpt-ad-1'>buy</div>",
    f"<article>{BODY}</article><div class=comments>" + "<article class=comment-body>I say no.</article>" * 50
    + "</div>",
])
def test_marks_leave_the_article(html):
    assert extraction.blocks(html) == ["Title", "The whole of a long article stands here."]


def own_words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))


LINE = "Read our new rules before you go on with this site today"


def test_host_boilerplate_goes_and_unique_runs_stay(spark):
    rng = random.Random(3)
    bodies = [own_words(rng, 40) for _ in range(12)]
    data = [(i, f"https://A.example/{i}", f"<div>{LINE}</div><div>{b} {LINE} tail{i}</div>")
            for i, b in enumerate(bodies)]
    data += [(100 + i, f"http://b.example/{i}", f"<p>{bodies[0]}</p>") for i in range(6)]  # copies stay
    data += [(200, None, "<p>alone here</p>"), (201, "x", None), (None, "https://a.example/n", ""),
             (200, None, "<p>alone here</p>")]
    got = extraction.extract(spark.createDataFrame(data, PAGES).withColumn("text", F.lit(1)))
    want = [(i, u, f"{b} tail{i}") for (i, u, _), b in zip(data, bodies)]
    want += [(i, u, bodies[0]) for i, u, _ in data[12:18]]
    want += [(200, None, "alone here"), (201, "x", ""), (None, "https://a.example/n", ""),
             (200, None, "alone here")]
    assert rows(got) == sorted(want, key=lambda r: tuple((v is not None, v) for v in r))


def test_boilerplate_of_a_section_a_small_host_and_a_long_menu_goes(spark):
    rng = random.Random(5)
    menu = own_words(rng, 60)
    bodies = [own_words(rng, 12) for _ in range(60)]
    page = lambda i, line: f"<div>{line}</div><div>{bodies[i]}</div>" if line else f"<div>{bodies[i]}</div>"
    data = [(i, f"https://big.example/{i}", page(i, LINE if i % 5 == 0 else "")) for i in range(50)]  # one in five
    data += [(50 + i, f"https://small.example/{i}", page(50 + i, menu)) for i in range(3)]  # longer than the article
    data += [(53 + i, f"https://two.example/{i}", page(53 + i, LINE)) for i in range(2)]  # two pages are too few
    got = {r.page_id: r.text for r in extraction.extract(spark.createDataFrame(data, PAGES)).collect()}
    assert all(got[i] == bodies[i] for i in range(53))
    assert all(got[i] == f"{LINE}\n\n{bodies[i]}" for i in (53, 54))


def test_one_more_page_changes_others_only_by_a_run_that_crosses_the_count(spark):
    rng = random.Random(6)
    bodies = [own_words(rng, 30) for _ in range(8)]
    data = [(i, "http://h/", f"<p>{b}</p><p>{LINE if i < 2 else ''}</p>") for i, b in enumerate(bodies)]
    text = lambda d: {r.page_id: r.text for r in extraction.extract(spark.createDataFrame(d, PAGES)).collect()}
    before = text(data)
    same = text(data + [(90, "http://h/", f"<p>{own_words(rng, 30)}</p>"), (91, "http://other/", f"<p>{LINE}</p>"),
                        (92, "http://h/", data[0][2])])  # a copy is no further page
    assert {i: same[i] for i in before} == before and before[0].endswith(LINE)
    crossed = text(data + [(90, "http://h/", f"<p>{own_words(rng, 30)}</p><p>{LINE}</p>")])
    assert {i: t for i, t in crossed.items() if i < 90} == {i: b for i, b in enumerate(bodies)}


def test_near_copies_and_marked_articles_keep_shared_text(spark):
    rng = random.Random(7)
    words = own_words(rng, 80).split()
    near = [" ".join(words[:k] + ["edited"] + words[k + 1:]) for k in (20, 40, 60, 70)]
    shared = own_words(rng, 60)
    marked = [f"{own_words(rng, 20)}\n\n{shared}" for _ in range(5)]
    data = [(i, "http://h/", f"<p>{t}</p>") for i, t in enumerate(near)]
    data += [(10 + i, "http://h/", "<article>" + "".join(f"<p>{b}</p>" for b in t.split("\n\n")) + "</article>")
             for i, t in enumerate(marked)]
    got = {r.page_id: r.text for r in extraction.extract(spark.createDataFrame(data, PAGES)).collect()}
    assert got == dict(enumerate(near)) | {10 + i: t for i, t in enumerate(marked)}


def test_a_notice_of_the_host_goes_from_marked_articles_too(spark):
    rng = random.Random(8)
    bodies = [own_words(rng, 30) for _ in range(20)]
    teaser, shared = own_words(rng, 12), own_words(rng, 12)
    plain = lambda i, *more: "".join(f"<p>{x}</p>" for x in (bodies[i], *more))
    marked = lambda i, *more: f"<article>{plain(i, *more)}</article>"
    data = [(i, "http://h/", plain(i, LINE, teaser)) for i in range(3)]
    data += [(3 + i, "http://h/", marked(3 + i, LINE, shared)) for i in range(3)]
    data += [(6, "http://h/", marked(6, teaser)), (7, "http://h/", "<article></article>")]
    data += [(8 + i, "http://articles/", marked(8 + i, LINE)) for i in range(3)]  # in articles alone
    data += [(11 + i, "http://two/", plain(11 + i, LINE)) for i in range(3)]
    data += [(14 + i, "http://two/", marked(14 + i, LINE)) for i in range(2)]  # in two articles
    got = {r.page_id: r.text for r in extraction.extract(spark.createDataFrame(data, PAGES)).collect()}
    want = {i: bodies[i] for i in (0, 1, 2, 11, 12, 13)}
    want |= {i: f"{bodies[i]}\n\n{shared}" for i in (3, 4, 5)}
    want |= {6: f"{bodies[6]}\n\n{teaser}", 7: ""}
    assert got == want | {i: f"{bodies[i]}\n\n{LINE}" for i in (8, 9, 10, 14, 15)}


@pytest.mark.parametrize("name", "discussion widgets search comments navigation related notice byline tracking "
                                 "login social replies".split())
def test_sections_of_an_article_keep_their_text(name):
    html = f"<article><h2>T</h2><section id={name}><h3>Head</h3><p>Some text.</p></section></article>"
    assert extraction.blocks(html) == ["T", "Head", "Some text."]


def test_inline_elements_keep_their_text():
    assert extraction.blocks("<p>Let <math>x</math> be <label>real</label>, <output>1</output>.</p>") == [
        "Let x be real, 1."]


@pytest.mark.parametrize("html", [
    "<b>" * 100_000 + "x" + "</i>" * 100_000, "<b>" * 50_000 + "<p>y</p>" * 50_000,
    "<b>" * 50_000 + "<li>y</li>" * 50_000, "<div>" * 100_000 + "z" + "</p>" * 100_000,
    "<a>w</a>" * 50_000 + "<b><i>" * 50_000 + "v</b>" * 50_000])
def test_parsing_is_linear_in_open_elements(html):
    began = time.perf_counter()
    extraction.blocks(html)
    assert time.perf_counter() - began < 5


def test_runs_equal_brute_force():
    rng = random.Random(2)
    streams = [[" ".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(0, 6))]
               for _ in range(40)]
    run, stream, at = extraction.runs_of(streams)
    w = extraction.MIN_RUN
    want = {(i, k): tuple(t[k:k + w]) for i, t in enumerate(" ".join(s).split() for s in streams)
            for k in range(len(t) - w + 1)}
    got = dict(zip(zip(stream.tolist(), at.tolist()), run.tolist()))
    assert set(got) == set(want)
    assert len(set(zip(got.values(), (want[k] for k in got)))) == len(set(want.values())) == len(set(got.values()))


def test_extraction_of_no_pages(spark):
    assert extraction.extract(spark.createDataFrame([], PAGES)).count() == 0


# --------------------------------------------------------------------------- warc


@pytest.fixture(scope="module")
def pages():
    same = "<p>same\r\n\r\nWARC/1.1\r\n</p>"
    return [(5, "http://x/5", same), (3, "http://x/3", same), (9, None, same), (1, "http://x/1", None),
            (2, "http://x/2", ""), (4, "http://x/\r\nWARC-Type: fake", "é\U0001F600\n\r\n\r\n"),
            (7, "http://x/7", "long " * 30000), (5, "http://x/5", same), (None, "http://x/n", same),
            (None, "u", "only without id")]


def want(pages, least=0):
    body = [(i, (h or "").encode()) for i, _, h in pages]
    out, led = [], set()
    for i, b in body:
        ids = [j for j, c in body if c == b and j is not None]
        first = min(ids) if ids else None
        digest = base64.b32encode(hashlib.sha1(b).digest()).decode()
        if len(b) < least or (i == first and (b, i) not in led):
            led.add((b, i))
            out.append((i, len(b), digest, "response", None))
        else:
            out.append((i, len(b), digest, "revisit", first))
    return sorted(out, key=lambda r: tuple((v is not None, v) for v in r))


FIELDS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def test_archive_round_trip(spark, pages):
    df = spark.createDataFrame(pages, PAGES).withColumn("header", F.lit(0)).repartition(3)
    path = scratch(spark, "archive")
    warc.write(df, path)
    back = warc.restore(warc.read(spark, path, payloads=True))
    assert rows(back, *FIELDS) == want(pages)
    assert Counter((r.page_id, bytes(r.payload)) for r in back.collect()) == Counter(
        (i, (h or "").encode()) for i, _, h in pages)
    index = spark.read.parquet(f"{path}/headers")
    assert Counter(r.header.encode() for r in index.collect()) == Counter(
        bytes(r.header) for r in warc.read(spark, path).collect())


def test_payloads_are_stored_once(spark, pages):
    path = scratch(spark, "archive")
    warc.write(spark.createDataFrame(pages, PAGES), path)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(f"{path}/warc").collect()
    blocks = [b for f in files for fields, _, b in warc.parse(gzip.decompress(f.content))
              if fields["WARC-Type"] == "response"]
    assert len(blocks) == len({h or "" for _, _, h in pages})


def test_small_payloads_are_responses(spark, pages):
    got = warc.headers(spark.createDataFrame(pages, PAGES), min_bytes=10).select(
        "page_id", "bytes", "sha1", "record_type", "refers_to")
    assert rows(got) == want(pages, 10)


def test_changed_payload_is_noticed(spark):
    for bad in (b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabcd\r\n\r\n", b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc",
                b"WARC/1.1\r\nContent", b"HTTP/1.1 200 OK\r\n\r\n"):
        with pytest.raises(ValueError):
            list(warc.parse(bad))
    with pytest.raises(ValueError):
        list(warc.inflated(gzip.compress(b"x" * 1000)[:-9]))


def test_records_are_read_piece_by_piece():
    rng = random.Random(4)
    records = [b"".join(rng.choice([b"\r\n", b"a", b"WARC/1.1"]) for _ in range(rng.randint(0, 30))) for _ in range(40)]
    data = b"".join(b"WARC/1.1\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(r), r) for r in records)
    for size in (1, 2, 3, 7, 50, len(data)):
        pieces = [data[i:i + size] for i in range(0, len(data), size)]
        assert [b for _, _, b in warc.parse(pieces)] == records
    members = gzip.compress(data) + gzip.compress(data)
    assert b"".join(warc.inflated(members)) == data + data
    assert [b for _, _, b in warc.parse(warc.inflated(members))] == records * 2


def test_files_are_bounded_by_bytes_and_a_large_page_comes_back(spark):
    body = lambda i: "".join(map(chr, np.random.default_rng(i).integers(48, 120, 20_000)))
    data = [(i, f"http://x/{i}", body(i)) for i in range(60)] + [(99, "http://x/99", "large page " * (6 << 20))]
    path = scratch(spark, "archive")
    warc.write(spark.createDataFrame(data, PAGES), path, file_bytes=100_000)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(f"{path}/warc")
    sizes = [sum(map(len, warc.inflated(r.content))) for r in files.collect()]
    assert len(sizes) > 12 and sorted(sizes)[-2] < 300_000
    back = warc.restore(warc.read(spark, path))
    assert rows(back, *FIELDS) == want(data)


def test_archive_of_no_pages(spark):
    path = scratch(spark, "archive")
    warc.write(spark.createDataFrame([], PAGES), path)
    assert warc.restore(warc.read(spark, path)).count() == 0
