"""Main text of web pages: markup first, then repeated runs of each host.

Markup settles most blocks: what stands in navigation, footers, forms, adverts,
comments and the like goes, and where a page marks its article, only that is
kept.  Names that mark an element (class, id, role) drop no article but one of
the comments, and an id inside an article says nothing, since ids there name its
sections.  Where names wrap the only article, or all text, they are passed over.

What is left is boilerplate where it repeats.  The token streams are the strings
of a suffix array for each host, in which Spark's own shuffle brings together the
suffixes that share their first ``MIN_RUN`` tokens.  On pages that mark no article
a run that stands on ``LEAST_PAGES`` of them or more goes, and the runs between
stay.  From articles that pages mark such a run goes if it stands in
``LEAST_PAGES`` of these as well; what only articles share is their own text.
Pages of a host with equal streams count as one page.  A page without a
run of ``MIN_RUN`` tokens of its own is a copy of others and is left as it is.
So another page changes a text only if it lifts a run over the count.

Suffixes are told apart by a 64-bit hash of their tokens and by host, and are
counted before the shuffle, so a host of any size is many tasks.

Defined cases: NULL html is empty and gives an empty text; a page without main
text gives an empty text; a NULL or relative URL belongs to the host of no
name; rows that repeat give a row each; an empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from casebook.llm.common import in_arrow, joined_back, saved, span_hashes, texts, windows, words

#: Tokens of a run that can be boilerplate, and pages of a host from which it is.
MIN_RUN = 8
LEAST_PAGES = 3
#: Share of linked characters from which a block outside an article is a menu.
LINKS = 0.5

# Elements by what they mean.
GONE = frozenset("""aside audio button canvas datalist dialog embed fieldset footer form frame frameset
    head iframe input menu nav noframes noscript object option optgroup progress script select style svg
    template textarea title video""".split())
MAIN = {"article": 2, "main": 1}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl
    dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend
    li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr
    ul""".split())
RAW = frozenset("script style textarea title xmp noscript iframe noframes".split())
#: Names in a class, id or role that mark what is not the article.
MARKS = frozenset("""ad ads adsense advert adverts advertisement advertising banner breadcrumb
    breadcrumbs byline captcha comment comments commentlist complementary contentinfo cookie cookies
    consent copyright dialog discussion disqus footer gdpr header login masthead menu modal nav navbar
    navigation newsletter notice notification notifications outbrain overlay pager pagination paywall
    popup promo promoted promotion recommended recommendations related replies reply respond search
    share sharing sidebar signup skip social sponsor sponsored subscribe subscription taboola toolbar
    topbar tracking widget widgets""".split())
#: Marks of what readers wrote: an article among them is a comment.
COMMENTS = frozenset("comment comments commentlist discussion disqus replies reply respond".split())
#: Words that may stand beside marks in one name, and those that may beside "header".
BESIDE = frozenset("""area articles bar block body bottom box btn button buttons col column container
    div elements entries footer form global google gpt group icon icons inner item items left link links
    list main media module outer page panel popular posts primary recent right secondary section site slot
    stories text title top unit wrap wrapper zone""".split())
SITE = frozenset("global header main nav navbar navigation site top wrap wrapper container".split())

#: Elements that end an open one of the same name, up to these around it.
ENDS = dict.fromkeys("li dt dd tr td th option".split(), "ul ol dl table select menu".split())

TOKEN = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)
    |<(/?)([A-Za-z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"']|["'])*?)(?:>|\Z)|[^<]+|<""", re.S | re.X)
NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
WORD = re.compile(r"[A-Za-z]+")


@lru_cache(1 << 14)
def _mark(name: str) -> int:
    """0 for a name that says nothing, 1 for what is not the article, 2 for comments, -1 for a header.

    A name counts if it is a mark as a whole, or made only of marks and words
    that may stand beside them.
    """
    parts = {w.lower() for w in WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", name))}
    whole = "".join(WORD.findall(name)).lower()
    marks = {whole} if whole in MARKS else parts & MARKS
    if not marks or whole not in MARKS and not parts <= MARKS | BESIDE:
        return 0
    if "header" in parts and parts <= SITE:
        return -1
    if marks == {"header"}:
        return 0
    return 2 if marks & COMMENTS else 1


def _marked(attributes: str, inside: bool) -> int:
    """What class, id and role say, as in ``_mark``; in an article an id says nothing.

    A header in an article is part of it.
    """
    level = 0
    for m in NAMES.finditer(attributes):
        if inside and m[1].lower() == "id":
            continue
        for name in (m[2] or m[3] or m[4] or "").split():
            mark = _mark(name)
            level = max(level, mark if mark >= 0 else int(not inside))
    return level


def _chosen(found: list[tuple[int, list[tuple[int, int, bool, str]]]]) -> tuple[list[str], bool]:
    """The texts of the blocks that stay, and whether the page marks them as its article.

    A block is (2 in an article, 1 in main, 0 elsewhere; parts); a part is (mark
    around the article or main or, outside of one, around the text; mark inside
    it; linked; text).
    """
    def pick(around: int, within: int, wrapped: int = 0) -> list[tuple[int, str]]:
        out = []
        for inside, parts in found:
            most = max(around, wrapped) if inside == 2 else around
            stays = [x for x in parts if x[0] <= most and x[1] <= within]
            words_ = " ".join("".join([x[3] for x in stays]).split())
            if words_ and (inside or sum(len(x[3]) for x in stays if x[2]) <= LINKS * len(words_)):
                out.append((inside, words_))
        some = any(inside for inside, _ in out)
        return [x for x in out if x[0] or not some]

    size = lambda out: sum(len(t) for _, t in out)
    left = pick(0, 0)
    if any(x[0] or x[1] for _, parts in found for x in parts):
        if not any(inside == 2 for inside, _ in left):  # names around the only article
            other = pick(0, 0, 1)
            if size([x for x in other if x[0] == 2]) > size(left):
                left = other
        left = left or pick(1, 1) or pick(2, 2)
    return [t for _, t in left], any(inside for inside, _ in left)


def main_blocks(page: str) -> tuple[list[str], bool]:
    """The text blocks of a page that markup leaves, in page order, and whether it marks them.

    Every element is opened and closed once and looked up by name, so the work
    grows with the page's length whatever is left open in it.
    """
    found: list[tuple[int, list[tuple[int, int, bool, str]]]] = []
    # (tag, dropped, 2 in an article and 1 in main, mark around that, mark inside it)
    stack: list[tuple[str, bool, int, int, int]] = []
    places: dict[str, list[int]] = {}  # where the open elements of each name stand
    block_at: list[int] = []  # and those of blocks
    text: list[tuple[int, int, bool, str]] = []
    at = 0
    start = (False, 0, 0, 0)
    state = start

    def flush() -> None:
        if text:
            found.append((state[1], text.copy()))
            text.clear()

    def shut(size: int) -> None:
        nonlocal state
        if block_at and block_at[-1] >= size:
            flush()
        for tag, *_ in stack[size:]:
            places[tag].pop()
        while block_at and block_at[-1] >= size:
            block_at.pop()
        del stack[size:]
        state = stack[-1][1:] if stack else start

    def last(tag: str) -> int:
        return places[tag][-1] if places.get(tag) else -1

    while at < len(page):
        m = TOKEN.match(page, at)
        at = m.end()
        tag = m[3]
        if tag is None:
            part = m[1] if m[1] is not None else m[0]
            if not state[0] and (m[1] is not None or not m[0].startswith(("<!", "<?"))):
                part = entities.unescape(part) if "&" in part and m[1] is None else part
                text.append((*state[2:], bool(places.get("a")), part))
            continue
        tag = tag.lower()
        if m[2]:
            if places.get(tag):
                shut(last(tag))
            if tag in BLOCK:
                flush()
            continue
        if tag in BLOCK:
            flush()
            if block_at and stack[block_at[-1]][0] == "p":  # a block ends an open paragraph
                shut(block_at[-1])
            if tag in ENDS and last(tag) > max(map(last, ENDS[tag])):
                shut(last(tag))
        if tag == "br":
            text.append((*state[2:], False, " "))
        if tag in VOID:
            continue
        inside = max(state[1], MAIN.get(tag, 0))
        dropped, around, within = state[0] or tag in GONE or (tag == "header" and not inside), *state[2:]
        if inside > state[1]:  # what stood inside main is around its article
            around, within = max(around, within), 0
        if not dropped and m[4].strip() and tag not in ("html", "body", "main"):
            dropped = bool(HIDDEN.search(m[4]))
            mark = _marked(m[4], bool(inside))
            if tag == "article" and mark == 1:
                mark = 0
            if state[1]:
                within = max(within, mark)
            else:
                around = max(around, mark)
        if tag in RAW:
            close = re.compile(f"</{re.escape(tag)}", re.I).search(page, at)
            if tag not in GONE and not dropped:
                text.append((around, within, False, page[at:close.start() if close else len(page)]))
            at = close.start() if close else len(page)
        if tag in BLOCK:
            block_at.append(len(stack))
        places.setdefault(tag, []).append(len(stack))
        stack.append((tag, dropped, inside, around, within))
        state = stack[-1][1:]
    flush()
    return _chosen(found)


def blocks(page: str) -> list[str]:
    """The text blocks of a page that markup leaves, in page order."""
    return main_blocks(page)[0]


# ------------------------------------------------------------------ repeated runs


def runs_of(streams: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, stream, first token) of every run of ``MIN_RUN`` tokens within a stream."""
    joined = pa.array([" ".join(s) for s in streams], pa.string())
    parts = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for lo, _, buf, offsets in texts(joined):
        starts, ends, bounds = words(buf, offsets)
        grams, at = windows(span_hashes(buf, starts, ends), bounds, MIN_RUN)
        stream = np.searchsorted(bounds, at, "right") - 1
        parts.append((grams, lo + stream, at - bounds[stream]))
    return tuple(np.concatenate(p) for p in zip(*parts))


def without_runs(stream: list[str], at: list[int]) -> list[str]:
    """The blocks of a page without the runs that begin at the tokens ``at``.

    All blocks stay if no run of ``MIN_RUN`` tokens would be left.
    """
    size = [len(b.split(" ")) for b in stream]
    gone = np.zeros(sum(size), bool)
    for k in at:
        gone[k:k + MIN_RUN] = True
    edges = np.flatnonzero(np.diff(np.concatenate(([True], gone, [True]))))
    if not len(edges) or (edges[1::2] - edges[::2]).max() < MIN_RUN:
        return stream
    out, lo = [], 0
    for block, n in zip(stream, size):
        if gone[lo:lo + n].any():
            block = " ".join(t for t, g in zip(block.split(" "), gone[lo:lo + n].tolist()) if not g)
        if block:
            out.append(block)
        lo += n
    return out


def _runs(streams: DataFrame) -> DataFrame:
    """(host, stream, run, at) of every run of ``MIN_RUN`` tokens."""
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        run, row, at = runs_of(batch.column(2).to_pylist())
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)),
             pa.array(run.view(np.int64)), pa.array(at)], ["host", "stream", "run", "at"])

    return streams.select("host", "stream", "blocks").mapInArrow(
        in_arrow(step), "host bigint, stream string, run bigint, at bigint")


def _common(runs: DataFrame, least_pages: int) -> DataFrame:
    """(host, run): the runs that stand on enough pages of their host."""
    return (runs.select("host", "run", "stream").distinct().groupBy("host", "run")
            .agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= least_pages).drop("pages"))


def _places(runs: DataFrame, common: DataFrame) -> DataFrame:
    """(host, stream, at): where the common runs stand in each stream."""
    return (joined_back(runs, common, "host", "run").groupBy("host", "stream")
            .agg(F.collect_list("at").alias("at")))


def _streams(rows: DataFrame) -> DataFrame:
    """Each text of a host once."""
    return rows.groupBy("host", "stream").agg(F.first("blocks").alias("blocks"))


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")),
                                    r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def extract(pages: DataFrame, least_pages: int = LEAST_PAGES) -> DataFrame:
    """(page_id, url, text) of every row of ``pages`` (page_id, url, html)."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"),
                        F.col("url").cast("string").alias("url"),
                        F.xxhash64(host(F.col("url"))).alias("host"),
                        F.col("html").cast("string").alias("html"))

    def parse(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [main_blocks(h or "") for h in batch.column(3).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array([b for b, _ in found], pa.list_(pa.string())),
             pa.array([m for _, m in found], pa.bool_())], ["page_id", "url", "host", "blocks", "marked"])

    parsed = saved(rows.mapInArrow(in_arrow(parse), "page_id bigint, url string, host bigint, "
                                                    "blocks array<string>, marked boolean"), "parsed")
    joined = F.array_join("blocks", "\n\n")
    empty = F.size("blocks") == 0
    rows = parsed.withColumn("stream", F.sha2(joined, 256))
    open_rows = rows.where(~F.col("marked") & ~empty)
    runs = _runs(_streams(open_rows))
    common = saved(_common(runs, least_pages), "common")
    hits = saved(_places(runs, common), "runs")

    # Articles can only hold common runs of their own host, so the others are done.
    hosts = common.select("host").distinct()
    articles = rows.where(F.col("marked") & ~empty)
    near = articles.join(hosts, "host", "left_semi")
    found = saved(joined_back(_runs(_streams(near)), common, "host", "run"), "found")
    article_hits = saved(_places(found, _common(found, least_pages)), "article_runs")
    done = (rows.where(empty).select("page_id", "url", joined.alias("text"))
            .unionByName(articles.join(hosts, "host", "left_anti").select("page_id", "url", joined.alias("text"))))

    def clean(batch: pa.RecordBatch) -> pa.RecordBatch:
        left = [without_runs(b, at) if at else b
                for b, at in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        return pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(["\n\n".join(b) for b in left], pa.string())],
                                          ["page_id", "url", "text"])

    for some, at in ((open_rows, hits), (near, article_hits)):
        done = done.unionByName(
            some.join(at, ["host", "stream"], "left").select("page_id", "url", "blocks", "at")
            .mapInArrow(in_arrow(clean), "page_id bigint, url string, text string"))
    return done
