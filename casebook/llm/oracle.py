"""DuckDB SQL for the operators that SQL can express, over whole tables.

The others have brute-force tests: sharding and packing need CRC-32, which
DuckDB lacks, and the rest hash, tokenize or parse in ways SQL cannot.
"""

from __future__ import annotations

from casebook.llm import mixing, secrets

_WORD = r"[^\x20\x09-\x0D]+"

_MIXING = f"""
WITH RECURSIVE keyed AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS tokens,
         md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':'
             || md5(coalesce(text, ''))) AS key
  FROM documents),
sources AS (SELECT source, CAST(sum(tokens) AS BIGINT) AS tokens, count(*) AS docs
            FROM keyed GROUP BY source),
spread AS (SELECT max(tokens) AS top, max(tokens) / min(tokens) AS ratio FROM sources WHERE tokens > 0),
halves(i, low, high) AS (
  SELECT 0, CAST(0 AS DOUBLE), CAST(1 AS DOUBLE)
  UNION ALL
  SELECT i + 1,
         CASE WHEN pow(ratio, 1 - (low + high) / 2) > {mixing.MAX_REPEATS} THEN (low + high) / 2 ELSE low END,
         CASE WHEN pow(ratio, 1 - (low + high) / 2) > {mixing.MAX_REPEATS} THEN high ELSE (low + high) / 2 END
  FROM halves, spread WHERE i < {mixing.LEVELS * mixing.ROUNDS}),
power AS (SELECT top, CASE WHEN ratio <= {mixing.MAX_REPEATS} THEN 0 ELSE high END AS a
          FROM halves, spread WHERE i = {mixing.LEVELS * mixing.ROUNDS}),
weights AS (
  SELECT source, tokens, CASE WHEN tokens > 0 THEN pow(tokens, a) ELSE 0 END AS raw,
         CASE WHEN tokens > 0 THEN CAST(round(tokens * pow(top / tokens, 1 - a)) AS BIGINT) ELSE 0 END
           AS budget,
         CAST(ceil(docs / {mixing.BLOCK_DOCS}.0) AS BIGINT) AS blocks
  FROM sources, power),
plan AS (
  SELECT source, raw / sum(raw) OVER () AS weight, blocks,
         CASE WHEN tokens > 0 THEN budget // tokens ELSE 1 END AS epochs,
         CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS rest
  FROM weights),
reads AS (
  SELECT k.*, p.weight, p.epochs, p.rest, unnest(range(p.epochs + 1)) AS epoch,
         (CAST('0x' || substr(key, 1, 8) AS BIGINT) * p.blocks) // 4294967296 AS block
  FROM keyed k JOIN plan p ON k.source IS NOT DISTINCT FROM p.source),
ordered AS (
  SELECT *, md5('{mixing.SEED}:block:' || epoch || ':' || coalesce(source, '') || ':' || block) AS block_order,
         md5('{mixing.SEED}:doc:' || epoch || ':' || key) AS doc_order
  FROM reads),
added AS (
  SELECT *, coalesce(sum(tokens) OVER (PARTITION BY source, epoch ORDER BY block_order, doc_order
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done
  FROM ordered)
SELECT doc_id, source, tokens, round(weight, 9) AS weight, epoch, block,
       row_number() OVER (PARTITION BY source, epoch, block ORDER BY doc_order) - 1 AS place
FROM added WHERE epoch < epochs OR done < rest"""

_NEAREST = """
WITH fine AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         sqrt(list_reduce(list_transform(list_zip(q.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])),
                          lambda a, b: a + b)) AS score
  FROM fine q JOIN fine c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM pairs QUALIFY rank <= 10"""


def _kind(k: int, pattern: str, group: int, least: int) -> str:
    p = "'" + pattern.replace("'", "''") + "'"
    return f"""
  list_filter(list_transform(range(1, len(regexp_extract_all(t, {p})) + 1), lambda i: {{
    'start': coalesce(list_sum(list_transform(string_split_regex(t, {p})[1:i], lambda x: len(x))), 0)
           + coalesce(list_sum(list_transform(regexp_extract_all(t, {p})[1:i - 1], lambda x: len(x))), 0),
    'kind': {k}, 'size': len(regexp_extract_all(t, {p})[i]),
    'long': len(regexp_extract_all(t, {p}, {group})[i])}}), lambda s: s['long'] >= {least})"""


# The base kinds as the contract of the query words them, but that hex runs are
# matched from 24 on (each match is found again for its place), then the added kind.
_RULES = [
    (0, r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    (1, r"AKIA[A-Z0-9]+", 0, 20),
    (2, r"[0-9a-f]{24,}", 0, 24),
    (3, *secrets.RULES[3][1:])]
_NAMES = "[" + ", ".join(f"'{r[0]}'" for r in secrets.RULES) + "]"


def _spelled(spans: str) -> str:
    return (f"coalesce(array_to_string(list_transform({spans}, lambda s: {_NAMES}[s['kind'] + 1] || ':' "
            "|| CAST(s['start'] AS BIGINT) || ':' || CAST(s['start'] + s['size'] AS BIGINT)), ','), '')")


_BASE_SPANS = f"list_filter(spans, lambda s: s['kind'] < {len(secrets.BASE)})"
_SECRETS = f"""
WITH spanned AS (
  SELECT doc_id, list_sort(list_concat({','.join(_kind(*r) for r in _RULES)})) AS spans
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents) d)
SELECT doc_id, {', '.join(
    f"len(list_filter(spans, lambda s: s['kind'] = {k})) AS n_{name}" for k, name in enumerate(secrets.BASE))},
       sha256({_spelled(_BASE_SPANS)}) AS base_sha256, {_spelled('spans')} AS spans
FROM spanned"""

_WARC = """
WITH captures AS (
  SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS payload_bytes,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
  FROM pages),
digits AS (SELECT *, list_transform(range(8), lambda i: CAST(
             '0x' || substr(sha1(body), CAST(5 * i + 1 AS BIGINT), 5) AS BIGINT)) AS parts FROM captures)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(parts, lambda v: array_to_string(list_transform([15, 10, 5, 0],
         lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((v >> s) & 31 AS BIGINT) + 1, 1)), '')), '')
         AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM digits"""

_JACCARD = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
texts AS (SELECT w, min(doc_id) AS id, count(*) AS n_copies FROM worded GROUP BY w),
shingles AS (
  SELECT DISTINCT id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
                             ELSE list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4]) END) AS s
  FROM texts),
sizes AS (SELECT id, count(*) AS n FROM shingles GROUP BY id),
shared AS (SELECT a.id AS u, b.id AS v, count(*) AS c
           FROM shingles a JOIN shingles b ON a.s = b.s AND a.id <> b.id GROUP BY ALL),
links AS (SELECT u, v FROM shared JOIN sizes x ON x.id = u JOIN sizes y ON y.id = v
          WHERE 5 * c >= 4 * (x.n + y.n - c)),
reach(id, other) AS (
  SELECT id, id FROM texts
  UNION
  SELECT reach.id, links.v FROM reach JOIN links ON reach.other = links.u),
classes AS (SELECT id, min(other) AS class_id FROM reach GROUP BY id),
counts AS (SELECT u AS id, sum(n_copies) AS docs, count(*) AS n
           FROM links JOIN texts ON texts.id = v GROUP BY u)
SELECT doc_id, class_id, CAST(n_copies - 1 + coalesce(docs, 0) AS BIGINT) AS n_links,
       CAST(coalesce(n, 0) AS BIGINT) AS n_text_links, n_copies
FROM worded JOIN texts USING (w) JOIN classes USING (id) LEFT JOIN counts USING (id)"""

#: CRC-32 of a string: a table of 256 remainders, folded over its UTF-8 bytes.
_CRC_TABLE = """(SELECT list(list_reduce(list_concat([i], range(8)),
  lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) FROM range(256) r(i))"""


def _crc32(text: str, table: str) -> str:
    """CRC-32 of ``text`` that is not empty; ``table`` is a column with the remainders."""
    return (f"xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(octet_length(encode({text}))), "
            f"lambda i: CAST('0x' || substr(hex(encode({text})), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))), "
            f"lambda c, b: xor(c >> 8, {table}[xor(c, b) % 256 + 1])))")


_SPELLING = f"""
WITH RECURSIVE crc AS (SELECT {_CRC_TABLE} AS remainders),
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents WHERE text IS NOT NULL),
checked AS (
  SELECT run, n, {_crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run", "remainders")} AS h
  FROM (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL) r, crc),
words AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT))
              || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, CAST(sum(n) AS BIGINT) AS n
  FROM checked GROUP BY 1 HAVING length(word) >= 6 AND sum(n) >= 5),
cuts AS (
  SELECT word, n, i, substr(word, 1, CAST(i - 1 AS BIGINT)) || substr(word, CAST(i + 1 AS BIGINT)) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words) w),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT a.word, a.n, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
  UNION
  SELECT b.word, b.n, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, max(n) AS n, max(other_n) AS form_n,
         min(CASE WHEN other_n = top THEN other END) AS form
  FROM (SELECT *, max(other_n) OVER (PARTITION BY word) AS top FROM near) r GROUP BY word),
forms AS (SELECT word, form, form_n FROM best WHERE form_n >= 5 * n),
chain(word, last) AS (
  SELECT word, form FROM forms
  UNION ALL
  SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.last),
roots AS (SELECT word, last AS root FROM chain WHERE last NOT IN (SELECT word FROM forms))
SELECT w.word, f.form, coalesce(r.root, w.word) AS root, w.n, coalesce(b.n_near, 0) AS n_near, f.form_n
FROM words w LEFT JOIN best b ON b.word = w.word LEFT JOIN forms f ON f.word = w.word
LEFT JOIN roots r ON r.word = w.word"""

_MIDDLE = """
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents),
cut AS (
  SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS u,
         list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(d, i, 8) AS BIGINT)) AS h FROM hashed),
placed AS (
  SELECT doc_id, t, u, CAST(len(u) AS BIGINT) AS n, h, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS a,
         greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS b FROM cut),
parted AS (
  SELECT doc_id, t, n, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m,
         array_to_string(u[b + 1:n], '') AS s,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90
              THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM placed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parted"""

SQL = {
    "op1_mixing": _MIXING,
    "op2_nearest": _NEAREST,
    "op7_secrets": _SECRETS,
    "op8_warc": _WARC,
    "op9_jaccard_join": _JACCARD,
    "op11_spelling": _SPELLING,
    "op12_fill_in_middle": _MIDDLE,
}
