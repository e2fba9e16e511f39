"""Secret scans with an incremental blob ledger.

Every version of every path is addressed by the SHA-256 of its content.  The
ledger records which (blob, rule set) pairs have been scanned and what was
found.  A run scans each unseen blob once, however many paths and versions hold
it, and joins the findings of old and new blobs back to all paths.

Matches are found by Spark's own regular expressions.  Their places follow
from the text between them: splitting by a pattern and extracting its matches
gives the two lists whose lengths add up to every offset.

Defined cases: NULL content counts as empty; versions that repeat are joined
each; an empty table gives an empty result; offsets are code points, end
exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from casebook.llm.common import free_name, saved

# The base rules, in the order in which kinds are listed.
# (kind, pattern, group to measure, characters it needs)
RULES = (
    ("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
               r"([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),  # the same as runs of any length, then the long ones
    # Added by this operator: private key blocks, also with header lines, and those of PGP.
    ("key", r"-----BEGIN [A-Z ]{0,32}PRIVATE KEY(?: BLOCK)?-----\s?\n?(?:[A-Za-z0-9-]{1,64}: [^\n]{0,256}\n)*"
            r"[A-Za-z0-9+/=\s]*-----END [A-Z ]{0,32}PRIVATE KEY(?: BLOCK)?-----", 0, 60),
)
BASE = ("assign", "access", "hex")
#: Names the rules above; a change of rules needs a new name.
VERSION = "2"

SPANS = "array<struct<start:int,kind:int,end:int>>"


def _matches(text: Column, kind: int, pattern: str, group: int) -> Column:
    """The matches of one rule as structs (kind, nth, gap before it, size, measured size)."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sizes = F.transform(found, F.length)
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    measured = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.length)
    rows = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(sizes)).alias("gap"), sizes.alias("size"),
                        measured.alias("long"))
    numbered = F.transform(rows, lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("nth"), x["gap"].alias("gap"), x["size"].alias("size"),
        x["long"].alias("long")))
    return F.when(text.rlike(pattern), numbered).otherwise(
        F.array().cast("array<struct<kind:int,nth:int,gap:int,size:int,long:int>>"))


def findings(blobs: DataFrame) -> DataFrame:
    """(blob, spans) of (blob, content) with distinct blobs: matches of all rules by start, then kind.

    A match is a row of its own until its place is known, as the running sum of
    what lies before it, so a blob with very many matches is as much work as
    they are.  Blobs are dealt by name already; nothing moves but sizes.
    """
    rows = blobs.select("blob", F.explode_outer(F.concat(*(
        _matches(F.col("content"), k, p, g) for k, (_, p, g, _) in enumerate(RULES)))).alias("m")).select("blob", "m.*")
    so_far = (Window.partitionBy("blob", "kind").orderBy("nth")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    least = F.element_at(F.array(*(F.lit(r[3]) for r in RULES)), F.col("kind") + 1)
    placed = rows.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(so_far).cast("int"))
    span = F.struct((F.col("end") - F.col("size")).alias("start"), "kind", "end")
    return (placed.groupBy("blob").agg(F.sort_array(F.collect_list(F.when(F.col("long") >= least, span))).alias("spans"))
            .withColumn("spans", F.col("spans").cast(SPANS)))


def blob(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def scan(versions: DataFrame, content: str, ledger: DataFrame | None = None) -> DataFrame:
    """Ledger rows (blob, rules, spans) for the blobs that ``ledger`` lacks.

    One copy of each unseen blob is scanned.  Grouping leaves one copy per
    task before the shuffle, so a blob with very many copies moves no more
    than any other.
    """
    text = F.coalesce(F.col(content).cast("string"), F.lit(""))
    blobs = versions.select(blob(text).alias("blob"), text.alias("content"))
    if ledger is not None:
        seen = ledger.where(F.col("rules") == VERSION).select("blob").distinct()
        blobs = blobs.join(seen, "blob", "left_anti")
    return findings(blobs.dropDuplicates(["blob"])).select("blob", F.lit(VERSION).alias("rules"), "spans")


def scan_paths(versions: DataFrame, content: str, ledger: DataFrame | None = None
               ) -> tuple[DataFrame, DataFrame]:
    """(``versions`` without content but with ``spans``, the new ledger rows).

    The new rows are written before they are joined, so that a later failure
    repeats no scan and a blob with very many paths is an ordinary join that
    Spark can split.  Spans of a blob seen earlier come from the ledger.
    """
    fresh = saved(scan(versions, content, ledger), "ledger")
    known = fresh
    if ledger is not None:
        old = ledger.where(F.col("rules") == VERSION).select(*fresh.columns)
        known = saved(fresh.unionByName(old).dropDuplicates(["blob"]), "known")
    own, hit, spans = (free_name(versions, n) for n in ("_blob", "_hit", "_spans"))
    hits = known.where(F.size("spans") > 0).select(F.col("blob").alias(hit), F.col("spans").alias(spans))
    plain = [c for c in versions.columns if c not in (content, "spans")]
    paths = versions.select(*(f"`{c}`" for c in plain), blob(F.col(content).cast("string")).alias(own))
    joined = paths.join(hits, F.col(own) == F.col(hit), "left")
    return joined.select(*(f"`{c}`" for c in plain), F.coalesce(
        F.col(spans), F.array().cast(SPANS)).alias("spans")), fresh


def spelled(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*(F.lit(r[0]) for r in RULES))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"),
        s["end"].cast("string"))), ",")


def of_kinds(spans: Column, *kinds: str) -> Column:
    numbers = [k for k, r in enumerate(RULES) if r[0] in kinds]
    return F.filter(spans, lambda s: s["kind"].isin(*numbers))
