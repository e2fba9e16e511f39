"""Temperature mixing of sources, realised as budgeted block permutations.

Each source's share of the corpus tokens is raised to an exponent and
normalised.  The exponent is bisected until the mixture meets a limit on how
often the most repeated source is read, or a target entropy.  A source's
documents lie in blocks by hash; every epoch permutes its blocks and the
documents inside each.  Whole epochs are emitted as they are, and the last,
partial epoch ends inside one block, where the token budget is used up.

By default the budget is the least that reads every source once, so that no
document is lost: the largest source is read once and smaller ones more often.

All main-path work is DataFrame operations.  The bisection reads one written
row per source and never gathers them: each job evaluates the exponents that
the next ``LEVELS`` halvings can meet.

Defined cases: tokens are words; NULL and empty texts have none and cost
nothing, and a source without tokens gets weight 0 and is read once; NULL is a
source of its own; rows that repeat are drawn each; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from casebook.llm.common import free_name, saved

#: How often the most repeated source is read.
MAX_REPEATS = 2.0
#: Documents of a block on average.
BLOCK_DOCS = 4096
#: Halvings decided by one job, and jobs.
LEVELS = 6
ROUNDS = 5
SEED = 17


def n_tokens(text: Column) -> Column:
    """Words of a text: runs of anything but space, \\t, \\n, \\v, \\f and \\r."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\x0B\f\r]+")), F.lit(0)).cast("bigint")


def _measure(entropy: bool, budget: int | None) -> Column:
    """What the bisection holds against its target, for the exponent in column ``a``."""
    tokens, a = F.col("tokens"), F.col("a")
    if entropy:
        # -sum(w log w) for w = tokens^a / norm
        norm = F.sum(F.pow(tokens, a))
        return F.log(norm) - F.first(a) * F.sum(F.pow(tokens, a) * F.log(tokens)) / norm
    if budget is None:
        return F.pow(F.max(tokens) / F.min(tokens), 1 - F.first(a))
    return F.lit(budget) * F.max(F.pow(tokens, a - 1)) / F.sum(F.pow(tokens, a))


def exponent(sources: DataFrame, max_repeats: float = MAX_REPEATS,
             entropy: float | None = None, budget: int | None = None) -> float:
    """The exponent in [0, 1] whose weights meet the limit, by bisection.

    ``sources`` has a row per source with ``tokens``.  Both measures fall as
    the exponent grows.  The result is the smallest exponent with which the
    most repeated source is read ``max_repeats`` times at most or, if
    ``entropy`` (in nats) is given, the entropy of the weights is no larger;
    1 if none is.
    """
    target = max_repeats if entropy is None else entropy
    full = sources.where("tokens > 0").select("tokens")
    low, high = 0.0, 1.0
    for k in range(ROUNDS):
        step = (high - low) / (1 << LEVELS)
        grid = [low + i * step for i in range(1 << LEVELS)]
        rows = (full.withColumn("a", F.explode(F.array(*map(F.lit, grid)))).groupBy("a")
                .agg(_measure(entropy is not None, budget).alias("value")).collect())
        value = {row["a"]: row["value"] for row in rows}  # a row per exponent of the grid
        if not value:
            return 1.0
        if k == 0 and value[0.0] <= target:
            return 0.0
        lo, hi = 0, 1 << LEVELS
        while hi - lo > 1:
            mid = (lo + hi) // 2
            lo, hi = (mid, hi) if value[grid[mid]] > target else (lo, mid)
        low, high = low + lo * step, low + hi * step
    return high


def _hash(*parts: Column) -> Column:
    return F.md5(F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)))


def _keyed(docs: DataFrame, seed: int) -> DataFrame:
    """``docs`` (source, doc_id, text) with ``tokens`` and ``key``, their place in the ring."""
    return docs.withColumn("tokens", n_tokens(F.col("text"))).withColumn(
        "key", _hash(F.lit(seed), F.col("doc_id"), F.md5(F.coalesce("text", F.lit("")))))


def _block(key: Column, blocks: Column) -> Column:
    place = F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint")
    return F.call_function("div", place * blocks, F.lit(1 << 32))


def _block_order(seed: int, epoch: Column, source: Column, block: Column) -> Column:
    return _hash(F.lit(seed), F.lit("block"), epoch, source, block)


def _doc_order(seed: int, epoch: Column, key: Column) -> Column:
    return _hash(F.lit(seed), F.lit("doc"), epoch, key)


def shares(keyed: DataFrame, max_repeats: float = MAX_REPEATS, entropy: float | None = None,
           budget: int | None = None, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Per source: tokens, docs, blocks, exponent, weight, its budget, whole epochs and rest."""
    sources = saved(keyed.groupBy("source").agg(F.sum("tokens").alias("tokens"),
                                                F.count(F.lit(1)).alias("docs")), "sources")
    a = exponent(sources, max_repeats, entropy, budget)
    raw = F.when(F.col("tokens") > 0, F.pow("tokens", F.lit(a))).otherwise(0.0)
    top, norm = sources.agg(F.max("tokens"), F.sum(raw)).first()
    weight = raw / F.lit(norm) if norm else F.lit(0.0)
    whole = (F.col("tokens") * F.pow(F.lit(top) / F.col("tokens"), F.lit(1 - a))
             if budget is None else F.lit(budget) * weight)
    own = F.when(F.col("tokens") > 0, F.round(whole).cast("bigint")).otherwise(0)
    epochs = F.when(F.col("tokens") > 0, F.call_function("div", "budget", "tokens")).otherwise(1)
    out = (sources.withColumn("budget", own).withColumn("epochs", epochs)
           .select("source", "tokens", "docs", F.lit(a).alias("exponent"), weight.alias("weight"),
                   "budget", "epochs", (F.col("budget") - F.col("epochs") * F.col("tokens"))
                   .alias("rest"),
                   F.ceil(F.col("docs") / F.lit(block_docs)).cast("bigint").alias("blocks")))
    return saved(out, "shares")


def cuts(keyed: DataFrame, plan: DataFrame, seed: int = SEED) -> DataFrame:
    """``plan`` with the place where the partial epoch of each source ends.

    Blocks come first: their token sums, added up in block order, name the one
    block in which the budget ends.  Only that block's documents are added up
    one by one.  ``cut_block`` and ``cut_doc`` are the last block and document
    that are still read (by order key); NULL where nothing is.
    """
    docs = _with(keyed, plan, "rest > 0", "rest", "epochs", "blocks").withColumn(
        "block", _block(F.col("key"), F.col("blocks")))
    sums = docs.groupBy("source", "epochs", "rest", "block").agg(F.sum("tokens").alias("size"))
    sums = sums.withColumn("block_order", _block_order(seed, F.col("epochs"), F.col("source"),
                                                       F.col("block")))
    by = Window.partitionBy("source").orderBy("block_order").rowsBetween(
        Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("size").over(by), F.lit(0)))
    last = sums.where("before < rest and before + size >= rest").select(
        F.col("source").alias("_source"), F.col("block").alias("_block"), "before", "block_order")
    inside = (docs.join(last, docs["source"].eqNullSafe(last["_source"])
                        & (docs["block"] == last["_block"]))
              .withColumn("doc_order", _doc_order(seed, F.col("epochs"), F.col("key"))))
    within = Window.partitionBy("source").orderBy("doc_order").rowsBetween(
        Window.unboundedPreceding, -1)
    inside = inside.withColumn("done", F.col("before") + F.coalesce(
        F.sum("tokens").over(within), F.lit(0)))
    ends = (inside.where("done < rest").groupBy("source")
            .agg(F.max("block_order").alias("cut_block"), F.max("doc_order").alias("cut_doc"))
            .select(F.col("source").alias("_source"), "cut_block", "cut_doc"))
    return saved(plan.join(ends, plan["source"].eqNullSafe(ends["_source"]), "left")
                 .drop("_source"), "cuts")


def _with(keyed: DataFrame, plan: DataFrame, where: str, *columns: str) -> DataFrame:
    """``keyed`` with columns of its source's row in ``plan``."""
    side = plan.where(where).select(F.col("source").alias("_source"), *columns)
    return keyed.join(side, keyed["source"].eqNullSafe(side["_source"])).drop("_source")


def draw(keyed: DataFrame, plan: DataFrame, seed: int = SEED) -> DataFrame:
    """The rows of ``keyed`` once per epoch that reads them, with their block and order."""
    rows = _with(keyed, plan, "true", "weight", "epochs", "blocks", "cut_block", "cut_doc")
    rows = rows.withColumn("block", _block(F.col("key"), F.col("blocks")))
    parts = F.sequence(F.lit(0).cast("bigint"), F.col("epochs") - F.when(
        F.col("cut_doc").isNull(), 1).otherwise(0))
    rows = rows.where((F.col("epochs") > 0) | F.col("cut_doc").isNotNull()).withColumn(
        "epoch", F.explode(parts))
    rows = (rows.withColumn("block_order", _block_order(seed, F.col("epoch"), F.col("source"),
                                                        F.col("block")))
            .withColumn("doc_order", _doc_order(seed, F.col("epoch"), F.col("key"))))
    inside = ((F.col("block_order") < F.col("cut_block"))
              | ((F.col("block_order") == F.col("cut_block"))
                 & (F.col("doc_order") <= F.col("cut_doc"))))
    return rows.where((F.col("epoch") < F.col("epochs")) | inside)


def mixture(docs: DataFrame, max_repeats: float = MAX_REPEATS, entropy: float | None = None,
            budget: int | None = None, block_docs: int = BLOCK_DOCS, seed: int = SEED) -> DataFrame:
    """The mixture as a table of draws, without texts.

    Returns doc_id, source, tokens, weight (of the source), epoch, block, and
    place: the row's position in its (source, epoch, block).  Blocks of an epoch
    follow each other by ``block_order``.
    """
    slim = saved(_keyed(docs.select("doc_id", "source", "text"), seed).drop("text"), "keyed")
    plan = cuts(slim, shares(slim, max_repeats, entropy, budget, block_docs), seed)
    place = F.row_number().over(Window.partitionBy("source", "epoch", "block")
                                .orderBy("doc_order")) - 1
    return draw(slim, plan, seed).select(
        "doc_id", "source", "tokens", "weight", "epoch", "block", "block_order",
        place.cast("bigint").alias("place"))


def mixed(docs: DataFrame, max_repeats: float = MAX_REPEATS, seed: int = SEED) -> DataFrame:
    """``docs`` with every row as often as the mixture draws it."""
    row = free_name(docs, "_row")
    packed = docs.select("doc_id", "source", "text", F.struct("*").alias(row))
    keyed = _keyed(packed, seed).drop("text")
    slim = saved(keyed.drop(row), "keyed")
    plan = cuts(slim, shares(slim, max_repeats), seed)
    return draw(keyed, plan, seed).select(f"{row}.*")
