"""Join shapes: membership flags, interval joins, null-aware NOT IN."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def membership_flag(df: DataFrame, keys: DataFrame, key: str, flag: str) -> DataFrame:
    """Add ``flag`` = 1 when ``df.key`` occurs in ``keys``, else 0.

    ``keys`` is reduced to distinct keys first so the left join cannot fan
    out; the join is an equi-join on ``key``.
    """
    k = keys.select(F.col(key).alias("_k")).distinct().withColumn("_hit", F.lit(1))
    return (df.join(k, df[key] == F.col("_k"), "left")
            .withColumn(flag, F.coalesce(F.col("_hit"), F.lit(0)))
            .drop("_k", "_hit"))


#: Levels of the dyadic lattice over days: enough for any two dates.
DAY_LEVELS = 32


def dyadic_nodes(start: Column, end: Column, levels: int = DAY_LEVELS) -> Column:
    """The dyadic blocks that make up the whole numbers ``start`` to ``end``.

    An array of structs (level, node): the block of 2^level numbers from
    ``node * 2^level`` on.  They are disjoint, cover the interval and nothing
    else, and there are two a level at most, so an interval of any length is
    O(log length) rows.  On each level the blocks that fit inside are a range; an
    odd first or an even last one has no whole parent inside, so it is emitted.
    """
    def level(k: Column) -> Column:
        first = -F.call_function("shiftright", -start, k)
        past = F.call_function("shiftright", end + 1, k)
        left = F.when((first < past) & (F.pmod(first, F.lit(2)) == 1), F.struct(k.alias("level"), first.alias("node")))
        right = F.when((first < past) & (F.pmod(past, F.lit(2)) == 1), F.struct(k.alias("level"), (past - 1).alias("node")))
        return F.array_compact(F.array(left, right))

    top = F.least(F.lit(levels - 1), F.ceil(F.log2((end - start + 2).cast("double"))).cast("int"))
    return F.when(start <= end, F.flatten(F.transform(F.sequence(F.lit(0), top), level)))


def interval_join(facts: DataFrame, ts_col: str, dim: DataFrame, start_col: str, end_col: str,
                  key: Sequence[str]) -> DataFrame:
    """Left join each fact to the dim rows with ``start <= ts <= end``.

    Long, open and overlapping intervals cost little: an interval is cut into
    the dyadic blocks of its days, O(log days) rows, and a fact meets the one
    block of each level that holds its day.  Levels that no interval uses are
    left out.  The meeting is an equi-join on (level, block), with the exact
    range test as its condition.  One more row of each fact, at a level of its
    own, meets nothing and stays if no other did; that is seen by ``key``, which
    is unique among the facts and not NULL.  Days outside the facts' own span are
    cut off first, which bounds the levels.
    """
    span = facts.agg(F.to_date(F.min(ts_col)).alias("lo"), F.to_date(F.max(ts_col)).alias("hi"))
    lo, hi = span.select("lo").scalar(), span.select("hi").scalar()
    own = [c for c in dim.columns if c not in (start_col, end_col)]
    first, last = F.greatest(F.to_date(start_col), lo), F.least(F.to_date(end_col), hi)
    nodes = (dim.select(F.col(start_col).alias("_start"), F.col(end_col).alias("_end"), *own,
                        F.unix_date(first).alias("_from"), F.unix_date(last).alias("_to"))
             .withColumn("_at", F.explode(dyadic_nodes(F.col("_from"), F.col("_to"))))
             .select("_start", "_end", *own, F.col("_at.level").alias("_at_level"),
                     F.col("_at.node").alias("_at_node"), F.lit(True).alias("_hit")))
    used = nodes.agg(F.collect_set("_at_level")).scalar()
    each = (facts.withColumn("_level", F.explode(F.concat(F.array(F.lit(-1)), used)))
            .withColumn("_node", F.call_function("shiftright", F.unix_date(F.to_date(ts_col)),
                                                 F.greatest("_level", F.lit(0)))))
    met = each.join(nodes, (F.col("_level") == F.col("_at_level")) & (F.col("_node") == F.col("_at_node"))
                    & F.col(ts_col).between(F.col("_start"), F.col("_end")), "left")
    any_hit = F.max("_hit").over(Window.partitionBy(*key))
    kept = (met.where(F.col("_hit") | (F.col("_level") < 0)).withColumn("_any", any_hit)
            .where(F.col("_hit") | F.col("_any").isNull()))
    return kept.select(*facts.columns, *own)


def not_in_values(df: DataFrame, col: str, values: DataFrame, vcol: str) -> DataFrame:
    """``WHERE col NOT IN (SELECT vcol FROM values)`` with SQL NULL semantics.

    Rows are kept when absent from the non-NULL values; if the value set
    holds a NULL the predicate is never true, so the result is empty.  The
    NULL test is a one-row scalar subquery; the rest is a left-anti join.
    """
    v = values.select(F.col(vcol).alias("_v")).distinct()
    has_null = v.agg(F.max(F.col("_v").isNull().cast("int")).alias("_h"))
    return (df.join(v.where(F.col("_v").isNotNull()), df[col] == F.col("_v"), "left_anti")
            .where(F.coalesce(has_null.scalar(), F.lit(0)) == 0))
