"""Distinct counts that merge: stored per day, read per month or year.

A distinct count can't be added up.  These forms store, for each fine period,
something that can be merged, so a coarser period never reads the facts again.

* ``bitmaps`` are exact, for whole-number ids; dense ids fill them well.  A
  bitmap has 32,768 ids, so a group of any size is many rows.
* ``sketches`` are HyperLogLog sketches of a few kB for ids of any type and
  number; their count is an estimate (about 1.6 % off at the default size).

NULL ids are not counted; a period without ids has no row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

SKETCH_LG_K = 12


def bitmaps(df: DataFrame, by: Sequence[str], id_col: str) -> DataFrame:
    """(by, bucket, bits): the ids of each group as bitmaps."""
    ids = F.col(id_col).cast("bigint")
    return (df.where(F.col(id_col).isNotNull())
            .groupBy(*by, F.bitmap_bucket_number(ids).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(ids)).alias("bits")))


def count_bitmaps(stored: DataFrame, by: Sequence[str | Column], out: str) -> DataFrame:
    """The distinct ids of coarser groups ``by``, exactly.

    Bitmaps of one bucket meet first, so a group's work is dealt by bucket.
    """
    merged = stored.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    names = [c for c in merged.columns if c not in ("bucket", "bits")]
    return merged.groupBy(*names).agg(F.sum(F.bitmap_count("bits")).alias(out))


def sketches(df: DataFrame, by: Sequence[str], id_col: str, lg_k: int = SKETCH_LG_K) -> DataFrame:
    """(by, sketch): a HyperLogLog sketch of each group's ids."""
    return (df.where(F.col(id_col).isNotNull())
            .groupBy(*by).agg(F.hll_sketch_agg(id_col, F.lit(lg_k)).alias("sketch")))


def count_sketches(stored: DataFrame, by: Sequence[str | Column], out: str) -> DataFrame:
    """The estimated distinct ids of coarser groups ``by``."""
    return stored.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(out))
