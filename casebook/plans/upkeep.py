"""Incremental upkeep of stored results: deltas are merged, not recomputed.

A stored result is kept as additive partials.  A delta of new facts is
aggregated to the same grain by itself, merged with the stored partials of the
partitions that it touches, and those partitions alone are written again
(dynamic partition overwrite).  The other partitions' files are neither read nor
replaced, so the cost follows the delta.

The merged rows are staged in the shared checkpoint folder before a partition is
replaced, since a job can't overwrite the files it reads.  A delta must hold
what it counts as a whole: all that an order has in a week (weekly sales; a delta
of whole weeks does), or all of a visit (products).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from casebook.functions import parse_dmy2
from casebook.plans import mart, web
from casebook.sources import LiteralTables, materialize, new_folder

WEEK_KEYS = ("week_date", "region", "platform", "segment", "customer_type")
WEEK_SUMS = ("transactions", "amount")
PRODUCT_KEYS = ("product_id", "product_name", "product_category")
PRODUCT_SUMS = ("views", "cart_add", "abandoned", "purchases")
#: Folders of the product partials; a delta rewrites those of its products.
PRODUCT_PARTS = 64


def store(partials: DataFrame, path: str, partition: str) -> None:
    """Write partials as a new stored result at ``path``."""
    partials.write.mode("overwrite").partitionBy(partition).parquet(path)


def merge(delta: DataFrame, path: str, partition: str, keys: Sequence[str], sums: Sequence[str]) -> None:
    """Add the partials of ``delta`` to those stored at ``path``.

    Stored rows are read for the delta's partitions only: a semi-join on the
    partition column, which Spark turns into dynamic partition pruning.
    """
    delta = materialize(delta, "delta")
    touched = delta.select(partition).distinct()
    stored = delta.sparkSession.read.parquet(path)
    old = stored.join(F.broadcast(touched), partition, "left_semi")  # at most a row per folder
    if not touched.where(F.col(partition).isNull()).isEmpty():
        old = old.unionByName(stored.where(F.col(partition).isNull()))
    grouped = (old.unionByName(delta).groupBy(partition, *keys)
               .agg(*[F.sum(c).cast(stored.schema[c].dataType).alias(c) for c in sums]))
    (materialize(grouped, "merged").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition).parquet(path))


# ----------------------------------------------------------------- weekly sales


def weekly_partials(t) -> DataFrame:
    """Weekly sums of a set of line items, with the year that they are stored by."""
    year = F.year(parse_dmy2("week_date"))
    return t.weekly_amounts.select(*WEEK_KEYS, F.col("transactions").cast("bigint"),
                                   F.col("amount").cast("decimal(38,2)"), year.alias("calendar_year"))


def store_weekly(t, path: str) -> None:
    store(weekly_partials(t), path, "calendar_year")


def add_weekly(t, path: str) -> None:
    """Add the line items of ``t``, new ones, to the stored weekly sums."""
    merge(weekly_partials(t), path, "calendar_year", WEEK_KEYS, WEEK_SUMS)


def clean_weekly(spark: SparkSession, path: str) -> DataFrame:
    """``clean_weekly_sales`` from the stored weekly sums."""
    sums = spark.read.parquet(path)
    return mart.clean(LiteralTables(data_mart=sums.select(
        *WEEK_KEYS, F.col("transactions").cast("int").alias("transactions"),
        F.floor("amount").cast("bigint").alias("sales"))))


def weekly_in_deltas(t, mondays: Sequence[dt.date] = (), path: str | None = None) -> DataFrame:
    """``clean_weekly_sales`` from the weeks before ``mondays[0]`` and a delta for each span after it.

    What was shipped from one Monday up to the next comes as one delta, what was
    shipped from the last one on as another.  The result is that of one build.
    """
    path = path or new_folder(t.spark, "weekly")
    bounds = [None, *mondays, None]
    for i, (start, end) in enumerate(zip(bounds, bounds[1:])):
        (add_weekly if i else store_weekly)(t.shipped(start, end), path)
    return clean_weekly(t.spark, path)


# ---------------------------------------------------------------------- products


def product_partials(t) -> DataFrame:
    """The product funnel of a set of visits, with the folder it is stored in."""
    return web.product_funnel(t).withColumn("part", F.pmod("product_id", F.lit(PRODUCT_PARTS)).cast("int"))


def store_products(t, path: str) -> None:
    store(product_partials(t), path, "part")


def add_products(t, path: str) -> None:
    """Add the visits of ``t``, whole and new ones, to the stored funnel."""
    merge(product_partials(t), path, "part", PRODUCT_KEYS, PRODUCT_SUMS)


def product_info(spark: SparkSession, path: str) -> DataFrame:
    """``product_info`` from the stored funnel."""
    return spark.read.parquet(path).select(*PRODUCT_KEYS, *PRODUCT_SUMS)
