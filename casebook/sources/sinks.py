"""Materialised result tables (``SELECT ... INTO`` / ``DROP TABLE``).

A materialised table is written as Parquet to an explicit path, or to a new
folder under the shared one named by ``spark.checkpoint.dir``, so that jobs
never overwrite each other's tables, and read back, which also cuts the lineage
of long jobs.  ``mode="overwrite"`` replaces an existing
table, the Spark form of drop-and-create.  ``save_table`` / ``drop_table``
do the same through the session catalog.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from casebook.session import checkpoint_dir


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder that no other job uses, under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}/{name}"


def materialize(df: DataFrame, name: str, path: str | None = None,
                partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as table ``name`` (overwrite) and return it read back.

    ``partition_by`` lays the files out by those columns, so later filters
    on them prune whole folders.
    """
    spark = df.sparkSession
    target = path or new_folder(spark, name)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(target)
    return spark.read.parquet(target)


def save_table(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """``SELECT ... INTO name``: create or replace a catalog table."""
    w = df.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)
    return df.sparkSession.table(name)


def bucket_table(df: DataFrame, name: str, by: list[str], buckets: int) -> DataFrame:
    """Store ``df`` as catalog table ``name`` in ``buckets`` buckets of ``by``, and read it back.

    Aggregates and joins by those columns, or by them and more, then need no
    exchange: rows that belong together are in one bucket already.  The files lie
    in the warehouse folder, which a cluster's executors share.
    """
    (df.repartition(buckets, *by).write.mode("overwrite").format("parquet")
     .bucketBy(buckets, *by).sortBy(*by).saveAsTable(name))
    return df.sparkSession.table(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """``DROP TABLE IF EXISTS name``."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
