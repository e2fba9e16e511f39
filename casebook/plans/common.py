"""Output types shared by the analyses."""

from pyspark.sql import DataFrame, functions as F

MONEY = "decimal(38,2)"      # sums of money: wide enough not to overflow at scale


def row_counts(**tables: DataFrame) -> DataFrame:
    """One row per table: ``table_name``, ``row_count`` (a full scan each)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
