"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``VNODES`` places on a ring of ``CELLS`` cells; a document
falls into a cell by the hash of its id and belongs to the next place
clockwise.  A shard takes documents until it is full; what is left over of a
cell continues clockwise to the next place whose shard has room.  The shards'
own documents come first, so no more of them move on than must, and a shard
that is added or dropped mostly takes or leaves documents of its own places.

Capacities add up to the number of documents when ``slack`` is 0, so that
counts differ by one at most; with slack they are that much larger and fewer
documents overflow.

Who goes where is decided on document counts per cell, at most ``CELLS``
numbers, which is all the driver sees.  Documents then need only their rank in
their cell.  It is counted in ``BUCKETS`` buckets of a cell, so that no task sees
a cell that holds very many documents, such as all those without an id; rows that
repeat are counted before that and dealt out again afterwards.

Defined cases: NULL text has no bytes and the checksum of an empty text; NULL
ids share one cell and are told apart by size and checksum; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import DataFrame, Window, functions as F

from casebook.llm.common import saved

SHARDS = 8
VNODES = 128
CELLS = 1 << 14
#: Buckets in which the documents of one cell are ranked.
BUCKETS = 512


def ring(shards: int, vnodes: int = VNODES, cells: int = CELLS) -> list[tuple[int, int]]:
    """(cell, shard) of all places, clockwise."""
    places = []
    for s in range(shards):
        for v in range(vnodes):
            h = hashlib.md5(f"{s}:{v}".encode()).hexdigest()
            places.append((int(h[:8], 16) * cells >> 32, h, s))
    return [(cell, s) for cell, _, s in sorted(places)]


def capacities(total: int, shards: int, slack: float = 0.0) -> list[int]:
    """Documents that each shard takes."""
    if slack:
        return [math.ceil(total * (1 + slack) / shards)] * shards
    return [total // shards + (s < total % shards) for s in range(shards)]


def place(loads: dict[int, int], places: list[tuple[int, int]],
          room: list[int]) -> list[tuple[int, int, int, int]]:
    """(cell, first, end, shard): how the documents of each cell, by rank, are dealt.

    Round by round, cells offer what they have left, in ring order, to the
    place they have reached; after a round all of it moves on to the next place
    whose shard is not full.  Every round but the last fills a shard.
    """
    room = list(room)
    pending, at = [], 0
    for cell in sorted(loads):
        while at < len(places) and places[at][0] < cell:
            at += 1
        pending.append((cell, 0, loads[cell], at % len(places)))
    out = []
    while pending:
        left = []
        for cell, lo, hi, at in pending:
            shard = places[at][1]
            take = min(hi - lo, room[shard])
            if take:
                out.append((cell, lo, lo + take, shard))
                room[shard] -= take
            if lo + take < hi:
                left.append((cell, lo + take, hi, at))
        pending = []
        for cell, lo, hi, at in left:
            while not room[places[at][1]]:
                at = (at + 1) % len(places)
            pending.append((cell, lo, hi, at))
    return out


def shard(docs: DataFrame, shards: int = SHARDS, slack: float = 0.0, vnodes: int = VNODES,
          cells: int = CELLS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every document.

    ``size`` is the text's UTF-8 bytes plus 1; ``slot`` counts the documents of
    a shard from 0 without gaps.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    point = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    place_of = F.conv(F.substring(point, 1, 15), 16, 10).cast("bigint")
    slim = saved(docs.select(
        F.col("doc_id"), (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), place_of.alias("point"))
        .withColumn("cell", F.call_function("div", "point", F.lit((1 << 60) // cells))), "slim")
    loads = {r["cell"]: r["n"] for r in slim.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n")).collect()}  # a row per cell at most
    deal, filled = [], [0] * shards
    for cell, lo, hi, s in sorted(place(loads, ring(shards, vnodes, cells),
                                        capacities(sum(loads.values()), shards, slack))):
        deal.append((cell, lo, hi, s, filled[s]))
        filled[s] += hi - lo
    deal = spark.createDataFrame(
        deal, "_cell bigint, _lo bigint, _hi bigint, shard int, _base bigint")
    row = ["point", "doc_id", "size", "text_crc32"]
    bucket = F.pmod(F.xxhash64(*row), F.lit(BUCKETS))
    counted = slim.withColumn("bucket", bucket)
    sizes = counted.groupBy("cell", "bucket").agg(F.count(F.lit(1)).alias("n"))
    of_cell = Window.partitionBy("cell").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("cell", "bucket", F.coalesce(F.sum("n").over(of_cell), F.lit(0)).alias("before"))
    of_bucket = (Window.partitionBy("cell", "bucket").orderBy(*row)
                 .rowsBetween(Window.unboundedPreceding, -1))
    ranked = (counted.groupBy("cell", "bucket", *row).agg(F.count(F.lit(1)).alias("n"))
              .withColumn("start", F.coalesce(F.sum("n").over(of_bucket), F.lit(0)))
              .join(sizes, ["cell", "bucket"]).withColumn("start", F.col("start") + F.col("before")))
    end = F.col("start") + F.col("n")
    # The deal has a row per cell, and one more per place that a shard fills up at.
    met = ranked.join(F.broadcast(deal), (F.col("cell") == F.col("_cell"))
                      & (F.col("_lo") < end) & (F.col("_hi") > F.col("start")))
    ranks = F.sequence(F.greatest("start", "_lo"), F.least(end, F.col("_hi")) - 1)
    return met.withColumn("_rank", F.explode(ranks)).select(
        "doc_id", "size", "text_crc32", "shard",
        (F.col("_base") + F.col("_rank") - F.col("_lo")).alias("slot"))
