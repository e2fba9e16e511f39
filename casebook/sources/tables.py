"""Domain tables bound to the driver's Parquet test data (FIXTURES §2).

Every table is a lazy DataFrame derived from the given Parquet files, so
each query's work grows with them.  Columns are pruned right after the
scan so only the needed columns are read.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from casebook.operators.sequence import next_date_in_order
from casebook.operators.sessions import sessionize
from casebook.sources.schemas import SCHEMAS, SOURCES

MONEY_IN = "decimal(18,2)"

# Fixed values of the test binding (FIXTURES §2.2).
EVENT_NAMES = [(1, "Page View"), (2, "Add to Cart"), (3, "Purchase"),
               (4, "Ad Impression"), (5, "Ad Click")]
EVENT_CODES = {"view": 1, "click": 2, "purchase": 3, "signup": 4, "error": 5}
CAMPAIGNS = [("Campaign A", "2024-01-02", "2024-01-09"),
             ("Campaign B", "2024-01-11", "2024-01-18"),
             ("Campaign C", "2024-01-20", "2024-01-28")]
OVERLAPPING_CAMPAIGNS = CAMPAIGNS + [("Campaign D", "2024-01-05", "2024-01-25"),
                                     ("Campaign E", "2024-01-07", "2024-01-07"),
                                     ("Always on", "2024-01-15", "9999-12-31")]
CHANGES = [("packaging", "1998-06-15"), ("prices", "1996-03-04"), ("logo", "1998-09-07"),
           ("loyalty card", "2000-12-18")]
ORDER_STATUS_TXN = {"O": "deposit", "F": "withdrawal", "P": "purchase"}
RETURNFLAG_CUSTOMER = {"A": "New", "N": "Existing"}  # anything else: Guest
PRODUCT_PAGE_MIN = 13   # part keys from 13 on are product pages
SESSION_GAP_HOURS = 12
# Tasks that take the rows of one input split after a shuffle for the weekly table.
TASKS_PER_SPLIT = 16


def _map(col, mapping: dict, default=None):
    expr = None
    for k, v in mapping.items():
        expr = (F.when(col == k, v) if expr is None else expr.when(col == k, v))
    return expr.otherwise(default) if default is not None else expr


class Tables:
    """Lazy domain tables over one test-data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        """A source table, read with its declared schema."""
        return self.spark.read.schema(SOURCES[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def shipped(self, start: dt.date | None, end: dt.date | None) -> Tables:
        """The same tables with the line items shipped from ``start`` and before ``end`` only."""
        return _Shipped(self.spark, self.sf_dir, start, end)

    # ---------------------------------------------------------------- loyalty
    @cached_property
    def sales(self) -> DataFrame:
        o = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        li = self.raw("lineitem").select("l_orderkey", "l_partkey")
        return (li.join(o, li.l_orderkey == o.o_orderkey)
                .select(F.col("o_custkey").alias("customer_id"),
                        F.to_date("o_orderdate").alias("order_date"),
                        F.col("l_partkey").alias("product_id")))

    @cached_property
    def menu(self) -> DataFrame:
        return self.raw("part").select(F.col("p_partkey").alias("product_id"),
                                       F.col("p_name").alias("product_name"),
                                       F.col("p_retailprice").cast(MONEY_IN).alias("price"))

    @cached_property
    def members(self) -> DataFrame:
        c = self.raw("customer").select("c_custkey")
        offset = ((F.col("c_custkey") * 37) % 730).cast("int")
        return (c.where(F.col("c_custkey") % 3 != 0)
                .select(F.col("c_custkey").alias("customer_id"),
                        F.date_add(F.lit(dt.date(1997, 1, 1)), offset).alias("join_date")))

    # ------------------------------------------------------------------- bank
    @cached_property
    def regions(self) -> DataFrame:
        return self.raw("region").select(F.col("r_regionkey").alias("region_id"),
                                         F.col("r_name").alias("region_name"))

    @cached_property
    def customer_nodes(self) -> DataFrame:
        o = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        c = self.raw("customer").select("c_custkey", "c_nationkey")
        n = self.raw("nation").select("n_nationkey", "n_regionkey")
        base = (o.join(c, o.o_custkey == c.c_custkey)
                .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
                .select(F.col("o_custkey").alias("customer_id"),
                        F.col("n_regionkey").alias("region_id"),
                        "o_orderkey", "o_orderdate"))
        stays = next_date_in_order(base, "customer_id", "o_orderdate", "o_orderkey",
                                   "end_date")
        return stays.select("customer_id", "region_id",
                            (F.col("o_orderkey") % 5 + 1).alias("node_id"),
                            F.to_date("o_orderdate").alias("start_date"), "end_date")

    @cached_property
    def customer_transactions(self) -> DataFrame:
        o = self.raw("orders").select("o_custkey", "o_orderdate", "o_orderstatus",
                                      "o_totalprice")
        return o.select(F.col("o_custkey").alias("customer_id"),
                        F.to_date("o_orderdate").alias("txn_date"),
                        _map(F.col("o_orderstatus"), ORDER_STATUS_TXN).alias("txn_type"),
                        F.col("o_totalprice").cast(MONEY_IN).alias("txn_amount"))

    # ------------------------------------------------------------------- mart
    def _dealt(self, li: DataFrame, o: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Line items by order and orders by customer, so that a task's share does not grow with the tables.

        Spark merges shuffle partitions up to a size in compressed bytes.  The
        few columns kept here compress to a few bytes a row, while a sum or a
        sort holds hundreds for it, so a merged partition may be many times too
        large.  With more line items than a few MB for a slot, both tables
        therefore get a number of partitions that follows their input splits,
        which Spark leaves as it is.  Spark aims at a split for every slot, but
        counts the cost of opening each file, so many files may make little more
        than half as many.
        """
        splits = li.rdd.getNumPartitions()
        if 2 * splits <= self.spark.sparkContext.defaultParallelism:
            return li.repartition("l_orderkey"), o
        merged = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return (li.repartition(max(splits * TASKS_PER_SPLIT, merged), "l_orderkey"),
                o.repartition(max(o.rdd.getNumPartitions() * TASKS_PER_SPLIT, merged), "o_custkey"))

    @cached_property
    def weekly_amounts(self) -> DataFrame:
        """Weekly orders and exact sales per (week, region, platform, segment, customer type).

        ``transactions`` counts distinct orders.  Region and segment are
        attributes of the order, so lineitem is first summed per (order, week,
        platform, customer type): after the joins each order occurs once per
        output group and the distinct count is a plain count.  Lineitem is
        dealt by order key once, which serves both that sum and the join to
        orders; the small tables are joined to each other first.
        """
        li = self.raw("lineitem").select("l_orderkey", "l_extendedprice", "l_returnflag",
                                         "l_linestatus", "l_shipdate")
        o = self.raw("orders").select("o_orderkey", "o_custkey")
        c = self.raw("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        n = self.raw("nation").select("n_nationkey", "n_regionkey")
        r = self.raw("region").select("r_regionkey", "r_name")
        li, o = self._dealt(li, o)
        per_order = (li.groupBy("l_orderkey", F.date_trunc("week", "l_shipdate").alias("_week"),
                                "l_linestatus", "l_returnflag")
                     .agg(F.sum(F.col("l_extendedprice").cast(MONEY_IN)).alias("_sales")))
        seg = F.col("c_mktsegment")
        segment = F.when(seg == "AUTOMOBILE", F.lit("null")).otherwise(
            F.concat(F.when(seg.isin("BUILDING", "FURNITURE"), "C").otherwise("F"),
                     (F.col("o_custkey") % 4 + 1).cast("string")))
        places = n.join(r, F.col("n_regionkey") == F.col("r_regionkey"))
        buyers = c.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        placed = o.join(buyers, F.col("o_custkey") == F.col("c_custkey"))
        rows = (per_order.join(placed, per_order.l_orderkey == placed.o_orderkey)
                .select(F.date_format("_week", "d/M/yy").alias("week_date"),
                        F.upper("r_name").alias("region"),
                        F.when(F.col("l_linestatus") == "O", "Retail")
                        .otherwise("Shopify").alias("platform"),
                        segment.alias("segment"),
                        _map(F.col("l_returnflag"), RETURNFLAG_CUSTOMER, "Guest")
                        .alias("customer_type"),
                        "_sales"))
        return (rows.groupBy("week_date", "region", "platform", "segment", "customer_type")
                .agg(F.count(F.lit(1)).cast("int").alias("transactions"),
                     F.sum("_sales").alias("amount")))

    @cached_property
    def data_mart(self) -> DataFrame:
        """Weekly sales in whole units, as the mart's source has them."""
        return (self.weekly_amounts.withColumn("sales", F.floor("amount").cast("bigint"))
                .drop("amount"))

    # -------------------------------------------------------------------- web
    def _events(self) -> DataFrame:
        e = self.raw("events").select("event_id", "ts", "user_id", "event_type", "props")
        cookie = F.concat(F.col("user_id").cast("string"), F.lit("-"),
                          F.floor((F.dayofmonth("ts") - 1) / 10).cast("string"))
        return e.withColumn("cookie_id", cookie)

    @cached_property
    def users(self) -> DataFrame:
        return self._events().select("user_id", "cookie_id").distinct()

    @cached_property
    def web_events(self) -> DataFrame:
        e = sessionize(self._events(), "user_id", "ts", "_visit_no", SESSION_GAP_HOURS)
        return e.select(
            F.concat(F.col("user_id").cast("string"), F.lit("-"),
                     F.col("_visit_no").cast("string")).alias("visit_id"),
            "cookie_id",
            F.get_json_object("props", "$.k").cast("int").alias("page_id"),
            _map(F.col("event_type"), EVENT_CODES).cast("int").alias("event_type"),
            F.col("event_id").alias("sequence_number"),
            F.col("ts").alias("event_time"))

    @cached_property
    def page_hierarchy(self) -> DataFrame:
        p = self.raw("part").select("p_partkey", "p_name", "p_type")
        is_product = F.col("p_partkey") >= PRODUCT_PAGE_MIN
        return p.select(F.col("p_partkey").cast("int").alias("page_id"),
                        F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string"))
                        .alias("page_name"),
                        F.when(is_product, F.col("p_type")).alias("product_category"),
                        F.when(is_product, F.col("p_partkey").cast("int")).alias("product_id"))

    @cached_property
    def event_identifier(self) -> DataFrame:
        return self.spark.createDataFrame(EVENT_NAMES, SCHEMAS["event_identifier"])

    def _campaigns(self, campaigns: list[tuple[str, str, str]]) -> DataFrame:
        rows = [(n, dt.datetime.fromisoformat(s), dt.datetime.fromisoformat(e)) for n, s, e in campaigns]
        return self.spark.createDataFrame(rows, SCHEMAS["campaign_identifier"])

    @cached_property
    def campaign_identifier(self) -> DataFrame:
        return self._campaigns(CAMPAIGNS)

    @cached_property
    def change_dates(self) -> DataFrame:
        """Several changes whose effect on weekly sales is compared at once."""
        rows = [(n, dt.date.fromisoformat(d)) for n, d in CHANGES]
        return self.spark.createDataFrame(rows, SCHEMAS["change_dates"])

    @cached_property
    def overlapping_campaigns(self) -> DataFrame:
        """Campaigns that overlap, last one day or have an open end."""
        return self._campaigns(OVERLAPPING_CAMPAIGNS)


class _Shipped(Tables):
    """Tables with the line items of a span of days only."""

    def __init__(self, spark: SparkSession, sf_dir: str, start: dt.date | None, end: dt.date | None):
        super().__init__(spark, sf_dir)
        self.start, self.end = start, end

    def raw(self, name: str) -> DataFrame:
        df = super().raw(name)
        if name == "lineitem":
            at = lambda day: F.lit(day).cast("timestamp_ntz")
            if self.start:
                df = df.where(F.col("l_shipdate") >= at(self.start))
            if self.end:
                df = df.where(F.col("l_shipdate") < at(self.end))
        return df


def bind(spark: SparkSession, sf_dir: str) -> Tables:
    """Domain tables over ``sf_dir`` (one Parquet file per source table)."""
    return Tables(spark, sf_dir)


class CatalogTables:
    """Domain tables read from a catalog database (``spark.table(db.name)``).

    For deployments where the domain tables exist under their own names:
    sales, menu, members, customer_nodes, regions, customer_transactions,
    data_mart, users, web_events, event_identifier, page_hierarchy,
    campaign_identifier.  Each is projected to the columns the analyses use
    (``SCHEMAS``), so scans read only those columns.
    """

    def __init__(self, spark: SparkSession, database: str):
        self.spark = spark
        self.database = database

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(name)
        cols = [f.name for f in SCHEMAS[name].fields]
        return self.spark.table(f"{self.database}.{name}").select(*cols)


def bind_catalog(spark: SparkSession, database: str) -> CatalogTables:
    """Domain tables stored in catalog database ``database``."""
    return CatalogTables(spark, database)


class LiteralTables:
    """Domain tables given directly as DataFrames (tests, other bindings)."""

    def __init__(self, **tables: DataFrame):
        for k, v in tables.items():
            setattr(self, k, v)
