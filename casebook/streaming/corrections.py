"""Real-time allocation that corrects itself when transactions come late.

A transaction of an earlier day changes the balance of that day and of every
day after it.  Here the state of a customer keeps the net of each day, so a
late transaction is put where it belongs, and the days from it on are sent
again with their corrected balances and a higher version.  The last version of
every (customer, day) is the batch result, in whatever order rows arrived.

Days that the watermark has passed can't change any more.  A timer folds them
into one opening balance, so a customer's state holds the days within the
allowed lateness only; later rows than that are dropped by the watermark.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from casebook.functions import signed_amount

OUT_SCHEMA = "customer_id long, txn_date date, n_rows long, running_cents long, version long"
EPOCH = dt.date(1970, 1, 1)
DAY_MS = 86_400_000


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


class DayBalances(StatefulProcessor):
    """Per customer: the net of each open day, the opening balance, the version."""

    def __init__(self, lateness_days: int):
        self.lateness_days = lateness_days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.days = handle.getMapState("days", _schema(day=T.IntegerType()),
                                       _schema(n_rows=T.LongType(), cents=T.LongType()))
        self.opening = handle.getValueState("opening", _schema(cents=T.LongType(), version=T.LongType()))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        """Add the rows to their days; send those days and all after them."""
        parts = [b.groupby("day")["cents"].agg(n_rows="size", cents="sum") for b in rows]
        fresh = pd.concat(parts).groupby(level=0).sum()
        opening, version = self.opening.get() if self.opening.exists() else (0, 0)
        self.opening.update((opening, version + 1))
        for day, n, cents in zip(fresh.index.tolist(), fresh["n_rows"].tolist(), fresh["cents"].tolist()):
            old = self.days.getValue((day,)) if self.days.containsKey((day,)) else (0, 0)
            self.days.updateValue((day,), (old[0] + n, old[1] + cents))
            self.handle.registerTimer((day + 1 + self.lateness_days) * DAY_MS)
        out, first = [], int(fresh.index.min())
        for (day,), (n, cents) in sorted(self.days.iterator()):
            opening += cents
            if day >= first:
                out.append((key[0], EPOCH + dt.timedelta(day), n, opening, version + 1))
        yield pd.DataFrame(out, columns=["customer_id", "txn_date", "n_rows", "running_cents", "version"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Fold the days that can't change any more into the opening balance."""
        closed = expiredTimerInfo.getExpiryTimeInMs() // DAY_MS - 1 - self.lateness_days
        opening, version = self.opening.get()
        for (day,), (_, cents) in sorted(self.days.iterator()):
            if day <= closed:
                opening += cents
                self.days.removeKey((day,))
        self.opening.update((opening, version))
        return iter(())

    def close(self) -> None:
        pass


def corrected_balance_stream(transactions: DataFrame, lateness_days: int = 30) -> DataFrame:
    """(customer, day, n_rows, running balance, version), sent again where a late row changes it.

    ``transactions`` is a stream of customer_id, txn_date, txn_type, txn_amount.
    Rows that are more than ``lateness_days`` behind the newest day are dropped.
    The session needs the RocksDB state store (``STATE_STORE``).
    """
    cents = (signed_amount("txn_type", "txn_amount") * 100).cast("long")
    x = (transactions.withColumn("at", F.col("txn_date").cast("timestamp"))
         .withWatermark("at", f"{lateness_days} days")
         .select(F.col("customer_id").cast("long").alias("customer_id"),
                 F.unix_date("txn_date").alias("day"), cents.alias("cents"), "at"))
    return x.groupBy("customer_id").transformWithStateInPandas(
        DayBalances(lateness_days), OUT_SCHEMA, "Update", "EventTime")


#: The state store that the corrections need, as (setting, value).
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass",
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def latest(rows: DataFrame) -> DataFrame:
    """The last version of every (customer, day)."""
    row = F.struct("n_rows", "running_cents")
    return (rows.groupBy("customer_id", "txn_date").agg(F.max_by(row, "version").alias("r"))
            .select("customer_id", "txn_date", "r.n_rows", "r.running_cents"))
