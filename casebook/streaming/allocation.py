"""Real-time storage allocation over a stream of transactions.

The batch key ``bank_alloc_running`` sums, over every transaction row, an
allocation derived from the customer's running balance (RANGE frame: rows of
one day share the balance after that day).  Here the same quantity is kept
up to date as transactions arrive: a keyed state per customer holds the
balance so far, each micro-batch advances it day by day, and one output row
per (customer, day) carries the row count and the running balance.  Summed
per month the rows equal the batch result whenever all rows of a day arrive
in one micro-batch (transactions of an earlier day arriving later are applied
at arrival).

Only an integer running sum (amounts in cents) runs in pandas; the signed
amounts, the allocation rule and the decimal arithmetic stay Spark
expressions.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from casebook.functions import month_name, signed_amount
from casebook.plans.common import MONEY

OUT_SCHEMA = "customer_id long, txn_date date, n_rows long, running_cents long"
STATE_SCHEMA = "balance_cents long"
GB_BASE, GB_PER_UNIT = Decimal("0.5"), Decimal("0.02")


def _advance(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """Advance one customer's balance over the days of this micro-batch.

    The customer's rows arrive as Arrow batches; each is folded into per-day
    sums at once, so memory holds one row per day, not one per transaction.
    """
    balance = state.get[0] if state.exists else 0
    parts = [b.groupby("txn_date")["cents"].agg(n_rows="size", net="sum") for b in batches]
    days = pd.concat(parts).groupby(level=0).sum().sort_index().reset_index()
    days["running_cents"] = balance + days["net"].cumsum()
    state.update((int(days["running_cents"].iloc[-1]),))
    days["customer_id"] = key[0]
    yield days[["customer_id", "txn_date", "n_rows", "running_cents"]]


def running_balance_stream(transactions: DataFrame) -> DataFrame:
    """(customer, day, n_rows, running balance) kept current across micro-batches.

    ``transactions`` has customer_id, txn_date, txn_type, txn_amount and may
    be a streaming or a batch DataFrame.
    """
    cents = (signed_amount("txn_type", "txn_amount") * 100).cast("long")
    x = transactions.select(F.col("customer_id").cast("long").alias("customer_id"),
                            "txn_date", cents.alias("cents"))
    return (x.groupBy("customer_id")
            .applyInPandasWithState(_advance, OUT_SCHEMA, STATE_SCHEMA, "append",
                                    GroupStateTimeout.NoTimeout))


def allocation_rows(running: DataFrame) -> DataFrame:
    """Allocation per (customer, day): rows x (0.5 if balance < 0 else bal/100*2 + 0.5)."""
    bal = (F.col("running_cents").cast("decimal(38,0)") / 100).cast(MONEY)
    gb = F.when(bal < 0, F.lit(GB_BASE)).otherwise(bal * F.lit(GB_PER_UNIT) + F.lit(GB_BASE))
    return running.select("customer_id", "txn_date",
                          F.month("txn_date").cast("int").alias("month_no"),
                          month_name("txn_date").alias("month_name"),
                          bal.alias("running_bal"),
                          (F.col("n_rows") * gb).alias("data_allocated_gb"))


def monthly_allocation(rows: DataFrame) -> DataFrame:
    """Total allocation per month, as the batch report shows it."""
    return (rows.groupBy("month_no", "month_name")
            .agg(F.sum("data_allocated_gb").cast(MONEY).alias("total_data_allocated_gb")))
