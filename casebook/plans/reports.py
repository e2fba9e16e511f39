"""Report jobs: store a family's shared tables once, then write all its keys.

This is how the families run at scale, over any domain tables (the test
binding or a catalog database).  The weekly mart is cleaned once into
``clean_weekly_sales``, laid out by ``calendar_year`` so that comparisons of a
year read only its files; the clickstream is cut into visits once, and its
product funnel stored once for the keys that read it.  Stored tables live in a
folder of their own per run under the shared checkpoint folder, which also cuts
the lineage: a lost executor recomputes from the stored table, not from the raw
sources.  Each result is written to ``out_dir/<key>``.
"""

from __future__ import annotations

import inspect
import uuid

from pyspark.sql import DataFrame

from casebook.plans import mart, web
from casebook.plans.registry import QUERIES
from casebook.sources import bucket_table, materialize

FAMILIES = ("loyalty", "bank", "mart", "web")


class Stored:
    """Domain tables with some of them replaced by stored ones."""

    def __init__(self, tables, **stored: DataFrame):
        self._tables = tables
        for name, df in stored.items():
            setattr(self, name, df)

    def __getattr__(self, name: str) -> DataFrame:
        return getattr(self._tables, name)


def keys_of(family: str) -> list[str]:
    """The registered keys of a family, in registry order."""
    return [k for k in QUERIES if k.startswith((f"{family}_", f"scan_{family}_"))]


def stored(tables, family: str, buckets: int | None = None) -> Stored:
    """``tables`` with the family's shared tables written and read back.

    ``buckets`` stores the clickstream in that many buckets of ``visit_id``, a
    catalog table: visits are then aggregated, flagged and counted without an
    exchange by visit.
    """
    if family == "mart":
        return Stored(tables, clean_weekly_sales=materialize(
            mart.clean(tables), "clean_weekly_sales", partition_by=["calendar_year"]))
    if family == "web":
        events = Stored(tables, web_events=(
            bucket_table(tables.web_events, f"web_events_{uuid.uuid4().hex}", ["visit_id"], buckets)
            if buckets else materialize(tables.web_events, "web_events")))
        return Stored(events, product_info=materialize(web.product_funnel(events), "product_info"),
                      visit_bitmaps=materialize(web.visit_bitmaps(events), "visit_bitmaps"),
                      visit_sketches=materialize(web.visit_sketches(events), "visit_sketches"))
    return Stored(tables)


def reports(tables: Stored, family: str, bound: bool = False, **params) -> dict[str, DataFrame]:
    """Every key of the family over ``tables``.

    ``bound`` takes the parameter values that fit the test binding; otherwise
    they are the reference's.  ``params`` (say ``change_year=2021``) override
    both, in every analysis that has a parameter of that name; ``change_year``
    stands for the ``year`` of the keys that have one set.
    """
    out = {}
    for key in keys_of(family):
        q = QUERIES[key]
        values = dict(q.params if bound else q.portable_params)
        known = inspect.signature(q.analysis).parameters
        values |= {k: v for k, v in params.items() if k in known and k != "year"}
        if "change_year" in params and "year" in q.params and key != "mart_missing_weeks_year":
            values["year"] = params["change_year"]
        out[key] = q.analysis(tables, **values)
    if "mart_clean" in out:
        out["mart_clean"] = tables.clean_weekly_sales
    if "web_product_funnel" in out:
        out["web_product_funnel"] = tables.product_info
    return out


def run(tables, family: str, out_dir: str, bound: bool = False, **params) -> list[str]:
    """Store the shared tables, then write every key of the family."""
    results = reports(stored(tables, family), family, bound, **params)
    for key, df in results.items():
        df.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/{key}")
    return list(results)
