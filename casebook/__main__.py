"""Run analyses as a Spark job.

    python -m casebook list
    python -m casebook run  <src_dir> <out_dir> [key ...]     # lazy, one job per key
    python -m casebook run  catalog:<db> <out_dir> [key ...]  # domain tables in a catalog
    python -m casebook report <family> <src> <out_dir> [name=value ...]

``report`` stores the shared tables of a family (loyalty, bank, mart, web) once
and writes all its keys; ``name=value`` sets a parameter, such as
``change_date=2021-06-15`` or ``change_year=2021``.

``src_dir`` holds ``<table>.parquet`` (a file or a folder) per source table (the test
binding, with its parameter values); ``catalog:<db>`` reads the domain tables
from catalog database ``db`` and keeps the reference's parameter values.  Results are
written as Parquet to ``out_dir/<key>``.  Under ``spark-submit`` the
cluster's own settings apply; casebook only fills unset ones.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from casebook.plans import reports
from casebook.plans.registry import QUERIES, on_tables
from casebook.session import get_spark
from casebook.sources import bind, bind_catalog


def _param(text: str) -> tuple[str, object]:
    """name=value, with a date, a whole number or plain text as value."""
    name, _, value = text.partition("=")
    for kind in (dt.date.fromisoformat, int):
        try:
            return name, kind(value)
        except ValueError:
            pass
    return name, value


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="casebook")
    sub = p.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    r = sub.add_parser("run")
    r.add_argument("src")
    r.add_argument("out")
    r.add_argument("keys", nargs="*")
    rep = sub.add_parser("report")
    rep.add_argument("family", choices=reports.FAMILIES)
    rep.add_argument("src")
    rep.add_argument("out")
    rep.add_argument("params", nargs="*", type=_param)
    a = p.parse_args(argv)
    if a.cmd == "list":
        print("\n".join(QUERIES))
        return 0
    spark = get_spark(app="casebook")
    catalog = a.src[len("catalog:"):] if a.src.startswith("catalog:") else None
    if a.cmd == "run":
        unknown = [k for k in a.keys if k not in QUERIES]
        if unknown:
            p.error(f"unknown keys: {unknown}")
        for k in a.keys or list(QUERIES):
            df = (on_tables(k, bind_catalog(spark, catalog)) if catalog
                  else QUERIES[k](spark, a.src))
            df.write.mode("overwrite").parquet(f"{a.out.rstrip('/')}/{k}")
            print(k)
    else:
        tables = bind_catalog(spark, catalog) if catalog else bind(spark, a.src)
        for k in reports.run(tables, a.family, a.out, bound=not catalog, **dict(a.params)):
            print(k)
    return 0


if __name__ == "__main__":
    sys.exit(main())
