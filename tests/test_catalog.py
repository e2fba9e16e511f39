"""Analyses over domain tables stored in a catalog database."""

from casebook.plans import bank, loyalty, web
from casebook.sources import bind_catalog, save_table
from tests import fixtures
from tests.conftest import rows


def test_analyses_read_catalog_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS casebook_test")
    lit = {**vars(fixtures.loyalty(spark)), **vars(fixtures.bank(spark)),
           **vars(fixtures.web(spark))}
    for name, df in lit.items():
        save_table(df, f"casebook_test.{name}")
    t = bind_catalog(spark, "casebook_test")
    assert rows(loyalty.total_spend(t)) == rows(loyalty.total_spend(fixtures.loyalty(spark)))
    assert rows(bank.alloc_running(t)) == rows(bank.alloc_running(fixtures.bank(spark)))
    assert rows(web.product_funnel(t)) == rows(web.product_funnel(fixtures.web(spark)))


def test_cli_runs_over_catalog(spark):
    import tempfile

    from casebook.__main__ import main
    spark.sql("CREATE DATABASE IF NOT EXISTS casebook_cli")
    for name, df in vars(fixtures.loyalty(spark)).items():
        save_table(df, f"casebook_cli.{name}")
    out = tempfile.mkdtemp(prefix="casebook-cat-")
    assert main(["run", "catalog:casebook_cli", out, "loyalty_points"]) == 0
    got = dict(rows(spark.read.parquet(f"{out}/loyalty_points")))
    assert got["A"] == 940          # reference bonus product 'sushi', not the test binding's
