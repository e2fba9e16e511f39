"""The command-line runner."""

import os
import tempfile

import pytest

from casebook.__main__ import main

SF = "/root/testdata/sf0.001"


def test_list(capsys):
    assert main(["list"]) == 0
    keys = capsys.readouterr().out.split()
    assert len(keys) == 83 and "web_product_funnel" in keys


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_run_writes_each_key(spark):
    out = tempfile.mkdtemp(prefix="casebook-cli-")
    assert main(["run", SF, out, "bank_node_count", "web_top_pages"]) == 0
    assert spark.read.parquet(f"{out}/bank_node_count").count() == 1
    assert spark.read.parquet(f"{out}/web_top_pages").count() == 3
    with pytest.raises(SystemExit):
        main(["run", SF, out, "no_such_key"])
