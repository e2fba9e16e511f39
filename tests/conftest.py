import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from casebook.session import checkpoint_dir, get_spark
    scratch = tempfile.mkdtemp(prefix="casebook-test-")
    s = get_spark("local[4]", app="casebook-tests", shuffle_partitions=4,
                  extra={"spark.local.dir": scratch,
                         "spark.sql.warehouse.dir": f"{scratch}/warehouse",
                         "spark.driver.memory": "4g"})
    checkpoint_dir(s)
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples (NULLs sort first) for order-free comparison."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(out, key=lambda r: tuple((v is not None, v) for v in r))
