"""casebook: business case-study analyses as native PySpark DataFrame plans.

Four analysis families (loyalty, bank, mart, web) are built from small
DataFrame operators; every query is a lazy ``DataFrame`` that Catalyst
optimises as a whole.  Nothing runs through Python UDFs.
"""

from casebook.session import get_spark, checkpoint_dir  # noqa: F401
from casebook.sources import bind, bind_catalog, materialize  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir", "bind", "bind_catalog", "materialize"]
