"""Sources (domain tables bound to Parquet) and sinks (materialised tables)."""

from casebook.sources.schemas import SCHEMAS  # noqa: F401
from casebook.sources.tables import CatalogTables, LiteralTables, Tables, bind, bind_catalog  # noqa: F401
from casebook.sources.sinks import (  # noqa: F401
    bucket_table, drop_table, materialize, new_folder, save_table,
)
