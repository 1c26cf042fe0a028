"""Sources and sinks: parquet tables, labelled views, CSV ingest, report writers."""

from .tables import TABLES, VIEWS, table, view  # noqa: F401
