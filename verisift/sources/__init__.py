"""Sources (S1) and sinks."""

from .sink import export_rows, write_results
from .tables import discover_tables, load_catalog_tables, load_tables, register_views

__all__ = ["discover_tables", "export_rows", "load_catalog_tables", "load_tables", "register_views", "write_results"]
