"""Whole-run plans: fixture tables, rule catalogs and the suite runner."""
