"""verisift — data-quality checks as lazy Spark DataFrame jobs.

Typical use::

    from verisift import Catalog, Relationship, RequiredFields, load_tables, run

    tables = load_tables(spark, "/data/warehouse", ["PATIENT", "ENCOUNTER"])
    out = run(tables, Catalog(relationships=[Relationship("ENCOUNTER", "patient_id", "PATIENT")]))
    out["suites"].show()
"""

__version__ = "0.1.0"

from .contract import check_contract, to_contract
from .plans.suites import run, run_suites, suite_sub_results
from .rules import (
    Catalog,
    CompletenessRule,
    ConceptColumn,
    FieldComparison,
    GroupCount,
    RangeCheck,
    ReferenceCheck,
    Relationship,
    RelationshipExists,
    RequiredFields,
    Terminology,
    Uniqueness,
)
from .sources import load_catalog_tables, load_tables, write_results

__all__ = [
    "Catalog",
    "CompletenessRule",
    "ConceptColumn",
    "FieldComparison",
    "GroupCount",
    "RangeCheck",
    "ReferenceCheck",
    "Relationship",
    "RelationshipExists",
    "RequiredFields",
    "Terminology",
    "Uniqueness",
    "check_contract",
    "load_catalog_tables",
    "load_tables",
    "run",
    "run_suites",
    "suite_sub_results",
    "to_contract",
    "write_results",
]
