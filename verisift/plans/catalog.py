"""The rule catalog run against the driver tables (and their derived views).

Each suite mirrors the shape of the reference's shipped configuration: a
person-like table with row rules, foreign keys between entity tables, and code
columns that map through a concept map to concepts.
"""

from __future__ import annotations

from ..rules import (
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
    UnusableRule,
)
from .fixtures import DRIVER_TABLES

TERMINOLOGY = Terminology(
    map_table="cmap",
    map_source="source_code_id",
    map_target="target_code_id",
    concept_table="con",
    concept_id="id",
    concept_display="display",
    concept_code="code",
)

NULL_TABLES = tuple(DRIVER_TABLES) + ("pat",)
EMPTY_TABLES = tuple(DRIVER_TABLES) + ("region_empty", "orders_BACKUP")

COMPLETENESS = (
    CompletenessRule("pat", "practice_id", 95.0),
    CompletenessRule("pat", "birth_year", 98.0),
    CompletenessRule("pat", "death_year", 98.0),
    CompletenessRule("orders", "o_custkey", 100.0),
    CompletenessRule("lineitem", "l_orderkey", 100.0),
    CompletenessRule("region_empty", "r_name", 100.0),
)

RELATIONSHIPS = (
    Relationship("orders", "o_custkey", "customer", "c_custkey", group="orders"),
    Relationship("lineitem", "l_orderkey", "orders", "o_orderkey", group="lineitem"),
    Relationship("lineitem", "l_partkey", "part", "p_partkey", group="lineitem"),
    Relationship("lineitem", "l_suppkey", "supplier", "s_suppkey", group="lineitem"),
    Relationship("customer", "c_nationkey", "nation", "n_nationkey", group="geography"),
    Relationship("supplier", "s_nationkey", "nation", "n_nationkey", group="geography"),
    Relationship("nation", "n_regionkey", "region", "r_regionkey", group="geography"),
    Relationship("events", "user_id", "customer", "c_custkey", group="events"),
    Relationship("orders", "o_orderkey", "lineitem", "l_orderkey", group="reversed"),
    Relationship("events", "user_id", "supplier", "s_suppkey", group="cross"),
    Relationship("documents", "doc_id", "labels", "doc_id", group="documents"),
    Relationship("pages", "page_id", "labels", "doc_id", group="cross"),
    Relationship("pat", "practice_id", "customer", "c_custkey", group="person"),
)

# Same rules plus one naming a column that does not exist (reported SKIPPED).
RELATIONSHIPS_WITH_MISSING = RELATIONSHIPS + (
    Relationship("pat", "registered_practice_id", "customer", "c_custkey", group="person"),
)

NOT_DUMMY = "is_dummy = false"

PATTERNS = (
    Uniqueness("order_id_uniqueness", "orders", "o_orderkey"),
    RelationshipExists(
        "customer_has_orders", "customer", "orders", (("c_custkey", "o_custkey"),), entity="c_custkey"
    ),
    RequiredFields("pat_has_birth_year", "pat", ("birth_year",), filter=NOT_DUMMY, check_empty=True),
    RangeCheck("pat_birth_year_range", "pat", "birth_year", 1900, 2000, filter=NOT_DUMMY),
    RangeCheck("pat_death_year_range", "pat", "death_year", 1950, 2005, filter=NOT_DUMMY),
    RequiredFields("pat_has_practice", "pat", ("practice_id",), filter=NOT_DUMMY),
    ReferenceCheck(
        "pat_practice_exists", "pat", "practice_id", "customer", "c_custkey",
        filter=NOT_DUMMY, exclude_null_keys=True,
    ),
    RequiredFields("pat_flags_not_null", "pat", ("is_dummy", "death_year"), filter="id > 0"),
    FieldComparison(
        "pat_death_after_birth", "pat", "death_year", "birth_year", "ge",
        filter="death_year is not null and birth_year is not null",
    ),
    RequiredFields("order_priority_present", "orders", ("o_orderpriority",), check_empty=True),
    RelationshipExists(
        "order_has_lineitems", "orders", "lineitem", (("o_orderkey", "l_orderkey"),), entity="o_orderkey"
    ),
    RelationshipExists(
        "customer_has_events", "customer", "events", (("c_custkey", "user_id"),),
        entity="c_custkey", count="rows",
    ),
    GroupCount(
        "customer_multiple_event_types", "customer", "c_custkey", "event_type",
        joined="events", on=(("c_custkey", "user_id"),), join_filter="value > 10.0",
        filter="c_acctbal > 0",
    ),
)

CONCEPTS = (
    ConceptColumn("lineitem", "l_suppkey"),
    ConceptColumn("supplier", "s_suppkey"),
    ConceptColumn("events", "user_id"),
    ConceptColumn("customer", "c_nationkey"),
    ConceptColumn("part", "p_size"),
    ConceptColumn("nation", "n_nationkey"),
)

CATALOG = Catalog(
    null_tables=NULL_TABLES,
    empty_tables=EMPTY_TABLES,
    completeness=COMPLETENESS,
    relationships=RELATIONSHIPS,
    patterns=PATTERNS,
    concepts=CONCEPTS,
    terminology=TERMINOLOGY,
)

# The same catalog with a rule of each kind that can't be tested: missing tables and columns,
# and a pattern that can't be read.
CONCEPTS_WITH_MISSING = CONCEPTS + (ConceptColumn("pat", "ethnicity_concept_id"),)
UNUSABLE = UnusableRule("pattern_without_type", "KeyError: type")
CATALOG_WITH_FAULTS = Catalog(
    null_tables=NULL_TABLES + ("referrals",),
    empty_tables=EMPTY_TABLES + ("referrals",),
    completeness=COMPLETENESS + (CompletenessRule("pat", "postcode", 90.0),),
    relationships=RELATIONSHIPS_WITH_MISSING,
    patterns=PATTERNS + (UNUSABLE, RequiredFields("pat_has_postcode", "pat", ("postcode",))),
    concepts=CONCEPTS_WITH_MISSING,
    terminology=TERMINOLOGY,
)
