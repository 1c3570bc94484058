"""Declarative rule objects.

A rule only names tables and columns; the tables themselves arrive as a
``{name: DataFrame}`` mapping at run time. Filters are SQL predicate strings
(plain or back-ticked column names) or ``Column`` objects, and are always
combined as separate parenthesised terms.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Optional, Sequence, Tuple, Union

from pyspark.sql import Column

Filter = Union[str, Column, None]

COMPARISON_OPS = ("gt", "ge", "lt", "le", "eq", "ne")
# Long names accepted for the same operators (fixed values of the rule format).
COMPARISON_ALIASES = {
    "greater_than": "gt",
    "greater_than_or_equal": "ge",
    "less_than": "lt",
    "less_than_or_equal": "le",
    "equal": "eq",
    "not_equal": "ne",
}


@dataclass(frozen=True)
class Relationship:
    """Foreign key ``child.fk`` must exist as ``parent.key``."""

    child: str
    fk: str
    parent: str
    key: str = "id"
    name: Optional[str] = None
    filter: Filter = None
    group: Optional[str] = None
    description: Optional[str] = None

    @property
    def label(self) -> str:
        return self.name or f"{self.child}.{self.fk} -> {self.parent}.{self.key}"


@dataclass(frozen=True)
class ConceptColumn:
    """A code column that must map through the concept map to a concept."""

    table: str
    column: str
    name: Optional[str] = None
    description: Optional[str] = None

    @property
    def label(self) -> str:
        return self.name or f"{self.table}.{self.column}"


@dataclass(frozen=True)
class Terminology:
    """Where the concept map and concept tables live and how their columns are named."""

    map_table: str = "CONCEPT_MAP"
    map_source: str = "source_code_id"
    map_target: str = "target_code_id"
    concept_table: str = "CONCEPT"
    concept_id: str = "id"
    concept_display: str = "display"
    concept_code: str = "code"


@dataclass(frozen=True)
class CompletenessRule:
    """``table.column`` must be at least ``min_pct`` percent non-NULL."""

    table: str
    column: str
    min_pct: float

    @property
    def label(self) -> str:
        return f"{self.table}.{self.column}"


@dataclass(frozen=True)
class Uniqueness:
    """Surplus rows of ``column``; NULLs ignored or counted as duplicates."""

    name: str
    table: str
    column: str
    count_nulls: bool = False
    filter: Filter = None
    description: str = ""


@dataclass(frozen=True)
class RequiredFields:
    """R2: a row fails once if any field is NULL (or blank with ``check_empty``)."""

    name: str
    table: str
    fields: Tuple[str, ...]
    filter: Filter = None
    check_empty: bool = False
    description: str = ""


@dataclass(frozen=True)
class RangeCheck:
    """``TRY_CAST(field) < min OR > max`` over eligible rows; bounds inclusive."""

    name: str
    table: str
    field: str
    min_value: Optional[Union[int, float, str]] = None
    max_value: Optional[Union[int, float, str]] = None
    cast_to: Optional[str] = "int"
    filter: Filter = None
    exclude_nulls: bool = True
    exclude_empty: bool = True
    description: str = ""


@dataclass(frozen=True)
class FieldComparison:
    """A row fails iff ``NOT (TRY_CAST(f1) op TRY_CAST(f2))`` is TRUE."""

    name: str
    table: str
    field1: str
    field2: str
    op: str
    cast_to: Optional[str] = "int"
    filter: Filter = None
    exclude_empty: bool = True
    description: str = ""

    def __post_init__(self):
        op = COMPARISON_ALIASES.get(self.op, self.op)
        if op not in COMPARISON_OPS:
            raise ValueError(f"unknown comparison operator {self.op!r}")
        object.__setattr__(self, "op", op)


@dataclass(frozen=True)
class ReferenceCheck:
    """Rows of ``child`` (after ``filter``) whose key finds no ``parent`` row.

    ``mode="rows"`` counts rows after the left join (duplicate parents inflate
    the total, NULL keys fail unless excluded); ``mode="integrity"`` routes to
    the J1 semantics with the filter.
    """

    name: str
    child: str
    fk: str
    parent: str
    key: str = "id"
    filter: Filter = None
    exclude_null_keys: bool = False
    mode: str = "rows"
    description: str = ""


@dataclass(frozen=True)
class Within:
    """The ``joined`` column lies from ``base + low`` to ``base + high``, both included
    unless open; None leaves that side unbounded.

    Bounds are numbers, or for dates and timestamps interval texts such as ``"30 days"``
    (``0`` is the base value itself).
    """

    base: str
    joined: str
    low: Union[int, float, str, None] = None
    high: Union[int, float, str, None] = None
    low_open: bool = False
    high_open: bool = False

    def __post_init__(self):
        if self.low is None and self.high is None:
            raise ValueError(f"no bound between {self.base!r} and {self.joined!r}")


@dataclass(frozen=True)
class RelationshipExists:
    """Base entities (or rows) with no matching row in ``joined``.

    A joined row matches a base row if all of these hold: the equalities of ``on``,
    ``(base_column, joined_column)`` pairs; the range ``within``; ``base_on`` of the
    base row and ``joined_on`` of the joined row; and ``condition``, any other SQL
    condition over columns written ``b.x`` (base) and ``j.y`` (joined), which needs
    an equality beside it. ``filter`` decides which base rows are tested at all.
    """

    name: str
    base: str
    joined: str
    on: Tuple[Tuple[str, str], ...] = ()
    filter: Filter = None
    count: str = "entities"
    entity: str = "id"
    description: str = ""
    within: Optional[Within] = None
    base_on: Filter = None
    joined_on: Filter = None
    condition: Optional[str] = None

    def __post_init__(self):
        if not self.on and (self.within is None or self.condition):
            raise ValueError(f"{self.name!r} needs an equality, or a range and nothing else between the two tables")


@dataclass(frozen=True)
class GroupCount:
    """Groups of ``base`` whose distinct count of ``counted`` exceeds ``min_count``.

    With ``joined`` set the base is left-joined on ``on`` pairs plus the optional
    ``join_filter`` (an extra, possibly non-equi, ON term on the joined side).
    Informational: always passes.
    """

    name: str
    base: str
    group_key: str
    counted: str
    joined: Optional[str] = None
    on: Tuple[Tuple[str, str], ...] = ()
    join_filter: Filter = None
    filter: Filter = None
    min_count: int = 1
    description: str = ""


@dataclass(frozen=True)
class QueryCount:
    """R5 by a query: each of its rows is a group that stands out, over ``table``.

    ``query`` is Spark SQL over the loaded tables' names; its first column is the
    group, its second the count. Informational: always passes.
    """

    name: str
    table: str
    query: str
    filter: Filter = None
    description: str = ""


@dataclass(frozen=True)
class UnusableRule:
    """A rule that could not be read, with why; a run reports it as ERROR."""

    name: str
    reason: str


RowRule = Union[Uniqueness, RequiredFields, RangeCheck, FieldComparison]
PatternRule = Union[
    Uniqueness,
    RequiredFields,
    RangeCheck,
    FieldComparison,
    ReferenceCheck,
    RelationshipExists,
    GroupCount,
    QueryCount,
    UnusableRule,
]


@dataclass(frozen=True)
class Catalog:
    """Everything one full run checks."""

    null_tables: Sequence[str] = ()
    empty_tables: Sequence[str] = ()
    completeness: Sequence[CompletenessRule] = ()
    relationships: Sequence[Relationship] = ()
    patterns: Sequence[PatternRule] = ()
    concepts: Sequence[ConceptColumn] = ()
    terminology: Terminology = field(default_factory=Terminology)
    empty_exclude: Sequence[str] = ("%_BACKUP", "%_OLD")
