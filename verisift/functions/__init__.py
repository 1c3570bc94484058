"""Column helpers: null/blank predicates, safe casts, guarded percentages."""

from .columns import (
    Predicate,
    all_of,
    any_of,
    as_predicate,
    common_key_type,
    count_where,
    is_missing,
    key_family,
    not_blank,
    pct,
    qcol,
    rate,
    sum_long,
    typed,
)
from .topk import top_k_per_group

__all__ = [
    "Predicate",
    "all_of",
    "any_of",
    "as_predicate",
    "common_key_type",
    "count_where",
    "is_missing",
    "key_family",
    "not_blank",
    "pct",
    "qcol",
    "rate",
    "sum_long",
    "top_k_per_group",
    "typed",
]
