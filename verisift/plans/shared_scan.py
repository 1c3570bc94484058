"""Scan sharing for a full run: one pass per table for every single-table check.

A table is typically named by several suites at once — all-NULL columns,
row counts, completeness rules and row rules. Run separately each is its own
scan; at scale the table scans dominate. Here every single-pass aggregate any
suite needs from a table is registered first (de-duplicated: ``count(*)`` and
``count(col)`` are shared between suites), the table is aggregated once, and
the rule rows of all suites are emitted from that one-row aggregate with a
single ``inline``.

Checks that need a shuffle of their own (uniqueness, joins, concept mapping)
still run as their own operators; their results are stacked with these.
"""

from __future__ import annotations

from collections import OrderedDict
from typing import Dict, List, Mapping, Optional, Tuple, Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contract import SUB_RESULT_SCHEMA
from ..functions.columns import sql_ident, sql_str
from ..functions.frames import literal_frame
from ..operators import joins, rowrules
from ..operators.profile import completeness_reason, table_names_excluding
from ..rules import Catalog, FieldComparison, RangeCheck, RequiredFields, UnusableRule
from ..session import aggregate_pushdown_enabled

class _TableAggs:
    """Registry of de-duplicated aggregate expressions per table.

    Plain counts (``count(*)``, ``count(col)``) and predicate counts
    (``count_if``) go to separate groups. With parquet aggregate push-down the
    plain-count group is answered from file footers, so it is kept apart from
    predicates that need column data; without push-down both groups are one
    aggregate, i.e. one read of the table.

    Output rows are written as SQL text and turned into one
    ``inline(array(named_struct(...)))`` expression per group, so building a
    suite costs a few gateway calls per table rather than several per rule.
    """

    def __init__(self, tables: Mapping[str, DataFrame], split_predicates: bool):
        self.tables = tables
        self.split = split_predicates
        self.exprs: "OrderedDict[Tuple[str, str], OrderedDict[tuple, Tuple[str, Union[str, Column]]]]" = OrderedDict()
        self.rows_out: "OrderedDict[Tuple[str, str], List[str]]" = OrderedDict()
        self._aggs: Dict[Tuple[str, str], DataFrame] = {}

    def _group(self, table: str, predicate: bool) -> Tuple[str, str]:
        return (table, "pred" if (predicate and self.split) else "count")

    def _add(self, group: Tuple[str, str], key: tuple, expr: Union[str, Column]) -> str:
        d = self.exprs.setdefault(group, OrderedDict())
        if key not in d:
            d[key] = (f"__a{len(d)}", expr)
        return d[key][0]

    def rows(self, table: str) -> str:
        return self._add(self._group(table, False), ("rows",), "count(1)")

    def non_null(self, table: str, col: str) -> str:
        return self._add(self._group(table, False), ("nn", col), f"count({sql_ident(col)})")

    def count_if(self, table: str, key: tuple, cond: Column) -> str:
        return self._add(self._group(table, True), ("if",) + key, F.count_if(cond))

    def emit(self, table: str, suite: str, seq: int, rule: str, total: str, failed: str,
             status: str, predicate: bool = False, reason: str = "cast(null as string)") -> None:
        self.rows_out.setdefault(self._group(table, predicate), []).append(
            f"named_struct('suite', {sql_str(suite)}, 'seq', {int(seq)}, 'rule', {sql_str(rule)}, "
            f"'total_tested', cast({total} as bigint), 'failed_records', cast({failed} as bigint), "
            f"'status', {status}, 'reason', {reason})"
        )

    def _agg(self, group: Tuple[str, str]) -> DataFrame:
        # One aggregate DataFrame per group, shared by every output drawn from it
        # (Spark reuses its exchange, so the table is read once).
        if group not in self._aggs:
            aggs = [
                F.expr(f"{e} as {n}") if isinstance(e, str) else e.alias(n)
                for n, e in self.exprs[group].values()
            ]
            self._aggs[group] = self.tables[group[0]].agg(*aggs)
        return self._aggs[group]

    def frames(self) -> List[DataFrame]:
        return [
            self._agg(group).select(F.expr("inline(array(" + ", ".join(structs) + "))"))
            for group, structs in self.rows_out.items()
        ]

def _pass_fail(failing: str) -> str:
    return f"case when {failing} then 'FAIL' else 'PASS' end"


def single_table_rows(tables: Mapping[str, DataFrame], catalog: Catalog) -> Tuple[DataFrame, List]:
    """Rows of every single-table check, from one aggregate per table; also the
    patterns that need plans of their own."""
    spark = next(iter(tables.values())).sparkSession
    reg = _TableAggs(tables, split_predicates=aggregate_pushdown_enabled(spark))
    errors: List[tuple] = []

    # All-NULL columns
    seq = 0
    for n in catalog.null_tables:
        if n not in tables:
            continue
        rows = reg.rows(n)
        for c in tables[n].columns:
            nn = reg.non_null(n, c)
            reg.emit(n, "null_columns", seq, f"{n}.{c}", rows, f"{rows} - {nn}", _pass_fail(f"{nn} = 0 and {rows} > 0"))
            seq += 1
    for i, n in enumerate([n for n in catalog.null_tables if n not in tables]):
        errors.append(("null_columns", seq + i, n, None, None, "ERROR", f"table {n} not found"))

    # Empty tables
    kept = table_names_excluding(list(catalog.empty_tables), catalog.empty_exclude)
    for i, n in enumerate(kept):
        if n not in tables:
            errors.append(("empty_tables", i, n, None, None, "ERROR", f"table {n} not found"))
            continue
        rows = reg.rows(n)
        reg.emit(n, "empty_tables", i, n, rows, f"case when {rows} = 0 then 1 else 0 end", _pass_fail(f"{rows} = 0"))

    # Completeness (rate rounded before the comparison; empty table = ERROR)
    for i, r in enumerate(catalog.completeness):
        if r.table not in tables or r.column not in tables[r.table].columns:
            errors.append(("column_completeness", i, r.label, None, None, "ERROR", completeness_reason(tables, r)))
            continue
        rows, nn = reg.rows(r.table), reg.non_null(r.table, r.column)
        rate = f"round(cast({nn} as double) / nullif({rows}, 0) * 100.0, 2)"
        status = (
            f"case when {rows} = 0 then 'ERROR' when {rate} >= {float(r.min_pct)!r} then 'PASS' else 'FAIL' end"
        )
        why = f"case when {rows} = 0 then {sql_str(completeness_reason(tables, r))} end"
        reg.emit(r.table, "column_completeness", i, r.label, rows, f"{rows} - {nn}", status, reason=why)

    # R2-R4 patterns; everything else in the pattern suite runs as its own plan
    from .suites import pattern_missing, pattern_sub_results  # local import: suites imports this module

    others = []
    for i, p in enumerate(catalog.patterns):
        if isinstance(p, UnusableRule) or pattern_missing(tables, p) is not None:
            others.append(p)  # reported SKIPPED or ERROR by pattern_sub_results
        elif isinstance(p, (RequiredFields, RangeCheck, FieldComparison)):
            df = tables[p.table]
            eligible, failing = rowrules.eligibility_and_failure(p, df)
            tot = reg.count_if(p.table, ("t", p.name), eligible)
            bad = reg.count_if(p.table, ("f", p.name), eligible & failing)
            reg.emit(p.table, "person_patterns", i, p.name, tot, bad, _pass_fail(f"{bad} > 0"), predicate=True)
        else:
            others.append(p)

    frames = reg.frames()
    if errors:
        frames.append(literal_frame(spark, errors, SUB_RESULT_SCHEMA))
    out = frames[0] if frames else literal_frame(spark, [], SUB_RESULT_SCHEMA)
    for f in frames[1:]:
        out = out.unionByName(f)
    return out, others


def join_suites(tables: Mapping[str, DataFrame], catalog: Catalog, others: List) -> Dict[str, DataFrame]:
    """By suite, the checks that need their own shuffles."""
    from .suites import pattern_sub_results  # local import: suites imports this module

    out = {}
    if others:
        seq_of = {p.name: i for i, p in enumerate(catalog.patterns)}
        out["person_patterns"] = pattern_sub_results(tables, others, seq_of=seq_of)
    out["referential_integrity"] = joins.referential_sub_results(tables, catalog.relationships)
    out["concept_mapping"] = joins.concept_sub_results(tables, catalog.concepts, catalog.terminology, buckets=True)
    return out


def public_rows(single: DataFrame) -> DataFrame:
    return single.where(~F.col("suite").startswith("__"))


def shared_sub_results(tables: Mapping[str, DataFrame], catalog: Catalog) -> DataFrame:
    """Same rows as ``suites.suite_sub_results`` with one scan per table for
    null columns, empty tables, completeness and the row-rule patterns — as
    one lazy plan."""
    out, others = single_table_rows(tables, catalog)
    for p in join_suites(tables, catalog, others).values():
        out = out.unionByName(public_rows(p))
    return out
