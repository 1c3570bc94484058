"""Row-rule checks R1-R5.

R2-R4 are pure per-row predicates: every such rule of a table is answered by
one ``agg`` of ``count_if`` pairs (eligible, eligible-and-failing), so a table
is scanned once however many rules it carries. R1 needs a distinct count: the
values of all unique columns of one type are stacked and grouped by ``(rule, value)``
in one shuffle, after map-side counting. R5 aggregates the joined side before it
meets the base table.

Output of R1-R4: ``name, total_tested, failed_records, failed_pct, passed``.
"""

from __future__ import annotations

import uuid
from collections import OrderedDict
from typing import List, Mapping, Sequence, Tuple, Union

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import sql_ident
from ..functions.frames import literal_frame
from ..functions.sqltext import tokens
from ..functions import qcol, all_of, any_of, is_missing, key_family, not_blank, pct, typed
from ..rules import FieldComparison, GroupCount, QueryCount, RangeCheck, RequiredFields, Uniqueness

# Parts that the rows of one duplicated value are dealt into.
SALTS = 32

_OPS = {
    "gt": lambda a, b: a > b,
    "ge": lambda a, b: a >= b,
    "lt": lambda a, b: a < b,
    "le": lambda a, b: a <= b,
    "eq": lambda a, b: a == b,
    "ne": lambda a, b: a != b,
}

PredicateRule = Union[RequiredFields, RangeCheck, FieldComparison]


def _bound(value) -> Column:
    """A bound is a literal, or a SQL expression string such as ``year(date'2024-06-30')``."""
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        return F.expr(value)
    return F.lit(value)


def eligibility_and_failure(rule: PredicateRule, df: DataFrame) -> Tuple[Column, Column]:
    """(eligible, failing) predicates of one R2-R4 rule; both three-valued."""
    if isinstance(rule, RequiredFields):
        eligible = all_of(rule.filter)
        failing = any_of(is_missing(qcol(f), rule.check_empty) for f in rule.fields)
        return eligible, failing
    if isinstance(rule, RangeCheck):
        f = qcol(rule.field)
        eligible = all_of(
            rule.filter,
            f.isNotNull() if rule.exclude_nulls else None,
            not_blank(f) if rule.exclude_empty else None,
        )
        v = typed(f, rule.cast_to)
        conds = []
        if rule.min_value is not None:
            conds.append(v < _bound(rule.min_value))
        if rule.max_value is not None:
            conds.append(v > _bound(rule.max_value))
        return eligible, any_of(conds)
    if isinstance(rule, FieldComparison):
        f1, f2 = qcol(rule.field1), qcol(rule.field2)
        eligible = all_of(
            rule.filter, (not_blank(f1) & not_blank(f2)) if rule.exclude_empty else None
        )
        a, b = typed(f1, rule.cast_to), typed(f2, rule.cast_to)
        return eligible, ~_OPS[rule.op](a, b)
    raise TypeError(f"not a predicate rule: {rule!r}")


def _finish(counts: DataFrame) -> DataFrame:
    tot, fail = F.col("total_tested"), F.col("failed_records")
    return counts.select(
        "name", "total_tested", "failed_records", pct(fail, tot).alias("failed_pct"),
        (fail == 0).alias("passed"),
    )


def _predicate_counts(df: DataFrame, rules: Sequence[PredicateRule]) -> DataFrame:
    """All predicate rules of one table in a single scan."""
    aggs = []
    for i, r in enumerate(rules):
        eligible, failing = eligibility_and_failure(r, df)
        aggs.append(F.count_if(eligible).alias(f"__t{i}"))
        aggs.append(F.count_if(eligible & failing).alias(f"__f{i}"))
    rows = F.array(
        *[
            F.struct(
                F.lit(r.name).alias("name"),
                F.col(f"__t{i}").alias("total_tested"),
                F.col(f"__f{i}").alias("failed_records"),
            )
            for i, r in enumerate(rules)
        ]
    )
    return df.agg(*aggs).select(F.inline(rows))


def _uniqueness_counts(tables: Mapping[str, DataFrame], rules: Sequence[Uniqueness]) -> List[DataFrame]:
    """Surplus rows = rows - distinct values, for any number of rules.

    NULLs ignored: counted over non-NULL rows. NULLs counted (legacy): over all
    rows, and since COUNT(DISTINCT) skips NULL every NULL row is a duplicate.

    A table is read once for all its unique columns of one type (integers are one
    type); the stacked ``(rule, value)`` rows of all tables share one grouping per type.
    """
    families: "OrderedDict[str, OrderedDict[str, List[Tuple[int, Uniqueness]]]]" = OrderedDict()
    for i, r in enumerate(rules):
        kind = tables[r.table].schema[r.column].dataType
        families.setdefault(key_family(kind) or kind.simpleString(), OrderedDict()).setdefault(r.table, []).append((i, r))
    out = []
    for kind, by_table in families.items():
        stacked = None
        for table, items in by_table.items():
            each = [
                F.when(
                    all_of(r.filter, None if r.count_nulls else qcol(r.column).isNotNull()),
                    F.struct(F.lit(i).alias("rule"), qcol(r.column).cast(kind).alias("value")),
                )
                for i, r in items
            ]
            rows = tables[table].select(F.explode(F.filter(F.array(*each), lambda e: e.isNotNull())).alias("e")).select("e.*")
            stacked = rows if stacked is None else stacked.unionByName(rows)
        by_value = stacked.groupBy("rule", "value").agg(F.count(F.lit(1)).alias("n"))
        per_rule = by_value.groupBy("rule").agg(F.sum("n").alias("tested"), F.count("value").alias("distinct"))
        own = [(i, r.name) for items in by_table.values() for i, r in items]
        names = literal_frame(next(iter(tables.values())).sparkSession, own, "rule int, name string")
        # One row per rule: bounded by configuration.
        out.append(
            F.broadcast(names).join(per_rule, "rule", "left").select(
                "name",
                F.coalesce("tested", F.lit(0)).cast("bigint").alias("total_tested"),
                F.coalesce(F.col("tested") - F.col("distinct"), F.lit(0)).cast("bigint").alias("failed_records"),
            )
        )
    return out


def row_checks(
    tables: Mapping[str, DataFrame],
    rules: Sequence[Union[Uniqueness, PredicateRule]],
) -> DataFrame:
    """R1-R4 for any mix of rules and tables; one scan per table for R2-R4."""
    by_table: "OrderedDict[str, List[PredicateRule]]" = OrderedDict()
    frames: List[DataFrame] = _uniqueness_counts(tables, [r for r in rules if isinstance(r, Uniqueness)])
    for r in rules:
        if not isinstance(r, Uniqueness):
            by_table.setdefault(r.table, []).append(r)
    for table, trs in by_table.items():
        frames.append(_predicate_counts(tables[table], trs))
    spark = next(iter(tables.values())).sparkSession
    out = literal_frame(
        spark,
        [], "name string, total_tested bigint, failed_records bigint"
    )
    for f in frames:
        out = out.unionByName(f)
    return _finish(out)


def uniqueness(tables: Mapping[str, DataFrame], rule: Uniqueness) -> DataFrame:
    return row_checks(tables, [rule])


def required_fields(tables: Mapping[str, DataFrame], rule: RequiredFields) -> DataFrame:
    return _finish(_predicate_counts(tables[rule.table], [rule]))


def range_check(tables: Mapping[str, DataFrame], rule: RangeCheck) -> DataFrame:
    return _finish(_predicate_counts(tables[rule.table], [rule]))


def field_comparison(tables: Mapping[str, DataFrame], rule: FieldComparison) -> DataFrame:
    return _finish(_predicate_counts(tables[rule.table], [rule]))


def failing_rows(tables: Mapping[str, DataFrame], rule: Union[Uniqueness, PredicateRule]) -> DataFrame:
    """J6 for row rules: the records behind a failure, ``rule`` + the table's columns.

    R2-R4: eligible rows whose failure predicate is TRUE. R1: rows whose value
    occurs more than once (plus every NULL row when NULLs count as
    duplicates); the duplicated values are found by aggregation and the rows
    by a semi join in salted parts of each value.
    """
    df = tables[rule.table]
    if isinstance(rule, Uniqueness):
        base = df.where(all_of(rule.filter))
        c = qcol(rule.column)
        dup_values = (
            base.where(c.isNotNull())
            .groupBy(c.alias("__v"))
            .agg(F.count(F.lit(1)).alias("__n"))
            .where(F.col("__n") > 1)
            .select("__v")
        )
        # A duplicated value meets its rows in SALTS parts, so one held by a third
        # of the table is spread over as many tasks.
        salted = dup_values.select("__v", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt"))
        part = F.pmod(F.xxhash64(*[qcol(x) for x in df.columns], F.monotonically_increasing_id()), F.lit(SALTS)).cast("int")
        rows = base.where(c.isNotNull()).withColumn("__part", part)
        hits = rows.join(salted, (c == F.col("__v")) & (F.col("__part") == F.col("__salt")), "left_semi").drop("__part")
        if rule.count_nulls:
            hits = hits.unionByName(base.where(c.isNull()))
        return hits.select(F.lit(rule.name).alias("rule"), *[qcol(x) for x in df.columns])
    eligible, failing = eligibility_and_failure(rule, df)
    return df.where(eligible & failing).select(F.lit(rule.name).alias("rule"), *[qcol(x) for x in df.columns])


def failing_samples(
    tables: Mapping[str, DataFrame],
    rules: Sequence[PredicateRule],
    k: int = 10,
    keys: Mapping[str, Sequence[str]] = {},
) -> DataFrame:
    """J6 with a limit, for all R2-R4 rules at once: ``rule, seq, record, place``.

    Per rule the ``k`` failing records with the smallest hashes, a sample that no order
    of the files decides. ``record`` is the JSON of the table's ``keys`` (all its columns
    where none are named), ``place`` its MD5, by which records are ordered; equal records
    are listed as often as they fail, up to ``k``. A table is read once for all its rules:
    a row gives one entry per rule it fails, and each task keeps its ``k`` smallest per
    rule before anything is shuffled.
    """
    if k < 1:
        raise ValueError("k must be positive")
    by_table: "OrderedDict[str, List[Tuple[int, PredicateRule]]]" = OrderedDict()
    for i, r in enumerate(rules):
        by_table.setdefault(r.table, []).append((i, r))
    spark = next(iter(tables.values())).sparkSession
    out = literal_frame(spark, [], "rule_id int, place string, record string")
    for table, items in by_table.items():
        df = tables[table]
        failed = []
        for i, r in items:
            eligible, failing = eligibility_and_failure(r, df)
            failed.append(F.when(eligible & failing, F.lit(i)))
        columns = list(keys.get(table) or df.columns)
        record = F.to_json(F.struct(*[qcol(c) for c in columns]), {"ignoreNullFields": "false"})
        hits = df.select(F.filter(F.array(*failed), lambda e: e.isNotNull()).alias("rules"), *[qcol(c) for c in dict.fromkeys(columns)])
        hits = hits.where(F.size("rules") > 0).select("rules", record.alias("record"))
        rows = hits.select(F.explode("rules").alias("rule_id"), F.md5(F.col("record").cast("binary")).alias("place"), "record")
        out = out.unionByName(rows)
    w = Window.partitionBy("rule_id").orderBy("place", "record")
    # Filtered by row number, Spark limits each rule's rows to k in every task before the shuffle.
    top = out.withColumn("seq", F.row_number().over(w)).where(F.col("seq") <= k)
    names = literal_frame(spark, [(i, r.name) for i, r in enumerate(rules)], "rule_id int, rule string")
    # One row per rule: bounded by configuration.
    return top.join(F.broadcast(names), "rule_id").select("rule", "seq", "record", "place")


# --------------------------------------------------------------------------- R5


def group_counts(tables: Mapping[str, DataFrame], rule: GroupCount) -> DataFrame:
    """Groups whose distinct count of ``counted`` exceeds ``min_count``: ``group_key, n``.

    When the base is left-joined on its group key alone, a group can only
    exceed ``min_count >= 0`` through matched rows, so the joined side is
    aggregated first (partial de-duplication of ``(key, counted)`` before any
    shuffle) and the base only semi-joins the qualifying keys: the base rows are
    never multiplied by the join. Other shapes: ``_groups_by_keys``.
    """
    base = tables[rule.base].where(all_of(rule.filter))
    n = F.count_distinct(F.col("__counted")).alias("n")
    if rule.joined is None:
        grouped = base.select(
            base[rule.group_key].alias("group_key"), base[rule.counted].alias("__counted")
        ).groupBy("group_key").agg(n)
        return grouped.where(F.col("n") > rule.min_count)
    joined = tables[rule.joined].where(all_of(rule.join_filter))
    if (
        rule.min_count >= 0
        and len(rule.on) == 1
        and rule.on[0][0] == rule.group_key
    ):
        jk = rule.on[0][1]
        per_key = (
            joined.select(joined[jk].alias("group_key"), joined[rule.counted].alias("__counted"))
            .groupBy("group_key")
            .agg(n)
            .where(F.col("n") > rule.min_count)
        )
        keys = base.select(base[rule.group_key].alias("group_key"))
        return per_key.join(keys, "group_key", "left_semi")
    return _groups_by_keys(base, joined, rule).where(F.col("n") > rule.min_count)


def _groups_by_keys(base: DataFrame, joined: DataFrame, rule: GroupCount) -> DataFrame:
    """``group_key, n`` where base and joined side meet on other columns than the group key.

    Only distinct values count, so both sides are reduced to them first. A group with one key
    has the count of that key, which is made once and handed to its groups as a number; only
    groups of several keys, whose values may overlap, are joined row by row. Either way a key
    is dealt into ``SALTS`` parts, so one that a third of the rows have is spread.
    """
    names = [f"__k{i}" for i in range(len(rule.on))]
    own = base.select(qcol(rule.group_key).alias("group_key"), *[qcol(bc).alias(n) for n, (bc, _) in zip(names, rule.on)]).distinct()
    theirs = joined.where(all_of(*[qcol(jc).isNotNull() for _, jc in rule.on])).select(
        qcol(rule.counted).alias("__counted"), *[qcol(jc).alias(f"{n}j") for n, (_, jc) in zip(names, rule.on)]
    ).distinct()
    able = all_of(*[F.col(n).isNotNull() for n in names])
    per_group = own.groupBy("group_key").agg(F.count_if(able).alias("keys"), F.max(F.when(able, F.struct(*names))).alias("key"))
    part = F.pmod(F.xxhash64("group_key"), F.lit(SALTS)).cast("int").alias("__part")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt")
    same = [F.col(n) == F.col(f"{n}j") for n in names] + [F.col("__part") == F.col("__salt")]
    per_key = theirs.groupBy(*[f"{n}j" for n in names]).agg(F.count("__counted").alias("n")).select("*", salts)
    single = per_group.where("keys <= 1").select("group_key", *[F.col(f"key.{n}").alias(n) for n in names], part)
    one = single.join(per_key, all_of(*same), "left").select("group_key", F.coalesce("n", F.lit(0)).alias("n"))
    several = per_group.where("keys > 1").select(F.col("group_key").alias("__g"))
    rows = own.where(able).join(several, F.col("group_key").eqNullSafe(F.col("__g")), "left_semi").select("*", part)
    met = rows.join(theirs.select("*", salts), all_of(*same)).groupBy("group_key").agg(F.count_distinct("__counted").alias("n"))
    # Groups of several keys that met nothing count too, where the bound asks for them.
    more = several.join(met, F.col("group_key").eqNullSafe(F.col("__g")), "left").select(F.col("__g").alias("group_key"), F.coalesce("n", F.lit(0)).alias("n"))
    return one.unionByName(more)


def over_tables(tables: Mapping[str, DataFrame], query: str) -> DataFrame:
    """``query`` over the loaded tables by their names. The caller's views stay as they are: the
    names are those of the query's own WITH, over views that are dropped once it is planned."""
    named = {t.name.lower() for t in tokens(query) if t.name is not None}
    spark, run = next(iter(tables.values())).sparkSession, uuid.uuid4().hex
    views = {name: f"verisift_{run}_{k}" for k, name in enumerate(tables) if name.lower() in named}
    try:
        for name, view in views.items():
            tables[name].createTempView(view)
        heads = ", ".join(f"{sql_ident(name)} AS (SELECT * FROM {view})" for name, view in views.items())
        return spark.sql(f"WITH {heads} SELECT * FROM (\n{query.strip().rstrip(';')}\n)" if views else query)
    finally:
        for view in views.values():
            spark.catalog.dropTempView(view)


def query_groups(tables: Mapping[str, DataFrame], rule: QueryCount) -> DataFrame:
    """``group_key, n`` of a rule that brings its own query."""
    got = over_tables(tables, rule.query)
    if len(got.columns) < 2:
        raise ValueError(f"the query of {rule.name!r} needs a group and a count")
    return got.toDF("group_key", "n", *got.columns[2:]).select("group_key", F.col("n").cast("bigint").alias("n"))


def group_count_check(tables: Mapping[str, DataFrame], rule: GroupCount) -> DataFrame:
    """R5 summary: ``name, total_tested, failed_records, avg_count, passed``.

    ``total_tested`` is the number of base rows after the filter,
    ``failed_records`` the number of qualifying groups; informational, so it
    always passes.
    """
    by_query = isinstance(rule, QueryCount)
    base = tables[rule.table if by_query else rule.base].where(all_of(rule.filter))
    total = base.agg(F.count(F.lit(1)).alias("total_tested")).select(
        "total_tested",
        F.lit(None).cast("bigint").alias("failed_records"),
        F.lit(None).cast("double").alias("avg_count"),
    )
    groups = (query_groups if by_query else group_counts)(tables, rule).agg(
        F.lit(None).cast("bigint").alias("total_tested"),
        F.count(F.lit(1)).alias("failed_records"),
        F.avg("n").alias("avg_count"),
    )
    # Two single-row aggregates stacked and folded: no join between them.
    return total.unionByName(groups).agg(
        F.max("total_tested").alias("total_tested"),
        F.max("failed_records").alias("failed_records"),
        F.max("avg_count").alias("avg_count"),
    ).select(
        F.lit(rule.name).alias("name"),
        "total_tested",
        "failed_records",
        "avg_count",
        F.lit(True).alias("passed"),
    )
