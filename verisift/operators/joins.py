"""Join checks J1-J6.

Design points that matter at scale:

* **Pre-aggregate before joining.** A child foreign key is reduced to
  ``(rule, key, n)`` with map-side partial aggregation before any shuffle, so a
  key that holds a third of the table arrives at the join as one row per map
  partition, never as a hot partition. The same holds for concept codes.
* **One grouping for many rules.** All relationships whose keys share a type
  family (integral -> BIGINT, string or mixed -> string) go through a single
  ``groupBy(parent tag, key)`` over the stacked keys of all children and parents.
  A child table is scanned once whatever number of foreign keys it carries
  (``explode`` of an array of tagged keys). Keys of other types keep a per-rule
  join with their native equality.
* **Broadcast is left to AQE**, which decides from measured shuffle sizes; the
  only frames hinted are built from the rule list itself (size bounded by the
  number of rules, not by data).
"""

from __future__ import annotations

from collections import OrderedDict
from typing import Dict, List, Mapping, Optional, Sequence, Tuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import SUB_RESULT_SCHEMA
from ..functions.frames import literal_frame
from ..functions.sqltext import meaningful, tokens
from ..functions import all_of, any_of, qcol, common_key_type, pct, sum_long, top_k_per_group
from ..rules import (
    ConceptColumn,
    ReferenceCheck,
    Relationship,
    RelationshipExists,
    Terminology,
)

# ----------------------------------------------------------------------------- helpers


def _spark(tables: Mapping[str, DataFrame]) -> SparkSession:
    return next(iter(tables.values())).sparkSession


def _field_type(df: DataFrame, col: str) -> T.DataType:
    return df.schema[col].dataType


def _missing_reason(tables: Mapping[str, DataFrame], pairs: Sequence[Tuple[str, str]]) -> Optional[str]:
    """Why a rule cannot run, decided from schemas only (no Spark job)."""
    for table, col in pairs:
        if table not in tables:
            return f"table {table} not found"
        if col not in tables[table].columns:
            return f"column {table}.{col} not found"
    return None


def _union_all(frames: List[DataFrame]) -> Optional[DataFrame]:
    out = None
    for f in frames:
        out = f if out is None else out.unionByName(f)
    return out


# ----------------------------------------------------------------------------- J1 core

_KEYED_SCHEMA = "rule_id int, key string, n bigint, found boolean"


def _tagged_child_keys(
    df: DataFrame, items: Sequence[Tuple[int, int, Relationship]], key_type: str
) -> DataFrame:
    """``(ptag, rule_id, key)`` for every non-NULL FK of the given rules, one scan."""
    if len(items) == 1:
        ptag, rid, r = items[0]
        fk = qcol(r.fk)
        return df.where(all_of(fk.isNotNull(), r.filter)).select(
            F.lit(ptag).alias("ptag"), F.lit(rid).alias("rule_id"), fk.cast(key_type).alias("key")
        )
    elems = []
    for ptag, rid, r in items:
        fk = qcol(r.fk)
        elems.append(
            F.when(
                all_of(fk.isNotNull(), r.filter),
                F.struct(
                    F.lit(ptag).alias("ptag"), F.lit(rid).alias("rule_id"), fk.cast(key_type).alias("key")
                ),
            )
        )
    # The OR of IS NOT NULLs reaches the parquet reader as a pushed filter.
    pre = df.where(any_of(qcol(r.fk).isNotNull() for _, _, r in items))
    return pre.select(F.explode(F.filter(F.array(*elems), lambda e: e.isNotNull())).alias("e")).select(
        "e.ptag", "e.rule_id", "e.key"
    )


# Rules that share one aggregate row per key; more rules of one parent take a
# second pass over its keys rather than wider rows.
RULES_PER_KEY = 16


def _fused_family(
    tables: Mapping[str, DataFrame], items: Sequence[Tuple[int, Relationship]], key_type: str
) -> DataFrame:
    """Keyed result ``rule_id, key, n, found`` for rules sharing one key type.

    Child and parent keys are stacked and grouped once by ``(parent tag, key)``:
    a flag tells whether the parent has the key, and each rule counts its child
    rows in a slot of its own. Partial aggregation before that one shuffle makes
    a hot key one row per map partition, and no join follows.
    """
    parents: "OrderedDict[Tuple[str, str, int], int]" = OrderedDict()
    by_child: "OrderedDict[str, List[Tuple[int, int, Relationship]]]" = OrderedDict()
    used: Dict[Tuple[str, str], int] = {}
    rule_at: Dict[Tuple[int, int], int] = {}
    for rid, r in items:
        k = used.get((r.parent, r.key), 0)
        used[(r.parent, r.key)] = k + 1
        ptag = parents.setdefault((r.parent, r.key, k // RULES_PER_KEY), len(parents))
        slot = k % RULES_PER_KEY
        rule_at[(ptag, slot)] = rid
        by_child.setdefault(r.child, []).append((ptag, slot, r))
    rows = _union_all(
        [_tagged_child_keys(tables[c], its, key_type) for c, its in by_child.items()]
        + [
            tables[p].where(tables[p][k].isNotNull()).select(
                F.lit(tag).alias("ptag"), F.lit(None).cast("int").alias("rule_id"), tables[p][k].cast(key_type).alias("key")
            )
            for (p, k, _), tag in parents.items()
        ]
    )
    slots = sorted({slot for _, slot in rule_at})
    grouped = rows.groupBy("ptag", "key").agg(
        F.bool_or(F.col("rule_id").isNull()).alias("found"),
        *[F.count_if(F.col("rule_id") == s).alias(f"__n{s}") for s in slots],
    )
    each = F.expr("array(" + ", ".join(f"named_struct('slot', {s}, 'n', __n{s})" for s in slots) + ")")
    numbered = literal_frame(
        _spark(tables), [(t, s, rid) for (t, s), rid in rule_at.items()], "ptag int, slot int, rule_id int"
    )
    counted = grouped.select("ptag", "key", "found", F.explode(F.filter(each, lambda e: e["n"] > 0)).alias("e"))
    # The frame of rule numbers has one row per rule: bounded by configuration.
    return counted.select("ptag", "key", F.when(F.col("found"), F.lit(True)).alias("found"), F.col("e.slot").alias("slot"), F.col("e.n").alias("n")).join(
        F.broadcast(numbered), ["ptag", "slot"]
    ).select("rule_id", F.col("key").cast("string").alias("key"), "n", "found")


def _single_rule(tables: Mapping[str, DataFrame], rid: int, r: Relationship) -> DataFrame:
    """Per-rule keyed result with the engine's native equality (non-fusable types)."""
    child, parent = tables[r.child], tables[r.parent]
    pre = (
        child.where(all_of(child[r.fk].isNotNull(), r.filter))
        .groupBy(child[r.fk].alias("__k"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    pk = parent.where(parent[r.key].isNotNull()).select(parent[r.key].alias("__pk")).distinct()
    pk = pk.withColumn("found", F.lit(True))
    return pre.join(pk, pre["__k"] == pk["__pk"], "left").select(
        F.lit(rid).alias("rule_id"), F.col("__k").cast("string").alias("key"), "n", "found"
    )


def _plan_relationships(
    tables: Mapping[str, DataFrame], rules: Sequence[Relationship]
) -> Tuple[Dict[str, List[Tuple[int, Relationship]]], List[Tuple[int, Relationship]], Dict[int, str]]:
    families: Dict[str, List[Tuple[int, Relationship]]] = OrderedDict()
    singles: List[Tuple[int, Relationship]] = []
    skipped: Dict[int, str] = {}
    for rid, r in enumerate(rules):
        reason = _missing_reason(tables, [(r.child, r.fk), (r.parent, r.key)])
        if reason:
            skipped[rid] = reason
            continue
        fam = common_key_type(
            _field_type(tables[r.child], r.fk), _field_type(tables[r.parent], r.key)
        )
        if fam is None:
            singles.append((rid, r))
        else:
            families.setdefault(fam, []).append((rid, r))
    return families, singles, skipped


def referential_keys(tables: Mapping[str, DataFrame], rules: Sequence[Relationship]) -> DataFrame:
    """Per rule and distinct FK value: ``rule_id, key, n, found`` (found NULL = orphan)."""
    families, singles, _ = _plan_relationships(tables, rules)
    frames = [_fused_family(tables, items, fam) for fam, items in families.items()]
    frames += [_single_rule(tables, rid, r) for rid, r in singles]
    out = _union_all(frames)
    if out is None:
        out = literal_frame(_spark(tables), [], _KEYED_SCHEMA)
    return out


def _rule_frame(spark: SparkSession, rules: Sequence[Relationship], skipped: Dict[int, str]) -> DataFrame:
    rows = [
        (rid, r.label, r.child, r.fk, r.parent, r.key, r.group, skipped.get(rid))
        for rid, r in enumerate(rules)
    ]
    return literal_frame(
        spark,
        rows,
        "rule_id int, name string, child string, fk string, parent string, key string, "
        "rule_group string, reason string",
    )


def _child_totals(tables: Mapping[str, DataFrame], rules: Sequence[Relationship], skipped) -> DataFrame:
    """``rule_id, total_records``: rows of the child (after the rule's filter).

    One aggregate per child table; an unfiltered ``count(1)`` needs no column
    data from parquet.
    """
    by_child: "OrderedDict[str, List[Tuple[int, Relationship]]]" = OrderedDict()
    for rid, r in enumerate(rules):
        if rid not in skipped:
            by_child.setdefault(r.child, []).append((rid, r))
    frames = []
    for child, items in by_child.items():
        df = tables[child]
        aggs, rows = [F.count(F.lit(1)).alias("__all")], []
        for rid, r in items:
            if r.filter is None:
                col = F.col("__all")
            else:
                aggs.append(F.count_if(all_of(r.filter)).alias(f"__t{rid}"))
                col = F.col(f"__t{rid}")
            rows.append(F.struct(F.lit(rid).alias("rule_id"), col.alias("total_records")))
        frames.append(df.agg(*aggs).select(F.inline(F.array(*rows))))
    out = _union_all(frames)
    if out is None:
        out = literal_frame(_spark(tables), [], "rule_id int, total_records bigint")
    return out


def _per_rule(tables: Mapping[str, DataFrame], rules: Sequence[Relationship]) -> DataFrame:
    return referential_keys(tables, rules).groupBy("rule_id").agg(
        F.sum("n").alias("non_null_fk"),
        F.sum(F.when(F.col("found").isNull(), F.col("n"))).alias("violation_count"),
    )


def referential_integrity(
    tables: Mapping[str, DataFrame],
    rules: Sequence[Relationship],
    *,
    with_reason: bool = False,
) -> DataFrame:
    """``name, child, fk, parent, key, total_records, non_null_fk, violation_count,
    pct_of_table, pct_of_non_null, status`` (+ ``rule_id, rule_group, reason``).

    A violation is a child row whose FK is not NULL and has no parent row; each
    child row counts once, so duplicate parent keys are harmless and NULL parent
    keys never match. A rule naming a missing table or column is SKIPPED with
    its reason and does not stop the others.
    """
    spark = _spark(tables)
    _, _, skipped = _plan_relationships(tables, rules)
    meta = _rule_frame(spark, rules, skipped)
    totals = _child_totals(tables, rules, skipped)
    res = meta.join(totals, "rule_id", "left").join(_per_rule(tables, rules), "rule_id", "left")
    ok = F.col("reason").isNull()
    total = F.when(ok, F.coalesce(F.col("total_records"), F.lit(0))).cast("bigint")
    nn = F.when(ok, F.coalesce(F.col("non_null_fk"), F.lit(0))).cast("bigint")
    bad = F.when(ok, F.coalesce(F.col("violation_count"), F.lit(0))).cast("bigint")
    out = res.select(
        "rule_id",
        "name",
        "child",
        "fk",
        "parent",
        "key",
        "rule_group",
        total.alias("total_records"),
        nn.alias("non_null_fk"),
        bad.alias("violation_count"),
        F.when(ok, pct(bad, total)).alias("pct_of_table"),
        F.when(ok, pct(bad, nn)).alias("pct_of_non_null"),
        F.when(~ok, F.lit("SKIPPED"))
        .when(bad == 0, F.lit("PASS"))
        .otherwise(F.lit("FAIL"))
        .alias("status"),
        "reason",
    )
    # Relationship-level wording of the same outcome.
    rel = F.when(~ok, F.lit("SKIPPED")).when(bad == 0, F.lit("VALID")).otherwise(F.lit("VIOLATED"))
    out = out.withColumn("relationship_status", rel)
    if not with_reason:
        out = out.drop("rule_id", "rule_group", "reason", "relationship_status")
    return out


def referential_sub_results(tables, rules: Sequence[Relationship]) -> DataFrame:
    """Suite rows: the tested (non-NULL) and the failed keys of each rule. Row totals are no part of them."""
    _, _, skipped = _plan_relationships(tables, rules)
    meta = _rule_frame(_spark(tables), rules, skipped)
    res = F.broadcast(meta).join(_per_rule(tables, rules), "rule_id", "left")  # a row per rule: bounded by configuration
    ok = F.col("reason").isNull()
    tested, bad = (F.when(ok, F.coalesce(F.col(c), F.lit(0))).cast("bigint") for c in ("non_null_fk", "violation_count"))
    return res.select(
        F.lit("referential_integrity").alias("suite"),
        F.col("rule_id").alias("seq"),
        F.col("name").alias("rule"),
        tested.alias("total_tested"),
        bad.alias("failed_records"),
        F.when(~ok, F.lit("SKIPPED")).when(bad == 0, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
        "reason",
    )


# ----------------------------------------------------------------------------- J6


def failing_keys(tables: Mapping[str, DataFrame], rules: Sequence[Relationship]) -> DataFrame:
    """Every orphan FK value: ``rule, key, n_records``."""
    spark = _spark(tables)
    names = literal_frame(
        spark,
        [(rid, r.label) for rid, r in enumerate(rules)], "rule_id int, rule string"
    )
    orphans = referential_keys(tables, rules).where(F.col("found").isNull())
    # The rule-name frame has one row per rule: bounded by configuration.
    return orphans.join(F.broadcast(names), "rule_id").select(
        "rule", "key", F.col("n").alias("n_records")
    )


def failing_keys_topk(
    tables: Mapping[str, DataFrame], rules: Sequence[Relationship], k: int = 10
) -> DataFrame:
    """J6 drill-down: per rule the ``k`` orphan keys with most rows (ties by key)."""
    fk = failing_keys(tables, rules)
    top = top_k_per_group(
        fk,
        ["rule"],
        [F.col("n_records").desc(), F.col("key").asc()],
        k,
        salt_cols=["key"],
    )
    return top.select("rule", "seq", "key", "n_records")


# ----------------------------------------------------------------------------- J2


def reference_check(tables: Mapping[str, DataFrame], rule: ReferenceCheck) -> DataFrame:
    """``name, total_tested, failed_records, failed_pct, passed``.

    ``mode="rows"`` reproduces counting rows after ``child LEFT JOIN parent``:
    a child row contributes ``max(parent matches, 1)`` rows and fails when it
    has no match (a NULL key never matches). Both sides are reduced to
    ``(key, count)`` first, so the fan-out is multiplied out arithmetically
    rather than materialised. ``mode="integrity"`` is J1 with the filter.
    """
    if rule.mode == "integrity":
        rel = Relationship(rule.child, rule.fk, rule.parent, rule.key, name=rule.name, filter=rule.filter)
        r = referential_integrity(tables, [rel])
        return r.select(
            "name",
            F.col("non_null_fk").alias("total_tested"),
            F.col("violation_count").alias("failed_records"),
            pct(F.col("violation_count"), F.col("non_null_fk")).alias("failed_pct"),
            (F.col("violation_count") == 0).alias("passed"),
        )
    child, parent = tables[rule.child], tables[rule.parent]
    fk = child[rule.fk]
    kids = child.where(all_of(rule.filter, fk.isNotNull() if rule.exclude_null_keys else None))
    kids = kids.groupBy(fk.alias("__k")).agg(F.count(F.lit(1)).alias("n"))
    par = (
        parent.where(parent[rule.key].isNotNull())
        .groupBy(parent[rule.key].alias("__pk"))
        .agg(F.count(F.lit(1)).alias("m"))
    )
    kind = common_key_type(_field_type(child, rule.fk), _field_type(parent, rule.key))
    own, theirs = kids["__k"], par["__pk"]
    joined = kids.join(par, own.cast(kind) == theirs.cast(kind) if kind else own == theirs, "left")
    counts = joined.agg(
        sum_long(F.col("n") * F.coalesce(F.col("m"), F.lit(1))).alias("total_tested"),
        sum_long(F.when(F.col("m").isNull(), F.col("n"))).alias("failed_records"),
    )
    tot, fail = F.col("total_tested"), F.col("failed_records")
    return counts.select(
        F.lit(rule.name).alias("name"), tot, fail, pct(fail, tot).alias("failed_pct"), (fail == 0).alias("passed")
    )


# ----------------------------------------------------------------------------- J3


# Parts that the rows of one key are dealt into, at most.
SALTS = 32
# Classes by hash in which the rows of a side are counted, and the share of its rows (one in so
# many) above which a class is dealt into parts.
CLASSES, SHARE = 8192, 1024


def _alike(a: T.DataType, b: T.DataType) -> Optional[str]:
    """The type in which equal values of two key columns hash alike; None where that isn't sure."""
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    if isinstance(a, whole) and isinstance(b, whole):
        return "bigint"
    plain = (T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType, T.DecimalType, T.FloatType, T.DoubleType)
    return a.simpleString() if a == b and (isinstance(a, plain) or a == T.StringType()) else None


def _dealt(left: DataFrame, right: DataFrame, same: Sequence[Tuple[str, str]], spread: Sequence[str]) -> Tuple[DataFrame, DataFrame]:
    """Both sides of a join on the column pairs ``same``, the rows of hot keys in parts: ``left`` with
    its row's ``__part``, dealt by the columns ``spread``; ``right`` with a copy and ``__salt`` per part.

    Left rows are counted by class of their key. A class of more than one in ``SHARE`` of them has parts
    in proportion, ``SALTS`` at most, and every other class one. All parts beyond one are ``SHARE`` at most, so
    right rows of many keys are copied about once in ``CLASSES / SHARE``, and those of few keys as often as their
    left rows need. Columns whose types may hash apart are left out of the classes.
    """
    kinds = [(a, b, _alike(left.schema[a].dataType, right.schema[b].dataType)) for a, b in same]

    def classed(df: DataFrame, names: Sequence[Tuple[str, Optional[str]]]) -> DataFrame:
        # One zero for floats.
        keys = [F.col(n).cast(k) + F.lit(0.0) if k in ("float", "double") else F.col(n).cast(k) for n, k in names if k]
        return df.withColumn("__class", F.pmod(F.xxhash64(*keys), F.lit(CLASSES)).cast("int"))

    if not any(k for *_, k in kinds):
        # Nothing tells hot keys from others: parts for all.
        part = F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int")
        return left.withColumn("__part", part), right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own, theirs = classed(left, [(a, k) for a, _, k in kinds]), classed(right, [(b, k) for _, b, k in kinds])
    counts = own.groupBy("__class").agg(F.count(F.lit(1)).alias("__n"))
    # One row with a pair per class, and then fewer rows than SHARE.
    hot = counts.agg(F.sum("__n").alias("__all"), F.collect_list(F.struct("__class", "__n")).alias("__c")).select("__all", F.inline("__c"))
    share = F.col("__n") * F.lit(SHARE)
    hot = F.broadcast(hot.where(share > F.col("__all")).select("__class", F.least(F.ceil(share / F.col("__all")), F.lit(SALTS)).cast("int").alias("__parts")))
    part = F.when(F.col("__parts").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(*spread), F.col("__parts"))).cast("int")
    own = own.join(hot, "__class", "left").withColumn("__part", part)
    theirs = theirs.join(hot, "__class", "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1)))
    return own.drop("__class", "__parts"), theirs.drop("__class", "__parts")

# Least and greatest seconds of a calendar unit, clock changes included (fixed values).
_UNITS = {
    "second": (1, 1), "minute": (60, 60), "hour": (3600, 3600), "day": (82_800, 90_000), "week": (601_200, 608_400),
    "month": (2_415_600, 2_682_000), "year": (31_532_400, 31_626_000),
}


def _seconds(offset, least: bool) -> float:
    """The least or greatest seconds of an interval text; 0 is none."""
    if not offset:
        return 0
    n, unit = str(offset).split()
    low, high = _UNITS[unit.lower().rstrip("s")]
    return min(int(n) * low, int(n) * high) if least else max(int(n) * low, int(n) * high)


def _is_time(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType))


def _bucket_width(rule: RelationshipExists, time: bool) -> Optional[float]:
    """Half of the least that a range of the rule can span, in the unit of its axis
    (microseconds or the numbers themselves); 0 for a single value, None without an end."""
    low, high = rule.within.low, rule.within.high
    if low is None or high is None:
        return None
    if time:
        span = 1_000_000 * (_seconds(high, True) - _seconds(low, False))
    elif isinstance(low, str) or isinstance(high, str):
        raise ValueError(f"{rule.name!r}: an interval needs dates or timestamps")
    else:
        span = high - low
    if str(low) == str(high):
        return 0
    if span <= 0:
        raise ValueError(f"{rule.name!r}: the range from {low!r} to {high!r} is empty, or its units leave its length open")
    return span / 2


class _Match:
    """How one rule's base keys find their joined rows.

    Base key columns are ``__b0 ..`` (the equalities), ``__x`` (the range) and ``__c0 ..``
    (base columns of the condition), so two base rows with one key have one answer.

    *Equalities*: an equi-join of distinct keys.

    *Range*: the joined side is reduced to least and greatest value per (keys, bucket), with
    buckets of half the span of a range. A base value meets the buckets that its range
    touches, four at most, by equality. As the range reaches beyond its first bucket, a
    joined value is in the range exactly if that bucket's greatest is not below the range
    or that of a later one's least not above it, so two numbers per bucket decide. Ranges with
    one end need one bucket. No joined rows are multiplied, no inequality is joined on.

    *Condition*: an equi-join of the distinct columns that the condition names, with the
    condition on top. Base keys of a hot equality are dealt into parts in either case, see ``_dealt``.
    """

    def __init__(self, tables: Mapping[str, DataFrame], rule: RelationshipExists):
        self.rule, self.base, self.joined = rule, tables[rule.base], tables[rule.joined]
        self.range, self.used = rule.within, ([], [])
        if rule.condition:
            parts = tokens(rule.condition)
            self.used = tuple(
                sorted({c for c in frame.columns for alias in [side] if _names(parts, alias, c)})
                for side, frame in (("b", self.base), ("j", self.joined))
            )
        if self.range:
            kinds = [_field_type(self.base, self.range.base), _field_type(self.joined, self.range.joined)]
            self.time = all(map(_is_time, kinds))
            if not self.time and not all(isinstance(k, T.NumericType) for k in kinds):
                raise ValueError(f"{rule.name!r}: a range needs two numbers or two dates or timestamps")
            self.width = _bucket_width(rule, self.time)

    # -- base side

    def key_columns(self) -> List[Column]:
        keys = [qcol(bc).alias(f"__b{i}") for i, (bc, _) in enumerate(self.rule.on)]
        if self.range:
            keys.append(qcol(self.range.base).alias("__x"))
        keys += [qcol(c).alias(f"__c{i}") for i, c in enumerate(self.used[0])]
        return [*keys, F.coalesce(all_of(self.rule.base_on), F.lit(False)).alias("__on")]

    def key_names(self) -> List[str]:
        return [f"__b{i}" for i in range(len(self.rule.on))] + ["__x"] * bool(self.range) + [f"__c{i}" for i in range(len(self.used[0]))]

    def can_match(self) -> Column:
        """Rows with a NULL key, or out by ``base_on``, have no match and skip the join."""
        return all_of(F.col("__on"), *[F.col(n).isNotNull() for n in self.key_names() if not n.startswith("__c")])

    # -- joined side

    def _axis(self, value: Column) -> Column:
        return F.unix_micros(value.cast("timestamp")) if self.time else value

    def _moved(self, offset) -> Column:
        x = F.col("__x")
        if isinstance(offset, str):
            n, unit = offset.split()
            # A date moved by less than a day is a timestamp.
            x = x.cast("timestamp") if unit.lower().rstrip("s") in ("second", "minute", "hour") else x
            return self._axis(x + F.expr(f"INTERVAL '{n}' {unit.rstrip('sS')}"))
        if self.time and offset:
            raise ValueError(f"{self.rule.name!r}: dates are moved by intervals, not by {offset!r}")
        return self._axis(x) if not offset else x + F.lit(offset)

    def _bucket(self, axis: Column) -> Column:
        if self.width is None:
            return F.lit(0).cast("bigint")
        return axis.cast("bigint") if self.width == 0 and self.time else axis.cast("double") if self.width == 0 else F.floor(axis.cast("double") / F.lit(float(self.width)))

    def _in_range(self, keys: DataFrame) -> DataFrame:
        """Of distinct base ``keys`` that can match, those with a joined value in their range."""
        w, names, n = self.range, self.key_names(), len(self.rule.on)
        ends = (
            self._others().where(qcol(w.joined).isNotNull()).select(*self._theirs(), self._axis(qcol(w.joined)).alias("__v"))
            .groupBy(*[f"__j{i}" for i in range(n)], self._bucket(F.col("__v")).alias("__jk"))
            .agg(F.min("__v").alias("__min"), F.max("__v").alias("__max"))
        )
        low = None if w.low is None else self._moved(w.low)
        high = None if w.high is None else self._moved(w.high)
        first, last = (self._bucket(x) if x is not None else F.lit(0).cast("bigint") for x in (low, high))
        own = keys.select(
            *names,
            (low if low is not None else F.lit(None).cast("bigint")).alias("__low"),
            (high if high is not None else F.lit(None).cast("bigint")).alias("__high"),
            (F.explode(F.sequence(first, last)) if self.width else first).alias("__k"),
        )
        inside = []
        if low is not None:
            inside.append(F.col("__max") > F.col("__low") if w.low_open else F.col("__max") >= F.col("__low"))
        if high is not None:
            inside.append(F.col("__min") < F.col("__high") if w.high_open else F.col("__min") <= F.col("__high"))
        # Ranges with one end have one bucket.
        same = [*[(f"__b{i}", f"__j{i}") for i in range(n)], *([("__k", "__jk")] if self.width is not None else [])]
        own, ends = _dealt(own, ends, same, names)
        hit = own.join(ends, all_of(F.col("__part") == F.col("__salt"), *[F.col(a) == F.col(b) for a, b in same], *inside), "left_semi")
        return hit.select(*names).distinct()

    def _others(self) -> DataFrame:
        return self.joined.where(all_of(self.rule.joined_on, *[qcol(jc).isNotNull() for _, jc in self.rule.on]))

    def _theirs(self) -> List[Column]:
        return [qcol(jc).alias(f"__j{i}") for i, (_, jc) in enumerate(self.rule.on)]

    def equal(self, other: str) -> List[Column]:
        """Key columns equal to those called ``other`` before their name; only a condition's may be NULL."""
        return [F.col(n).eqNullSafe(F.col(other + n)) if n.startswith("__c") else F.col(n) == F.col(other + n) for n in self.key_names()]

    def lone(self, keys: DataFrame, spread: Optional[str] = None) -> DataFrame:
        """Of base rows ``keys`` that can match, with distinct keys, those that don't. Rows of one
        key, which only equalities may have, are dealt by the column ``spread``."""
        rule, names, n = self.rule, self.key_names(), len(self.rule.on)
        same = [(f"__b{i}", f"__j{i}") for i in range(n)]
        if self.range and not rule.condition:
            hit = self._in_range(keys.select(*names)).select(*[F.col(n).alias(f"__m{n}") for n in names])
            return keys.join(hit, all_of(*self.equal("__m")), "left_anti")
        if not rule.condition:
            own, others = keys, self._others().select(*self._theirs()).distinct()
            equal = [F.col(a) == F.col(b) for a, b in same]
            if spread:
                own, others = _dealt(own, others, same, [spread])
                equal.insert(0, F.col("__part") == F.col("__salt"))
            return own.join(others, all_of(*equal), "left_anti").select(*keys.columns)
        more = [qcol(c).alias(f"__d{i}") for i, c in enumerate(self.used[1])]
        if self.range:
            more.append(self._axis(qcol(self.range.joined)).alias("__v"))
        own, others = _dealt(keys, self._others().select(*self._theirs(), *more).distinct(), same, names)
        # Columns under the condition's own aliases, whatever else is called like them.
        own = own.select("*", F.struct(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(self.used[0])], F.lit(0).alias("__none")).alias("b"))
        others = others.select("*", F.struct(*[F.col(f"__d{i}").alias(c) for i, c in enumerate(self.used[1])], F.lit(0).alias("__none")).alias("j"))
        terms = [rule.condition]
        if self.range:
            w, v = self.range, F.col("__v")
            if w.low is not None:
                terms.append(v > self._moved(w.low) if w.low_open else v >= self._moved(w.low))
            if w.high is not None:
                terms.append(v < self._moved(w.high) if w.high_open else v <= self._moved(w.high))
        return own.join(others, all_of(F.col("__part") == F.col("__salt"), *[F.col(a) == F.col(b) for a, b in same], *terms), "left_anti").select(*keys.columns)

    def key_of(self, column: str) -> Optional[str]:
        """The key column that holds a base column, if there is one."""
        held = [*[bc for bc, _ in self.rule.on], *([self.range.base] if self.range else []), *self.used[0]]
        return dict(zip(reversed(held), reversed(self.key_names()))).get(column) if "." not in column else None


def _names(parts, alias: str, column: str) -> bool:
    some = meaningful(parts)
    return any(
        a.name is not None and a.name.lower() == alias and dot.says(".") and c.name is not None and c.name.lower() == column.lower()
        for a, dot, c in zip(some, some[1:], some[2:])
    )


def _unrelated(tables: Mapping[str, DataFrame], rule: RelationshipExists) -> DataFrame:
    """``__e``: the distinct entities of which some row has no match."""
    match = _Match(tables, rule)
    base = tables[rule.base].where(all_of(rule.filter)).where(F.col(rule.entity).isNotNull())
    rows = base.select(*match.key_columns(), F.col(rule.entity).alias("__e"))
    names = match.key_names()
    out = rows.where(~match.can_match()).select("__e")
    able = rows.where(match.can_match()).drop("__on")
    if key := match.key_of(rule.entity):
        lone = match.lone(able.select(*names).distinct()).select(F.col(key).alias("__e"))
    elif not rule.within and not rule.condition:
        lone = match.lone(able.distinct(), "__e").select("__e")
    else:
        gone = match.lone(able.select(*names).distinct()).select(*[F.col(n).alias(f"__k{n}") for n in names])
        pairs, gone = _dealt(able.distinct(), gone, [(n, f"__k{n}") for n in names], ["__e"])
        lone = pairs.join(gone, all_of(F.col("__part") == F.col("__salt"), *match.equal("__k")), "left_semi").select("__e")
    return lone.union(out).distinct()


def unrelated_entities(tables: Mapping[str, DataFrame], rule: RelationshipExists) -> DataFrame:
    """J6 for J3: ``rule, entity``, every base entity with no related row, as text."""
    return _unrelated(tables, rule).select(F.lit(rule.name).alias("rule"), F.col("__e").cast("string").alias("entity"))


def failing_references(tables: Mapping[str, DataFrame], rule: ReferenceCheck) -> DataFrame:
    """J6 for J2: ``rule, key, n_records``, the keys (NULL too, unless excluded) of rows without a parent."""
    child, parent = tables[rule.child], tables[rule.parent]
    keys_only = rule.exclude_null_keys or rule.mode == "integrity"
    kids = child.where(all_of(rule.filter)).groupBy(child[rule.fk].alias("__k")).agg(F.count(F.lit(1)).alias("n_records"))
    kind = common_key_type(_field_type(child, rule.fk), _field_type(parent, rule.key))
    own, theirs = F.col("__k"), parent[rule.key]
    if kind:
        own, theirs = own.cast(kind), theirs.cast(kind)
    par = parent.where(parent[rule.key].isNotNull()).select(theirs.alias("__pk")).distinct()
    lone = kids.join(par, own == F.col("__pk"), "left_anti")
    if keys_only:
        lone = lone.where(F.col("__k").isNotNull())
    return lone.select(F.lit(rule.name).alias("rule"), F.col("__k").cast("string").alias("key"), "n_records")


def relationship_exists(tables: Mapping[str, DataFrame], rule: RelationshipExists) -> DataFrame:
    """Base entities (default) or rows with no matching ``joined`` row.

    Both sides are reduced before the join: the joined side to its distinct
    keys (a range: two values per bucket, see ``_Match``), the base side to ``(keys, n)``
    (rows mode) or to distinct keys. Keys that don't hold the entity are handed to their ``(keys,
    entity)`` pairs; equalities alone take the pairs to the join itself. A key on a third of the base
    rows is dealt into parts, see ``_dealt``. Rows with a NULL key never match, as in SQL; they skip the join.
    """
    base = tables[rule.base].where(all_of(rule.filter))
    if rule.count == "rows":
        match = _Match(tables, rule)
        names = match.key_names()
        pre = base.select(*match.key_columns()).groupBy(*names, "__on").agg(F.count(F.lit(1)).alias("__n"))
        able = pre.where(match.can_match())
        failed = match.lone(able)
        counts = (
            pre.select("__n", (~match.can_match()).alias("__miss"))
            .unionByName(failed.select((-F.col("__n")).alias("__n"), F.lit(True).alias("__miss")))
            .agg(
                sum_long(F.when(F.col("__n") > 0, F.col("__n"))).alias("total_tested"),
                sum_long(F.when(F.col("__miss"), F.abs("__n"))).alias("failed_records"),
            )
        )
    elif rule.count == "entities":
        total = base.agg(F.count_distinct(F.col(rule.entity)).alias("total_tested")).select(
            "total_tested", F.lit(None).cast("bigint").alias("failed_records")
        )
        failed = _unrelated(tables, rule).agg(F.lit(None).cast("bigint").alias("total_tested"), F.count(F.lit(1)).alias("failed_records"))
        # Two single-row aggregates stacked and folded.
        counts = total.unionByName(failed).agg(F.max("total_tested").alias("total_tested"), F.max("failed_records").alias("failed_records"))
    else:
        raise ValueError(f"count must be 'entities' or 'rows', not {rule.count!r}")
    tot, fail = F.col("total_tested"), F.col("failed_records")
    return counts.select(
        F.lit(rule.name).alias("name"), tot, fail, pct(fail, tot).alias("failed_pct"), (fail == 0).alias("passed")
    )


# ----------------------------------------------------------------------------- J4 / J5 core

def _tagged_codes(df: DataFrame, items: Sequence[Tuple[int, ConceptColumn]], key_type: Optional[str]) -> DataFrame:
    def k(c):
        return c.cast(key_type) if key_type else c

    elems = [F.struct(F.lit(rid).alias("rule_id"), k(qcol(cc.column)).alias("code")) for rid, cc in items]
    return df.select(F.explode(F.array(*elems)).alias("e")).select("e.rule_id", "e.code")


# Parts that the map rows of one concept are dealt into.
MAP_SALTS = 16

_CODES_SCHEMA = (
    "rule_id int, code string, n bigint, fan bigint, no_map bigint, no_concept bigint, null_display bigint, null_code bigint, no_label bigint"
)


def _resolved(cmap: DataFrame, concept: DataFrame, term: Terminology, key_type: Optional[str]) -> DataFrame:
    """One row per source code of the map, ``__src``: what the rows joined to it come to.

    ``fan`` joined rows in all; of these ``lost`` have no concept, ``dull`` a NULL display,
    ``bare`` a NULL code, ``poor`` either or no concept. Map rows are counted per (source,
    target) and concepts per id before they meet, so equal rows are multiplied as numbers;
    a concept that a third of the map points to meets its sources in ``MAP_SALTS`` parts.
    """
    src = cmap[term.map_source]
    pairs = (
        cmap.where(src.isNotNull())
        .groupBy((src.cast(key_type) if key_type else src).alias("__src"), cmap[term.map_target].alias("__tgt"))
        .agg(F.count(F.lit(1)).alias("c"))
        .withColumn("__part", F.pmod(F.xxhash64("__src"), F.lit(MAP_SALTS)).cast("int"))
    )
    no_display, no_code = concept[term.concept_display].isNull(), concept[term.concept_code].isNull()
    labels = (
        concept.where(concept[term.concept_id].isNotNull())
        .groupBy(concept[term.concept_id].alias("__cid"))
        .agg(F.count(F.lit(1)).alias("k"), F.count_if(no_display).alias("d"), F.count_if(no_code).alias("e"), F.count_if(no_display | no_code).alias("f"))
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(MAP_SALTS - 1))).alias("__salt"))
    )
    met = pairs.join(labels, (F.col("__tgt") == F.col("__cid")) & (F.col("__part") == F.col("__salt")), "left")
    c, lost = F.col("c"), F.col("k").isNull()
    return met.groupBy("__src").agg(
        F.sum(c * F.coalesce("k", F.lit(1))).alias("fan"),
        F.sum(F.when(lost, c).otherwise(0)).alias("lost"),
        *[F.sum(c * F.coalesce(x, F.lit(0))).alias(name) for name, x in (("dull", "d"), ("bare", "e"))],
        F.sum(c * F.coalesce("f", F.lit(1))).alias("poor"),
    )


def _resolve_codes(pre: DataFrame, cmap: DataFrame, concept: DataFrame, term: Terminology, key_type: Optional[str]) -> DataFrame:
    """``(rule_id, code, n)`` with the joined rows that each source row makes, and how many of
    them have no map row, no concept, a NULL display, a NULL code, or no label at all.

    A source is read once: its aggregate keeps the NULL code too, whose count makes up
    the row total. The NULL code meets no map row and has no fault.
    """
    j = pre.join(_resolved(cmap, concept, term, key_type), F.col("code") == F.col("__src"), "left")
    unmapped = F.col("code").isNotNull() & F.col("__src").isNull()

    def zero(c):
        return F.coalesce(F.col(c), F.lit(0)).cast("bigint")

    return j.select(
        "rule_id", "code", "n", F.coalesce("fan", F.lit(1)).cast("bigint").alias("fan"), unmapped.cast("bigint").alias("no_map"),
        zero("lost").alias("no_concept"), zero("dull").alias("null_display"), zero("bare").alias("null_code"),
        (zero("poor") + unmapped.cast("bigint")).alias("no_label"),
    )


def concept_codes(
    tables: Mapping[str, DataFrame], columns: Sequence[ConceptColumn], term: Terminology
) -> DataFrame:
    """A row per distinct code of every concept column, fused per key-type family; see
    ``_resolve_codes``. No row is multiplied: joined rows are numbers.

    Columns whose table or column is missing are left out (reported SKIPPED
    by the callers); without any column the terminology tables are not read.
    """
    present = [(rid, cc) for rid, cc in enumerate(columns) if not _missing_reason(tables, [(cc.table, cc.column)])]
    if not present:
        return literal_frame(_spark(tables), [], _CODES_SCHEMA)
    reason = _terminology_missing(tables, term)
    if reason:
        raise KeyError(reason)
    cmap, concept = tables[term.map_table], tables[term.concept_table]
    src_type = _field_type(cmap, term.map_source)
    fams: "OrderedDict[Optional[str], OrderedDict[str, List[Tuple[int, ConceptColumn]]]]" = OrderedDict()
    for rid, cc in present:
        ctype = _field_type(tables[cc.table], cc.column)
        fam = common_key_type(ctype, src_type)
        if fam is None and ctype != src_type:
            fam = "string"
        fams.setdefault(fam, OrderedDict()).setdefault(cc.table, []).append((rid, cc))
    frames = []
    for fam, by_table in fams.items():
        codes = _union_all([_tagged_codes(tables[t], its, fam) for t, its in by_table.items()])
        pre = codes.groupBy("rule_id", "code").agg(F.count(F.lit(1)).alias("n"))
        frames.append(_resolve_codes(pre, cmap, concept, term, fam).withColumn("code", F.col("code").cast("string")))
    return _union_all(frames)


# Joined rows of one source row that have each fault.
_FAULTS = {
    "failed": "no_label", "no_map": "no_map", "no_concept": "no_concept", "null_display": "null_display", "null_code": "null_code",
    "mapping": "no_map + no_concept + null_code", "display": "no_label - no_map - no_concept",
}


def concept_metrics(
    tables: Mapping[str, DataFrame], columns: Sequence[ConceptColumn], term: Terminology
) -> DataFrame:
    """Every count of J4 and J5, a row per concept column (those that can't be tested: with
    their ``reason`` and no counts): ``rows`` and ``non_null`` of the source, ``joined_rows`` and
    ``ids`` of its codes, and ``<fault>_records`` and ``<fault>_ids`` of ``_FAULTS``."""
    codes = concept_codes(tables, columns, term)
    coded = F.col("code").isNotNull()
    aggs = [
        sum_long(F.col("n")).alias("rows"),
        sum_long(F.when(coded, F.col("n"))).alias("non_null"),
        sum_long(F.when(coded, F.expr("n * fan"))).alias("joined_rows"),
        F.count_if(coded).alias("ids"),
    ]
    for name, times in _FAULTS.items():
        aggs += [sum_long(F.expr(f"n * ({times})")).alias(f"{name}_records"), F.count_if(F.expr(times) > 0).alias(f"{name}_ids")]
    per_rule = codes.groupBy("rule_id").agg(*aggs)
    meta = _concept_meta(_spark(tables), columns, tables)
    counts = ["rows", "non_null", "joined_rows", "ids", *[f"{n}_{s}" for n in _FAULTS for s in ("records", "ids")]]
    # One row per concept column: bounded by configuration.
    return F.broadcast(meta).join(per_rule, "rule_id", "left").select(
        *meta.columns,
        *[F.when(F.col("reason").isNull(), F.coalesce(F.col(c), F.lit(0)).cast("bigint")).alias(c) for c in counts],
    )


def _tested(failed: Column) -> List[Column]:
    status = F.when(F.col("reason").isNotNull(), F.lit("SKIPPED")).when(failed == 0, F.lit("PASS")).otherwise(F.lit("FAIL"))
    return [F.when(F.col("reason").isNull(), failed == 0).alias("passed"), status.alias("status"), "reason"]


def _terminology_missing(tables: Mapping[str, DataFrame], term: Terminology) -> Optional[str]:
    return _missing_reason(
        tables,
        [
            (term.map_table, term.map_source),
            (term.map_table, term.map_target),
            (term.concept_table, term.concept_id),
            (term.concept_table, term.concept_display),
            (term.concept_table, term.concept_code),
        ],
    )


def _concept_meta(
    spark: SparkSession, columns: Sequence[ConceptColumn], tables: Optional[Mapping[str, DataFrame]] = None
) -> DataFrame:
    rows = []
    for rid, cc in enumerate(columns):
        reason = _missing_reason(tables, [(cc.table, cc.column)]) if tables is not None else None
        rows.append((rid, cc.label, cc.table, cc.column, reason))
    return literal_frame(
        spark, rows, "rule_id int, name string, source_table string, concept_field string, reason string"
    )


def concept_mapping_breakdown(
    tables: Mapping[str, DataFrame],
    columns: Sequence[ConceptColumn],
    term: Terminology = Terminology(),
    *,
    with_sections: bool = False,
) -> DataFrame:
    """Per column the 12 metrics over joined (fanned) rows with non-NULL code.

    ``total_records, distinct_ids, failed_records, failed_ids, no_map_records,
    no_map_ids, no_concept_records, no_concept_ids, null_display_records,
    null_display_ids, null_code_records, null_code_ids, passed, status, reason``. A
    NULL-display and a NULL-code row counts in both buckets. A column that can't be
    tested is SKIPPED with its reason: no counts, neither passed nor failed.
    ``with_sections`` adds ``mapping_records, mapping_ids`` (no map, no concept or NULL code).
    """
    names = ["failed", "no_map", "no_concept", "null_display", "null_code"] + ["mapping"] * with_sections
    return concept_metrics(tables, columns, term).select(
        "rule_id",
        "name",
        F.col("joined_rows").alias("total_records"),
        F.col("ids").alias("distinct_ids"),
        *[f"{n}_{s}" for n in names for s in ("records", "ids")],
        *_tested(F.col("failed_records")),
    )


def concept_mapping_rates(
    tables: Mapping[str, DataFrame],
    columns: Sequence[ConceptColumn],
    term: Terminology = Terminology(),
    *,
    with_meta: bool = False,
) -> DataFrame:
    """``name, total_records, non_null_records, mapping_failures,
    distinct_missing_mappings, display_failures, distinct_display_failures,
    total_failures, distinct_total_failures, pct_of_table, pct_of_non_null, passed,
    status, reason``.

    Row counts are fanned joined rows; denominators are un-fanned table counts,
    so a rate can exceed 100 %. A column with no non-NULL code passes (all sums
    are 0, not NULL); one that can't be tested is SKIPPED.
    """
    fails, tot, nn = F.col("failed_records"), F.col("rows"), F.col("non_null")
    ok = F.col("reason").isNull()
    out = concept_metrics(tables, columns, term).select(
        "rule_id",
        "name",
        "source_table",
        "concept_field",
        tot.alias("total_records"),
        nn.alias("non_null_records"),
        F.col("no_map_records").alias("mapping_failures"),
        F.col("no_map_ids").alias("distinct_missing_mappings"),
        F.col("display_records").alias("display_failures"),
        F.col("display_ids").alias("distinct_display_failures"),
        fails.alias("total_failures"),
        F.col("failed_ids").alias("distinct_total_failures"),
        F.when(ok, pct(fails, tot)).alias("pct_of_table"),
        F.when(ok, pct(fails, nn)).alias("pct_of_non_null"),
        *_tested(fails),
    )
    if not with_meta:
        out = out.drop("rule_id", "source_table", "concept_field")
    return out


# Suites of internal rows that carry the report's sections of a concept column.
BUCKET_SUITES = {"__concept_mapping": "mapping", "__concept_display": "null_display"}


def concept_sub_results(tables, columns: Sequence[ConceptColumn], term: Terminology, *, buckets: bool = False) -> DataFrame:
    """Suite rows; a missing source column is SKIPPED, missing terminology tables make every
    rule ERROR. ``buckets`` adds internal rows for the failure report (``BUCKET_SUITES``):
    joined rows, those of the section, and as ``reason`` the number of codes."""
    spark = _spark(tables)
    why = _terminology_missing(tables, term)
    if columns and why:
        return literal_frame(
            spark,
            [("concept_mapping", rid, cc.label, None, None, "ERROR", why) for rid, cc in enumerate(columns)],
            SUB_RESULT_SCHEMA,
        )

    def row(suite, total, failed, status, reason):
        return (
            f"named_struct('suite', '{suite}', 'seq', rule_id, 'rule', name, 'total_tested', {total}, "
            f"'failed_records', {failed}, 'status', {status}, 'reason', {reason})"
        )

    status = "case when reason is not null then 'SKIPPED' when failed_records = 0 then 'PASS' else 'FAIL' end"
    rows = [row("concept_mapping", "non_null", "failed_records", status, "reason")]
    if buckets:
        rows += [row(suite, "joined_rows", f"{b}_records", "''", f"cast({b}_ids as string)") for suite, b in BUCKET_SUITES.items()]
    return concept_metrics(tables, columns, term).select(F.expr("inline(array(" + ", ".join(rows) + "))"))


def concept_failing_codes(
    tables: Mapping[str, DataFrame], columns: Sequence[ConceptColumn], term: Terminology = Terminology()
) -> DataFrame:
    """J6 for concept columns: every failing code with its reasons.

    ``rule, code, n_records, no_map, no_concept, null_display, null_code``;
    ``n_records`` counts source rows (not fanned map rows). A code fails when
    it has no map row, a map row without concept, or a concept with a NULL
    display or code.
    """
    codes = concept_codes(tables, columns, term).where("code is not null and no_label > 0")
    names = _concept_meta(_spark(tables), columns).select("rule_id", F.col("name").alias("rule"))
    # The rule-name frame has one row per concept column: bounded by configuration.
    return codes.join(F.broadcast(names), "rule_id").select(
        "rule", "code", F.col("n").alias("n_records"), *[(F.col(c) > 0).alias(c) for c in ("no_map", "no_concept", "null_display", "null_code")]
    )
