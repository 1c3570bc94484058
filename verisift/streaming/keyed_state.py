"""Incremental checks whose counts do not add up across batches (A4 for R1, R5 and J1).

Uniqueness, group counts and foreign keys whose parents arrive later need the keys
seen so far. Each batch leaves one keyed delta, ``(rule, key, sub, n, parent)``: how many
rows it brought for a key (and, for group counts, for a counted value ``sub`` of it),
and how many parent or base rows. The state is the sum of the batches' deltas.

A batch is merged in four steps:

1. Its delta, grouped once for all rules, is written under an attempt of its own.
2. The change is that delta in the place of the one the batch left before, if it is a
   replay. A replay of the same rows changes nothing; of other rows, what differs.
3. The keys of the change meet their rows of the state in one grouping. What they were
   worth before and after gives each rule's difference of tested and failed records; keys
   that the change doesn't have differ by nothing, and where it has few of them (``FEW``),
   the others are left out before.
4. One small commit file names the attempt and holds the new totals. A batch that died
   before it has left an attempt that nobody reads.

Keys are compared as text, integral and text keys by the same rules as in ``joins``.
A hot key is one row per map partition and batch. ``compact`` sums old batches into one.
"""

from __future__ import annotations

import uuid
from typing import Dict, List, Mapping, Optional, Sequence, Tuple, Union

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import all_of, common_key_type, pct, qcol
from ..functions.frames import literal_frame
from ..rules import GroupCount, Relationship, Uniqueness

KeyedRule = Union[Uniqueness, GroupCount, Relationship]

DELTA = "rule int, key string, sub string, n bigint, parent bigint"
COMMIT = "seq bigint, batch_id bigint, attempt string, upto bigint, rule int, total_tested bigint, failed_records bigint"
#: The batch that holds what ``compact`` has summed.
BASE = -1
#: A change of less than one row in so many of the state has few keys.
FEW = 16


def _name(rule: KeyedRule) -> str:
    return rule.label if isinstance(rule, Relationship) else rule.name


def _kind(rule: KeyedRule) -> str:
    return {Uniqueness: "unique", GroupCount: "group", Relationship: "fk"}[type(rule)]


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _key(df: DataFrame, column: str, kind: Optional[str] = None) -> Column:
    """A column as key: text, but whole numbers as they are."""
    c, t = qcol(column), df.schema[column].dataType
    if kind:
        c = c.cast(kind)
    elif isinstance(t, (T.FloatType, T.DoubleType)):
        c = c + F.lit(0.0)  # one zero
    return c if isinstance(t, _WHOLE) and kind in (None, "bigint") else c.cast("string")


class KeyedState:
    """The keyed state of ``rules`` below ``path``, which must be shared storage."""

    def __init__(self, spark: SparkSession, path: str, rules: Sequence[KeyedRule]):
        for r in rules:
            if not isinstance(r, (Uniqueness, GroupCount, Relationship)):
                raise TypeError(f"no keyed state for {r!r}; its counts add up")
            if isinstance(r, GroupCount) and r.joined and (len(r.on) != 1 or r.on[0][0] != r.group_key):
                raise ValueError(f"{r.name!r} joins on more than its group key")
        self.spark, self.path, self.rules = spark, path.rstrip("/"), list(rules)

    # -- commits

    def _exists(self, folder: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(folder)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(at)

    def commits(self) -> DataFrame:
        if not self._exists(f"{self.path}/commits"):
            return literal_frame(self.spark, [], COMMIT)
        return self.spark.read.schema(COMMIT).option("recursiveFileLookup", "true").parquet(f"{self.path}/commits")

    def _live(self) -> Tuple[int, int, Dict[int, str], Dict[int, Tuple[int, int]]]:
        """Last commit's number, the last batch compacted, each batch's attempt, and the totals by rule."""
        rows = self.commits().collect()  # a row per rule and commit
        if not rows:
            return 0, BASE, {}, {}
        last = max(r.seq for r in rows)
        upto = max(r.upto for r in rows)
        attempts: Dict[int, str] = {}
        for r in sorted(rows, key=lambda r: r.seq):
            if r.batch_id > upto or r.batch_id == BASE:
                attempts[r.batch_id] = r.attempt
        return last, upto, attempts, {r.rule: (r.total_tested, r.failed_records) for r in rows if r.seq == last}

    def _commit(self, seq: int, batch_id: int, attempt: str, upto: int, totals: Mapping[int, Tuple[int, int]]) -> None:
        rows = [(seq, batch_id, attempt, upto, k, *totals.get(k, (0, 0))) for k in range(len(self.rules))]
        # The file of a commit replaces that of a run which died with this number.
        literal_frame(self.spark, rows, COMMIT).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/{seq}")

    def _delta_at(self, batch_id: int, attempt: str) -> str:
        return f"{self.path}/deltas/{batch_id}-{attempt}"

    def _read(self, attempts: Mapping[int, str]) -> DataFrame:
        if not attempts:
            return literal_frame(self.spark, [], DELTA)
        return self.spark.read.schema(DELTA).parquet(*[self._delta_at(b, a) for b, a in attempts.items()])

    # -- batches

    def delta(self, tables: Mapping[str, DataFrame], schemas: Mapping[str, DataFrame]) -> DataFrame:
        """What a batch's new rows bring, grouped. ``schemas`` has (empty) frames of tables that it brings no rows of."""
        known = {**schemas, **tables}
        frames: List[DataFrame] = []

        whole: List[DataFrame] = []

        def rows(table, where, rule, key, sub, n, parent, columns):
            if table in tables:
                # Whole numbers are grouped as such and written as text after.
                numbers = all(isinstance(c, _WHOLE) for c in columns)
                (whole if numbers else frames).append(
                    tables[table].where(all_of(*where)).select(
                        F.lit(rule).alias("rule"), *[c.cast("bigint" if numbers else "string").alias(name) for name, c in (("key", key), ("sub", sub))],
                        F.lit(n).cast("bigint").alias("n"), F.lit(parent).cast("bigint").alias("parent"),
                    )
                )

        none = F.lit(None).cast("string")

        def of(table, column):
            return known[table].schema[column].dataType

        for k, r in enumerate(self.rules):
            if isinstance(r, Uniqueness) and r.table in tables:
                where = [r.filter] if r.count_nulls else [r.filter, qcol(r.column).isNotNull()]
                rows(r.table, where, k, _key(tables[r.table], r.column), none, 1, 0, [of(r.table, r.column)])
            elif isinstance(r, GroupCount):
                if r.joined is None and r.base in tables:
                    columns = [of(r.base, r.group_key), of(r.base, r.counted)]
                    rows(r.base, [r.filter], k, _key(tables[r.base], r.group_key), _key(tables[r.base], r.counted), 1, 1, columns)
                elif r.joined:
                    (bc, jc), = r.on
                    columns = [of(r.base, bc), of(r.joined, jc), of(r.joined, r.counted)]
                    kind = common_key_type(*columns[:2])
                    rows(r.base, [r.filter], k, _key(known[r.base], bc, kind), none, 0, 1, columns)
                    rows(r.joined, [r.join_filter, qcol(jc).isNotNull()], k, _key(known[r.joined], jc, kind), _key(known[r.joined], r.counted), 1, 0, columns)
            elif isinstance(r, Relationship):
                types = of(r.child, r.fk), of(r.parent, r.key)
                kind = common_key_type(*types) or ("double" if types[0] != types[1] else None)
                rows(r.child, [r.filter, qcol(r.fk).isNotNull()], k, _key(known[r.child], r.fk, kind), none, 1, 0, types)
                rows(r.parent, [qcol(r.key).isNotNull()], k, _key(known[r.parent], r.key, kind), none, 0, 1, types)
        out = None
        for stacked in (whole, frames):
            if stacked:
                both = stacked[0]
                for f in stacked[1:]:
                    both = both.unionByName(f)
                both = both.groupBy("rule", "key", "sub").agg(F.sum("n").alias("n"), F.sum("parent").alias("parent"))
                both = both.withColumns({c: F.col(c).cast("string") for c in ("key", "sub")})
                out = both if out is None else out.unionByName(both)
        return literal_frame(self.spark, [], DELTA) if out is None else out

    def merge(self, tables: Mapping[str, DataFrame], batch_id: int, schemas: Mapping[str, DataFrame] = {}) -> None:
        """Add a batch's new rows of ``tables``, or put them in the place of those it added before."""
        last, upto, attempts, totals = self._live()
        if batch_id <= upto:
            raise ValueError(f"batch {batch_id} has been compacted (up to {upto}) and can't be replayed")
        attempt = uuid.uuid4().hex
        self.delta(tables, schemas).write.parquet(self._delta_at(batch_id, attempt))
        after, before = self._read({batch_id: attempt}), None
        kept = {b: a for b, a in attempts.items() if b != batch_id}
        if batch_id in attempts:
            before = self._read({batch_id: attempts[batch_id]})
        for r in self._differences(self._read(kept) if kept else None, before, after).collect():  # a row per rule
            tested, failed = totals.get(r.rule, (0, 0))
            totals[r.rule] = (tested + r.tested, failed + r.failed)
        self._commit(last + 1, batch_id, attempt, upto, totals)

    def _differences(self, kept: Optional[DataFrame], before: Optional[DataFrame], after: DataFrame) -> DataFrame:
        """``rule, tested, failed``: by how much the changed keys' records differ, where the rows ``after``
        come to those ``kept``, in the place of those ``before``. Only the rows of a group count have a
        ``sub`` and are grouped by it first; a key of the others is a row per batch."""
        change = after if before is None else after.unionByName(before)
        # Both are counted in the files' footers.
        if kept is not None and change.count() * FEW < kept.count():
            touched = change.select(F.col("rule").alias("r"), F.col("key").alias("k")).distinct()
            kept = kept.join(touched, (F.col("rule") == F.col("r")) & F.col("key").eqNullSafe(F.col("k")), "left_semi")
        rows = None
        for frame, was, now in ((kept, 1, 1), (before, 1, 0), (after, 0, 1)):
            if frame is not None:
                frame = frame.select("*", F.lit(was).alias("was"), F.lit(now).alias("now"))
                rows = frame if rows is None else rows.unionByName(frame)
        sums = [F.sum(F.when(F.col(at) == 1, F.col(c)).otherwise(0)).alias(name) for name, at, c in (("n0", "was", "n"), ("n1", "now", "n"), ("p0", "was", "parent"), ("p1", "now", "parent"))]
        grouped = F.col("rule").isin([k for k, r in enumerate(self.rules) if isinstance(r, GroupCount)])
        by_sub = rows.where(grouped).groupBy("rule", "key", "sub").agg(*sums)
        some = F.col("sub").isNotNull()
        by_key = by_sub.groupBy("rule", "key").agg(
            *[F.sum(c).alias(c) for c in ("n0", "n1", "p0", "p1")],
            F.count_if(some & (F.col("n0") > 0)).alias("d0"), F.count_if(some & (F.col("n1") > 0)).alias("d1"),
        )
        plain = rows.where(~grouped).drop("sub").repartition("rule", "key").groupBy("rule", "key").agg(*sums)
        none = F.lit(0).cast("bigint")
        by_key = by_key.unionByName(plain.withColumns({"d0": none, "d1": none}))
        kinds = [(k, _kind(r), r.min_count if isinstance(r, GroupCount) else 0) for k, r in enumerate(self.rules)]
        # One row per rule: bounded by configuration.
        known = by_key.join(F.broadcast(literal_frame(self.spark, kinds, "rule int, kind string, least int")), "rule")

        def worth(v: int) -> Tuple[Column, Column]:
            n, p, d = F.col(f"n{v}"), F.col(f"p{v}"), F.col(f"d{v}")
            group, fk = F.col("kind") == "group", F.col("kind") == "fk"
            surplus = F.when(F.col("key").isNull(), n).otherwise(F.greatest(n - 1, F.lit(0)))
            failed = F.when(group, ((d > F.col("least")) & (p > 0)).cast("bigint")).when(fk, F.when(p > 0, 0).otherwise(n)).otherwise(surplus)
            return F.when(group, p).otherwise(n), failed

        (t0, f0), (t1, f1) = worth(0), worth(1)
        return known.groupBy("rule").agg(F.sum(t1 - t0).alias("tested"), F.sum(f1 - f0).alias("failed"))

    def compact(self, keep_last: int = 1) -> None:
        """Sum all batches but the last ``keep_last`` into one; those can't be replayed any more."""
        last, upto, attempts, totals = self._live()
        old = sorted(b for b in attempts if b != BASE)[: -keep_last or None]
        if not old:
            return
        summed = {b: a for b, a in attempts.items() if b in old or b == BASE}
        attempt = uuid.uuid4().hex
        rows = self._read(summed)
        if len(summed) > 1:  # one batch is grouped already
            rows = rows.groupBy("rule", "key", "sub").agg(F.sum("n").alias("n"), F.sum("parent").alias("parent"))
        rows.where("n <> 0 or parent <> 0").write.parquet(self._delta_at(BASE, attempt))
        self._commit(last + 1, BASE, attempt, max(old), totals)

    def totals(self) -> DataFrame:
        """``rule, kind, total_tested, failed_records, failed_pct, passed`` after all batches."""
        last = self.commits().agg(F.max("seq").alias("seq"))
        # A single row.
        now = self.commits().join(F.broadcast(last), "seq").select(F.col("rule").alias("k"), "total_tested", "failed_records")
        names = literal_frame(self.spark, [(k, _name(r), _kind(r)) for k, r in enumerate(self.rules)], "k int, rule string, kind string")
        tot, fail = F.coalesce("total_tested", F.lit(0)), F.coalesce("failed_records", F.lit(0))
        return F.broadcast(names).join(now, "k", "left").select(
            "rule", "kind", tot.alias("total_tested"), fail.alias("failed_records"), pct(fail, tot).alias("failed_pct"),
            # Group counts are informational.
            ((fail == 0) | (F.col("kind") == "group")).alias("passed"),
        )

    def writer(self, table: str, schemas: Mapping[str, DataFrame] = {}):
        """The ``foreachBatch`` function of a stream of ``table``'s new rows."""

        def write_batch(batch: DataFrame, batch_id: int) -> None:
            self.merge({table: batch}, batch_id, schemas)

        return write_batch
