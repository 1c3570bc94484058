"""Incremental validation over a file stream equals the batch check on the whole table."""

import tempfile

from pyspark.sql import functions as F

from verisift.operators.joins import referential_integrity
from verisift.operators.rowrules import row_checks
from verisift.rules import RangeCheck, Relationship, RequiredFields
from verisift.sources import load_tables
from verisift.streaming import foreign_key_check, row_rule_check, stream_totals, validate_stream

SF = "/root/testdata/sf0.001"


def _stage_stream(spark, df, n_files, path):
    # Same rows, written as several files so the stream sees several batches.
    df.repartition(n_files, "event_id").write.mode("overwrite").parquet(path)


def test_stream_equals_batch(spark):
    t = load_tables(spark, SF, ["events", "customer", "supplier"])
    events = t["events"].withColumn("type_or_null", F.when(F.col("event_id") % 7 == 0, None).otherwise(F.col("event_type")))
    work = tempfile.mkdtemp(prefix="verisift-stream-")
    src = f"{work}/src"
    _stage_stream(spark, events, 4, src)

    rules = (
        RequiredFields("type_present", "events", ("type_or_null",)),
        RangeCheck("value_range", "events", "value", 0, 40, cast_to="double", exclude_empty=False),
    )
    rels = (Relationship("events", "user_id", "customer", "c_custkey"), Relationship("events", "user_id", "supplier", "s_suppkey"))

    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(src)
    for check, out in ((row_rule_check("events", rules), "rows"), (foreign_key_check("events", t, rels), "fk")):
        q = validate_stream(stream, check, f"{work}/{out}", f"{work}/ckpt_{out}")
        q.processAllAvailable()
        q.stop()

    rows = {r["rule"]: (r["total_tested"], r["failed_records"], r["batches"]) for r in stream_totals(spark, f"{work}/rows").collect()}
    full = {r["name"]: (r["total_tested"], r["failed_records"]) for r in row_checks({"events": events}, rules).collect()}
    assert {k: v[:2] for k, v in rows.items()} == full
    assert all(v[2] == 4 for v in rows.values())

    fk = {r["rule"]: (r["total_tested"], r["failed_records"]) for r in stream_totals(spark, f"{work}/fk").collect()}
    tables = dict(t)
    tables["events"] = events
    batch = {r["name"]: (r["non_null_fk"], r["violation_count"]) for r in referential_integrity(tables, rels).collect()}
    assert fk == batch


def test_replayed_batch_overwrites_its_partial(spark):
    from verisift.streaming.incremental import batch_writer, stream_totals

    work = tempfile.mkdtemp(prefix="verisift-replay-")
    t = load_tables(spark, SF, ["events"])
    check = row_rule_check("events", (RequiredFields("has_type", "events", ("event_type",)),))
    path = f"{work}/parts"
    write = batch_writer(check, path)  # the function validate_stream hands to foreachBatch

    write(t["events"], 0)
    write(t["events"], 1)
    write(t["events"], 1)  # replay of batch 1 after a failure
    r = stream_totals(spark, path).collect()[0]
    n = t["events"].count()
    assert (r["total_tested"], r["batches"]) == (2 * n, 2)
