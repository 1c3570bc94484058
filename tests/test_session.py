"""Checkpoint folder policy and push-down detection."""

from verisift.session import aggregate_pushdown_enabled, ensure_checkpoint_dir


def test_checkpoint_dir_is_stable(spark):
    first = ensure_checkpoint_dir(spark)
    assert first and ensure_checkpoint_dir(spark) == first
    assert spark.sparkContext.getCheckpointDir() == first


def test_pushdown_detection(spark):
    before = spark.conf.get("spark.sql.parquet.aggregatePushdown")
    try:
        spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        assert aggregate_pushdown_enabled(spark)
        spark.conf.set("spark.sql.parquet.aggregatePushdown", "false")
        assert not aggregate_pushdown_enabled(spark)
    finally:
        spark.conf.set("spark.sql.parquet.aggregatePushdown", before)
