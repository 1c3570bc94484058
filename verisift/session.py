"""Session helpers.

Library code never changes session settings: a cluster's configuration is the
operator's business. ``local_session`` is for tests and the benchmark only, and
``ensure_checkpoint_dir`` sets a checkpoint folder only where none is set.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the checks are designed around (AQE re-plans joins from measured
# sizes and splits skewed partitions); a cluster is expected to have them on.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Parquet through the V2 source with aggregate push-down: count(*) and
    # count(col) are answered from row-group footers (row and null counts), so
    # the all-NULL-column, empty-table and completeness suites read no column
    # data. Needs files written with statistics (the common writers do).
    "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def aggregate_pushdown_enabled(spark: SparkSession) -> bool:
    """Whether count aggregates over parquet can be answered from footers."""
    on = (spark.conf.get("spark.sql.parquet.aggregatePushdown", "false") or "").lower() == "true"
    v1 = (spark.conf.get("spark.sql.sources.useV1SourceList", "") or "").lower()
    return on and "parquet" not in [x.strip() for x in v1.split(",")]


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``.

    Where the setting is absent, a folder of its own below the session's warehouse,
    which all executors see, whatever the master is.
    """
    sc = spark.sparkContext
    current = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        current = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/verisift-checkpoints-{uuid.uuid4().hex}"
    # ``spark.checkpoint.dir`` is a core setting that cannot be changed at run
    # time; the context's checkpoint folder is set directly instead.
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "verisift") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir() and not spark.sparkContext.getConf().get("spark.checkpoint.dir", None):
        # This session's executor is this process: any folder of this machine is shared.
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="verisift-ckpt-"))
    return spark
