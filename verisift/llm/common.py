"""What the operators share: reading tables, shipping code, lineage cuts, keyed samples."""

from __future__ import annotations

import io
import os
import uuid
import zipfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verisift.session import ensure_checkpoint_dir

_SHIPPED = "_verisift_shipped"
WORK = "verisift_work"


def ship(spark: SparkSession) -> None:
    """Hand this package to the Python workers, once per Spark context.

    Workers of a cluster need not have the library installed; Spark sends the
    zip to every executor, also to those that join later.
    """
    sc = spark.sparkContext
    if getattr(sc, _SHIPPED, False):
        return
    import tempfile

    import verisift

    top = os.path.dirname(os.path.abspath(verisift.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="verisift-code-"), "verisift_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("verisift", os.path.relpath(full, top)))
    sc.addPyFile(path)
    setattr(sc, _SHIPPED, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """``df`` checkpointed in ``spark.checkpoint.dir``: computed once, recoverable from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder name for a table below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def bucketed(df: DataFrame, kind: str, key: str) -> DataFrame:
    """``df`` written once to the shared folder, a folder per value of ``kind``, in buckets
    by ``key``: a later grouping by ``key`` finds it dealt out already, with no shuffle.

    Buckets need a table entry: ``verisift_work.rows_...``, in a database of its own, as the
    caller's may be listed. ``drop_work_tables`` takes the entries away when results have been written.
    """
    spark = df.sparkSession
    name = f"rows_{uuid.uuid4().hex}"
    path = fresh_path(spark, name)
    spark.sql(f"create database if not exists {WORK}")
    name = f"{WORK}.{name}"
    (
        df.write.partitionBy(kind).bucketBy(shuffle_width(spark), key).option("path", path)
        .option("compression", "none").format("parquet").saveAsTable(name)
    )
    return spark.table(name)


def drop_work_tables(spark: SparkSession) -> None:
    if spark.catalog.databaseExists(WORK):
        for t in spark.catalog.listTables(WORK, "rows_*"):
            spark.sql(f"drop table if exists {WORK}.{t.name}")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(doc_id, n: int):
    """crc32 of the id as text, modulo ``n``; -1 for a null id (in no fold)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % F.lit(n), F.lit(-1))


def packed(df: DataFrame, fn, schema) -> DataFrame:
    """``mapInArrow`` where ``fn(batches)`` yields dicts of equal-length lists or arrays."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    want = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    ship(df.sparkSession)
    arrow = to_arrow_schema(want)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for cols in fn(batches):
            yield pa.RecordBatch.from_arrays([as_arrow(cols[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, want)


def as_arrow(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, kind)


def small_pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that one holds about ``limit`` bytes of ``column``, and never less than a row."""
    for b in batches:
        n, col = b.num_rows, b.column(column)
        if n == 0:
            continue
        step = max(1, min(n, int(n * limit / max(col.nbytes, 1))))
        for at in range(0, n, step):
            yield b.slice(at, step)


def give_back() -> None:
    """Return freed memory of this process to the system. Python workers are kept for later
    tasks; what one held for its largest batch would stay with it beside the JVM's heap."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def pickled(obj) -> bytes:
    import pickle

    out = io.BytesIO()
    pickle.dump(obj, out, protocol=4)
    return out.getvalue()
