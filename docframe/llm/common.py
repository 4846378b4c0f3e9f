"""Helpers shared by the training-data operators: shared scratch space, size-checked broadcasts, small expressions."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_scratch: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir`` of the session, which all executors share.

    It goes when the application ends. Only on a local master, where all tasks run on this machine, an unset
    ``spark.checkpoint.dir`` is replaced by a temporary folder; elsewhere that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="docframe-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    folder = f"{base.rstrip('/')}/{spark.sparkContext.applicationId}"
    if folder not in _scratch:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
        _scratch.add(folder)
    return folder


def scratch(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def fresh(label: str) -> str:
    """A column name that no table has."""
    return f"_{label}_{uuid.uuid4().hex[:12]}"


#: Rows and bytes of an Arrow batch: texts can be long, and a Python worker holds a whole batch.
BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to ``BATCH_ROWS`` rows and ``BATCH_BYTES`` bytes, unless they are smaller already.

    Batches are a setting of the session that counts when a plan runs, so it stays lowered.
    """
    for name, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(name, str(1 << 30)).lower().removesuffix("b")
        if not (now.isdigit() and 0 < int(now) <= most):
            spark.conf.set(name, str(most))


def give_back() -> None:
    """Return freed memory to the system at the end of a task: its Python worker lives on, and allocators keep what they once had."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only in glibc
    if trim:
        trim(0)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it again.

    This cuts the lineage: what was computed survives the loss of executors and is not computed twice. The shuffle files
    of the job go as soon as the table is written.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def discard(*staged: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in staged:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.staged_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Largest table, in bytes of its rows as Spark holds them, that is broadcast.
BROADCAST_BYTES = 64 << 20


def maybe_broadcast(df: DataFrame, row_bytes: int = 64) -> DataFrame:
    """Hint a broadcast only if a count shows that the rows, of ``row_bytes`` each, fit ``BROADCAST_BYTES``; else Spark shuffles both sides.

    ``df`` should be staged, so that the count is cheap.
    """
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def ascii_lower(col: Column) -> Column:
    return F.translate(col, UPPER, UPPER.lower())


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's text modulo ``modulus``; a null id gives null."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def sampled(df: DataFrame, key: Column, bound: int) -> DataFrame:
    """``bound`` rows at most: those whose ``key`` has the smallest hashes, the same on every run and for every partitioning.

    All rows take part. Of rows with equal keys as many are taken as the bound allows, so ``key`` should hold all that
    matters of a row. The driver sees at most ``bound`` hashes.
    """
    total = df.count()
    if total <= bound:
        return df
    h = F.xxhash64(F.lit("sample"), key)
    name, part = fresh("h"), 4 * bound / total
    hashed = df.withColumn(name, h)
    while True:
        below = hashed if part >= 1 else hashed.where(F.col(name) < int(-(1 << 63) + part * (1 << 64)))
        counts = below.groupBy(name).count().orderBy(name).limit(bound).collect()
        if part >= 1 or sum(r["count"] for r in counts) >= bound:
            break
        part *= 8
    less = 0
    for r in counts:
        if less + r["count"] >= bound:
            break
        less += r["count"]
    return hashed.where(F.col(name) < r[name]).union(hashed.where(F.col(name) == r[name]).limit(bound - less)).drop(name)
