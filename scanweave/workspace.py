"""Where intermediate tables live, and how they are written and read back."""

from __future__ import annotations

import gc
import hashlib
import tempfile
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Writer options for big tables of keys and hashes, which the faster codecs hardly shrink.
COMPACT = {"compression": "zstd"}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a
    cluster a machine-local folder would be lost with its machine, so there the
    setting is required.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    root = root or context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="scanweave-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A folder name of its own below the checkpoint root (not created yet)."""
    return f"{checkpoint_root(spark)}/scanweave/{label}-{uuid.uuid4().hex}"


def _filesystem(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def is_complete(spark: SparkSession, path: str) -> bool:
    """True once a table was written to its end (``_SUCCESS`` is there)."""
    fs, target = _filesystem(spark, f"{path}/_SUCCESS")
    return fs.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table of ``scratch_dir`` that no later step reads."""
    fs, target = _filesystem(spark, path)
    fs.delete(target, True)


def release_steps(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps that nothing refers to any more. The last
    step is still referred to right after its end: where its files are large, call this
    again after the next small job."""
    gc.collect()
    spark._jvm.System.gc()


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _filesystem(spark, path)
    return fs.exists(target)


def fingerprint(df: DataFrame) -> str:
    """Changes when the rows of ``df`` may have changed: names, sizes and times of all files in
    the folders it reads, together with its plan. Rows without files are hashed themselves.
    """
    spark = df.sparkSession
    plan = df._jdf.queryExecution().optimizedPlan().canonicalized().toString()
    folders = sorted({f.rsplit("/", 1)[0] for f in df.inputFiles()})
    if folders:
        listed = spark.read.format("binaryFile").load(folders)
        rows = listed.select(F.xxhash64("path", "length", "modificationTime").alias("h"))
    else:
        rows = df.select(F.xxhash64(*df.columns).alias("h"))
    found = rows.agg(F.count(F.lit(1)), F.sum(F.col("h").cast("decimal(20,0)"))).first()
    text = "\n".join([plan, *folders, *map(str, found)])
    return hashlib.sha256(text.encode()).hexdigest()


def _marker(spark: SparkSession, path: str):
    return _filesystem(spark, f"{path}/_inputs")


def made_from(spark: SparkSession, path: str) -> str:
    """What ``materialize`` noted beside a table about the inputs it was made from."""
    fs, target = _marker(spark, path)
    if not fs.exists(target):
        return ""
    lines = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(fs.open(target), "UTF-8"))
    try:
        return lines.readLine() or ""
    finally:
        lines.close()


def is_current(spark: SparkSession, path: str, inputs: str = "") -> bool:
    """True for a finished table that was made from ``inputs``."""
    return is_complete(spark, path) and made_from(spark, path) == inputs


def materialize(
    df: DataFrame,
    path: str,
    *,
    range_by: Sequence[str] = (),
    partitions: int | None = None,
    partition_by: Sequence[str] = (),
    resume: bool = False,
    inputs: str = "",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Write ``df`` as Parquet and return a scan of it, which cuts the lineage.

    With ``resume`` a table that an earlier run has finished from the same ``inputs`` (any
    text, such as ``fingerprint`` gives) is read, not computed. ``range_by`` clusters rows so
    that file statistics prune later filters. ``options`` are those of Spark's Parquet writer.
    """
    spark = df.sparkSession
    if not (resume and is_current(spark, path, inputs)):
        out = df
        if range_by:
            out = out.repartitionByRange(*([partitions] if partitions else []), *range_by)
        elif partitions:
            out = out.repartition(partitions)
        writer = out.write.mode("overwrite").options(**(options or {}))
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        if inputs:
            fs, target = _marker(spark, path)
            note = fs.create(target, True)
            note.writeBytes(f"{inputs}\n")
            note.close()
    return spark.read.schema(df.schema).parquet(path)
