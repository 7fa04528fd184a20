"""What the operators of this folder share: row keys, stored steps, packed arrays."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..workspace import materialize, release_steps, scratch_dir


#: Rows of a batch that goes to Python, for steps that send whole texts.
TEXT_ROWS = 2000
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def row_key() -> Column:
    """64 bits that stand for a document row. Repeated rows share one key, rows that
    differ in text do not, and rows without an id or a text have a key as well."""
    return F.xxhash64("doc_id", "text")


def texts(docs: DataFrame, *keep: str) -> DataFrame:
    """``doc_id`` (as long), ``text``, the row's key and the columns ``keep``; all others go."""
    own = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]
    return docs.select(*own, *keep, row_key().alias("row"))


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until ``df`` has no such column (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def local_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table from the driver, as Arrow columns: from a list of tuples Spark would start
    workers of another kind on the executors, which stay beside those of the steps."""
    if not rows:
        return spark.createDataFrame([], schema)
    names = T.StructType.fromDDL(schema).names
    return spark.createDataFrame(pa.table(dict(zip(names, map(pa.array, zip(*rows))))), schema)


@contextmanager
def _batches(spark: SparkSession, most: int | None):
    """Batches for Python of at most ``most`` rows; what the session asks for holds if it is less."""
    before = spark.conf.get(_BATCH_ROWS)
    if most is None or 0 < int(before) <= most:
        yield
        return
    spark.conf.set(_BATCH_ROWS, str(most))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_ROWS, before)


def stored(df: DataFrame, label: str, *, release: bool = True, batch_rows: int | None = None) -> DataFrame:
    """Write an intermediate table into the shared folder and read it back.

    This cuts the lineage: after a lost executor only the step at hand is repeated.
    With ``release`` the shuffle files of finished steps go at once. ``batch_rows`` bounds the
    batches that go to Python: those of whole texts take memory outside of the heap.
    """
    spark = df.sparkSession
    with _batches(spark, batch_rows):
        out = materialize(df, scratch_dir(spark, label))
    if release:
        release_steps(spark)
    return out


def buckets(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def columns(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[list]:
    for batch in batches:
        if batch.num_rows:
            yield [batch.column(n) for n in names]


def tidy() -> None:
    """Give what a task has left unused back to the system at its end: Python workers live on,
    and each stage's leftovers would add up."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def tidied(step: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """A step that is followed by ``tidy``, when nothing holds its variables any more."""

    @wraps(step)
    def run(*args, **named):
        yield from step(*args, **named)
        tidy()

    return run


def longs(column: pa.Array, null: int = 0) -> np.ndarray:
    return column.fill_null(null).to_numpy(zero_copy_only=False).astype(np.int64)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one length as bytes, one after the other."""
    return b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def unpack(data, *kinds: str) -> list[np.ndarray]:
    data = memoryview(data)
    n, at, out = len(data) // sum(np.dtype(k).itemsize for k in kinds), 0, []
    for kind in kinds:
        out.append(np.frombuffer(data, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


def split_by(bucket: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """``(bucket, positions)`` of every bucket that occurs, positions in their order."""
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(n + 1))
    for b in range(n):
        if ends[b + 1] > ends[b]:
            yield b, order[ends[b] : ends[b + 1]]


def gathered(batches: Iterator[pa.RecordBatch], column: str, *kinds: str) -> list[np.ndarray]:
    """The packed arrays of a whole partition, joined."""
    parts = [unpack(x.as_buffer(), *kinds) for (c,) in columns(batches, column) for x in c]
    return [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, k) for i, k in enumerate(kinds)]
