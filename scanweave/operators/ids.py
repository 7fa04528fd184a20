"""Dense global ids, numbered in key order without a single-task window."""

from __future__ import annotations

from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..workspace import COMPACT, materialize, scratch_dir

# monotonically_increasing_id: partition number above, row number below.
_ROW_BITS = 33


def assign_ids(
    df: DataFrame,
    key: str = "guid",
    *,
    start: int = 0,
    partitions: int | None = None,
    path: str | None = None,
    resume: bool = False,
    inputs: str = "",
    distinct: bool = False,
) -> DataFrame:
    """``(key, id)`` for every distinct ``key``: ids run from ``start`` without gaps,
    in byte order of the key, so that runs on equal input agree.

    The keys are range partitioned and sorted within their partitions; each row
    is tagged with partition and row number and stored. The tags are stored before
    partitions are counted, since sampling the ranges again could move keys. One
    count per partition (not per key) goes to the driver and comes back as a
    broadcast table of offsets. ``distinct`` says that no key occurs twice, so that none is
    looked for: the keys are shuffled once instead of twice.
    """
    spark = df.sparkSession
    sort = df.select(key).where(F.col(key).isNotNull())
    sort = sort if distinct else sort.distinct()
    ranged = sort.repartitionByRange(*([partitions] if partitions else []), key)
    tagged = ranged.sortWithinPartitions(key).withColumn("_tag", F.monotonically_increasing_id())
    stored = materialize(tagged, path or scratch_dir(spark, "ids"), resume=resume, inputs=inputs, options=COMPACT)

    part = F.shiftright("_tag", _ROW_BITS)
    counts = stored.groupBy(part.alias("_part")).count().orderBy("_part").collect()
    first = accumulate((row["count"] for row in counts), initial=start)
    offsets = pa.table(
        {
            "_part": pa.array([row["_part"] for row in counts], pa.int64()),
            "_first": pa.array(list(first)[: len(counts)], pa.int64()),
        }
    )
    row = F.col("_tag").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        stored.withColumn("_part", part)
        .join(F.broadcast(spark.createDataFrame(offsets)), "_part")
        .select(key, (F.col("_first") + row).alias("id"))
    )
