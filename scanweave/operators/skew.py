"""Keys that hold more rows than one task should take, and how to spread them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..workspace import materialize, scratch_dir

ROWS_PER_TASK = 2_000_000
#: Rows of a key with ``rows_per_task`` rows that the search for candidates sees, on average.
_SEEN = 200
_HASH, PIECES, _SALT = "_hash", "_pieces", "_salt"


@dataclass(frozen=True)
class HeavyKeys:
    """``table`` has the hash of each heavy key and the pieces to cut it into, by its own
    weight; ``pieces`` is their total. Keys with so many rows are few: at most one for each
    ``rows_per_task`` rows of the table they were found in, at 12 bytes each. That bounds what
    is broadcast: 6 MB for a million million rows."""

    columns: tuple[str, ...]
    table: DataFrame | None = None
    pieces: int = 0

    def __bool__(self) -> bool:
        return self.table is not None


def heavy_keys(
    df: DataFrame,
    columns: Sequence[str],
    *,
    rows_per_task: int = ROWS_PER_TASK,
    total: int | None = None,
) -> HeavyKeys:
    """Find every key with more than ``rows_per_task`` rows.

    ``df`` should be a stored table: it is counted (file footers), a sample of its keys
    names candidates, and if there are any, a second scan counts just those. Nothing is sampled
    away: the search steers balance, never rows. A small table is not searched at all.
    """
    columns = tuple(columns)
    total = df.count() if total is None else total
    if total <= rows_per_task:
        return HeavyKeys(columns)
    spark = df.sparkSession
    share = min(1.0, _SEEN / rows_per_task)

    def hashed(rows: DataFrame) -> DataFrame:
        return rows.dropna(subset=list(columns)).select(F.xxhash64(*columns).alias(_HASH))

    sample = hashed(df.sample(share, seed=11) if share < 1 else df)
    seen = sample.groupBy(_HASH).count().where(F.col("count") >= share * rows_per_task / 2)
    seen = materialize(seen.select(_HASH), scratch_dir(spark, "candidates"))
    if seen.isEmpty():
        return HeavyKeys(columns)
    counts = hashed(df).join(F.broadcast(seen), _HASH, "left_semi").groupBy(_HASH).count()
    heavy = counts.where(F.col("count") > rows_per_task)
    heavy = heavy.select(_HASH, F.ceil(F.col("count") / rows_per_task).cast("int").alias(PIECES))
    heavy = materialize(heavy, scratch_dir(spark, "heavy"))
    pieces = heavy.agg(F.sum(PIECES)).first()[0]
    return HeavyKeys(columns, heavy, pieces) if pieces else HeavyKeys(columns)


def with_pieces(df: DataFrame, heavy: HeavyKeys) -> DataFrame:
    """Add the number of pieces of the row's key, null unless it is heavy. Rows stay where
    they are: the table of heavy keys is broadcast."""
    if not heavy:
        return df.withColumn(PIECES, F.lit(None).cast("int"))
    keyed = df.withColumn(_HASH, F.xxhash64(*heavy.columns))
    return keyed.join(F.broadcast(heavy.table), _HASH, "left").drop(_HASH)


def salt_by(df: DataFrame, heavy: HeavyKeys, spread: Sequence[str]) -> DataFrame:
    """Add a salt that cuts rows of heavy keys into pieces by the ``spread`` columns.

    The salt is a hash of the row, not a random number: a task that is run again
    after a lost executor puts every row where it was before.
    """
    piece = F.pmod(F.xxhash64(*spread), F.col(PIECES)).cast("int")
    return with_pieces(df, heavy).withColumn(_SALT, F.coalesce(piece, F.lit(0))).drop(PIECES)


def lookup_join(
    rows: DataFrame, table: DataFrame, key: str, heavy: HeavyKeys, how: str = "inner", *, small: bool = False
) -> DataFrame:
    """Join ``rows`` with a ``table`` that has one row per ``key``.

    The table's part of each task is hashed and the rows run past it: they are not sorted, so
    a key with very many rows takes no memory for them. Rows of heavy keys are spread over many
    tasks, each key over as many as its own rows need; only the few table rows of those keys
    are copied, once for each piece. A ``small`` table is broadcast, and no row moves.
    """
    if small:
        return rows.join(F.broadcast(table), on=key, how=how)
    if not heavy:
        return rows.join(table.hint("shuffle_hash"), on=key, how=how)
    spread = [c for c in rows.columns if c != key] or [key]
    pieces = F.sequence(F.lit(0), F.col(PIECES) - 1)
    copies = F.when(F.col(PIECES).isNotNull(), pieces).otherwise(F.array(F.lit(0)))
    salted = with_pieces(table, heavy).withColumn(_SALT, F.explode(copies)).drop(PIECES)
    return salt_by(rows, heavy, spread).join(salted.hint("shuffle_hash"), on=[key, _SALT], how=how).drop(_SALT)
