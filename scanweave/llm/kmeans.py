"""Exact k-means over integer vectors by Shallot search.

Every vector carries its nearest and second-nearest centroid of the last search and two
bounds: its distance to the nearest is at most ``upper``, to any other at least ``lower``.
Centroid moves loosen the bounds; a vector whose bounds still part, or which lies within half
the way to the next centroid, keeps its cluster unseen. The others are searched: the closer
of the two remembered centroids is the start, the rest are visited by their distance from
it, and only within a ball that shrinks whenever a nearer second is found. Distances of
what is visited are compared as integers, so ties are exact.

Vectors lie in blocks of thousands. Each round is one pass over the stored blocks that writes
them with new bounds and the sums of their clusters, and drops the round before the last;
a lost executor costs the tasks of one round. The driver sees the centroids and one row
per centroid and component.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..workspace import materialize, remove, scratch_dir
from .exchange import columns, pack, unpack

#: Vectors of a block.
BLOCK = 8192
#: Rounding errors of the bounds, which are floating point: relative, far above those of a square root.
SLACK = 1e-9
CENTROIDS = "cluster int, n long, inertia long, total long, centroid array<long>"
STATE = "ids binary, vectors binary, state binary, counts array<long>, sums array<long>, inertia array<long>"


def reach(size: int) -> int:
    """Components up to this keep squared distances of ``size`` components in 64 bits."""
    return isqrt((2**63 - 1) // size) // 2


def usable(vector: Column, size: int) -> Column:
    """Exactly ``size`` components, none null, NaN or infinite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) == size) & fine, F.lit(False))


def _scaled(x: np.ndarray, scale: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = np.floor(x * float(scale))
    limit = reach(max(x.shape[-1], 1))  # no vectors: an array without components
    if (np.abs(x) > limit).any():
        raise ValueError(f"a component is beyond {limit} after scaling: distances would not fit 64 bits")
    return x


def _blocks(batches: Iterable[pa.RecordBatch], size: int, scale: int) -> Iterator[pa.RecordBatch]:
    """Vectors as blocks of integers, in four bytes a component. An id may be null: the
    first byte of ``state`` tells."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def flush() -> pa.RecordBatch:
        ids, null, vectors = (np.concatenate(x) for x in zip(*held))
        held.clear()
        made = [[pack(ids)], [pack(vectors)], [pack(null)], *([[]] for _ in range(3))]
        return pa.RecordBatch.from_arrays(
            [*(pa.array(x, pa.binary()) for x in made[:3]), *(pa.array(x, pa.list_(pa.int64())) for x in made[3:])],
            ["ids", "vectors", "state", "counts", "sums", "inertia"],
        )

    for batch in batches:
        for k in range(0, batch.num_rows, BLOCK):
            rows = batch.slice(k, BLOCK)
            null = rows.column("vec_id").is_null().to_numpy(zero_copy_only=False)
            ids = rows.column("vec_id").fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            x = rows.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            held.append((ids, null, _scaled(x, scale).astype(np.int32)))
            if sum(len(h[0]) for h in held) >= BLOCK:
                yield flush()
    if held:
        yield flush()


def _squared(vectors: np.ndarray, centre: np.ndarray) -> np.ndarray:
    gap = vectors.astype(np.int64) - centre
    return np.einsum("ij,ij->i", gap, gap)


def _up(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(squared.astype(np.float64)) * (1 + SLACK)


def _down(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(squared.astype(np.float64)) * (1 - SLACK)


class Search:
    """What one round needs of the centroids: their distances and neighbours by distance."""

    def __init__(self, centres: np.ndarray, before: np.ndarray | None):
        self.centres, k = centres, len(centres)
        between = np.stack([_squared(centres, c) for c in centres])
        self.between = _down(between)
        np.fill_diagonal(self.between, np.inf)
        self.half = self.between.min(axis=1) / 2
        self.neighbours = np.argsort(self.between, axis=1, kind="stable")[:, : k - 1]
        self.moved = None if before is None else _up(np.einsum("ij,ij->i", centres - before, centres - before))

    def loosened(self, near: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bounds after the centroids have moved. The nearest centroid's own move does not
        bring any other one closer, so the farthest move among the others counts."""
        order = np.argsort(-self.moved, kind="stable")
        others = np.where(near == order[0], self.moved[order[1]] if len(order) > 1 else 0.0, self.moved[order[0]])
        return (upper + self.moved[near]) * (1 + SLACK), (lower - others) * (1 - SLACK)

    def search(self, vectors: np.ndarray, near: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, ...]:
        """``(near, second, squared near, squared second)``, from the centroids remembered."""
        to_near, to_second = self._to(vectors, near), self._to(vectors, second)
        swap = (to_second < to_near) | ((to_second == to_near) & (second < near))
        near, second = np.where(swap, second, near), np.where(swap, near, second)
        to_near, to_second = np.where(swap, to_second, to_near), np.where(swap, to_near, to_second)
        begin = near.copy()
        for start in np.unique(begin):
            rows = np.flatnonzero(begin == start)
            x, inner = vectors[rows], _up(to_near[rows])
            best, best_d, next_, next_d = near[rows], to_near[rows], second[rows], to_second[rows]
            remembered = second[rows].copy()
            open_ = np.arange(len(rows))
            for c in self.neighbours[start]:
                # Nothing beyond this ball is nearer than the second found so far.
                open_ = open_[self.between[start, c] <= inner[open_] + _up(next_d[open_])]
                if not len(open_):
                    break
                at = open_[remembered[open_] != c]
                d = _squared(x[at], self.centres[c])
                first = (d < best_d[at]) | ((d == best_d[at]) & (c < best[at]))
                other = ~first & ((d < next_d[at]) | ((d == next_d[at]) & (c < next_[at])))
                top, sub = at[first], at[other]
                next_[top], next_d[top] = best[top], best_d[top]
                best[top], best_d[top] = c, d[first]
                next_[sub], next_d[sub] = c, d[other]
            near[rows], second[rows], to_near[rows], to_second[rows] = best, next_, best_d, next_d
        return near, second, to_near, to_second

    def _to(self, vectors: np.ndarray, which: np.ndarray) -> np.ndarray:
        return _squared(vectors, self.centres[which])


def _sums(vectors: np.ndarray, near: np.ndarray, k: int) -> np.ndarray:
    out = np.zeros((k, vectors.shape[1]), np.int64)
    for c in np.unique(near):
        out[c] = vectors[near == c].sum(axis=0, dtype=np.int64)
    return out


def _round(batches: Iterable[pa.RecordBatch], centres, size: int, last: bool) -> Iterator[pa.RecordBatch]:
    now, before = centres.value
    search, k = Search(now, before), len(now)
    for ids, packed, states in columns(batches, "ids", "vectors", "state"):
        for place in range(len(ids)):
            vectors = unpack(packed[place].as_buffer(), "i4")[0].reshape(-1, size)
            n, state = len(vectors), memoryview(states[place].as_buffer())
            if before is None:  # nothing is remembered yet: any two centroids and no bounds
                near, second = np.zeros(n, np.int64), np.full(n, min(1, k - 1))
                upper, lower = np.full(n, np.inf), np.full(n, -np.inf)
            else:
                near, second, upper, lower = (x.copy() for x in unpack(state[n:], "i4", "i4", "f8", "f8"))
                upper, lower = search.loosened(near, upper, lower)
            squared = np.zeros(n, np.int64)
            if k > 1:
                at = np.flatnonzero(upper >= np.maximum(lower, search.half[near]))
                near[at], second[at], squared[at], to_second = search.search(vectors[at], near[at], second[at])
                upper[at], lower[at] = _up(squared[at]), _down(to_second)
            if last:
                squared = search._to(vectors, near)
            yield pa.RecordBatch.from_pydict({
                "ids": ids[place : place + 1],
                "vectors": packed[place : place + 1],
                "state": pa.array([bytes(state[:n]) + pack(near.astype("i4"), second.astype("i4"), upper, lower) + (pack(squared) if last else b"")], pa.binary()),
                "counts": pa.array([np.bincount(near, minlength=k)], pa.list_(pa.int64())),
                "sums": pa.array([_sums(vectors, near, k).ravel()], pa.list_(pa.int64())),
                "inertia": pa.array([[int(squared[near == c].sum()) for c in range(k)] if last else []], pa.list_(pa.int64())),
            })


def _total(blocks: DataFrame, column: str) -> dict[int, int]:
    """Position-wise sums of an array column: one row per position reaches the driver."""
    rows = blocks.select(F.posexplode(column).alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x"))
    return {r["at"]: r["x"] for r in rows.collect()}


def _moved(centres: np.ndarray, blocks: DataFrame) -> np.ndarray:
    """Each centroid at the floor of its vectors' mean; one without vectors stays."""
    counts, sums = _total(blocks, "counts"), _total(blocks, "sums")
    out, size = centres.copy(), centres.shape[1]
    for c in range(len(centres)):
        if counts.get(c):
            out[c] = [sums[c * size + i] // counts[c] for i in range(size)]
    return out


def _results(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for packed, states in columns(batches, "ids", "state"):
        for x, y in zip(packed, states):
            ids, state = unpack(x.as_buffer(), "i8")[0], memoryview(y.as_buffer())
            n = len(ids)
            null, state = np.frombuffer(state[:n], bool), state[n:]
            near, squared = np.frombuffer(state, "i4", n), np.frombuffer(state, "i8", n, 24 * n)
            yield pa.RecordBatch.from_pydict({
                "vec_id": pa.array(ids, pa.int64(), mask=null), "cluster": near, "distance": squared,
            })


def starts(rows: DataFrame, k: int, seed: int, scale: int) -> np.ndarray:
    """The ``k`` vectors with the smallest hashed ids; of one id's vectors the smallest."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = rows.where("vec_id IS NOT NULL").orderBy(key, "vector").limit(k).select("vector").collect()
    return _scaled(np.array([r["vector"] for r in first], np.float64), scale).astype(np.int64)


def cluster_vectors(
    vectors: DataFrame, *, vector: str = "embedding", size: int = 64, k: int = 8, rounds: int = 10,
    seed: int = 3, scale: int = 1024,
) -> tuple[DataFrame, DataFrame]:
    """``(members, centroids)`` of ``k`` clusters after ``rounds`` rounds and a last assignment.

    Vectors are those of exactly ``size`` components without nulls, NaN or infinities, each
    component ``x`` as the integer ``floor(scale * x)``; beyond ``reach(size)`` that is an error, as
    squared distances would leave 64 bits. ``members``: ``vec_id, cluster, distance`` (squared),
    one row per such vector, repeated ones too. ``centroids``: ``cluster, n, inertia, total,
    centroid``, with ``total`` the inertia of all clusters; an empty cluster has ``n`` 0. Ties go to the smaller cluster. Rows without an
    id are clustered but never start a cluster. With fewer than ``k`` vectors to start from
    there are so many clusters; with none both tables are empty. Columns besides ``vec_id`` and
    ``vector`` are not looked at.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.where(usable(F.col("vector"), size))
    centres = starts(rows, k, seed, scale)
    if not len(centres):
        return (
            spark.createDataFrame([], "vec_id long, cluster int, distance long"),
            spark.createDataFrame([], CENTROIDS),
        )
    path, before = scratch_dir(spark, "vectors"), None
    blocks = materialize(rows.mapInArrow(partial(_blocks, size=size, scale=scale), STATE), path)
    for r in range(rounds + 1):
        shared = spark.sparkContext.broadcast((centres, before))
        step = partial(_round, centres=shared, size=size, last=r == rounds)
        used, path = path, scratch_dir(spark, f"round-{r}")
        blocks = materialize(blocks.mapInArrow(step, STATE), path)
        remove(spark, used)
        shared.destroy()
        if r < rounds:
            before, centres = centres, _moved(centres, blocks)
    counts, inertia = _total(blocks, "counts"), _total(blocks, "inertia")
    total = sum(inertia.values())
    found = [(c, counts.get(c, 0), inertia.get(c, 0), total, x.tolist()) for c, x in enumerate(centres)]
    centroids = spark.createDataFrame(found, CENTROIDS)
    return blocks.select("ids", "state").mapInArrow(_results, "vec_id long, cluster int, distance long"), centroids
