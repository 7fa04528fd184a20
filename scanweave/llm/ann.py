"""Nearest neighbours by multiprobe p-stable hashing.

Each of ``tables`` hashes cuts a vector's projections on ``projections`` random directions
into cells of ``width``. A query visits its own cell and then perturbed ones, in the order
of the squared distance to the boundaries crossed, which is the estimated order of
success. What the tables give is merged and reranked by the exact cosine.

Vectors are kept in packed blocks. Every block of queries meets every block of the
index, where sorted cells are searched; a frequent cell costs no more than its rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .exchange import columns, longs, stored, unpack
from .textbytes import mix

#: Vectors in a block of the index, queries in a block of queries.
INDEX_BLOCK, QUERY_BLOCK = 8192, 256
#: Queries that calibrate the number of probes, and the recall they are to reach.
SAMPLE, TARGET = 128, 0.96
PROBES = 1024


@dataclass(frozen=True)
class Hashing:
    dim: int
    tables: int = 8
    projections: int = 6
    width: float = 1.25
    seed: int = 7

    def directions(self) -> tuple[np.ndarray, np.ndarray]:
        return _directions(self)

    def cells(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cells ``(vectors, tables, projections)`` and the place within them, from 0 to 1."""
        a, b = self.directions()
        at = (unit @ a + b).reshape(len(unit), self.tables, self.projections) / self.width
        cell = np.floor(at)
        return cell.astype(np.int64), at - cell

    def keys(self, cells: np.ndarray) -> np.ndarray:
        """One number per cell; the last but one axis is the table."""
        out = np.zeros(cells.shape[:-1], np.uint64) + np.arange(self.tables, dtype=np.uint64)
        for k in range(self.projections):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + cells[..., k].astype(np.uint64))
        return out


@lru_cache(maxsize=4)
def _directions(h: Hashing) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.RandomState(h.seed)
    n = h.tables * h.projections
    return rng.standard_normal((h.dim, n)), rng.uniform(0, h.width, n)


def perturbations(inside: np.ndarray, count: int) -> list[tuple[tuple[int, int], ...]]:
    """The first ``count`` sets of steps ``(projection, -1 or 1)`` in ascending order of the
    summed squared distance to the crossed boundaries; the empty set comes first."""
    m = len(inside)
    steps = sorted([(x * x, i, -1) for i, x in enumerate(inside)] + [((1 - x) ** 2, i, 1) for i, x in enumerate(inside)])
    cost = [s[0] for s in steps]
    out: list[tuple[tuple[int, int], ...]] = [()]
    heap = [(cost[0], (0,))] if steps else []
    while heap and len(out) < count:
        total, chosen = heapq.heappop(heap)
        picked = [steps[j][1] for j in chosen]
        if len(set(picked)) == len(picked):  # one step per projection
            out.append(tuple((steps[j][1], steps[j][2]) for j in chosen))
        last = chosen[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (total + cost[last + 1], (*chosen, last + 1)))
    return out


def probe_keys(h: Hashing, unit: np.ndarray, count: int) -> np.ndarray:
    """Keys ``(queries, tables, count)`` in the order of probing; short lists repeat."""
    cells, inside = h.cells(unit)
    out = np.zeros((len(unit), h.tables, count), np.uint64)
    for t in range(h.tables):
        moved = np.repeat(cells[:, t, None, :], count, axis=1)
        for q in range(len(unit)):
            for k, steps in enumerate(perturbations(inside[q, t], count)):
                for i, d in steps:
                    moved[q, k, i] += d
        grid = np.zeros((len(unit), count, h.tables, h.projections), np.int64)
        grid[:, :, t] = moved
        out[:, t] = h.keys(grid)[:, :, t]
    return out


def vectors(data: np.ndarray, dim: int) -> np.ndarray:
    return data.reshape(-1, dim)


def _norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(axis=1))


def _scaled(x: np.ndarray) -> np.ndarray:
    """Each vector times a power of two that brings its largest component near one: that
    changes no digit of a cosine, and keeps squares from under- and overflowing."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0))[1][:, None])


def _block(batches: Iterable[pa.RecordBatch], size: int, dim: int) -> Iterator[pa.RecordBatch]:
    for ids, values in columns(batches, "id", "vector"):
        ids, flat = longs(ids), values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        x = _scaled(vectors(flat, dim))
        for k in range(0, len(ids), size):
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([int(mix(ids[k : k + 1].view(np.uint64) + np.uint64(len(ids)))[0] >> np.uint64(2))], pa.int64()),
                "ids": pa.array([ids[k : k + size].tobytes()], pa.binary()),
                "data": pa.array([np.ascontiguousarray(x[k : k + size]).tobytes()], pa.binary()),
            })


def _load(ids, data, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x = vectors(np.frombuffer(data.as_buffer(), np.float64), dim)
    return np.frombuffer(ids.as_buffer(), np.int64), x, _norms(x)


def _best(ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best ids, each at its best score, however many rows repeat it."""
    rows = 4 * k
    while True:
        keep = np.arange(len(ids))
        if len(ids) > rows:
            keep = np.flatnonzero(score >= np.partition(score, len(score) - rows)[len(score) - rows])
        order = keep[np.lexsort((ids[keep], -score[keep]))]
        first = np.sort(np.unique(ids[order], return_index=True)[1])
        if len(first) >= k or len(keep) == len(ids):
            return order[first[:k]]
        rows *= 4


FOUND = "query_id long, vec_id long, score double"


def _search(batches: Iterable[pa.RecordBatch], h: Hashing, probes: int | None, k: int) -> Iterator[pa.RecordBatch]:
    """The best ``k`` of a block of the index for each query of a block; of all its rows
    where ``probes`` is None."""
    for qids, qdata, qkeys, ids, data in columns(batches, "qids", "qdata", "qkeys", "ids", "data"):
        for q_id, q_x, q_keys, i, x in zip(qids, qdata, qkeys, ids, data):
            (query, qx, qn), (own, v, n) = _load(q_id, q_x, h.dim), _load(i, x, h.dim)
            if probes is not None:
                wanted = np.frombuffer(q_keys.as_buffer(), np.uint64).reshape(len(query), h.tables, probes)
                keys = h.keys(h.cells(v / n[:, None])[0])
                order = [np.argsort(keys[:, t], kind="stable") for t in range(h.tables)]
                ordered = [keys[o, t] for t, o in enumerate(order)]
            rows = []
            for q in range(len(query)):
                if probes is None:
                    at = np.arange(len(own))
                else:
                    hit = np.zeros(len(own), bool)
                    for t in range(h.tables):
                        a = np.searchsorted(ordered[t], wanted[q, t], "left")
                        b = np.searchsorted(ordered[t], wanted[q, t], "right")
                        for f, e in zip(a[b > a], b[b > a]):
                            hit[order[t][f:e]] = True
                    at = np.flatnonzero(hit)
                at = at[own[at] != query[q]]
                if len(at):
                    score = (v[at] * qx[q]).sum(axis=1) / (n[at] * qn[q])
                    best = _best(own[at], score, k)
                    rows.append((np.full(len(best), query[q]), own[at][best], score[best]))
            cols = [np.concatenate(c) for c in zip(*rows)] if rows else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["query_id", "vec_id", "score"])


def _add_probes(batches: Iterable[pa.RecordBatch], h: Hashing, probes: int) -> Iterator[pa.RecordBatch]:
    for block, ids, data in columns(batches, "block", "ids", "data"):
        keys = []
        for i, x in zip(ids, data):
            _, v, n = _load(i, x, h.dim)
            keys.append(probe_keys(h, v / n[:, None], probes).tobytes())
        yield pa.RecordBatch.from_arrays([block, ids, data, pa.array(keys, pa.binary())], ["block", "qids", "qdata", "qkeys"])


def _needed(batches: Iterable[pa.RecordBatch], h: Hashing) -> Iterator[pa.RecordBatch]:
    """At which probe each true neighbour is met first, or ``PROBES``."""
    for q, v in columns(batches, "q", "v"):
        x, y = (_scaled(vectors(c.flatten().to_numpy(zero_copy_only=False).astype(np.float64), h.dim)) for c in (q, v))
        wanted = probe_keys(h, x / _norms(x)[:, None], PROBES)
        same = wanted == h.keys(h.cells(y / _norms(y)[:, None])[0])[:, :, None]
        at = np.where(same.any(axis=2), same.argmax(axis=2), PROBES).min(axis=1)
        yield pa.RecordBatch.from_pydict({"at": at.astype(np.int64)})


def usable(table: DataFrame, id_column: str, vector: str) -> tuple[DataFrame, int]:
    """``id, vector`` (doubles) of the rows that take part, and the number of components."""
    x = F.col(vector).cast("array<double>")
    rows = table.select(F.col(id_column).cast("long").alias("id"), x.alias("vector")).where("id IS NOT NULL AND vector IS NOT NULL")
    finite = F.forall("vector", lambda c: c.isNotNull() & (F.abs(c) < float("inf")))  # NaN is above all numbers
    rows = rows.where(finite & F.exists("vector", lambda c: c != 0))
    common = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = common["dim"] if common else 0
    return rows.where(F.size("vector") == dim), dim


def nearest(
    table: DataFrame, is_query, *, k: int = 5, id_column: str = "vec_id", vector: str = "embedding", hashing: dict | None = None
) -> DataFrame:
    """``query_id, rank, vec_id, score, recall``: the ``k`` nearest rows found for each row that
    ``is_query`` (a condition on ``id``) holds for, by cosine, ties to the smaller id.

    The number of probes is the least that reaches ``TARGET`` recall on a sample of ``SAMPLE``
    queries, whose neighbours are searched exhaustively; all rows are indexed. ``recall`` is
    what the sample had with it. Where all probes there are miss the target, and for a query
    that meets fewer than ``k`` rows, the search is exhaustive. Of different vectors
    with a query's id the least one asks. Rows without an id,
    and vectors that are null, zero, of another length than most, or hold a null or a
    number that is not finite take no part. Rows that repeat a query's id are not its
    neighbours; other repeated ids count once, at their best score. An empty table gives
    no rows; other columns are not looked at.
    """
    spark = table.sparkSession
    rows, dim = usable(table, id_column, vector)
    schema = "query_id long, rank int, vec_id long, score double, recall double"
    if not dim:
        return spark.createDataFrame([], schema)
    h = Hashing(dim, **(hashing or {}))
    packed = "block long, ids binary, data binary"
    index = stored(rows.mapInArrow(partial(_block, size=INDEX_BLOCK, dim=dim), packed), "index")
    queries = rows.where(is_query(F.col("id"))).groupBy("id").agg(F.min("vector").alias("vector"))
    blocks = stored(queries.mapInArrow(partial(_block, size=QUERY_BLOCK, dim=dim), packed), "queries")

    sample = queries.orderBy(F.xxhash64("id"), "id").limit(SAMPLE)
    some = sample.coalesce(1).mapInArrow(partial(_block, size=SAMPLE, dim=dim), packed)
    truth = stored(_ranked(_searched(index, _unprobed(some), h, None, k), k), "truth")
    probes, recall = _probes(truth, rows, h)
    if probes is None:
        found = stored(_ranked(_searched(index, _unprobed(blocks), h, None, k), k), "found")
        return _shown(found, 1.0)

    probed = "block long, qids binary, qdata binary, qkeys binary"
    ready = blocks.mapInArrow(partial(_add_probes, h=h, probes=probes), probed)
    found = stored(_ranked(_searched(index, stored(ready, "probes"), h, probes, k), k), "found")
    full = found.groupBy("query_id").count().where(F.col("count") >= k).select(F.col("query_id").alias("id"))
    short = queries.join(full, "id", "left_anti")
    rest = _unprobed(short.mapInArrow(partial(_block, size=QUERY_BLOCK, dim=dim), packed))
    more = _ranked(_searched(index, rest, h, None, k), k)
    found = found.join(full, found["query_id"] == full["id"], "left_semi").unionByName(more)
    return _shown(found, recall)


def _shown(found: DataFrame, recall: float) -> DataFrame:
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", F.lit(recall).alias("recall"))


def _unprobed(blocks: DataFrame) -> DataFrame:
    return blocks.select("block", F.col("ids").alias("qids"), F.col("data").alias("qdata"), F.lit(None).cast("binary").alias("qkeys"))


def _searched(index: DataFrame, blocks: DataFrame, h: Hashing, probes: int | None, k: int) -> DataFrame:
    """Every block of queries against every block of the index: the blocks of queries are
    numbered, and each block of the index is sent to all the numbers."""
    spark = index.sparkSession
    numbered = stored(blocks.select(F.monotonically_increasing_id().alias("number"), "qids", "qdata", "qkeys"), "numbered")
    numbers = [r["number"] for r in numbered.select("number").collect()]  # one per QUERY_BLOCK queries
    if not numbers:
        return spark.createDataFrame([], FOUND)
    sent = index.withColumn("number", F.explode(F.lit(numbers).cast("array<long>")))
    met = sent.join(numbered, "number").select("qids", "qdata", "qkeys", "ids", "data")
    return met.repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "ids", "qids").mapInArrow(
        partial(_search, h=h, probes=probes, k=k), FOUND
    )


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _probes(truth: DataFrame, rows: DataFrame, h: Hashing) -> tuple[int | None, float]:
    """The number of probes that meets ``TARGET`` of the sample's neighbours, and the share that
    it meets; None if there are not enough."""
    one = rows.dropDuplicates(["id"])
    pairs = truth.select("query_id", "vec_id")
    pairs = one.join(F.broadcast(pairs), one["id"] == F.col("query_id")).select("vec_id", F.col("vector").alias("q"))
    pairs = one.join(F.broadcast(pairs), one["id"] == F.col("vec_id")).select("q", F.col("vector").alias("v"))
    at = sorted(r["at"] for r in pairs.mapInArrow(partial(_needed, h=h), "at long").collect())  # SAMPLE * k at most
    if not at:
        return 1, 1.0
    need = at[int(np.ceil(TARGET * len(at))) - 1]
    return (None if need >= PROBES else need + 1), sum(a <= need for a in at) / len(at)
