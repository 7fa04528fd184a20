"""k-means by Shallot search against plain rounds in Python integers."""

import hashlib
import math
import random

import pytest

from scanweave.llm import kmeans
from scanweave.llm.kmeans import cluster_vectors, reach

SCHEMA = "vec_id long, embedding array<double>, cluster string, distance int, vector int"


def _plain(rows, size, k, rounds, seed=3, scale=1024):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1])
    centres = [list(v) for _, v in sorted((r for r in kept if r[0] is not None), key=key)[:k]]
    kept = kept if centres else []
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min((square(v, c), n) for n, c in enumerate(centres))
    for _ in range(rounds):
        of = [near(v)[1] for _, v in kept]
        for c in range(len(centres)):
            own = [v for (_, v), n in zip(kept, of) if n == c]
            if own:
                centres[c] = [sum(x) // len(own) for x in zip(*own)]
    last = [(i, *reversed(near(v))) for i, v in kept]
    inertia = {c: sum(d for _, n, d in last if n == c) for c in range(len(centres))}
    counts = {c: sum(n == c for _, n, _ in last) for c in range(len(centres))}
    return last, [(c, counts[c], inertia[c], sum(inertia.values()), centres[c]) for c in range(len(centres))]


def _order(rows):
    return sorted(rows, key=repr)


def _vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize("size, k, spread, seed", [(3, 8, 1.0, 1), (64, 8, 1.0, 2), (2, 17, 0.01, 3), (5, 40, 300.0, 4), (1, 2, 5.0, 5)])
def test_same_as_plain_rounds(spark, monkeypatch, size, k, spread, seed):
    monkeypatch.setattr(kmeans, "BLOCK", 64)
    rng = random.Random(seed)
    centres = [[rng.gauss(0, spread) for _ in range(size)] for _ in range(6)]
    rows = [(i, [x + rng.gauss(0, spread / 3) for x in rng.choice(centres)]) for i in range(900)]
    rows += rows[:20] + [(900, None), (901, [None] * size), (902, [math.nan] * size), (903, [0.0] * (size + 1)), (904, []), (905, [math.inf] * size)]
    rows += [(None, rows[0][1]), (3, [0.0] * size), (3, [-0.0] * size), (906, [-1e-9] * size)]
    members, centroids = cluster_vectors(_vectors(spark, rows), size=size, k=k, rounds=7)
    last, found = _plain(rows, size, k, 7)
    assert _order(map(tuple, members.collect())) == _order(last)
    assert [tuple(r) for r in centroids.orderBy("cluster").collect()] == found


def test_ties_and_equal_centroids(spark):
    rows = [(i, [float(i % 3), 0.0]) for i in range(30)] + [(100, [0.5, 0.0]), (101, [1.5, 0.0])]
    members, centroids = cluster_vectors(_vectors(spark, rows), size=2, k=8, rounds=4)
    last, found = _plain(rows, 2, 8, 4)
    assert _order(map(tuple, members.collect())) == _order(last)
    assert [tuple(r) for r in centroids.orderBy("cluster").collect()] == found
    assert any(n == 0 for _, n, *_ in found)


def test_few_and_no_vectors(spark):
    for rows in ([], [(1, None)], [(None, [1.0, 2.0])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        members, centroids = cluster_vectors(_vectors(spark, rows), size=2)
        last, found = _plain(rows, 2, 8, 10)
        assert _order(map(tuple, members.collect())) == _order(last)
        assert [tuple(r) for r in centroids.orderBy("cluster").collect()] == found


def test_large_components(spark):
    edge = float(reach(2))
    rows = [(i, [edge * (-1) ** i, -edge]) for i in range(9)]
    members, _ = cluster_vectors(_vectors(spark, rows), size=2, scale=1)
    assert _order(map(tuple, members.collect())) == _order(_plain(rows, 2, 8, 10, scale=1)[0])
    with pytest.raises(Exception, match="would not fit 64 bits"):
        cluster_vectors(_vectors(spark, [*rows, (10, [1e300, 0.0])]), size=2, scale=1)
