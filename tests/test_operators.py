"""Ids, joins on heavy keys, folds and degrees: small cases and random invariants."""

import random
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from scanweave.operators.degrees import attach_degrees, degrees, number_vertices
from scanweave.operators import fold, skew
from scanweave.operators.edges import (
    edge_members,
    edge_rows,
    fold_edges,
    folds_at_once,
    merge_observations,
    pack_keys,
    resolve_endpoints,
    reverse_valid,
    semi_edges,
    small_kinds,
)
from scanweave.operators.ids import assign_ids
from scanweave.operators.cluster import cluster_by_id
from scanweave.operators.skew import HeavyKeys, heavy_keys, lookup_join, salt_by, with_pieces
from scanweave.workspace import checkpoint_root, is_complete, materialize, scratch_dir


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("partitions", [None, 1, 7])
def test_ids_are_dense_and_ordered(spark, partitions):
    keys = spark.range(20_000).select(F.sha1(F.col("id").cast("string").cast("binary")).alias("guid"))
    ids = assign_ids(keys.union(keys), start=5, partitions=partitions)
    got = sorted((r.id, r.guid) for r in ids.collect())
    assert [i for i, _ in got] == list(range(5, 20_005))
    assert [g for _, g in got] == sorted(r.guid for r in keys.collect())


def test_ids_of_nothing(spark):
    assert assign_ids(spark.createDataFrame([], "guid string")).count() == 0
    assert assign_ids(spark.createDataFrame([(None,), ("a",)], "guid string")).collect() == [("a", 0)]


def test_ids_do_not_depend_on_the_split(spark):
    keys = spark.range(1000).select(F.col("id").cast("string").alias("guid"))
    assert rows(assign_ids(keys.repartition(3), partitions=4)) == rows(assign_ids(keys.repartition(8), partitions=5))


def test_ids_use_no_global_window(spark):
    ids = assign_ids(spark.range(10).select(F.col("id").cast("string").alias("guid")))
    assert "Window" not in plan(ids) and "SinglePartition" not in plan(ids)
    # A kind filter reaches the file scan.
    assert "StringStartsWith" in plan(ids.where(F.col("guid").startswith("d_")))


@pytest.fixture(scope="module")
def hub(spark):
    """10,000 edges, a third of them to one key and a fifth from another."""
    n = F.col("id")
    edges = spark.range(10_000).select(
        F.when(n % 5 == 0, "s0").otherwise(F.concat(F.lit("s"), n % 900)).alias("from"),
        F.when(n % 3 == 0, "t0").otherwise(F.concat(F.lit("t"), n)).alias("to"),
        n.alias("n"),
    )
    return materialize(edges, scratch_dir(spark, "hub"))


def test_heavy_keys(spark, hub):
    heavy = heavy_keys(hub, ["to"], rows_per_task=1000)
    ((key, pieces),) = heavy.table.collect()
    assert key == spark.range(1).select(F.xxhash64(F.lit("t0"))).first()[0]
    assert pieces == heavy.pieces == 4
    assert not heavy_keys(hub, ["to"], rows_per_task=5000)
    assert not heavy_keys(hub, ["to"])


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_salted_join_equals_the_plain_one(spark, hub, how):
    table = spark.range(0, 10_000, 2).select(F.concat(F.lit("t"), F.col("id")).alias("to"), F.col("id").alias("x"))
    heavy = heavy_keys(hub, ["to"], rows_per_task=1000)
    salted = lookup_join(hub, table, "to", heavy, how)
    plain = lookup_join(hub, table, "to", HeavyKeys(("to",)), how)
    assert rows(salted) == rows(plain)
    assert "_salt" in plan(salted) and "_salt" not in plan(plain)
    assert salted.columns == plain.columns


def test_salt_spreads_the_heavy_key(spark, hub):
    heavy = heavy_keys(hub, ["to"], rows_per_task=1000)
    pieces = salt_by(hub, heavy, ["from", "n"]).where(F.col("to") == "t0").groupBy("_salt").count().collect()
    assert len(pieces) == heavy.pieces and max(r["count"] for r in pieces) < 1200


def test_heavy_keys_have_pieces_of_their_own(spark):
    ends = F.when(F.col("id") < 7000, "a").when(F.col("id") < 9500, "b").otherwise(F.concat(F.lit("c"), F.col("id")))
    edges = spark.range(10_000).select(ends.alias("to"), F.col("id").alias("n"))
    heavy = heavy_keys(edges, ["to"], rows_per_task=1000)
    names = {r[0]: r[1] for r in spark.createDataFrame([("a",), ("b",)], "to string").select(F.xxhash64("to"), "to").collect()}
    assert {names[h]: n for h, n in heavy.table.collect()} == {"a": 7, "b": 3} and heavy.pieces == 10
    cut = rows(salt_by(edges, heavy, ["n"]).groupBy("to").agg(F.countDistinct("_salt")).where("to < 'c'"))
    assert cut == Counter([("a", 7), ("b", 3)])
    table = edges.select("to").distinct().withColumn("x", F.length("to"))
    assert rows(lookup_join(edges, table, "to", heavy)) == rows(edges.join(table, "to"))


@pytest.mark.parametrize("hubs", [False, True])
def test_cluster_by_id(spark, hubs):
    edges = spark.range(10_000).select(F.when(F.col("id") < 4000, 3).otherwise(F.col("id") % 100).alias("src"), F.col("id").alias("dst"))
    heavy = heavy_keys(edges, ["src"], rows_per_task=1000) if hubs else HeavyKeys(("src",))
    dealt = with_pieces(edges, heavy) if hubs else edges
    dealt = cluster_by_id(dealt, "src", ids=100, total=10_000, then="dst", partitions=5, hub_pieces=heavy.pieces)
    assert dealt.columns == edges.columns and rows(dealt) == rows(edges)
    at = dealt.withColumn("p", F.spark_partition_id()).groupBy("p").agg(F.min("src"), F.max("src"), F.count("*")).collect()
    for p, low, high, n in at:
        assert (20 * p <= low and high < 20 * p + 20) if p < 5 else low == high == 3 and n < 3000
    assert max(r[3] for r in at) < (3000 if hubs else 6000)
    assert "RoundRobin" not in plan(dealt) and "rangepartitioning" not in plan(dealt)


def test_resolve_with_heavy_ends(spark, hub):
    keys = hub.select(F.col("from").alias("guid")).union(hub.select("to")).where(F.col("guid") != "t7")
    ids = assign_ids(keys)
    split = resolve_endpoints(hub, ids, rows_per_task=1000)
    plain = resolve_endpoints(hub, ids, split_heavy=False)
    assert rows(split) == rows(plain) and split.count() == 9_999
    kinds = resolve_endpoints(hub, ids, src_kinds=["s"], dst_kinds=["t"], split_heavy=False)
    assert rows(kinds) == rows(plain)
    assert resolve_endpoints(hub, ids, src_kinds=["x"], split_heavy=False).count() == 0


def test_resolve_drops_null_and_unknown_ends(spark):
    ids = spark.createDataFrame([("a", 0), ("b", 1)], "guid string, id bigint")
    edges = spark.createDataFrame(
        [("a", "b", 1), ("a", None, 2), (None, "b", 3), ("a", "x", 4), ("b", "b", 5)], "`from` string, `to` string, n int"
    )
    assert rows(resolve_endpoints(edges, ids)) == Counter([(0, 1, 1), (1, 1, 5)])


@pytest.mark.parametrize("batch", [10_000, 7])
def test_fold(spark, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    pick = random.Random(5)
    days = [date(2024, 1, d) for d in range(1, 6)] + [None]
    data = [
        (pick.choice([1, 1, 1, 2, 3]), 9, pick.choice(days), pick.choice(["x", "y", None]), pick.choice([True, False, None]))
        for _ in range(500)
    ] + [(4, 9, days[0], None, None), (5, 9, None, "z", False)]
    edges = materialize(
        spark.createDataFrame(data, "src bigint, dst bigint, scan_date date, sni string, valid boolean"),
        scratch_dir(spark, "fold"),
    )
    got = fold_edges(edges, sets={"sni": "server_name_indicators"})
    assert got.columns == ["src", "dst", "scan_dates", "server_name_indicators", "valid"]
    want = {}
    for src, dst, day, sni, valid in data:
        dates, names, flags = want.setdefault((src, dst), (set(), set(), set()))
        dates.add(day), names.add(sni), flags.add(valid)
    for r in got.collect():
        dates, names, flags = want.pop((r.src, r.dst))
        assert r.scan_dates == sorted(dates - {None})
        assert r.server_name_indicators == sorted(names - {None})
        assert r.valid is (True if True in flags else False if False in flags else None)
    assert not want
    names = {(s, n): [v for a, _, _, b, v in data if (a, b) == (s, n)] for s, _, _, n, _ in data if n}
    best = lambda v: True if True in v else False if False in v else None
    assert rows(edge_members(edges, "sni")) == Counter((s, 9, n, best(v)) for (s, n), v in names.items())
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_fold_without_dates_is_distinct(spark):
    edges = spark.createDataFrame([(1, 2), (1, 2), (2, 1)], "src bigint, dst bigint")
    assert rows(fold_edges(edges)) == Counter([(1, 2), (2, 1)])


def test_merge_observations(spark):
    ddl = "`from` string, `to` string, scan_date string"
    one = spark.createDataFrame(
        [("a", "b", "d", True), ("a", "b", "d", False), ("a", "c", "d", False), ("a", "e", "d", None)], ddl + ", valid boolean"
    )
    two = spark.createDataFrame([("a", "c", "d"), ("z", "b", "d")], ddl)
    assert rows(merge_observations(one, two)) == Counter(
        [("a", "b", "d", True), ("a", "c", "d", False), ("a", "e", "d", None), ("z", "b", "d", None)]
    )


def test_reverse_and_semi(spark):
    edges = spark.createDataFrame([(1, 2, ["d"], True), (3, 4, ["d"], False), (5, 6, ["d"], None)], "src bigint, dst bigint, scan_dates array<string>, valid boolean")
    assert reverse_valid(edges).collect() == [(2, 1, ["d"])]
    assert reverse_valid(edges.drop("scan_dates")).collect() == [(2, 1)]
    returns = spark.createDataFrame([(1, 7, True), (2, 7, True), (3, 8, False), (3, 9, None)], "src bigint, dst bigint, valid boolean")
    contains = spark.createDataFrame([(7, 1), (7, 2), (8, 1), (9, 1)], "src bigint, dst bigint")
    assert rows(semi_edges(contains, returns)) == Counter([(1, 7), (2, 7)])


def test_degrees(spark):
    pick = random.Random(2)
    kinds = [[(pick.randint(0, 20), pick.randint(0, 30)) for _ in range(200)] for _ in range(3)]
    frames = [spark.createDataFrame(k, "src bigint, dst bigint") for k in kinds]
    every = [e for k in kinds for e in k]
    ins, outs = Counter(d for _, d in every), Counter(s for s, _ in every)
    got = {r.id: (r.inDegree, r.outDegree) for r in degrees(*frames).collect()}
    assert got == {i: (ins.get(i), outs.get(i)) for i in ins.keys() | outs.keys()}
    assert sum(i or 0 for i, _ in got.values()) == sum(o or 0 for _, o in got.values()) == len(every)


def test_vertices(spark):
    ids = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "guid string, id bigint")
    vertices = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y"), ("z", "no id")], "guid string, name string")
    numbered = number_vertices(vertices, ids)
    assert rows(numbered) == Counter([(0, "x"), (1, "y")])
    degree = spark.createDataFrame([(0, 2, None)], "id bigint, inDegree bigint, outDegree bigint")
    assert rows(attach_degrees(numbered, degree)) == Counter([(0, "x", 2, None), (1, "y", None, None)])
    assert rows(attach_degrees(numbered, degree, zero=True)) == Counter([(0, "x", 2, 0), (1, "y", 0, 0)])


def test_one_shuffle_per_operator(spark, hub):
    edges = hub.select(F.hash("from").cast("long").alias("src"), F.hash("to").cast("long").alias("dst"))
    assert plan(degrees(edges, edges)).count("Exchange") == 1


def test_fold_is_hashed_then_sorted(spark, hub):
    dated = hub.withColumns({"scan_date": F.lit("d"), "sni": F.col("to")})
    shown = plan(fold_edges(dated, ("from", "to"), sets={"sni": "names"}))
    assert "ObjectHashAggregate" not in shown and "SortAggregate" not in shown
    assert shown.count("HashAggregate") == 2 and shown.count("Exchange") == 2


def test_workspace(spark, tmp_path):
    assert checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    path = str(tmp_path / "t")
    assert not is_complete(spark, path)
    first = materialize(spark.range(5), path, range_by=["id"], partitions=2)
    assert is_complete(spark, path) and first.count() == 5
    assert materialize(spark.range(9), path, resume=True).count() == 5
    assert materialize(spark.range(9), path).count() == 9


def test_rows_of_a_lookup_are_not_sorted(spark, hub):
    table = spark.range(0, 10_000, 2).select(F.concat(F.lit("t"), F.col("id")).alias("to"), F.col("id").alias("x"))
    for heavy in (HeavyKeys(("to",)), heavy_keys(hub, ["to"], rows_per_task=1000)):
        shown = plan(lookup_join(hub, table, "to", heavy))
        assert "ShuffledHashJoin" in shown and "SortMergeJoin" not in shown


def test_an_observation_is_one_row_of_the_fold(spark):
    seen = spark.createDataFrame(
        [(1, 2, "d1", "x", None), (1, 2, "d1", "x", True), (1, 2, "d2", None, False), (1, 3, None, None, None)],
        "src long, dst long, scan_date string, sni string, valid boolean",
    )
    assert rows(edge_rows(seen, sets=["sni"])) == Counter([(1, 2, "d1", "x", True), (1, 2, "d2", None, False), (1, 3, None, None, None)])
    assert edge_rows(seen.drop("valid"), sets=["sni"]).count() == 3


def test_a_large_group_is_reduced_as_it_grows(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(fold, "_HELD_ROWS", 10)
    pick = random.Random(3)
    data = sorted([(k, pick.choice("abc"), pick.choice("xyz")) for k in (1, 2, 2, 2) for _ in range(50)])
    for size in (3, 7, 200):
        table = pa.table({"k": [r[0] for r in data], "d": [r[1] for r in data], "s": [r[2] for r in data], "f": [i == 60 for i in range(200)]})
        made = list(fold._gather(iter(table.to_batches(size)), ["k"], {"d": "ds", "s": "ss"}, ["f"]))
        got = [tuple(r.values()) for b in made for r in b.to_pylist()]
        assert got == [(1, list("abc"), list("xyz"), False), (2, list("abc"), list("xyz"), True)]


def test_packed_keys_are_as_different_as_texts(spark):
    digits = "c_" + "0f" * 32
    texts = ["", "a", "c_", digits, digits.upper(), digits[:-1], digits + "0", "\0c_" + "\x0f" * 32, "\1\0a", "\0a", "\1a", "d_é", None]
    df = spark.createDataFrame([(t, t) for t in texts], "`from` string, t string")
    packed = pack_keys(df, "from")
    assert {len(r[0]) for r in packed.where(F.col("t") == digits).collect()} == {35}
    assert packed.select("from").distinct().count() == len(texts) and pack_keys(packed, "from").schema == packed.schema
    ids = assign_ids(df.select(F.col("t").alias("guid")))
    edges = df.select("from", F.col("t").alias("to"))
    assert resolve_endpoints(edges, ids).where("src = dst").count() == len(texts) - 1
    assert rows(resolve_endpoints(pack_keys(edges, "from", "to"), ids)) == rows(resolve_endpoints(edges, ids))


def test_ids_of_different_keys_need_no_second_shuffle(spark):
    keys = spark.range(1000).select(F.sha1(F.col("id").cast("string").cast("binary")).alias("guid"))
    assert rows(assign_ids(keys, distinct=True)) == rows(assign_ids(keys.union(keys)))


def test_rows_are_scanned_again_for_candidates_only(spark, hub, monkeypatch):
    stored = []
    monkeypatch.setattr(skew, "materialize", lambda df, path: stored.append(path) or materialize(df, path))
    assert not heavy_keys(hub, ["n"], rows_per_task=1000) and len(stored) == 1
    assert heavy_keys(hub, ["to"], rows_per_task=1000).pieces == 4 and len(stored) == 3


def test_rows_that_hardly_repeat_are_shuffled_once(spark):
    pick = random.Random(9)
    days = [date(2024, 1, d) for d in range(1, 6)] + [None]
    data = [(pick.randrange(60), 9, pick.choice(days), pick.choice(["x", "y", None]), pick.choice([True, False, None])) for _ in range(900)]
    seen = spark.createDataFrame(data, "src int, dst int, scan_date date, sni string, valid boolean")
    sets = {"sni": "names"}
    once = fold_edges(seen, sets=sets, reduce_first=False)
    twice = fold_edges(seen, sets=sets)
    assert [plan(x).count("Exchange hash") for x in (once, twice)] == [1, 2]
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))
    assert folds_at_once(seen.distinct()) and not folds_at_once(seen.union(seen))
    # An edge with more rows than a task should take is reduced first.
    assert not folds_at_once(seen.distinct(), share=skew.ROWS_PER_TASK // 10)
    assert folds_at_once(seen.limit(0))


def test_small_kinds_are_broadcast(spark, monkeypatch):
    from scanweave.operators import edges as module

    monkeypatch.setattr(module, "SMALL_KIND", 5)
    ids = assign_ids(spark.range(8).selectExpr("concat('d_', id) AS guid").union(spark.range(5).selectExpr("concat('ip_', id) AS guid")))
    assert small_kinds(ids, ["d_", "ip_", "c_"]) == ["ip_", "c_"]
    seen = spark.range(60).selectExpr("concat('ip_', id % 6) AS `from`", "IF(id % 11 > 0, concat('d_', id % 7), NULL) AS `to`", "id AS n")
    for kinds in ({"src_kinds": ["ip_"], "dst_kinds": ["d_"]}, {"src_kinds": ["ip_"], "dst_kinds": ["c_", "d_"]}):
        found = resolve_endpoints(seen, ids, **kinds, split_heavy=False, small_kinds=["ip_", "c_"])
        assert plan(found).count("ShuffledHashJoin") == 1
        assert plan(found).count("Exchange hash") == 2  # of the rows and of the ids of the other kind
        assert rows(found) == rows(resolve_endpoints(seen, ids, **kinds, split_heavy=False))
