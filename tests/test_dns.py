"""Alias resolution within one record."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from scanweave.operators.dns import answer_errors, flatten_answers, long_aliases, resolve_cnames
from scanweave.schemas import DNS_RECORD

RECORDS = {
    "chain": ["a CNAME b", "b CNAME c", "c A 1.1.1.1"],
    "cycle": ["x CNAME y", "y CNAME x"],
    "self": ["z CNAME z", "z A 9.9.9.9"],
    "diamond": ["r CNAME p", "r CNAME q", "p CNAME e", "q CNAME e", "e AAAA ::1"],
    "other": ["k A 2.2.2.2", "k TXT t"],
    "dots": ["h. |CNAME|i.", "i.|A|3.3.3.3"],
    "loop with address": ["x CNAME y", "y CNAME x", "x A 1.0.0.1"],
    "case": ["a CNAME B", "b A 1.1.1.1"],
    "empty": [],
}

EXPECTED = {
    "chain": [("1.1.1.1", "a", "A"), ("1.1.1.1", "b", "A"), ("1.1.1.1", "c", "A")],
    "self": [("9.9.9.9", "z", "A")],
    "diamond": [("::1", n, "AAAA") for n in "rrpqe"],
    "other": [("2.2.2.2", "k", "A")],
    "dots": [("3.3.3.3", "h", "A"), ("3.3.3.3", "i", "A")],
    "loop with address": [("1.0.0.1", "x", "A"), ("1.0.0.1", "y", "A")],
    "case": [("1.1.1.1", "b", "A")],
}


def records(spark, data):
    lines = []
    for name, answers in data.items():
        split = [a.split("|") if "|" in a else a.split(" ") for a in answers]
        found = [dict(zip(("name", "type", "data"), s)) for s in split]
        lines.append((json.dumps({"name": name, "data": {"answers": found}}),))
    df = spark.createDataFrame(lines, "line string")
    df = df.select(F.from_json("line", DNS_RECORD).alias("r"))
    return df.select(F.col("r.name").alias("record"), F.col("r.data.answers").alias("answers"))


def grouped(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.record, []).append((r.ip, r.domain, r.type))
    return {k: Counter(v) for k, v in out.items()}


def counters(expected, bag=True):
    return {k: Counter(v if bag else set(v)) for k, v in expected.items()}


def test_paths(spark):
    got = resolve_cnames(records(spark, RECORDS), keep=["record"], bag=True)
    assert grouped(got) == counters(EXPECTED)


def test_pairs(spark):
    got = resolve_cnames(records(spark, RECORDS), keep=["record"], bag=False)
    assert grouped(got) == counters(EXPECTED, bag=False)


def test_flatten(spark):
    got = grouped(flatten_answers(records(spark, RECORDS), keep=["record"]))
    assert got["chain"] == Counter([("1.1.1.1", "c", "A")])
    assert got["dots"] == Counter([("3.3.3.3", "i", "A")])


def walk(answers):
    """Brute force: every loop-free walk along aliases that ends at an address."""
    out = []

    def visit(root, name, seen):
        for owner, kind, data in answers:
            if owner == name and kind in ("A", "AAAA"):
                out.append((data, root, kind))
            elif owner == name and kind == "CNAME" and data not in seen:
                visit(root, data, seen | {data})

    for owner, kind, data in answers:
        if kind in ("A", "AAAA"):
            out.append((data, owner, kind))
        elif kind == "CNAME" and data != owner:
            visit(owner, data, {owner, data})
    return out


def test_random_records_equal_brute_force(spark):
    pick = random.Random(11)
    data, want = {}, {}
    for i in range(300):
        answers = [
            (pick.choice("abcdef"), kind, pick.choice("abcdef" if kind == "CNAME" else "12"))
            for kind in pick.choices(["CNAME", "CNAME", "A", "AAAA"], k=pick.randint(0, 8))
        ]
        data[str(i)] = [" ".join(a) for a in answers]
        if walk(answers):
            want[str(i)] = walk(answers)
    df = records(spark, data)
    assert grouped(resolve_cnames(df, keep=["record"], bag=True)) == counters(want)
    assert grouped(resolve_cnames(df, keep=["record"], bag=False)) == counters(want, bag=False)


@pytest.mark.parametrize("bag", [True, False])
@pytest.mark.parametrize("max_hops", [1, 2, 3, 9])
def test_bounded_paths_lose_nothing_silently(spark, bag, max_hops):
    pick = random.Random(12)
    data = {
        str(i): [f"{pick.choice('abcdef')} CNAME {pick.choice('abcdef')}" for _ in range(pick.randint(1, 9))]
        + [f"{pick.choice('abcdef')} A {k}" for k in "12"]
        for i in range(150)
    }
    df = records(spark, data)
    got = grouped(resolve_cnames(df, keep=["record"], bag=bag, max_hops=max_hops))
    cut = {}
    for r in long_aliases(df, keep=["record"], bag=bag, max_hops=max_hops).collect():
        assert r.reason == "alias path too long"
        cut.setdefault(r.record, []).append(tuple(json.loads(r.payload).values()))
    for name, answers in data.items():
        answers = [tuple(a.split()) for a in answers]
        pairs, beyond = Counter(), set()
        for owner, kind, target in answers:
            if kind == "A":
                pairs[target, owner, kind] += 1
        walks = [(a, b, (a, b)) for a, kind, b in answers if kind == "CNAME" and a != b]
        if not bag:
            walks = list(dict.fromkeys(walks))
        reached = {(a, a): 0 for a, kind, _ in answers if kind == "CNAME"}
        for hops in range(1, max_hops + 2):
            if not bag:  # each name of an owner is met once, over a shortest path
                walks = [w for w in dict((w[:2], w) for w in walks).values() if reached.setdefault(w[:2], hops) == hops]
            for root, tip, _ in walks:
                if hops > max_hops:
                    beyond.add((root, tip))
                    continue
                for owner, kind, target in answers:
                    if kind == "A" and owner == tip:
                        pairs[target, root, kind] += 1
            walks = [(r, b, (*seen, b)) for r, tip, seen in walks for a, kind, b in answers if kind == "CNAME" and a == tip and b not in seen]
        assert set(got.get(name, Counter())) == set(pairs) and (not bag or got.get(name) == pairs)
        assert sorted(cut.get(name, [])) == sorted(beyond)


def test_no_shuffle(spark):
    plan = resolve_cnames(records(spark, RECORDS))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_long_chain(spark):
    names = [f"n{i}" for i in range(200)]
    answers = [f"{a} CNAME {b}" for a, b in zip(names, names[1:])] + [f"{names[-1]} A 1.1.1.1"]
    got = resolve_cnames(records(spark, {"long": answers}), bag=False)
    assert got.count() == 200


def test_errors(spark):
    df = records(spark, {"a": ["k TXT t", "k A 1.1.1.1"]})
    partial = F.array(F.struct(F.lit("n").alias("name"), F.lit("A").alias("type"), F.lit(None).cast("string").alias("data")))
    df = df.union(spark.range(1).select(F.lit("b").alias("record"), partial.alias("answers")))
    got = {(r.record, r.reason) for r in answer_errors(df, keep=["record"]).collect()}
    assert got == {("a", "unknown type"), ("b", "incomplete answer")}


@pytest.mark.parametrize("bag", [True, False])
def test_search_is_in_the_plan_once(spark, bag):
    df = records(spark, RECORDS)
    for rows in (
        resolve_cnames(df, keep=["record"], bag=bag, max_hops=2),
        long_aliases(df, keep=["record"], bag=bag, max_hops=2),
    ):
        assert rows._jdf.queryExecution().optimizedPlan().toString().count("aggregate(") == 1


def test_mesh_records_are_dealt_out(spark, tmp_path):
    from catalog.dns import cname_bounded

    spark.range(200).selectExpr("id AS c_custkey").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    rows = cname_bounded(spark, str(tmp_path))
    assert len(rows.inputFiles()) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert rows.where("reason IS NULL").agg(F.sum("paths")).first()[0] == 200 * (1 + 4 + 12)
    assert rows.where("reason IS NOT NULL").count() == 200 * 20
