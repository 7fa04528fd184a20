"""Every query against the SQL that checks it, on whole tables."""

import math
import os
from collections import Counter

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = os.environ.get("CATALOG_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def checker():
    with duckdb.connect() as db:
        for name in TABLES:
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
        yield db


def plain(value):
    return round(value, 6) if isinstance(value, float) and not math.isnan(value) else value


def compare(spark, checker, name):
    got = queries()[name](spark, FOLDER)
    cursor = checker.execute(oracle_sql()[name])
    want_columns = [d[0] for d in cursor.description]
    assert sorted(got.columns) == sorted(want_columns)
    order = sorted(want_columns)
    want = Counter(
        tuple(plain(dict(zip(want_columns, row))[c]) for c in order) for row in cursor.fetchall()
    )
    have = Counter(tuple(plain(row[c]) for c in order) for row in got.collect())
    assert sum(want.values()) > 0
    missing, extra = want - have, have - want
    assert not missing and not extra, (
        f"{sum(missing.values())} missing {list(missing)[:3]}, {sum(extra.values())} extra {list(extra)[:3]}"
    )


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, checker, name):
    compare(spark, checker, name)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_observations_are_numbered_before_they_are_folded(spark):
    shown = queries()["returns_edges"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    folds = [line for line in shown.splitlines() if "hashpartitioning(src" in line]
    assert len(folds) == 2 and "hashpartitioning(from" in shown
