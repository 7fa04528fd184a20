"""Public suffix lookup as broadcast joins against a small rule table."""

from __future__ import annotations

import glob
import hashlib
import itertools
import os
import zipfile

import pyarrow as pa
import pyspark
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .names import ancestors, is_valid_domain, label_count, normalized
from .text import url_host

EXACT, WILDCARD, EXCEPTION = 1, 2, 4


def _read_list(path: str | None) -> str:
    if path:
        with open(path, encoding="utf-8") as lines:
            return lines.read()
    homes = [os.environ.get("SPARK_HOME"), os.path.dirname(pyspark.__file__)]
    for home in filter(None, homes):
        for jar in sorted(glob.glob(os.path.join(home, "jars", "httpclient-4*.jar"))):
            with zipfile.ZipFile(jar) as archive:
                return archive.read("mozilla/public-suffix-list.txt").decode("utf-8")
    raise FileNotFoundError("no public suffix list among Spark's jars; pass a path")


def _spellings(rule: str):
    """The rule with each non-ASCII label in Unicode and in its ASCII form."""
    forms = []
    for label in rule.split("."):
        forms.append([label] if label.isascii() else [label, label.encode("idna").decode()])
    return (".".join(labels) for labels in itertools.product(*forms))


class SuffixRules:
    """Small tables of suffixes by their number of labels, each with a bit mask of
    the rule kinds it carries, without and with the private section of the list.

    The list is a file that the driver reads, ten thousand rules as published; it does not
    grow with the scans, so its tables are always broadcast."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        masks: dict[str, list[int]] = {}
        private = False
        for line in _read_list(path).splitlines():
            rule = line.strip()
            if rule.startswith("//"):
                if "===BEGIN" in rule:
                    private = "PRIVATE" in rule
                continue
            if not rule:
                continue
            kind = EXACT
            if rule.startswith("!"):
                kind, rule = EXCEPTION, rule[1:]
            elif rule.startswith("*."):
                kind, rule = WILDCARD, rule[2:]
            for spelling in _spellings(rule.lower()):
                mask = masks.setdefault(spelling, [0, 0])
                mask[0] |= 0 if private else kind
                mask[1] |= kind
        self.depth = max(s.count(".") + 1 for s in masks)
        self.digest = hashlib.sha256(repr(sorted(masks.items())).encode()).hexdigest()
        self._sides = {
            (column, n): self._side(spark, masks, i, n)
            for i, column in enumerate(("icann", "every"))
            for n in range(1, self.depth + 1)
        }

    def _side(self, spark: SparkSession, masks: dict, section: int, labels: int) -> DataFrame:
        rows = {s: m[section] for s, m in masks.items() if m[section] and s.count(".") + 1 == labels}
        return F.broadcast(spark.createDataFrame(
            pa.table(
                {
                    f"_last{labels}": pa.array(rows, pa.string()),
                    f"_mask{labels}": pa.array(rows.values(), pa.int32()),
                }
            )
        ))

    def of_length(self, labels: int, private: bool) -> DataFrame:
        """``(_last<n>, _mask<n>)``: suffixes of ``labels`` labels, each with its mask."""
        return self._sides["every" if private else "icann", labels]


def with_suffix_labels(
    df: DataFrame, name: Column, rules: SuffixRules, *, private: bool, out: str = "suffix_labels"
) -> DataFrame:
    """Add the number of labels of the public suffix of ``name``, 0 if unknown.

    One left join per suffix length against the broadcast rules of that length:
    rows stay where they are, nothing is exploded, shuffled or grouped. The last
    ``n`` labels of a shorter name are the name itself, which no rule of ``n`` labels equals.
    """
    columns = df.columns
    lengths = range(1, rules.depth + 1)
    df = df.withColumn("_name", F.lower(name))
    df = df.selectExpr("*", *(f"substring_index(_name, '.', -{n}) AS _last{n}" for n in lengths))
    for n in lengths:
        df = df.join(rules.of_length(n, private), on=f"_last{n}", how="left")
    # Longest candidate first. A wildcard covers one label more than its key.
    cases = []
    for n in range(rules.depth + 1, 0, -1):
        if n <= rules.depth:
            cases.append(f"WHEN _mask{n} & {EXCEPTION} != 0 THEN {n - 1}")
            cases.append(f"WHEN _mask{n} & {EXACT} != 0 THEN {n}")
        if n > 1:
            further = f"_last{n - 1} != _name"
            cases.append(f"WHEN _mask{n - 1} & {WILDCARD} != 0 AND {further} THEN {n}")
    return df.select(*columns, F.expr(f"CASE {' '.join(cases)} ELSE 0 END").alias(out))


def with_redirect_host(
    df: DataFrame, url: Column, rules: SuffixRules, out: str = "redirect_host"
) -> DataFrame:
    """Add the host a URL points at if it is a valid domain below a known public
    suffix (private suffixes do not count), else null."""
    host = F.regexp_replace(url_host(url), r"\A\.(?!\.)", "")
    df = df.withColumn("_host", host)
    df = with_suffix_labels(df, F.col("_host"), rules, private=False, out="_known")
    named = (F.col("_known") > 0) & (label_count(F.col("_host")) > F.col("_known"))
    keep = F.when(named & is_valid_domain(F.col("_host")), F.col("_host"))
    return df.withColumn(out, keep).drop("_host", "_known")


def with_ancestors(
    df: DataFrame, name: Column, rules: SuffixRules, out: str = "ancestors"
) -> DataFrame:
    """Add the ancestor list of ``name``; private suffixes count."""
    df = with_suffix_labels(df, normalized(name), rules, private=True, out="_known")
    return df.withColumn(out, ancestors(name, F.col("_known"))).drop("_known")
