"""Quality rules as a ledger of bits.

Every rule is evaluated once per document; the ledger keeps the measurements and one
failure bit per rule. Policies are versioned masks over those bits, so a new policy, or the
question what a rule costs, needs the ledger only and no text. All of it is DataFrame and
SQL functions: one pass over the texts, no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

#: What separates words, and the characters counted as symbols.
SEPARATORS = " \t\n\x0b\x0c\r"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """``fails``: SQL over the measurements."""

    name: str
    fails: str


#: A rule's bit is its place in this list. Rules are added at the end, never moved.
RULES = (
    Rule("few_words", "n_words < 10"),
    Rule("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 40 * n_lines"),
    Rule("few_letters", "100 * n_letter_words < 60 * n_words"),
)
BASE = ("few_words", "repeated_windows")


@dataclass(frozen=True)
class Policy:
    """A document is kept if it fails none of ``rules``."""

    name: str
    version: int
    rules: tuple[str, ...]

    def mask(self, rules: Sequence[Rule] = RULES) -> int:
        bits = {r.name: 1 << i for i, r in enumerate(rules)}
        return sum(bits[r] for r in set(self.rules))


BASE_POLICY = Policy("base", 1, BASE)
POLICY = Policy("corpus", 1, tuple(r.name for r in RULES))


def _repeat_words(ordered: str) -> Column:
    """Words in windows that the text holds twice: with the windows' places sorted by
    their hash, equal ones are neighbours; the places found are then summed up as ranges."""
    at = F.filter(
        F.transform(ordered, lambda x, i: F.when(
            (x["h"] == F.get(F.col(ordered), i - 1)["h"]) | (x["h"] == F.get(F.col(ordered), i + 1)["h"]), x["i"]
        )),
        lambda x: x.isNotNull(),
    )
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("sum"))
    return F.aggregate(
        F.sort_array(at),
        start,
        lambda s, x: F.struct(x.alias("last"), (s["sum"] + F.least(F.lit(WINDOW), x - s["last"])).alias("sum")),
        lambda s: s["sum"],
    )


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the measurements of every whole text; a null text has no words."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    inner = F.btrim(F.col("_text"), F.lit(SEPARATORS))
    words = F.when(F.col("_inner") == "", F.array().cast("array<string>")).otherwise(F.split("_inner", "[ \t-\r]+"))
    lines = F.filter(F.split(F.col("_text"), "\n"), lambda x: F.btrim(x, F.lit(SEPARATORS)) != "")
    windows = F.when(F.size("_words") >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size("_words") - WINDOW),
        lambda i: F.xxhash64(*(F.get(F.col("_words"), i + k) for k in range(WINDOW))),
    )).otherwise(F.array().cast("array<long>"))
    twice = F.size(F.array_distinct("_windows")) < F.size("_windows")
    ordered = F.when(twice, F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("_text"))
    rows = rows.withColumn("_inner", inner).withColumns({"_words": words, "_lines": lines}).withColumn("_windows", windows)
    rows = rows.withColumn("_ordered", ordered)
    return rows.select(
        "doc_id",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.concat_ws("", "_words")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.when(F.col("_ordered").isNotNull(), _repeat_words("_ordered")), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.regexp_count("_text", F.lit(r"(?<![^ \t-\r])[^ \t-\r\p{L}]*+\p{L}")).cast("long").alias("n_letter_words"),
    )


def ledger(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``doc_id``, the measurements and ``fail_bits``: one row per row of ``docs``.

    A null or empty text, or one of separators only, has zero for every measurement. Rows
    without an id and repeated rows are measured each for itself; an empty table gives
    no rows; columns besides ``doc_id`` and ``text`` are not looked at.
    """
    bits = [F.when(F.expr(r.fails), F.lit(1 << i)).otherwise(0).cast("long") for i, r in enumerate(rules)]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return measured(docs).withColumn("fail_bits", total)


def keeps(policy: Policy, rules: Sequence[Rule] = RULES, bits: str = "fail_bits") -> Column:
    return F.col(bits).bitwiseAND(F.lit(policy.mask(rules)).cast("long")) == 0


def with_policies(book: DataFrame, *policies: Policy) -> DataFrame:
    """One column ``<name>_v<version>`` per policy: whether it keeps the document."""
    return book.withColumns({f"{p.name}_v{p.version}": keeps(p) for p in policies})


def ablation(book: DataFrame, *policies: Policy, rules: Sequence[Rule] = RULES) -> DataFrame:
    """What each rule of each policy does: ``policy, version, rule, failed, failed_alone, kept,
    kept_without``. Documents are counted by their failure bits first, so the
    shuffle holds one row per combination of failures and task."""
    counted = book.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    bit = {r.name: 1 << i for i, r in enumerate(rules)}
    asked = F.array(*(
        F.struct(
            F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"), F.lit(r).alias("rule"),
            F.lit(p.mask(rules)).cast("long").alias("mask"), F.lit(bit[r]).cast("long").alias("bit"),
        )
        for p in policies for r in p.rules
    ))
    rows = counted.select("fail_bits", "n", F.inline(asked))
    hit = F.col("fail_bits").bitwiseAND(F.col("mask"))
    others = hit.bitwiseAND(F.bitwise_not("bit"))
    total = lambda when: F.sum(F.when(when, F.col("n")).otherwise(0))
    return rows.groupBy("policy", "version", "rule").agg(
        total(hit.bitwiseAND(F.col("bit")) != 0).alias("failed"),
        total((hit != 0) & (others == 0)).alias("failed_alone"),
        total(hit == 0).alias("kept"),
        total(others == 0).alias("kept_without"),
    )


def judged(docs: DataFrame, policy: Policy = POLICY) -> DataFrame:
    """The ledger with ``base_failed`` and ``kept``."""
    book = ledger(docs)
    base = ~keeps(BASE_POLICY)
    return book.withColumn("base_failed", base).withColumn("kept", ~base & keeps(policy))
