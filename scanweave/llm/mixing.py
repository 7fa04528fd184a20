"""Mixing of sources to target weights, by budgets in a tree of domains, languages and sources.

A total of tokens flows down the tree by weights. What a node cannot use goes to its
siblings first and only then, when they are full as well, to the next level up. Each leaf
takes whole epochs and then a prefix of the next, in an order seeded by epoch. The prefix
is found as a cut in the order's hash, so documents are chosen by a filter.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from .exchange import local_table, row_key, stored, unused

LEVELS = ("domain", "lang", "source")
UNKNOWN = "unknown"
#: Leaves of a tree that the driver fills and that are broadcast; larger trees are filled by
#: windows and joined by their leaves.
SMALL_TREE = 100_000
#: Steps of the order's hash; a step's documents are ordered in one task.
_STEP_BITS = 12
#: Fixed values of the test tables: the domain of a source is told by its hash.
DOMAINS = ("web", "books", "code")


@dataclass(frozen=True)
class Target:
    """``weights``: per level the weight of a node by name, 1 if it has none. ``total``: tokens to
    take, or ``share`` of those there are. A leaf is read at most ``epochs`` times."""

    weights: Mapping[str, Mapping[str, float]] = field(default_factory=dict)
    total: int | None = None
    share: float = 1.0
    epochs: int = 1
    seed: int = 17


def domain_of(source: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, DOMAINS)), (F.pmod(F.crc32(F.encode(source, "UTF-8")), F.lit(len(DOMAINS))) + 1).cast("int"))


def fill(budget: float, wanted: dict, room: dict) -> dict:
    """Shares of ``budget`` by weight, none above its room; the rest goes to those below."""
    got, open_ = dict.fromkeys(wanted, 0.0), {k for k, w in wanted.items() if w > 0}
    left = min(budget, sum(room[k] for k in open_))
    while open_ and left > 1e-9:
        unit = left / sum(wanted[k] for k in open_)
        full = {k for k in open_ if got[k] + unit * wanted[k] >= room[k] - 1e-9}
        for k in full or open_:
            more = room[k] - got[k] if full else unit * wanted[k]
            got[k] += more
            left -= more
        if not full:
            break
        open_ -= full
    return got


def budgets(leaves: Mapping[tuple[str, ...], int], target: Target) -> dict[tuple[str, ...], int]:
    """Tokens for each leaf (a path of names); ``leaves`` has how many there are."""
    total = target.total if target.total is not None else int(target.share * sum(leaves.values()))
    out: dict[tuple[str, ...], int] = {}

    def down(path: tuple[str, ...], budget: float, below: list[tuple[str, ...]]) -> None:
        if len(path) == len(LEVELS):
            out[path] = int(budget + 1e-6)
            return
        children: dict[str, list] = {}
        for leaf in below:
            children.setdefault(leaf[len(path)], []).append(leaf)
        weights = target.weights.get(LEVELS[len(path)], {})
        room = {c: float(target.epochs * sum(leaves[x] for x in own)) for c, own in children.items()}
        got = fill(budget, {c: float(weights.get(c, 1.0)) for c in children}, room)
        for c, own in children.items():
            down((*path, c), got[c], own)

    down((), float(total), sorted(leaves))
    return out


def flowed(leaves: DataFrame, target: Target) -> DataFrame:
    """``_leaf, tokens, budget``: as ``budgets`` (to a token, for rounding) for a table ``_leaf,
    tokens`` of any size.

    Below one parent, children fill up in the order of their room for each unit of weight. A
    child is full if the level at which the budget would end among it and those after it is
    above its own; from the first that is not, all get that level. Running sums tell, so a
    window passes over its sorted children and keeps none of them.
    """
    total = target.total
    if total is None:
        total = int(target.share * (leaves.agg(F.sum("tokens")).first()[0] or 0))
    nodes, budget = leaves.select(*(F.col(f"_leaf.{n}").alias(n) for n in LEVELS), "tokens"), None
    for i, level in enumerate(LEVELS):
        parent = list(LEVELS[:i])
        weights = [F.when(F.col(level) == name, F.lit(float(w))) for name, w in target.weights.get(level, {}).items()]
        own = nodes.groupBy(*parent, level).agg((F.sum("tokens") * target.epochs).cast("double").alias("room"))
        own = own.withColumn("weight", F.coalesce(*weights, F.lit(1.0))).where("weight > 0")
        own = own.join(budget, parent) if parent else own.withColumn("given", F.lit(float(total)))
        weight = own.groupBy(*parent).agg(F.sum("weight").alias("weights"))
        own = own.join(weight, parent) if parent else own.join(F.broadcast(weight))  # one row
        own = own.withColumn("own_level", F.col("room") / F.col("weight"))
        order = Window.partitionBy(*parent).orderBy("own_level", level)
        before = order.rowsBetween(Window.unboundedPreceding, -1)
        used, passed = (F.coalesce(F.sum(c).over(before), F.lit(0.0)) for c in ("room", "weight"))
        own = own.withColumn("level", (F.col("given") - used) / F.greatest(F.col("weights") - passed, "weight"))
        short = F.when(F.col("own_level") > F.col("level"), F.col("level"))
        ends = F.first(short, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        got = F.when(ends.isNull(), F.col("room")).otherwise(F.greatest(ends, F.lit(0.0)) * F.col("weight"))
        budget = own.select(*parent, level, got.alias("given"))
    budget = budget.select(F.struct(*LEVELS).alias("_leaf"), F.floor(F.col("given") + 1e-6).cast("long").alias("budget"))
    return leaves.join(budget, "_leaf", "left").select("_leaf", "tokens", F.coalesce("budget", F.lit(0)).alias("budget"))


def _lookup(table: DataFrame, leaves: int) -> DataFrame:
    """A table with one row per leaf as the side of a join: broadcast if the tree is small."""
    return F.broadcast(table) if leaves <= SMALL_TREE else table


def _words(text: Column) -> Column:
    inner = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(inner == "", 0).otherwise(F.size(F.split(inner, "[ \t-\r]+"))).cast("long")


def placed(docs: DataFrame, domain: Column | None = None) -> DataFrame:
    """``docs`` with its leaf in ``_leaf`` (names of the levels), ``_tokens`` (words) and ``_row``."""
    domain = domain if domain is not None else domain_of(F.col("source"))
    names = [F.coalesce(c.cast("string"), F.lit(UNKNOWN)).alias(n) for c, n in zip((domain, F.col("lang"), F.col("source")), LEVELS)]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumns({"_leaf": F.struct(*names), "_tokens": _words(text), "_row": row_key()})


def _order(seed: int, epoch: Column) -> Column:
    return F.xxhash64(F.lit(seed), epoch.cast("int"), F.col("_row"))


def cuts(rows: DataFrame, target: Target) -> DataFrame:
    """``_leaf, whole, cut, budget, tokens``: whole epochs of each leaf, and up to which hash its
    next epoch is read. ``rows`` as by ``placed``."""
    spark = rows.sparkSession
    sizes = stored(rows.select("_leaf", "_tokens", "_row"), "leaves")
    leaves = stored(sizes.groupBy("_leaf").agg(F.sum("_tokens").alias("tokens")), "tree")
    count = leaves.count()
    if count <= SMALL_TREE:
        held = {tuple(r["_leaf"]): r["tokens"] for r in leaves.collect()}
        schema = "_leaf struct<domain string, lang string, source string>, tokens long, budget long"
        plan = local_table(spark, [(dict(zip(LEVELS, k)), held[k], b) for k, b in budgets(held, target).items()], schema)
    else:
        plan = stored(flowed(leaves, target), "budgets")
    plan = plan.withColumn("whole", F.when(F.col("tokens") > 0, F.expr("budget div nullif(tokens, 0)")).otherwise(0))
    plan = plan.withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens"))

    # Where whole epochs use up the budget nothing of the next one is read, not even texts without tokens.
    keyed = sizes.join(_lookup(plan, count), "_leaf").where(F.col("rest") > 0).select("_leaf", "_tokens", "rest", _order(target.seed, F.col("whole")).alias("h"))
    step = F.shiftright("h", 64 - _STEP_BITS)
    keyed = keyed.withColumn("step", step)
    sums = keyed.groupBy("_leaf", "rest", "step").agg(F.sum("_tokens").alias("in_step"), F.max("h").alias("last"))
    ahead = Window.partitionBy("_leaf").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("in_step").over(ahead), F.lit(0)))
    whole = sums.where(F.col("before") + F.col("in_step") <= F.col("rest")).groupBy("_leaf").agg(F.max("last").alias("cut"))
    # The step in which the budget ends: one per leaf, ordered row by row.
    split = sums.where((F.col("before") <= F.col("rest")) & (F.col("before") + F.col("in_step") > F.col("rest")))
    split = keyed.join(_lookup(split.select("_leaf", "step", "before"), count), ["_leaf", "step"])
    upto = Window.partitionBy("_leaf", "step").orderBy("h").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    split = split.withColumn("total", F.col("before") + F.sum("_tokens").over(upto))
    inside = split.where(F.col("total") <= F.col("rest")).groupBy("_leaf").agg(F.max("h").alias("inner_cut"))
    out = plan.join(whole, "_leaf", "left").join(inside, "_leaf", "left")
    cut = F.coalesce(F.greatest("cut", "inner_cut"), F.lit(None).cast("long"))
    return stored(out.select("_leaf", "whole", cut.alias("cut"), "budget", "tokens"), "cuts")


def mix_sources(docs: DataFrame, target: Target, domain: Column | None = None) -> DataFrame:
    """The columns of ``docs`` and ``_leaf, _tokens, _row, epoch``: a row for each time a document
    is taken. Input columns of these four names are replaced, all others are kept.

    Tokens are words between white space. Names that are null are one node, ``unknown``. A
    text that is null or empty has no tokens; it is taken where the order reaches it.
    Repeated rows have one place in the order and are taken or left together. A leaf never
    exceeds its budget; it may stay below it by less than the next document. An empty
    table gives no rows.
    """
    rows = placed(docs, domain)
    plan = cuts(rows, target).select("_leaf", F.struct("whole", "cut").alias(name := unused(docs, "_plan")))
    chosen = rows.join(_lookup(plan, plan.count()), "_leaf")
    whole, cut = F.col(f"{name}.whole"), F.col(f"{name}.cut")
    epochs = F.array_compact(F.concat(
        F.when(whole > 0, F.sequence(F.lit(0).cast("long"), whole - 1)).otherwise(F.array().cast("array<long>")),
        F.array(F.when(cut.isNotNull() & (_order(target.seed, whole) <= cut), whole)),
    ))
    own = [c for c in rows.columns if c != "epoch"]
    return chosen.select(*own, name, F.explode(epochs).alias("epoch")).drop(name)
