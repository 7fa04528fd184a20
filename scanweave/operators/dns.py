"""DNS answers to address pairs, following aliases within one record."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import strip_dots

# Record types that carry an address, and the alias type.
ADDRESS_TYPES = ("A", "AAAA")
ALIAS_TYPE = "CNAME"


def _clean(answers: Column) -> Column:
    """Answers with all three fields, names without trailing dots and blanks."""
    whole = F.filter(
        answers, lambda a: a["name"].isNotNull() & a["type"].isNotNull() & a["data"].isNotNull()
    )
    return F.transform(
        whole,
        lambda a: F.struct(
            strip_dots(a["name"]).alias("name"),
            a["type"].alias("type"),
            strip_dots(a["data"]).alias("data"),
        ),
    )


def _addresses(answers: Column) -> Column:
    return F.filter(answers, lambda a: a["type"].isin(*ADDRESS_TYPES))


def _pair(address: Column, owner: Column) -> Column:
    return F.struct(
        address["data"].alias("ip"), owner.alias("domain"), address["type"].alias("type")
    )


def flatten_answers(
    records: DataFrame, answers: str = "answers", keep: Sequence[str] = ()
) -> DataFrame:
    """``(ip, domain, type)`` of every address answer, with the ``keep`` columns in front."""
    found = F.transform(_addresses(_clean(F.col(answers))), lambda a: _pair(a, a["name"]))
    return records.select(*keep, F.inline(found))


def resolve_cnames(
    records: DataFrame,
    answers: str = "answers",
    keep: Sequence[str] = (),
    *,
    bag: bool = False,
    max_hops: int | None = None,
) -> DataFrame:
    """``(ip, domain, type)``: address answers, and for every alias the addresses
    that its owner reaches over aliases of the same record.

    All work is array work within the row, nothing is shuffled. Every pair of a record
    comes once, and each owner's names are searched breadth first. As a ``bag``, an
    address comes once per loop-free alias path to it, so a record whose aliases
    form a dense mesh yields as many rows as it has paths. ``max_hops`` bounds the aliases
    of a path; what lies beyond is found by ``long_aliases``.
    """
    rows = _searched(records, answers, keep, bag, max_hops, "found")
    direct = F.transform("_hosts", lambda a: _pair(a, a["name"]))
    chased = F.flatten(
        F.transform(
            "_found",
            lambda r: F.transform(
                F.filter("_hosts", lambda a: F.array_contains(r["names"], a["name"])),
                lambda a: _pair(a, r["root"]),
            ),
        )
    )
    pairs = F.concat(direct, chased)
    return rows.select(*keep, F.inline(pairs if bag else F.array_distinct(pairs)))


def long_aliases(
    records: DataFrame,
    answers: str = "answers",
    keep: Sequence[str] = (),
    *,
    bag: bool = False,
    max_hops: int,
) -> DataFrame:
    """``(reason, payload)``: where ``resolve_cnames`` with the same bound stops, one row per alias
    owner and name that it would have gone on to."""
    rows = _searched(records, answers, keep, bag, max_hops, "beyond")
    # Exploding a bare column, Spark would filter on its size first, and search twice for that.
    rows = rows.select(*keep, F.explode(F.flatten("_beyond")).alias("b"))
    return rows.select(*keep, F.lit("alias path too long").alias("reason"), F.to_json("b").alias("payload"))


def _searched(
    records: DataFrame, answers: str, keep: Sequence[str], bag: bool, max_hops: int | None, part: str
) -> DataFrame:
    """The records' addresses ``_hosts``, and one part of the search: ``_found`` or ``_beyond``."""
    if max_hops is not None and max_hops < 1:
        raise ValueError("max_hops must be at least 1")
    rows = records.where(F.size(answers) > 0)
    rows = rows.select(*keep, _clean(F.col(answers)).alias("_answers"))
    rows = rows.withColumns(
        {
            "_hosts": _addresses(F.col("_answers")),
            "_alias": F.filter("_answers", lambda a: a["type"] == ALIAS_TYPE),
        }
    )
    return rows.withColumn(f"_{part}", (_paths if bag else _closure)(F.col("_alias"), max_hops, part))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _rounds(alias: Column, most: int | None) -> Column:
    """One element for each round of a search that needs no more rounds than aliases."""
    return alias if most is None else F.slice(alias, 1, most)


def _paths(alias: Column, max_hops: int | None, part: str) -> Column:
    """``found [(root, [name])]``: one entry per loop-free path; or ``beyond [[(root, name)]]``: by
    owner, the next names of those that are stopped. A path grows by one alias per round.

    The aliases of each owner are listed first, each with the place among the owners of the name
    it leads to (0 if that has no aliases): a path meets only the aliases of its last name."""

    def listed(owner: Column, owners: Column) -> Column:
        return F.transform(
            F.filter(alias, lambda c: c["name"] == owner),
            lambda c: F.struct(c["data"].alias("name"), F.array_position(owners, c["data"]).cast("int").alias("at")),
        )

    def search(root: Column, own: Column, aliases: Column) -> Column:
        def step(to: Column, seen: Column) -> Column:
            return F.struct(to["name"].alias("name"), to["at"].alias("at"), F.array_append(seen, to["name"]).alias("seen"))

        def grow(path: Column) -> Column:
            onward = F.filter(
                F.get(aliases, path["at"] - 1), lambda to: ~F.array_contains(path["seen"], to["name"])
            )
            return F.transform(onward, lambda to: step(to, path["seen"]))

        def onward(tips: Column) -> Column:
            return F.flatten(F.transform(F.filter(tips, lambda p: p["at"] > 0), grow))

        def names(paths: Column) -> Column:
            return F.transform(paths, lambda p: p["name"])

        def round_(state: Column, _: Column) -> Column:
            grown = _let(
                onward(state["tips"]),
                lambda longer: F.struct(longer.alias("tips"), F.concat(state["all"], names(longer)).alias("all")),
            )
            return F.when(F.size(state["tips"]) > 0, grown).otherwise(state)

        def ended(state: Column) -> Column:
            if part == "found":
                return F.transform(state["all"], lambda n: F.struct(root.alias("root"), F.array(n).alias("names")))
            beyond = F.array_distinct(names(onward(state["tips"])))
            return F.transform(beyond, lambda n: F.struct(root.alias("root"), n.alias("name")))

        first = F.transform(F.filter(own, lambda to: to["name"] != root), lambda to: step(to, F.array(root)))
        start = _let(first, lambda tips: F.struct(tips.alias("tips"), names(tips).alias("all")))
        rounds = _rounds(alias, None if max_hops is None else max_hops - 1)
        return _let(F.aggregate(rounds, start, round_), ended)

    def searched(owners: Column, aliases: Column) -> Column:
        each = F.zip_with(owners, aliases, lambda root, own: search(root, own, aliases))
        return F.flatten(each) if part == "found" else each

    return _let(
        F.array_distinct(F.transform(alias, lambda c: c["name"])),
        lambda owners: _let(
            F.transform(owners, lambda owner: listed(owner, owners)), lambda aliases: searched(owners, aliases)
        ),
    )


def _closure(alias: Column, max_hops: int | None, part: str) -> Column:
    """``found [(root, names)]``: one entry per alias owner with all names it reaches; or
    ``beyond [[(root, name)]]``: by owner, the names that a bound keeps it from."""

    def onward(state: Column) -> Column:
        further = F.filter(alias, lambda c: F.array_contains(state["tips"], c["name"]))
        return F.array_except(F.transform(further, lambda c: c["data"]), state["seen"])

    def reach(root: Column) -> Column:
        def round_(state: Column, _: Column) -> Column:
            grown = _let(
                onward(state),
                lambda fresh: F.struct(
                    fresh.alias("tips"), F.concat(state["seen"], fresh).alias("seen")
                ),
            )
            return F.when(F.size(state["tips"]) > 0, grown).otherwise(state)

        start = F.struct(F.array(root).alias("tips"), F.array(root).alias("seen"))
        return F.aggregate(_rounds(alias, max_hops), start, round_)

    def ended(root: Column, state: Column) -> Column:
        if part == "found":
            names = F.array_except(state["seen"], F.array(root))
            return F.struct(root.alias("root"), names.alias("names"))
        return F.transform(onward(state), lambda n: F.struct(root.alias("root"), n.alias("name")))

    owners = F.array_distinct(F.transform(alias, lambda c: c["name"]))
    return F.transform(owners, lambda n: _let(reach(n), lambda state: ended(n, state)))


def answer_errors(
    records: DataFrame, answers: str = "answers", keep: Sequence[str] = ()
) -> DataFrame:
    """``(reason, payload)`` of answers that are incomplete or of another type."""
    known = (*ADDRESS_TYPES, ALIAS_TYPE)
    rows = records.select(*keep, F.explode(answers).alias("a"))
    whole = F.col("a.name").isNotNull() & F.col("a.type").isNotNull() & F.col("a.data").isNotNull()
    reason = F.when(~whole, "incomplete answer").when(~F.col("a.type").isin(*known), "unknown type")
    return rows.select(*keep, reason.alias("reason"), F.to_json("a").alias("payload")).where(
        F.col("reason").isNotNull()
    )
