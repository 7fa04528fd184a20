"""Domain name predicate and expansion into ancestors."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import ascii_dots

# At least two labels; the last one ends in a letter. The possessive loop keeps
# the matcher's stack flat on names with very many labels.
_DOMAIN = (
    r"\A(?:[A-Za-z0-9](?:[A-Za-z0-9_-]{0,61}[A-Za-z0-9])?\.)++"
    r"[A-Za-z0-9][A-Za-z0-9_-]{0,61}[A-Za-z]\z"
)


def _idna(name: Column) -> Column:
    # The JVM's own RFC 3490 encoder; null when the name cannot be encoded.
    # 1 = unassigned code points are allowed.
    return F.try_reflect(F.lit("java.net.IDN"), F.lit("toASCII"), name, F.lit(1))


def is_valid_domain(name: Column) -> Column:
    ascii_only = name.rlike(r"\A\p{ASCII}*\z")
    encoded = F.when(ascii_only, name).otherwise(_idna(name))
    return F.coalesce(encoded.rlike(_DOMAIN), F.lit(False))


def is_expandable(name: Column) -> Column:
    """Valid as it is, or once every ``*.`` is taken out."""
    return is_valid_domain(name) | is_valid_domain(F.replace(name, F.lit("*."), F.lit("")))


def label_count(name: Column) -> Column:
    return F.size(F.split(name, r"\."))


def last_labels(name: Column, count: Column) -> Column:
    return F.call_function("substring_index", name, F.lit("."), -count)


def normalized(name: Column) -> Column:
    return F.rtrim(ascii_dots(name), F.lit("."))


def ancestors(name: Column, suffix_labels: Column) -> Column:
    """The name and its parents down to the registered domain, longest first.

    ``suffix_labels`` is the length of the public suffix in labels; 0 stands for
    an unknown one, where the list ends at two labels. A bare public suffix has
    an empty list, an invalid name a null one.
    """
    clean = normalized(name)
    total = label_count(clean)
    shortest = F.greatest(suffix_labels, F.lit(1)) + 1
    listed = F.transform(
        F.sequence(total, shortest, F.lit(-1)), lambda n: last_labels(clean, n)
    )
    none = F.array().cast("array<string>")
    return F.when(is_expandable(name), F.when(total >= shortest, listed).otherwise(none))
