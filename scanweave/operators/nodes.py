"""Vertices and their keys from the scan tables.

A key is a kind prefix and the natural key: ``c_<sha256>``, ``d_<name>``,
``ip_<address>``. The prefixes sort one after the other, so each kind is one
stretch of the sorted id table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.address import is_valid_ip
from ..functions.names import is_expandable
from ..functions.suffix import SuffixRules, with_ancestors

CERT, DOMAIN, IP = "c_", "d_", "ip_"


def entity_key(kind: str, value: Column) -> Column:
    """Null for a null value, so that such an end never joins."""
    return F.concat(F.lit(kind), value)


def valid_certs(certs: DataFrame) -> DataFrame:
    """Rows with a full-length hash, with their key."""
    return certs.where(F.length("sha256") == 64).withColumn(
        "guid", entity_key(CERT, F.col("sha256"))
    )


def san_names(certs: DataFrame, names: str = "altNames") -> DataFrame:
    """``(guid, domain_name, ip)``: one row per alternative name, which is one of the two.

    A certificate seen in many scans is reduced to one row before it is exploded.
    """
    rows = certs.where(F.col(names).isNotNull()).select("guid", names).distinct()
    rows = rows.select("guid", F.explode(names).alias("name"))
    is_ip = is_valid_ip(F.col("name"))
    return rows.select(
        "guid",
        F.when(~is_ip, F.col("name")).alias("domain_name"),
        F.when(is_ip, F.col("name")).alias("ip"),
    )


def cert_nodes(certs: DataFrame) -> DataFrame:
    """One row per certificate; each attribute is the largest value seen.

    A certificate looks the same in all its scans: hashing makes its rows one before
    the maxima, which sort for text, see any.
    """
    keys, attributes = ["guid", "sha1", "sha256"], ["subject", "issuer", "notBefore", "notAfter", "numAltNames"]
    seen = certs.select(*keys, *attributes).distinct()
    return seen.groupBy(*keys).agg(*(F.max(a).alias(a) for a in attributes))


def domain_nodes(names: DataFrame, rules: SuffixRules) -> DataFrame:
    """``(guid, domain_name, parent)`` for all names and their ancestors.

    ``names`` has one column. Names are made distinct before the suffix lookup
    and once more after expansion. The parent is the next entry of the list the
    name was found in: it depends on the name alone, so the rows of one name are
    equal.
    """
    column = names.columns[0]
    rows = names.where(F.col(column).isNotNull()).distinct()
    rows = with_ancestors(rows, F.col(column), rules, "_chain").where(F.size("_chain") > 0)
    listed = F.transform("_chain", lambda d, i: F.struct(d.alias("domain_name"), (i + 1 < F.size("_chain")).alias("_below")))
    # The parent is the name without its first label: only that there is one goes along.
    rows = rows.select(F.inline(listed)).distinct()
    above = F.substr(F.col("domain_name"), F.instr(F.col("domain_name"), ".") + 1)
    parent = F.when(F.col("_below") & is_expandable(F.col("domain_name")), above)
    return rows.select(entity_key(DOMAIN, F.col("domain_name")).alias("guid"), "domain_name", parent.alias("parent"))


def parent_edges(domains: DataFrame) -> DataFrame:
    """``(from, to)`` from every domain to its immediate parent."""
    return domains.where(F.col("parent").isNotNull()).select(
        F.col("guid").alias("from"), entity_key(DOMAIN, F.col("parent")).alias("to")
    )


def ip_nodes(*addresses: DataFrame) -> DataFrame:
    """``(guid, ip)`` of the valid addresses in one-column tables, duplicates included:
    numbering the keys is what makes them distinct."""
    rows = reduce(DataFrame.union, addresses).toDF("ip").where(is_valid_ip(F.col("ip")))
    return rows.select(entity_key(IP, F.col("ip")).alias("guid"), "ip")
