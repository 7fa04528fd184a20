"""Degree metrics over all edge kinds and their join to the vertices."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def degrees(*edges: DataFrame) -> DataFrame:
    """``(id, inDegree, outDegree)`` over the bag union of all edges in one pass.

    A direction without edges is null. Each row gives one unit to either end;
    partial sums before the shuffle keep a hub as cheap as any other vertex.
    """
    ends = [e.select(F.col("src").cast("long"), F.col("dst").cast("long")) for e in edges]
    rows = reduce(DataFrame.union, ends)
    both = F.array(
        F.struct(F.col("src").alias("id"), F.lit(0).alias("i"), F.lit(1).alias("o")),
        F.struct(F.col("dst").alias("id"), F.lit(1).alias("i"), F.lit(0).alias("o")),
    )
    return (
        rows.select(F.inline(both))
        .groupBy("id")
        .agg(
            F.nullif(F.sum("i"), F.lit(0)).alias("inDegree"),
            F.nullif(F.sum("o"), F.lit(0)).alias("outDegree"),
        )
    )


def number_vertices(vertices: DataFrame, ids: DataFrame, key: str = "guid") -> DataFrame:
    """Distinct vertex rows with their id in front and without the key."""
    columns = [c for c in vertices.columns if c != key]
    rows = vertices.distinct().join(ids.withColumnRenamed(ids.columns[0], key), on=key)
    return rows.select("id", *columns)


def attach_degrees(vertices: DataFrame, degree: DataFrame, *, zero: bool = False) -> DataFrame:
    """Left join of the degrees; a vertex without edges has null ones, or 0 if asked."""
    rows = vertices.join(degree, on="id", how="left")
    return rows.fillna(0, ["inDegree", "outDegree"]) if zero else rows
