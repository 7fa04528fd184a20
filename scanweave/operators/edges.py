"""Edges: from dated observations between keys to folded rows between ids."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .fold import gather_sorted
from .skew import ROWS_PER_TASK, HeavyKeys, heavy_keys, lookup_join


def merge_observations(
    *observations: DataFrame,
    keys: Sequence[str] = ("from", "to", "scan_date"),
    flag: str = "valid",
) -> DataFrame:
    """Union by name (missing columns are null), one row per ``keys``.

    ``flag`` is true if any row says so, false if some say false and none true,
    null if no row knows.
    """
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), observations)
    return rows.groupBy(*keys).agg(F.max(flag).alias(flag))


#: Share of repeated observations up to which rows are folded without reducing them first.
_REPEATED = 0.4


def folds_at_once(edges: DataFrame, keys: Sequence[str] = ("src", "dst"), *, share: int = 1) -> bool:
    """Whether rows can be folded without reducing them first: most differ, by a count and an
    estimate made in one pass, and no edge has more rows than a task should take. ``edges`` may
    be one in ``share`` of the rows. The answer steers work, never rows."""
    different = F.approx_count_distinct(F.xxhash64(*edges.columns), 0.02)
    n, different = edges.agg(F.count(F.lit(1)), different).first()
    return n * (1 - _REPEATED) <= different and not heavy_keys(
        edges, keys, rows_per_task=max(1, ROWS_PER_TASK // share), total=n
    )


def edge_rows(
    edges: DataFrame,
    keys: Sequence[str] = ("src", "dst"),
    *,
    date: str = "scan_date",
    sets: Iterable[str] = (),
    flag: str = "valid",
) -> DataFrame:
    """The different observations of each edge: one row per edge, date and value of each column
    in ``sets``; ``flag`` is true if ever true.

    One plain hash aggregate over the whole observation: every map task reduces its rows first,
    and what is left is spread by edge *and* members, so an edge with a third of all rows is
    many small groups. An observation is one row, however many members it has.
    """
    members = [c for c in (date, *sets) if c in edges.columns]
    if flag not in edges.columns:
        return edges.select(*keys, *members).distinct()
    return edges.groupBy(*keys, *members).agg(F.max(flag).alias(flag))


def edge_members(
    edges: DataFrame, member: str, keys: Sequence[str] = ("src", "dst"), *, flag: str = "valid"
) -> DataFrame:
    """``(keys, member, flag)``: one row per edge and value of ``member``, for edges with more
    values than a list should hold. Null values are left out."""
    seen = edges.where(F.col(member).isNotNull())
    return edge_rows(seen.select(*keys, member, *(c for c in [flag] if c in edges.columns)), keys, date=member, flag=flag)


def fold_edges(
    edges: DataFrame,
    keys: Sequence[str] = ("src", "dst"),
    *,
    date: str = "scan_date",
    sets: Mapping[str, str] | None = None,
    flag: str = "valid",
    reduce_first: bool = True,
) -> DataFrame:
    """One row per edge over time: sorted ``scan_dates``, the sorted set of each
    column in ``sets`` (old name -> new name), and ``flag`` true if ever true.

    Columns that are absent are left out; without a date column the edges are
    made distinct. Rows are reduced to ``edge_rows`` by a hash aggregate; the lists are then
    made of sorted neighbours, so no aggregate holds sets. Rows of which ``folds_at_once`` is true
    can do without the first (``reduce_first``): they are shuffled once instead of twice.
    """
    if date not in edges.columns:
        return edges.select(*keys).distinct()
    rows = edge_rows(edges, keys, date=date, sets=sets or (), flag=flag) if reduce_first else edges
    lists = {date: "scan_dates", **(sets or {})}
    lists = {old: new for old, new in lists.items() if old in edges.columns}
    return gather_sorted(rows, keys, lists, [flag] if flag in edges.columns else [])


def resolve_endpoints(
    edges: DataFrame,
    ids: DataFrame,
    src: str = "from",
    dst: str = "to",
    *,
    src_kinds: Sequence[str] = (),
    dst_kinds: Sequence[str] = (),
    split_heavy: bool = True,
    rows_per_task: int | None = None,
    heavy: Mapping[str, HeavyKeys] | None = None,
    small_kinds: Sequence[str] = (),
) -> DataFrame:
    """Replace the keys at both ends by their ids, as ``src`` and ``dst``.

    Edges with a null key or one without an id are dropped. Keys travel packed (``pack_keys``),
    and the ends are looked up one after the other, ``dst`` first. ``src_kinds`` and
    ``dst_kinds`` name the key prefixes that can occur at an end; the id table is
    sorted by key, so the filter skips the files of all other kinds. ``edges``
    should be a stored table when ``split_heavy`` is on, see ``heavy_keys``; ``heavy`` has
    the heavy keys of both ends if they are known. An end whose kinds are all in ``small_kinds``
    is looked up first, in a broadcast table: what is shuffled for the other has one key less.
    """
    edges = pack_keys(edges, src, dst)
    if heavy is None:
        heavy = heavy_ends(edges, (src, dst), rows_per_task=rows_per_task) if split_heavy else {}
    rows = edges.where(F.col(src).isNotNull() & F.col(dst).isNotNull())
    others = [c for c in edges.columns if c not in (src, dst)]
    lookups = [(dst, "dst", dst_kinds), (src, "src", src_kinds)]
    for end, name, kinds in sorted(lookups, key=lambda x: not _all_small(x[2], small_kinds)):
        table = pack_keys(_of_kinds(ids, kinds), ids.columns[0]).select(
            F.col(ids.columns[0]).alias(end), F.col(ids.columns[1]).alias(name)
        )
        small = _all_small(kinds, small_kinds)
        rows = lookup_join(rows, table, end, heavy.get(end, HeavyKeys((end,))), small=small).drop(end)
    return rows.select("src", "dst", *others)


def heavy_ends(
    edges: DataFrame,
    ends: Sequence[str] = ("from", "to"),
    *,
    rows_per_task: int | None = None,
    total: int | None = None,
) -> dict[str, HeavyKeys]:
    """The heavy keys at each end of a stored edge table, packed as ``resolve_endpoints`` has them."""
    edges = pack_keys(edges, *ends)
    bound = {} if rows_per_task is None else {"rows_per_task": rows_per_task}
    total = edges.count() if total is None else total
    return {end: heavy_keys(edges, [end], total=total, **bound) for end in ends}


def pack_keys(df: DataFrame, *columns: str) -> DataFrame:
    """Text keys as bytes, a key of a kind and 64 hexadecimal digits in half its size.

    Equal bytes are equal keys: packed digits are marked by a first byte 0, and a text that
    begins with a byte 0 or 1 by a further 1. Columns that hold bytes already stay as they are.
    """
    texts = [c for c in columns if df.schema[c].dataType == T.StringType()]
    return df.withColumns({c: _packed(F.col(c)) for c in texts}) if texts else df


def _packed(key: Column) -> Column:
    digits = F.concat(F.lit(b"\0"), F.left(key, F.lit(2)).cast("binary"), F.unhex(F.substr(key, F.lit(3))))
    marked = F.concat(F.lit(b"\1"), key.cast("binary"))
    plain = F.when(key < "\2", marked).otherwise(key.cast("binary"))
    of_digits = key.rlike(r"\A[a-z]_[0-9a-f]{64}\z")
    return F.when(of_digits, digits).otherwise(plain)


#: Ids of a kind that are broadcast: some 50 MB.
SMALL_KIND = 500_000


def small_kinds(ids: DataFrame, kinds: Sequence[str]) -> list[str]:
    """Those of ``kinds`` with so few ids that they can be broadcast."""
    return [k for k in kinds if _of_kinds(ids, [k]).limit(SMALL_KIND + 1).count() <= SMALL_KIND]


def _all_small(kinds: Sequence[str], small: Sequence[str]) -> bool:
    return bool(kinds) and all(k in small for k in kinds)


def _of_kinds(ids: DataFrame, kinds: Sequence[str]) -> DataFrame:
    if not kinds:
        return ids
    key = F.col(ids.columns[0])
    return ids.where(reduce(lambda a, b: a | b, (key.startswith(k) for k in kinds)))


def reverse_valid(edges: DataFrame) -> DataFrame:
    """Valid edges the other way round, with their dates and nothing else.

    All dates of an edge are kept if it was valid on one of them.
    """
    dates = [c for c in edges.columns if c == "scan_dates"]
    return edges.where("valid").select(F.col("dst").alias("src"), F.col("src").alias("dst"), *dates)


def semi_edges(contains: DataFrame, returns: DataFrame, *, split_heavy: bool = True) -> DataFrame:
    """``contains`` reversed, where its source is the target of a valid ``returns`` edge.

    Targets are made distinct before the join: a certificate that is returned by
    very many hosts is one row there.
    """
    heavy = heavy_keys(contains, ["src"]) if split_heavy else HeavyKeys(("src",))
    targets = returns.where("valid").select(F.col("dst").alias("src")).distinct()
    rows = lookup_join(contains.select("src", "dst"), targets, "src", heavy, "left_semi")
    return rows.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
