"""Lists per group, gathered in one pass over sorted rows.

Aggregates that build arrays keep an object per group and fall back to sorting when there
are many. Here the rows are sorted by Spark, which spills, and equal neighbours are joined
batch by batch: what is held is the group at hand, reduced to its different values as it grows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, types as T

#: A group with more rows than this is reduced to its different values before more are held.
_HELD_ROWS = 1 << 20


def gather_sorted(
    rows: DataFrame, keys: Sequence[str], lists: Mapping[str, str], flags: Sequence[str] = ()
) -> DataFrame:
    """One row per ``keys``: the different values of each column in ``lists`` (old name -> new
    name) as a sorted list, without nulls, and the maximum of each boolean in ``flags``.
    """
    types = {f.name: f.dataType for f in rows.schema}
    fields = [T.StructField(k, types[k]) for k in keys]
    fields += [T.StructField(new, T.ArrayType(types[old])) for old, new in lists.items()]
    fields += [T.StructField(f, T.BooleanType()) for f in flags]
    rows = rows.select(*keys, *lists, *flags).repartition(*keys).sortWithinPartitions(*keys, *lists)
    return rows.mapInArrow(
        partial(_gather, keys=list(keys), lists=dict(lists), flags=list(flags)), T.StructType(fields)
    )


def _differ(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Where two arrays differ; null equals null only."""
    both = pc.fill_null(pc.not_equal(a, b), False)
    return pc.or_(both, pc.xor(pc.is_null(a), pc.is_null(b))).to_numpy(zero_copy_only=False)


def _starts(rows: pa.RecordBatch, keys: Sequence[str]) -> np.ndarray:
    new = np.zeros(rows.num_rows, bool)
    new[:1] = True
    for k in keys:
        column = rows.column(k)
        new[1:] |= _differ(column[1:], column[:-1])
    return np.flatnonzero(new)


def _continues(last: pa.RecordBatch, rows: pa.RecordBatch, keys: Sequence[str]) -> bool:
    return not any(_differ(last.column(k)[-1:], rows.column(k)[:1])[0] for k in keys)


def _gather(
    batches: Iterable[pa.RecordBatch], keys: list[str], lists: dict[str, str], flags: list[str]
) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []  # from the first row of the group at hand
    n, most = 0, _HELD_ROWS
    for batch in batches:
        if not batch.num_rows:
            continue
        first = _starts(batch, keys)
        if held and _continues(held[-1], batch, keys):
            first = first[1:]
        if not len(first):
            held.append(batch)
            n += batch.num_rows
            if n > most:
                held = [_reduced(held, keys, lists, flags)]
                n = held[0].num_rows
                most = max(_HELD_ROWS, 2 * n)
            continue
        if first[-1]:
            held.append(batch.slice(0, first[-1]))
        if held:
            yield _groups(held, keys, lists, flags)
        held, most = [batch.slice(first[-1])], _HELD_ROWS
        n = held[0].num_rows
    if held:
        yield _groups(held, keys, lists, flags)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def _reduced(
    parts: list[pa.RecordBatch], keys: list[str], lists: dict[str, str], flags: list[str]
) -> pa.RecordBatch:
    """The last group of ``parts`` in as few rows as its longest list, ahead of it all others."""
    rows = _joined(parts)
    at = _starts(rows, keys)[-1]
    group = rows.slice(at)
    values = {old: group.column(old).drop_null().unique() for old in lists}
    size = max(1, *(len(v) for v in values.values()))
    made = {k: group.column(k).take(pa.array(np.zeros(size, np.int64))) for k in keys}
    for old, v in values.items():
        made[old] = pa.concat_arrays([v, pa.nulls(size - len(v), v.type)])
    for f in flags:
        made[f] = pa.array([pc.max(group.column(f)).as_py()] * size, pa.bool_())
    # Columns keep their order and type, so that batches still fit together.
    small = pa.RecordBatch.from_arrays([made[c] for c in rows.schema.names], schema=rows.schema)
    return _joined([rows.slice(0, at), small]) if at else small


def _distinct(column: pa.Array, group: np.ndarray, groups: int) -> pa.ListArray:
    """The different values of each group in order, without nulls; ``group`` ascends."""
    valid = pc.is_valid(column).to_numpy(zero_copy_only=False)
    column, group = column.drop_null(), group[valid]
    size = np.bincount(group, minlength=groups)
    many = np.flatnonzero(size[group] > 1)
    if len(many):
        some = pa.table({"g": group[many], "v": column.take(pa.array(many))})
        order = np.arange(len(group))
        order[many] = many[pc.sort_indices(some, [("g", "ascending"), ("v", "ascending")]).to_numpy()]
        column = column.take(pa.array(order))
        new = np.ones(len(group), bool)
        new[1:] = (group[1:] != group[:-1]) | _differ(column[1:], column[:-1])
        column, size = column.filter(pa.array(new)), np.bincount(group[new], minlength=groups)
    ends = np.concatenate([[0], np.cumsum(size)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), column)


def _groups(
    parts: list[pa.RecordBatch], keys: list[str], lists: dict[str, str], flags: list[str]
) -> pa.RecordBatch:
    rows = _joined(parts)
    starts = _starts(rows, keys)
    group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, rows.num_rows)))
    made = {k: rows.column(k).take(pa.array(starts)) for k in keys}
    for old, new in lists.items():
        made[new] = _distinct(rows.column(old), group, len(starts))
    for f in flags:
        known = rows.column(f).cast(pa.int8()).fill_null(-1).to_numpy(zero_copy_only=False)
        best = np.maximum.reduceat(known, starts)
        made[f] = pa.array(best > 0, pa.bool_(), mask=best < 0)
    return pa.RecordBatch.from_pydict(made)
