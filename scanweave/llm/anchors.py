"""Repeated windows of many texts, found through anchors.

Windows of ``window`` consecutive units (words or bytes) are keyed by their anchor: the
least hash among the grams of ``gram`` units they hold. Equal windows have equal
anchors, so only texts that share an anchor have to be compared. Consecutive windows
with one anchor form a *segment*: a segment's content is the run of units it covers.

Segments meet by anchor. Those of equal content are settled on the spot; those
whose anchor has several contents are *open* and left to the operator.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .exchange import buckets, columns, longs, pack, split_by, tidied, unpack
from .textbytes import (
    byte_span_hash,
    byte_sums,
    gram_hashes,
    pieces,
    sliding_argmin,
    text_buffer,
    word_hashes,
    word_span_hash,
    word_spans,
    word_sums,
)

#: With more contents than this for one anchor in a batch, they are open without meeting
#: the other batches: no task gathers the contents of a very common anchor.
CONTENTS = 64
#: Segments that a task holds before it sends them on.
PORTION = 1 << 18
_FIRST = -(2**63)


class Scheme(NamedTuple):
    """What a window is and which of its occurrences count as repeated."""

    words: bool
    window: int
    gram: int
    everywhere: bool  # all occurrences, or all but the earliest


class Segments(NamedTuple):
    """``n`` windows each from ``start`` on, in document ``row``; ``lead`` units before the
    anchor; ``times``: how many equal segments it stands for."""

    key: np.ndarray
    content: np.ndarray
    doc: np.ndarray
    row: np.ndarray
    start: np.ndarray
    n: np.ndarray
    lead: np.ndarray
    times: np.ndarray

    def take(self, at: np.ndarray) -> "Segments":
        return Segments(*(x[at] for x in self))


KINDS = ("u8", "u8", "i8", "i8", "u4", "u2", "u2", "u4")
EMPTY = Segments(*(np.zeros(0, k) for k in KINDS))


def join(parts: list[Segments]) -> Segments:
    return Segments(*(np.concatenate(x) for x in zip(*parts))) if parts else EMPTY


def segments(text: pa.Array, doc: np.ndarray, row: np.ndarray, scheme: Scheme) -> Iterator[Segments]:
    raw, offsets = text_buffer(text)
    window, gram = scheme.window, scheme.gram
    for a, b in pieces(offsets):
        part, own = raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        if scheme.words:
            begin, end, counts = word_spans(part, own)
            units = word_hashes(part, begin, end)
            grams, sums, spans = gram_hashes(units, gram), word_sums(units), word_span_hash
        else:
            counts, sums, spans = np.diff(own), byte_sums(part), byte_span_hash
            at = np.arange(max(0, len(part) - gram + 1))
            grams = byte_span_hash(sums, at, at + gram)
        owner = np.repeat(np.arange(len(counts)), counts)
        if len(owner) < window:
            continue
        anchor = sliding_argmin(grams, window - gram + 1)
        inside = np.flatnonzero(owner[: len(owner) - window + 1] == owner[window - 1 :])
        if not len(inside):
            continue
        chosen = anchor[inside]
        new = np.ones(len(inside), bool)
        new[1:] = (chosen[1:] != chosen[:-1]) | (inside[1:] != inside[:-1] + 1)
        at = np.flatnonzero(new)
        n, first = np.diff(np.r_[at, len(inside)]), inside[at]
        of = owner[first]
        before = np.concatenate([[0], np.cumsum(counts)])[of]
        yield Segments(
            grams[chosen[at]], spans(sums, first, first + n + window - 1), doc[a + of], row[a + of],
            (first - before).astype(np.uint32), n.astype(np.uint16), (chosen[at] - first).astype(np.uint16),
            np.ones(len(first), np.uint32),
        )


def collapse(own: Segments, everywhere: bool) -> tuple[Segments, Segments]:
    """``(earliest, settled)``: the earliest segment of each content, in the order of keys,
    with the sum of ``times``; and the segments that equal an earlier one (or any other)."""
    if not len(own.key):
        return own, own
    own = own.take(np.lexsort((own.start, own.row, own.doc, own.content, own.key)))
    new = np.ones(len(own.key), bool)
    new[1:] = (own.key[1:] != own.key[:-1]) | (own.content[1:] != own.content[:-1])
    at = np.flatnonzero(new)
    times = np.add.reduceat(own.times.astype(np.int64), at)
    # A repeated row is the same place once more, not a later one.
    later = ~new
    if everywhere:
        settled = own.take(later & np.repeat(times > 1, np.diff(np.r_[at, len(new)])))
    else:
        place = np.repeat(at, np.diff(np.r_[at, len(new)]))
        later &= (own.doc != own.doc[place]) | (own.row != own.row[place]) | (own.start != own.start[place])
        settled = own.take(later)
    return own.take(at)._replace(times=np.minimum(times, 2).astype(np.uint32)), settled


def per_key(own: Segments) -> np.ndarray:
    """Number of contents that share a segment's key; ``own`` is in the order of keys."""
    if not len(own.key):
        return np.zeros(0, np.int64)
    at = np.flatnonzero(np.r_[True, own.key[1:] != own.key[:-1]])
    count = np.diff(np.r_[at, len(own.key)])
    return np.repeat(count, count)


#: What leaves a step: a settled range (``open`` false), or an open segment.
FOUND = "open boolean, hot boolean, key long, doc long, row long, start long, n int, lead int, times int"
_NAMES = ["open", "hot", "key", "doc", "row", "start", "n", "lead", "times"]


def found(own: Segments, still_open: bool, hot: np.ndarray | bool = False) -> pa.RecordBatch:
    k = len(own.key)
    flags = np.broadcast_to(np.asarray(hot, bool), k)
    if not still_open:
        own = _merged(own)
        k, flags = len(own.key), np.zeros(len(own.key), bool)
    columns_ = [
        np.full(k, still_open), flags, own.key.view(np.int64), own.doc, own.row, own.start.astype(np.int64),
        own.n.astype(np.int32), own.lead.astype(np.int32), own.times.astype(np.int32),
    ]
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns_], _NAMES)


def _merged(own: Segments) -> Segments:
    """Ranges of windows with those that touch joined."""
    if len(own.key) < 2:
        return own
    own = own.take(np.lexsort((own.start, own.row)))
    start = own.start.astype(np.int64)
    end = start + own.n
    base = np.cumsum(np.r_[0, own.row[1:] != own.row[:-1]]).astype(np.int64) << 33
    reach = np.maximum.accumulate(base + end)
    new = np.ones(len(start), bool)
    new[1:] = base[1:] + start[1:] > reach[:-1]
    at = np.flatnonzero(new)
    last = np.r_[at[1:], len(new)] - 1
    n = reach[last] - base[at] - start[at]
    return own.take(at)._replace(n=n)


def _portions(batches: Iterable[pa.RecordBatch], scheme: Scheme) -> Iterator[Segments]:
    waiting, held = [], 0
    for doc, row, text in columns(batches, "doc_id", "row", "text"):
        for own in segments(text, longs(doc, _FIRST), longs(row), scheme):
            waiting.append(own)
            held += len(own.key)
            if held >= PORTION:
                yield join(waiting)
                waiting, held = [], 0
    if waiting:
        yield join(waiting)


@tidied
def _scan(batches: Iterable[pa.RecordBatch], scheme: Scheme, parts: int) -> Iterator[pa.RecordBatch]:
    for own in _portions(batches, scheme):
        first, settled = collapse(own, scheme.everywhere)
        common = per_key(first) > CONTENTS
        if common.any():  # one segment of the key goes on, to mark the key
            yield _wrapped(found(first.take(common), True, True))
            own = first.take(common)
            mark = own.take(np.flatnonzero(np.r_[True, own.key[1:] != own.key[:-1]]))
            first = join([first.take(~common), mark._replace(times=np.zeros(len(mark.key), np.uint32))])
        if len(settled.key):
            yield _wrapped(found(settled, False))
        if len(first.key):
            lists = list(split_by((first.key % np.uint64(parts)).astype(np.int64), parts))
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in lists], pa.int32()), pa.array([pack(*first.take(at)) for _, at in lists], pa.binary()), pa.nulls(len(lists), pa.binary())],
                ["bucket", "data", "found"],
            )


def _wrapped(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Rows that are ready pass through the exchange as one packed value."""
    data = b"".join(np.ascontiguousarray(c.to_numpy(zero_copy_only=False)).tobytes() for c in batch.columns)
    bucket = pa.array([batch.num_rows * 7919 % 1009], pa.int32())
    return pa.RecordBatch.from_arrays([bucket, pa.nulls(1, pa.binary()), pa.array([data], pa.binary())], ["bucket", "data", "found"])


_FOUND_KINDS = ("?", "?", "i8", "i8", "i8", "i8", "i4", "i4", "i4")


@tidied
def _meet(batches: Iterable[pa.RecordBatch], scheme: Scheme, limit: int) -> Iterator[pa.RecordBatch]:
    parts = []
    for data, ready in columns(batches, "data", "found"):
        for d, r in zip(data, ready):
            if r.is_valid:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in unpack(r.as_buffer(), *_FOUND_KINDS)], _NAMES)
            else:
                parts.append(Segments(*unpack(d.as_buffer(), *KINDS)))
    own = join(parts)
    parts.clear()
    marked = np.unique(own.key[own.times == 0])
    own = own.take(own.times > 0)
    if not len(own.key):
        return
    first, settled = collapse(own, scheme.everywhere)
    yield found(settled, False)
    if scheme.everywhere:
        yield found(first.take(first.times > 1), False)
    hot = np.isin(first.key, marked)
    count = per_key(first)
    still = (count > 1) | hot
    yield found(first.take(still), True, (hot | (count > limit))[still])


def repeated(rows: DataFrame, scheme: Scheme, limit: int = 1 << 30) -> DataFrame:
    """Settled ranges and open segments (see ``FOUND``) of ``doc_id, row, text``. Open
    segments whose key has more than ``limit`` contents are ``hot``."""
    parts = buckets(rows.sparkSession)
    scanned = rows.mapInArrow(partial(_scan, scheme=scheme, parts=parts), "bucket int, data binary, found binary")
    return scanned.repartition(parts, "bucket").mapInArrow(partial(_meet, scheme=scheme, limit=limit), FOUND)


def with_lists(rows: DataFrame, of: DataFrame, name: str, how: str, *fields: str) -> DataFrame:
    """Documents with the list of what ``of`` has for their row; a list is bounded by
    the length of the text."""
    lists = of.groupBy("row").agg(F.collect_list(F.struct(*fields)).alias(name))
    return rows.join(lists, "row", how)


def covered(n: int, starts: np.ndarray, counts: np.ndarray, window: int) -> np.ndarray:
    """Which of ``n`` units lie in a window of the ranges."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + counts + window - 1, -1)
    return np.cumsum(edge[:-1]) > 0


def list_columns(lists, *fields: str) -> Iterator[tuple[np.ndarray, ...]]:
    """The fields of each list of structs as arrays; a null list is empty."""
    flat = lists.flatten()
    values = [longs(flat.field(f)) for f in fields]
    sizes = pa.compute.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
    at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    for i in range(len(lists)):
        yield tuple(v[at[i] : at[i + 1]] for v in values)
