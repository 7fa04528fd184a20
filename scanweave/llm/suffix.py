"""Removal of long byte strings that occur earlier, by distributed prefix doubling.

Suffixes are compared at anchors (see ``anchors``) instead of at every byte, so the sorted
table holds some per cent of the positions. A position's first rank is its
anchor. In each round Spark sorts the positions by the rank of a longer string, from 37 to
all 100 bytes; a position whose rank is unique is dropped, equal contents are settled at
once, and only ranks with several contents go on, each cut into finer ranges of offsets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from .anchors import Scheme, covered, list_columns, repeated, with_lists
from .exchange import TEXT_ROWS, buckets, columns, longs, stored, texts, tidied
from .textbytes import text_buffer

LENGTH = 100
GRAM = 24
#: A rank covers so many neighbouring offsets, and ``length + 1 - span`` bytes.
SPANS = (64, 16, 4, 1)

RANKED = "settled boolean, key long, content long, doc long, row long, start long, n int, lead int, data binary"
_NAMES = ["settled", "key", "content", "doc", "row", "start", "n", "lead", "data"]
_TYPES = [pa.bool_(), *[pa.int64()] * 5, pa.int32(), pa.int32(), pa.binary()]


def _fetch(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The bytes of open segments."""
    for row, text, asked in columns(batches, "row", "text", "asked"):
        raw, offsets = text_buffer(text)
        out = []
        for i, (r, own) in enumerate(zip(longs(row), list_columns(asked, "key", "doc", "start", "n", "lead"))):
            data = raw[offsets[i] : offsets[i + 1]].tobytes()
            for k, d, s, n, a in zip(*(x.tolist() for x in own)):
                out.append((False, k, 0, d, r, s, n, a, data[s : s + n + length - 1]))
        yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = zip(*rows) if rows else [[]] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, _TYPES)], _NAMES)


@tidied
def _rank(batches: Iterable[pa.RecordBatch], span: int, length: int) -> Iterator[pa.RecordBatch]:
    """Cut segments into ranges of ``span`` offsets and name each by the string that all of
    its windows share (``key``) and by the string it covers (``content``)."""
    names = ("key", "doc", "row", "start", "n", "lead", "data")
    digest = xxhash.xxh3_64_intdigest
    for key, doc, row, start, n, lead, data in columns(batches, *names):
        seen: dict[tuple[int, int], tuple] = {}
        out = []
        for k, d, r, s, m, a, x in zip(*(c.to_pylist() for c in (key, doc, row, start, n, lead, data))):
            k &= 2**64 - 1
            for j in range((a - m + 1) // span, a // span + 1):
                low, high = max(a - m + 1, j * span), min(a, j * span + span - 1)
                at, core = a - high, a - j * span
                own = x[at : at + high - low + length]
                name = digest(x[core : core + length + 1 - span], k ^ (j + 1))
                content = digest(own, high << 8 | low)
                place = (d, r, s + at)
                mine = (False, name - 2**63, content - 2**63, *place, high - low + 1, high, own)
                other = seen.get((name, content))
                if other is None:
                    seen[name, content] = mine
                elif other[3:6] > place:
                    seen[name, content] = mine
                    out.append((True, *other[1:8], None))
                elif other[3:6] < place:
                    out.append((True, *mine[1:8], None))
        yield _batch(list(seen.values()) + out)


def _fetch_and_rank(batches: Iterable[pa.RecordBatch], span: int, length: int) -> Iterator[pa.RecordBatch]:
    """Both in one worker: two Python steps in a row would take two for each task."""
    return _rank(_fetch(batches, length), span, length)


@tidied
def _rerank(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted rows: what equals the row before is settled, the first of each content goes
    on if its key has another content."""
    last = held = None  # key, content and place of the last content; its row while it is the only one of its key
    for batch in batches:
        ready = batch.column("settled").to_numpy(zero_copy_only=False)
        if ready.any():
            yield batch.filter(pa.array(ready))
            batch = batch.filter(pa.array(~ready))
        if not batch.num_rows:
            continue
        key, content, doc, row, start = (longs(batch.column(c)) for c in ("key", "content", "doc", "row", "start"))
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (content[1:] != content[:-1])
        if last and (key[0], content[0]) == last[:2]:
            new[0] = False
        # The place of the first row of each content, which may stand in the batch before.
        at = np.maximum.accumulate(np.where(new, np.arange(len(key)), -1))
        first = [np.where(at >= 0, x[at], last[2][i] if last else 0) for i, x in enumerate((doc, row, start))]
        later = ~new & ((doc != first[0]) | (row != first[1]) | (start != first[2]))
        if later.any():
            done = batch.filter(pa.array(later))
            yield done.set_column(0, "settled", pa.array(np.ones(done.num_rows, bool)))
        heads = np.flatnonzero(new)
        if len(heads):
            k = key[heads]
            shares = np.zeros(len(heads), bool)
            shares[1:] |= k[1:] == k[:-1]
            shares[:-1] |= k[1:] == k[:-1]
            if last and k[0] == last[0]:
                shares[0] = True
                if held is not None:
                    yield held
            held = None
            yield batch.take(pa.array(heads[shares]))
            if not shares[-1]:
                held = batch.slice(int(heads[-1]), 1)
            h = heads[-1]
            last = (key[h], content[h], (doc[h], row[h], start[h]))


@tidied
def _remove(batches: Iterable[pa.RecordBatch], length: int, keep: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    for doc, text, ranges, *more in columns(batches, "doc_id", "text", "ranges", *keep):
        raw, offsets = text_buffer(text)
        rows = []
        for i, (start, n) in enumerate(list_columns(ranges, "start", "n")):
            own = raw[offsets[i] : offsets[i + 1]]
            gone = covered(len(own), start, n, length)
            spans = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(len(gone) and gone[0])
            left = own[~gone].tobytes()
            kept = left.decode("utf-8", "ignore") if text[i].is_valid else None
            rows.append((len(own), int(gone.sum()), spans, hashlib.sha256(left).hexdigest(), kept))
        cols = list(zip(*rows)) if rows else [[]] * 5
        kinds = [pa.int64()] * 3 + [pa.string()] * 2
        yield pa.RecordBatch.from_arrays([doc, *more, *(pa.array(c, k) for c, k in zip(cols, kinds))], ["doc_id", *keep, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def earlier_strings(rows: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``row, start, n``: ranges of byte offsets at which a string of ``length`` bytes starts
    that also starts earlier."""
    scheme = Scheme(words=False, window=length, gram=gram, everywhere=False)
    parts = buckets(rows.sparkSession)
    first = stored(repeated(rows, scheme), "anchors", batch_rows=TEXT_ROWS)
    asked = with_lists(rows.select("row", "text"), first.where("open"), "asked", "inner", "key", "doc", "start", "n", "lead")
    still, rank = asked, _fetch_and_rank
    done = [first.where("NOT open").select("row", "start", "n")]
    for span in SPANS:
        ranked = still.mapInArrow(partial(rank, span=span, length=length), RANKED)
        ranked = ranked.repartition(parts, "key").sortWithinPartitions("key", "content", "doc", "row", "start")
        table = stored(ranked.mapInArrow(_rerank, RANKED), f"ranks-{span}")
        done.append(table.where("settled").select("row", "start", "n"))
        still, rank = table.where("NOT settled"), _rank
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def remove_earlier(docs: DataFrame, *, length: int = LENGTH, keep: Sequence[str] = ()) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept``: one row per row of ``docs``.

    A byte of a text's UTF-8 form goes when a string of ``length`` bytes that covers it
    also starts earlier: in a document with a smaller id, or further left in the same. All
    strings are judged on the input. ``kept`` is the rest as text; a character that
    lost only some of its bytes is left out of it, while ``kept_sha256`` is over the bytes.
    A null text is empty (``kept`` null). Rows without an id come before all others; rows
    that share an id are in the order of a hash of the row; repeated rows are the same
    place, so neither is earlier. An empty table gives no rows; columns besides
    ``doc_id`` and ``text`` are not looked at, those named in ``keep`` are passed on.
    """
    rows = texts(docs, *keep)
    ranges = stored(earlier_strings(rows, length), "ranges")
    listed = with_lists(rows, ranges, "ranges", "left", "start", "n")
    added = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string"
    schema = T.StructType([*listed.select("doc_id", *keep).schema.fields, *T._parse_datatype_string(added).fields])
    return listed.select("doc_id", *keep, "text", "ranges").mapInArrow(partial(_remove, length=length, keep=tuple(keep)), schema)
