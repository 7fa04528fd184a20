"""Removal of word windows that occur elsewhere, by suffix automata of reference shards.

The reference is the corpus itself, which no broadcast can hold. So the texts that share
an anchor (see ``anchors``) are brought together: each shard is a bounded run of such
texts, gets one generalized suffix automaton, and the same texts are streamed
through it for their matching statistics. What equals another text as a whole is settled
before and only marked in the automaton.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .anchors import FOUND, Scheme, Segments, _meet, collapse, covered, found, join, list_columns, repeated, with_lists
from .exchange import buckets, columns, longs, pack, split_by, stored, texts
from .textbytes import gram_hashes, text_buffer, word_hashes, word_spans

WINDOW = 35
GRAM = 8
#: Words of one shard: what one automaton holds.
SHARD = 1 << 16
#: Contents of one anchor that automata take; the windows of the rest are counted one by one.
LIMIT = 2048


class Automaton:
    """Generalized suffix automaton of word sequences. ``count`` of a state: how many
    positions (2 for a text that stands for several) end one of its words."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def add(self, words: list[int], times: int) -> None:
        nexts, link, length, count = self.next, self.link, self.length, self.count
        last = 0
        for w in words:
            there = nexts[last].get(w)
            if there is not None:
                if length[there] == length[last] + 1:
                    last = there
                else:
                    last = self._split(last, w, there)
                count[last] += times
                continue
            new = len(length)
            nexts.append({})
            length.append(length[last] + 1)
            link.append(0)
            count.append(times)
            p = last
            while p >= 0 and w not in nexts[p]:
                nexts[p][w] = new
                p = link[p]
            if p >= 0:
                q = nexts[p][w]
                link[new] = q if length[q] == length[p] + 1 else self._split(p, w, q)
            last = new

    def _split(self, p: int, w: int, q: int) -> int:
        new = len(self.length)
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.count.append(0)
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = new
            p = self.link[p]
        self.link[q] = new
        return new

    def finish(self) -> None:
        """Counts of longer words reach the states of their suffixes."""
        for s in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            if self.link[s] > 0:
                self.count[self.link[s]] += self.count[s]

    def repeats(self, words: list[int], window: int) -> list[int]:
        """Starts of the windows of ``words`` that end at more than one position."""
        state, matched, out = 0, 0, []
        nexts, link, length, count = self.next, self.link, self.length, self.count
        for i, w in enumerate(words):
            while state and w not in nexts[state]:
                state = link[state]
                matched = length[state]
            state = nexts[state].get(w, 0)
            matched = matched + 1 if state else 0
            while state and length[link[state]] >= window:
                state = link[state]
                matched = length[state]
            if matched >= window and count[state] > 1:
                out.append(i - window + 1)
        return out


def _words_of(text) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]]:
    raw, offsets = text_buffer(text)
    for i in range(len(offsets) - 1):
        own = raw[offsets[i] : offsets[i + 1]]
        start, end, _ = word_spans(own, np.array([0, len(own)]))
        yield own, start, end


def _fetch(batches: Iterable[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """The word hashes of open segments; of very common anchors, a hash of each window."""
    for row, text, asked in columns(batches, "row", "text", "asked"):
        out = []
        fields = list_columns(asked, "key", "start", "n", "times", "hot")
        for r, (own, start, end), (keys, at, n, times, hot) in zip(longs(row), _words_of(text), fields):
            words = word_hashes(own, start, end)
            whole = gram_hashes(words, window) if hot.any() else None
            for k, s, c, t, h in zip(keys, at, n, times, hot):
                data = whole[s : s + c] if h else words[s : s + c + window - 1]
                out.append((bool(h), int(k), int(r), int(s), int(t), data.tobytes()))
        names = ["hot", "key", "row", "start", "times", "data"]
        kinds = [pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        cols = zip(*out) if out else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)], names)


def _match(batches: Iterable[pa.RecordBatch], window: int, shard: int) -> Iterator[pa.RecordBatch]:
    groups: dict[int, list] = {}
    for key, row, start, times, data in columns(batches, "key", "row", "start", "times", "data"):
        for k, r, s, t, d in zip(longs(key), longs(row), longs(start), longs(times), data):
            groups.setdefault(int(k), []).append((int(r), int(s), int(t), d.as_buffer()))
    waiting, size = [], 0
    for own in groups.values():
        if len(own) > 1:
            waiting += own
            size += sum(len(d) // 8 for *_, d in own)
            if size >= shard:
                yield _repeats(waiting, window)
                waiting, size = [], 0
    if waiting:
        yield _repeats(waiting, window)


def _repeats(shard: list[tuple], window: int) -> pa.RecordBatch:
    automaton = Automaton()
    sequences = [np.frombuffer(d, np.uint64).tolist() for *_, d in shard]
    for words, (_, _, times, _) in zip(sequences, shard):
        automaton.add(words, times)
    automaton.finish()
    rows, starts = [], []
    for words, (row, start, times, _) in zip(sequences, shard):
        if times == 1:  # the others are settled
            hits = automaton.repeats(words, window)
            rows += [row] * len(hits)
            starts += [start + h for h in hits]
    k = len(rows)
    own = Segments(*(np.zeros(k, t) for t in ("u8", "u8", "i8")), np.array(rows, np.int64), np.array(starts, np.uint32), np.ones(k, np.uint16), np.zeros(k, np.uint16), np.ones(k, np.uint32))
    return found(own, False)


def _count_windows(batches: Iterable[pa.RecordBatch], scheme: Scheme, parts: int) -> Iterator[pa.RecordBatch]:
    """Each window by itself, as a segment whose key is its content."""
    for row, start, times, data in columns(batches, "row", "start", "times", "data"):
        own = []
        for r, s, t, d in zip(longs(row), longs(start), longs(times), data):
            key = np.frombuffer(d.as_buffer(), np.uint64)
            k, zero = len(key), np.zeros(len(key), np.int64)
            own.append(Segments(key, key, zero, np.full(k, r), (s + np.arange(k)).astype(np.uint32), np.ones(k, np.uint16), np.zeros(k, np.uint16), np.full(k, t, np.uint32)))
        first, settled = collapse(join(own), True)
        nothing = pa.nulls
        if len(settled.key):
            batch = found(settled, False)
            packed = b"".join(np.ascontiguousarray(c.to_numpy(zero_copy_only=False)).tobytes() for c in batch.columns)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows % 1009], pa.int32()), nothing(1, pa.binary()), pa.array([packed], pa.binary())], ["bucket", "data", "found"])
        lists = list(split_by((first.key % np.uint64(parts)).astype(np.int64), parts))
        yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in lists], pa.int32()), pa.array([pack(*first.take(at)) for _, at in lists], pa.binary()), nothing(len(lists), pa.binary())], ["bucket", "data", "found"])


def _remove(batches: Iterable[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for doc, row, text, ranges in columns(batches, "doc_id", "row", "text", "ranges"):
        total, gone, digest, kept = [], [], [], []
        for (own, start, end), (at, n) in zip(_words_of(text), list_columns(ranges, "start", "n")):
            data = own.tobytes()
            stay = ~covered(len(start), at, n, window)
            left = b" ".join([data[a:b] for a, b in zip(start[stay].tolist(), end[stay].tolist())])
            total.append(len(start))
            gone.append(int(len(start) - stay.sum()))
            digest.append(hashlib.sha256(left).hexdigest())
            kept.append(left)
        yield pa.RecordBatch.from_arrays(
            [doc, pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(digest, pa.string()), pa.array(kept, pa.binary()).cast(pa.string())],
            ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
        )


def repeated_windows(rows: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``row, start, n``: ranges of word windows that occur more than once in all texts."""
    scheme = Scheme(words=True, window=window, gram=gram, everywhere=True)
    parts = buckets(rows.sparkSession)
    first = stored(repeated(rows, scheme, LIMIT), "windows")
    asked = with_lists(rows.select("row", "text"), first.where("open").withColumn("hot", F.col("hot").cast("int")), "asked", "inner", "key", "start", "n", "times", "hot")
    # Repeated rows carry the same request: one of them answers it.
    fetched = asked.mapInArrow(partial(_fetch, window=window), "hot boolean, key long, row long, start long, times int, data binary")
    fetched = stored(fetched, "open-windows")
    matched = fetched.where("NOT hot").repartition(parts, "key").mapInArrow(partial(_match, window=window, shard=SHARD), FOUND)
    counted = fetched.where("hot").mapInArrow(partial(_count_windows, scheme=scheme, parts=parts), "bucket int, data binary, found binary")
    counted = counted.repartition(parts, "bucket").mapInArrow(partial(_meet, scheme=scheme, limit=1 << 30), FOUND)
    done = first.where("NOT open").unionByName(stored(matched.unionByName(counted), "matched").where("NOT open"))
    return done.select("row", "start", "n")


def remove_repeats(docs: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept``: one row per row of ``docs``.

    A word goes when a window of ``window`` consecutive words that covers it starts anywhere
    else too, in the same document or another; all windows are judged on the input. ``kept``
    are the other words, one space between them. A null text has no words; a text
    shorter than a window keeps all. A repeated row is another document, so both lose what
    they share. Rows without an id take part. An empty table gives no rows; columns besides
    ``doc_id`` and ``text`` are not looked at.
    """
    rows = texts(docs)
    ranges = stored(repeated_windows(rows, window), "ranges")
    listed = with_lists(rows, ranges, "ranges", "left", "start", "n")
    return listed.select("doc_id", "row", "text", "ranges").mapInArrow(
        partial(_remove, window=window), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
    )
