"""Token counts by a two-tier lookup of pre-tokens, without shuffling any of them.

Tier one is a table of the corpus's most frequent pre-tokens and their token counts,
broadcast to all tasks and bounded by ``frequent``. Tier two is a cache in each
Python worker, bounded by ``CACHE``, filled by the tokenizer itself on a miss.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from .exchange import columns, texts
from .textbytes import text_buffer

#: Fixed value: how the byte-level tokenizer cuts text into pre-tokens.
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Code points whose class differs between the two libraries' versions of Unicode, and
#: their neighbours. A text with one of them is left to the tokenizer as a whole.
UNSETTLED = r"\u0530-\u058f\u0870-\u08ff\u0c00-\u0cff\u1c80-\u1c8f\u2080-\u209f\ua7c0-\ua7ff\uab60-\uab6f\U00010000-\U0001efff\U00020000-\U0010ffff"
_WHOLE = regex.compile(f"[{UNSETTLED}]")
FREQUENT = 16384
CACHE = 400_000
#: Summaries of so many groups of tasks reach the driver, whatever the input's size.
FAN_IN = 64


@lru_cache(maxsize=4)
def tokenizer(path: str) -> Tokenizer:
    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    return made


class Lengths(dict):
    """Pre-token to its number of tokens; asks the tokenizer for what it does not hold."""

    def __init__(self, path: str, known: dict[str, int]):
        super().__init__(known)
        self.known, self.model = known, tokenizer(path)

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE + len(self.known):
            self.clear()
            self.update(self.known)
        n = self[word] = len(self.model.encode(word, add_special_tokens=False).ids)
        return n


def _specials(path: str) -> regex.Pattern | None:
    """What matches the strings that the tokenizer takes for special tokens in a text."""
    added = tokenizer(path).get_added_tokens_decoder().values()
    found = sorted((t.content for t in added), key=len, reverse=True)
    return regex.compile("|".join(map(regex.escape, found))) if found else None


def pruned(counts: Counter, keep: int) -> Counter:
    """At most ``keep`` counters: all are lowered by the first that goes (Misra and Gries),
    so no count is too high and one above ``total / keep`` is never lost."""
    if len(counts) <= keep:
        return counts
    top = counts.most_common(keep + 1)
    least = top[-1][1]
    return Counter({w: n - least for w, n in top[:-1] if n > least} or dict(top[:keep]))


def _summary(batches: Iterable[pa.RecordBatch], keep: int) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for (text,) in columns(batches, "text"):
        for x in text:
            if x.is_valid:
                counts.update(PRE_TOKEN.findall(x.as_py()))
                if len(counts) > 16 * keep:
                    counts = pruned(counts, 4 * keep)
    yield _as_row(pruned(counts, keep))


def _as_row(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "words": pa.array([list(counts)], pa.list_(pa.string())),
        "counts": pa.array([list(counts.values())], pa.list_(pa.int64())),
    })


def _merge(batches: Iterable[pa.RecordBatch], keep: int) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for words, ns in columns(batches, "words", "counts"):
        for w, n in zip(words.to_pylist(), ns.to_pylist()):
            for word, k in zip(w, n):
                counts[word] += k
            counts = pruned(counts, keep)
    yield _as_row(counts)


def frequent_words(docs: DataFrame, keep: int = FREQUENT) -> list[str]:
    """The most frequent pre-tokens of all texts. Each task sends one summary of at
    most ``keep`` counters; ``FAN_IN`` merged summaries reach the driver."""
    schema = "words array<string>, counts array<long>"
    rows = texts(docs).select("text").mapInArrow(partial(_summary, keep=keep), schema)
    rows = rows.repartition(FAN_IN).mapInArrow(partial(_merge, keep=keep), schema).collect()
    counts: Counter = Counter()
    for r in rows:
        for w, n in zip(r["words"], r["counts"]):
            counts[w] += n
    return [w for w, _ in counts.most_common(keep)]


_COUNTERS: dict = {}


def _count(batches: Iterable[pa.RecordBatch], path: str, known, limit: int) -> Iterator[pa.RecordBatch]:
    if (path, known.id) not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[path, known.id] = Lengths(path, known.value)
    length, special, find = _COUNTERS[path, known.id], _specials(path), PRE_TOKEN.findall
    for ids, text in columns(batches, "doc_id", "text"):
        counts = np.zeros(len(text), np.int64)
        for i, x in enumerate(text.to_pylist()):
            if x and not x.isascii() and _WHOLE.search(x):
                counts[i] = len(length.model.encode(x, add_special_tokens=False).ids)
            elif x:
                parts = special.split(x) if special else [x]
                counts[i] = len(parts) - 1 + sum(sum(map(length.__getitem__, find(p))) for p in parts)
        sizes = np.diff(text_buffer(text)[1])
        yield pa.RecordBatch.from_pydict(
            {"doc_id": ids, "n_bytes": sizes, "n_tokens": counts, "over_limit": counts > limit}
        )


def count_tokens(docs: DataFrame, path: str, *, limit: int = 512, frequent: int = FREQUENT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit``: one row per row of ``docs``.

    Counts are those of the byte-level tokenizer in ``path`` without begin, end or
    added tokens; a special token's string inside a text is one token, as by its
    default. A null text is empty: 0 bytes, 0 tokens. Repeated rows and rows without
    an id are counted each for itself; a table without rows gives none; columns
    besides ``doc_id`` and ``text`` are not looked at.
    """
    words = frequent_words(docs, frequent)
    known = dict(zip(words, (len(e.ids) for e in tokenizer(path).encode_batch(words, add_special_tokens=False))))
    table = docs.sparkSession.sparkContext.broadcast(known)
    named = _Named(table)
    return texts(docs).select("doc_id", "text").mapInArrow(
        partial(_count, path=path, known=named, limit=limit),
        "doc_id long, n_bytes long, n_tokens long, over_limit boolean",
    )


class _Named:
    """A broadcast with an id, so that a worker keeps its cache between tasks."""

    def __init__(self, broadcast):
        self.broadcast, self.id = broadcast, broadcast._jbroadcast.id()

    def __getstate__(self):
        return {"broadcast": self.broadcast, "id": self.id}

    @property
    def value(self) -> dict[str, int]:
        return self.broadcast.value
