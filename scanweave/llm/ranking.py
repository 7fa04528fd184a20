"""Ranked lexical search: short lists summed term by term, long ones skipped document by document.

The texts are read once, into blocks of documents with the posting lists of the terms that
the queries have. Each block answers every query. The query's short lists are summed into
accumulators (term at a time); these then act as one more list, bounded by its largest sum,
beside the long lists (document at a time). Lists whose bounds together cannot reach the
score of the k-th best document so far bring up no candidates, and a long list is only
looked into at documents that can still reach it. A task keeps its best documents from
block to block and returns them once; the best of all tasks are the answer.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..workspace import materialize, remove, scratch_dir
from .exchange import columns, pack, stored, texts, unpack

#: Documents and bytes of text of a block.
DOCS, BYTES = 16384, 1 << 25
#: Lists with at most this share of a block's documents are short.
SHORT = 1 / 64
#: Bytes of distinct query terms that are broadcast at once; larger query sets are answered in parts.
VOCABULARY = 1 << 25
INDEX = "docs binary, sizes binary, terms binary, ends binary, places binary, counts binary, n_docs long, n_terms long"
FOUND = "query long, doc_id long, score long"
_IDLESS = np.int64(2**63 - 1)

# Letters, digits and all bytes beyond ASCII belong to terms, A-Z as a-z.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms_of(text: Column) -> Column:
    """The terms of a text, in order and with repeats; null has none."""
    folded = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(F.coalesce(folded, F.lit("")), _BETWEEN), lambda t: t != "")


@dataclass
class _Block:
    """One block while it is filled: document ids, their lengths, ``(place, term)`` of every hit."""

    ids: list[int]
    sizes: list[int]
    places: list[np.ndarray]
    terms: list[np.ndarray]
    read: int = 0

    def packed(self) -> pa.RecordBatch:
        n = len(self.ids)
        term = np.concatenate(self.terms) if self.terms else np.zeros(0, np.int64)
        place = np.concatenate(self.places) if self.places else np.zeros(0, np.int64)
        key, counts = np.unique(term * max(n, 1) + place, return_counts=True)
        found, first = np.unique(key // max(n, 1), return_index=True)
        made = {
            "docs": np.array(self.ids, "i8"), "sizes": np.array(self.sizes, "i8"), "terms": found.astype("i4"),
            "ends": np.append(first, len(key))[1:].astype("i4") if len(found) else np.zeros(0, "i4"),
            "places": (key % max(n, 1)).astype("i4"), "counts": counts.astype("i4"),
        }
        row = {k: pa.array([pack(v)], pa.binary()) for k, v in made.items()}
        sizes = made["sizes"]
        return pa.RecordBatch.from_pydict({**row, "n_docs": [int((sizes > 0).sum())], "n_terms": [int(sizes.sum())]})


def _index(batches: Iterable[pa.RecordBatch], vocabulary) -> Iterator[pa.RecordBatch]:
    known: Mapping[bytes, int] = vocabulary.value
    block = _Block([], [], [], [])
    for ids, text in columns(batches, "doc_id", "text"):
        ids = ids.fill_null(int(_IDLESS)).to_pylist()
        for doc, t in zip(ids, text):
            data = t.as_buffer().to_pybytes() if t.is_valid else b""
            words = data.translate(_FOLD).split()
            hits = np.array([x for x in map(known.get, words) if x is not None], np.int64)
            if len(hits):
                block.places.append(np.full(len(hits), len(block.ids)))
                block.terms.append(hits)
            block.ids.append(doc)
            block.sizes.append(len(words))
            block.read += len(data)
            if len(block.ids) >= DOCS or block.read >= BYTES:
                yield block.packed()
                block = _Block([], [], [], [])
    if block.ids:
        yield block.packed()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


@dataclass(frozen=True)
class Queries:
    """``terms[offsets[q]:offsets[q+1]]`` are the numbers of query ``q``'s distinct terms, ``times`` how
    often each stands in it, ``weights`` the weight of every number."""

    names: np.ndarray
    offsets: np.ndarray
    terms: np.ndarray
    times: np.ndarray
    weights: np.ndarray
    n_docs: int
    n_terms: int


class Best:
    """The ``k`` best documents so far: score descending, then id ascending."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def bar(self) -> int:
        """The least score that can still get in (equal scores may, by their id)."""
        return max(int(self.scores[-1]), 1) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        enough = scores >= self.bar
        if not enough.any():
            return
        scores, ids = np.concatenate([self.scores, scores[enough]]), np.concatenate([self.ids, ids[enough]])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]


class Lists:
    """The posting lists of one block with the score of every posting."""

    def __init__(self, row: Mapping[str, pa.Scalar], q: Queries):
        read = lambda name, kind: unpack(row[name].as_buffer(), kind)[0]
        self.docs, sizes = read("docs", "i8"), read("sizes", "i8")
        self.terms, self.ends = read("terms", "i4"), read("ends", "i4").astype(np.int64)
        self.places, counts = read("places", "i4"), read("counts", "i4").astype(np.int64)
        self.starts = np.concatenate([[0], self.ends[:-1]]) if len(self.ends) else self.ends
        m = 75 + 25 * sizes * q.n_docs // max(q.n_terms, 1)
        term = np.repeat(self.terms, self.ends - self.starts)
        self.scores = q.weights[term] * (1_000_000_000 * counts // (1000 * counts + 12 * m[self.places]))
        self.bounds = np.maximum.reduceat(self.scores, self.starts) if len(self.starts) else self.scores
        self.place_of = np.full(len(q.weights), -1, np.int32)
        self.place_of[self.terms] = np.arange(len(self.terms))

    def answer(self, wanted: np.ndarray, times: np.ndarray, best: Best) -> None:
        """Bring the documents of this block that are among the best into ``best``."""
        at = self.place_of[wanted]
        at, times = at[at >= 0], times[at >= 0]
        if not len(at):
            return
        bound, size = self.bounds[at] * times, self.ends[at] - self.starts[at]
        short = size <= SHORT * len(self.docs)
        order = np.argsort(bound, kind="stable")
        lists: list[tuple[int, np.ndarray, np.ndarray]] = []
        summed = self._accumulated(at[short], times[short])
        if len(summed[0]):
            lists.append((int(summed[1].max()), *summed))
        for i in order[~short[order]]:
            own = slice(self.starts[at[i]], self.ends[at[i]])
            scores = self.scores[own] if times[i] == 1 else self.scores[own] * times[i]
            lists.append((int(bound[i]), self.places[own], scores))
        lists.sort(key=lambda x: x[0])
        below = np.cumsum([0, *(x[0] for x in lists)])  # what the first lists can add up to
        # Candidates come from the lists that are needed to reach the bar, highest bound first.
        for top in range(len(lists) - 1, -1, -1):
            if below[top + 1] < best.bar:
                break
            self._candidates(lists, below, top, best)

    def _accumulated(self, at: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Term at a time: the sums of short lists, ordered by document."""
        if not len(at):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        size = self.ends[at] - self.starts[at]
        place = np.repeat(self.starts[at] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        docs, inverse = np.unique(self.places[place], return_inverse=True)
        sums = np.zeros(len(docs), np.int64)
        np.add.at(sums, inverse, self.scores[place] * np.repeat(times, size))
        return docs, sums

    def _candidates(self, lists, below: np.ndarray, top: int, best: Best) -> None:
        """Documents whose highest list is ``top``: those of the lists above it have had their turn."""
        bound, docs, scores = lists[top]
        rows = np.flatnonzero(scores + below[top] >= best.bar)
        docs, scores = docs[rows], scores[rows]
        for _, other, _ in lists[top + 1 :]:
            if not len(docs):
                return
            docs, scores = (x[~_found(other, docs)[0]] for x in (docs, scores))
        for lower in range(top - 1, -1, -1):
            _, other, extra = lists[lower]
            hit, where = _found(other, docs)
            scores = scores + np.where(hit, extra[where], 0)
            rows = scores + below[lower] >= best.bar
            docs, scores = docs[rows], scores[rows]
            if not len(docs):
                return
        best.add(scores, self.docs[docs])


def _found(ordered: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``wanted`` are in ``ordered``, and where; the search skips all between."""
    where = np.minimum(np.searchsorted(ordered, wanted), len(ordered) - 1)
    return ordered[where] == wanted, where


def _answer(batches: Iterable[pa.RecordBatch], queries, k: int) -> Iterator[pa.RecordBatch]:
    q: Queries = queries.value
    best = [Best(k) for _ in q.names]
    for batch in batches:
        for i in range(batch.num_rows):
            lists = Lists({n: batch.column(n)[i] for n in ("docs", "sizes", "terms", "ends", "places", "counts")}, q)
            for j, b in enumerate(best):
                own = slice(q.offsets[j], q.offsets[j + 1])
                lists.answer(q.terms[own], q.times[own], b)
    if best:
        yield pa.RecordBatch.from_pydict({
            "query": pa.array(np.repeat(q.names, [len(b.ids) for b in best]), pa.int64()),
            "doc_id": pa.array(np.concatenate([b.ids for b in best]), pa.int64()),
            "score": pa.array(np.concatenate([b.scores for b in best]), pa.int64()),
        })


def _part(items: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """The best documents of a bounded set of queries: ``query, doc_id, score, rank``, stored."""
    spark = docs.sparkSession
    rows = items.select("query", F.explode("terms").alias("term")).groupBy("query", "term").count()
    rows = sorted((r["query"], r["term"], r["count"]) for r in rows.collect())  # VOCABULARY bytes
    names = sorted({q for q, _, _ in rows})
    number = {t: i for i, t in enumerate(sorted({t for _, t, _ in rows}))}
    vocabulary = spark.sparkContext.broadcast({t.encode(): i for t, i in number.items()})
    path = scratch_dir(spark, "index")
    blocks = materialize(texts(docs).mapInArrow(partial(_index, vocabulary=vocabulary), INDEX), path)
    vocabulary.destroy()

    total = blocks.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    df = np.zeros(len(number), np.int64)
    counted = blocks.select("terms", "ends").mapInArrow(_document_counts, "term int, n long")
    for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect():  # one row per query term
        df[r["term"]] = r["n"]
    n_docs, n_terms = total["n"] or 0, total["l"] or 0
    place = {q: i for i, q in enumerate(names)}
    queries = Queries(
        np.array(names, np.int64), np.searchsorted([place[q] for q, _, _ in rows], np.arange(len(names) + 1)),
        np.array([number[t] for _, t, _ in rows], np.int64), np.array([n for *_, n in rows], np.int64),
        np.array([weight(n_docs, int(n)) for n in df], np.int64), n_docs, n_terms,
    )
    shared = spark.sparkContext.broadcast(queries)
    found = blocks.drop("n_docs", "n_terms").mapInArrow(partial(_answer, queries=shared, k=k), FOUND)
    # Each task returns k rows a query at most; a window's row limit is applied before its shuffle too.
    best = Window.partitionBy("query").orderBy(F.desc("score"), "doc_id")
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    found = stored(found, "found", release=False)
    shared.destroy()
    remove(spark, path)
    return found


def _document_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for terms, ends in columns(batches, "terms", "ends"):
        for t, e in zip(terms, ends):
            term, end = unpack(t.as_buffer(), "i4")[0], unpack(e.as_buffer(), "i4")[0]
            yield pa.RecordBatch.from_pydict({"term": term, "n": np.diff(end, prepend=0).astype(np.int64)})


def ranked(docs: DataFrame, items: DataFrame, *, k: int = 20) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each row of ``items``.

    Terms are runs of letters, digits and characters beyond ASCII, with A-Z as a-z. A
    document's score for an item sums ``w * (10**9 * tf // (1000 * tf + 12 * m))`` over the
    item's terms, repeats included, with ``w = floor(1000 * ln((2N + 2) / (2df + 1)))`` and ``m =
    75 + 25 * n * N // L``; documents without terms do not count. Documents with score 0 are
    not returned; of equal scores the smaller ``doc_id`` comes first, rows without an id
    last. Every row of ``items`` is ranked for itself, also if its id is null or repeated; null
    or empty texts find nothing, empty tables too. Repeated documents are found each for
    itself. Columns besides ``doc_id``, ``item_id`` and ``text`` are not looked at.
    """
    spark = docs.sparkSession
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), terms_of(F.col("text").cast("string")).alias("terms"))
    rows = stored(rows.where(F.size("terms") > 0).withColumn("query", F.monotonically_increasing_id()), "queries", release=False)
    size = rows.agg(F.sum(F.aggregate("terms", F.lit(0), lambda s, t: s + F.octet_length(t) + 64))).first()[0] or 0
    parts = -(-size // VOCABULARY)
    out = spark.createDataFrame([], f"{FOUND}, rank int")
    for p in range(parts):
        own = rows.where(F.pmod(F.xxhash64("query"), F.lit(parts)) == p) if parts > 1 else rows
        out = out.unionByName(_part(own, docs, k))
    out = out.join(rows.select("query", "item_id"), "query")
    doc_id = F.when(F.col("doc_id") != int(_IDLESS), F.col("doc_id"))
    return out.select("item_id", F.col("rank").cast("int").alias("rank"), doc_id.alias("doc_id"), "score")
