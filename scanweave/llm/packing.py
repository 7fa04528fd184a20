"""Packing of tokenized documents into sequences of one length, as a cutting-stock problem.

A linear program over cutting patterns, restricted to the histogram of piece lengths,
is solved by column generation: a knapsack over the duals prices the next pattern.
The rounded patterns are then dealt to the pieces, which are ranked within their
length class. The driver sees the histogram and the patterns only; both are bounded
by the sequence length, not by the number of documents.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F

from .exchange import TEXT_ROWS, columns, local_table, stored, texts, tidied
from .tokens import UNSETTLED, tokenizer

#: Fixed value: how the word tokenizer cuts normalized text into words.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: What is left to the tokenizer as a whole: see UNSETTLED; sigma, whose lower case
#: depends on its place; strings that may be special tokens.
_WHOLE = regex.compile(rf"[{UNSETTLED}Σ\x1c-\x1f]|<\|")
#: Runs of characters and words whose ids a worker holds on to, twice so many at most.
RUNS, WORDS = 300_000, 180_000
#: Marks that are a word of their own at the end of a run of letters.
MARKS = frozenset(".,;:!?")
#: Fixed value: what the last token of a word ends with.
WORD_END = "</w>"
END_ID = 1
#: Texts that are encoded together.
TEXTS = 500
ROWS_PER_RANKING = 200_000
PIECE = "doc_id long, row long, start long, length long, ids_crc32 long, doc_tokens long"


class Recent:
    """A bounded memory in two generations: what is asked for moves to the young one, and when
    that is full it becomes the old one, whose entries go."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def missing(self, keys: set[str]) -> set[str]:
        """Those of ``keys`` that are not held; the others are in ``young`` from now on."""
        if len(self.young) > self.size:
            self.old, self.young = self.young, {}
        lacking = keys - self.young.keys()
        found = lacking & self.old.keys()
        self.young.update(zip(found, map(self.old.__getitem__, found)))
        return lacking - found


class Ids:
    """Texts to their ids as little-endian 32-bit text.

    White space never reaches the ids, so a run of other characters has the same ids
    wherever it stands: ``runs`` remembers them. What a run is cut into is looked up in
    ``words``, and the words missing there are encoded by the tokenizer, many at a time.
    """

    def __init__(self, path: str):
        self.model = tokenizer(path)
        vocabulary = self.model.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(WORD_END)]] = True
        self.runs, self.words = Recent(RUNS), Recent(WORDS)

    def _encode(self, words: list[str]) -> None:
        for k in range(0, len(words), 4096):
            some = words[k : k + 4096]
            ids = np.array(self.model.encode(" ".join(some), add_special_tokens=False).ids, "<u4")
            data, cuts = ids.tobytes(), np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(some):
                raise ValueError("the tokenizer cuts words in an unknown way")
            cuts = (4 * cuts).tolist()
            self.words.young.update(zip(some, (data[a:b] for a, b in zip([0, *cuts], cuts))))

    def _learn(self, runs: set[str]) -> None:
        missing = self.runs.missing(runs)
        alone = list(filter(str.isalpha, missing))
        rest = missing.difference(alone)
        # Letters with a mark at the end are the common case, told without a pattern.
        marked = [r for r in rest if r[-1] in MARKS and r[:-1].isalpha()]
        heads = [r[:-1] for r in marked]
        others = [(r, WORD.findall(r)) for r in rest.difference(marked)]
        words = {*alone, *heads, *(MARKS if marked else ()), *(w for _, c in others for w in c)}
        self._encode(list(self.words.missing(words)))
        get, learned = self.words.young.__getitem__, self.runs.young
        learned.update(zip(alone, map(get, alone)))
        learned.update((r, get(h) + get(r[-1])) for r, h in zip(marked, heads))
        learned.update((r, b"".join(map(get, c))) for r, c in others)

    def of(self, texts: list[str | None]) -> list[bytes]:
        out, split = [b""] * len(texts), {}
        for i, text in enumerate(texts):
            if not text:
                continue
            if not plain(text):
                if _WHOLE.search(text):
                    out[i] = np.array(self.model.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
                    continue
                text = unicodedata.normalize("NFC", text)
            split[i] = text.lower().split()
        self._learn({w for words in split.values() for w in words})
        get = self.runs.young.__getitem__
        for i, words in split.items():
            out[i] = b"".join(map(get, words))
        return out


def plain(text: str) -> bool:
    """Latin-1 without what may be a special token or a separator: the common case, told
    without looking at single characters. Such a text is in normal form."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return not any(x in text for x in ("<|", "\x1c", "\x1d", "\x1e", "\x1f"))


@lru_cache(maxsize=2)
def _ids(path: str) -> Ids:
    return Ids(path)


@tidied
def _cut(batches: Iterable[pa.RecordBatch], path: str, size: int) -> Iterator[pa.RecordBatch]:
    ids, end, step = _ids(path), np.array([END_ID], "<u4").tobytes(), 4 * size
    for doc, row, text in columns(batches, "doc_id", "row", "text"):
        at, start, length, crc, total = [], [], [], [], []
        tokens = (d for k in range(0, len(text), TEXTS) for d in ids.of(text[k : k + TEXTS].to_pylist()))
        for i, data in enumerate(tokens):
            data += end
            for a in range(0, len(data), step):
                piece = data[a : a + step]
                at.append(i)
                start.append(a // 4)
                length.append(len(piece) // 4)
                crc.append(zlib.crc32(piece))
                total.append(len(data) // 4)
        take = pa.array(at, pa.int32())
        made = [doc.take(take), row.take(take), *(pa.array(v, pa.int64()) for v in (start, length, crc, total))]
        yield pa.RecordBatch.from_arrays(made, ["doc_id", "row", "start", "length", "ids_crc32", "doc_tokens"])
    ids.runs, ids.words = Recent(RUNS), Recent(WORDS)


def cut_documents(docs: DataFrame, path: str, size: int) -> DataFrame:
    """Token pieces of at most ``size`` ids. A piece of full length is a sequence of its
    own; so only the last piece of a document needs a place beside others."""
    return texts(docs).mapInArrow(partial(_cut, path=path, size=size), PIECE)


@dataclass(frozen=True)
class Pattern:
    """How many pieces of each length class one sequence takes, and how often."""

    parts: tuple[tuple[int, int], ...]
    copies: int


def _knapsack(sizes: np.ndarray, value: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes (ascending) within ``room``."""
    best, pick = np.zeros(room + 1), np.full(room + 1, -1)
    fits = np.searchsorted(sizes, np.arange(room + 1), "right")
    for c in range(1, room + 1):
        best[c], k = best[c - 1], fits[c]
        if k:
            got = best[c - sizes[:k]] + value[:k]
            i = int(np.argmax(got))
            if got[i] > best[c] + 1e-12:
                best[c], pick[c] = got[i], i
    counts, c = np.zeros(len(sizes)), room
    while c > 0:
        if pick[c] < 0:
            c -= 1
        else:
            counts[pick[c]] += 1
            c -= sizes[pick[c]]
    return best[room], counts


# The linear algebra of the program is written with array steps alone: the driver's process
# has a Java gateway and its threads, beside which a threaded LAPACK call may not return.


def _times(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    return (matrix * vector).sum(axis=1)


def _inverse(matrix: np.ndarray) -> np.ndarray:
    """By elimination with row pivots."""
    n = len(matrix)
    both = np.hstack([matrix, np.eye(n)])
    for c in range(n):
        p = c + int(np.argmax(np.abs(both[c:, c])))
        both[[c, p]] = both[[p, c]]
        both[c] /= both[c, c]
        factor = both[:, c].copy()
        factor[c] = 0
        both -= factor[:, None] * both[c]
    return both[:, n:]


def solve(sizes: np.ndarray, demand: np.ndarray, room: int, *, gap: float = 2e-3, steps: int = 24) -> list[tuple[np.ndarray, float]]:
    """Patterns and how often to use each, fractions allowed: the linear program by
    column generation, to within ``gap`` of its optimum or ``steps`` times the number
    of sizes (the result is feasible whenever it stops).

    Lower bounds of the optimum end the search: ``demand @ y / v`` with the best
    knapsack value ``v`` under any prices ``y``. Prices are drawn towards those of the best
    bound so far (at first: the share of the room), which steadies them.
    """
    m = len(sizes)
    patterns = np.diag((room // sizes).astype(float))
    inverse = np.diag(1.0 / np.diag(patterns))
    use = _times(inverse, demand)
    centre = sizes / room
    low = float(centre @ demand)
    for step in range(1, steps * m + 1):
        if use.sum() - low <= gap * low:
            break
        dual = inverse.sum(axis=0)
        for pull in (0.9, 0.0):
            price = pull * centre + (1 - pull) * dual
            value, entering = _knapsack(sizes, price, room)
            bound = float(price @ demand) / max(value, 1.0)
            if bound > low:
                low, centre = bound, price / max(value, 1.0)
            if dual @ entering > 1 + 1e-9:
                break
        else:
            break
        ray = _times(inverse, entering)
        up = ray > 1e-9
        ratio = np.full(m, np.inf)
        ratio[up] = use[up] / ray[up]
        out = int(np.argmin(ratio))
        use = use - ratio[out] * ray
        use[out] = ratio[out]
        use = np.maximum(use, 0)
        inverse[out] /= ray[out]
        ray[out] = 0
        inverse -= ray[:, None] * inverse[out]
        patterns[:, out] = entering
        if step % 200 == 0:  # rounding errors add up
            inverse = _inverse(patterns)
            use = np.maximum(_times(inverse, demand), 0)
    return [(patterns[:, j].astype(np.int64), use[j]) for j in range(m) if use[j] > 0]


def _best_fit(sizes: np.ndarray, left: np.ndarray, room: int) -> Counter:
    """Patterns of the few pieces that rounding has left over: largest first, each into
    the fullest sequence that still takes it."""
    by_gap: dict[int, list[list[int]]] = {}
    for i in np.argsort(-sizes):
        for _ in range(int(left[i])):
            gap = next((g for g in range(int(sizes[i]), room + 1) if by_gap.get(g)), None)
            parts = by_gap[gap].pop() if gap is not None else []
            parts.append(int(i))
            by_gap.setdefault((room if gap is None else gap) - int(sizes[i]), []).append(parts)
    return Counter(tuple(sorted(Counter(p).items())) for bins in by_gap.values() for p in bins)


def plan(histogram: dict[int, int], room: int) -> list[Pattern]:
    """Whole patterns that place every piece of ``histogram`` (size to number) once."""
    if not histogram:
        return []
    sizes = np.array(sorted(histogram))
    demand = np.array([histogram[int(s)] for s in sizes], float)
    left, plans = demand.astype(np.int64), []
    for parts, often in solve(sizes, demand, room):
        copies = int(np.floor(often + 1e-6))
        if parts.any():
            copies = min([copies, *(left[parts > 0] // parts[parts > 0])])
            left = left - copies * parts
        if copies > 0:
            plans.append(Pattern(tuple((int(sizes[i]), int(parts[i])) for i in np.flatnonzero(parts)), copies))
    for parts, copies in _best_fit(sizes, left, room).items():
        plans.append(Pattern(tuple((int(sizes[i]), n) for i, n in parts), copies))
    return plans


def _slots(patterns: list[Pattern]) -> list[tuple[int, int, int, int, int]]:
    """``(cls, first, last, per, sequence)``: pieces of class ``cls`` with ranks from
    ``first`` to before ``last`` go ``per`` at a time into sequences from ``sequence`` on."""
    rank: Counter = Counter()
    rows, sequence = [], 0
    for p in patterns:
        for size, per in p.parts:
            rows.append((size, rank[size], rank[size] + per * p.copies, per, sequence))
            rank[size] += per * p.copies
        sequence += p.copies
    return rows


def ranked(pieces: DataFrame, total: int) -> DataFrame:
    """Add ``rank``, from 0 within each ``cls``. A class is cut into parts by a hash, parts
    are ranked side by side and moved on by the rows of the parts before them, so a class
    with a third of all rows is not one task's work."""
    parts = -(-max(total, 1) // ROWS_PER_RANKING)
    pieces = pieces.withColumn("part", F.pmod(F.xxhash64("row", "start"), F.lit(parts)))
    before = Window.partitionBy("cls").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    moved = pieces.groupBy("cls", "part").count().select(
        "cls", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before")
    )
    inside = Window.partitionBy("cls", "part").orderBy("doc_id", "row", "start")
    pieces = pieces.withColumn("rank", F.row_number().over(inside) - 1)
    return pieces.join(moved, ["cls", "part"]).withColumn("rank", F.col("rank") + F.col("before")).drop("before", "part")


def pack_documents(docs: DataFrame, path: str, *, size: int = 2048, grain: int = 16) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``: one row per piece.

    The ids of a document are those of the tokenizer in ``path``, then id 1. Lengths are
    classed by rounding up to ``grain`` ids, which bounds the linear program by
    ``size / grain`` rows. A null or empty text is one piece of length 1. Repeated rows
    are packed each for itself, rows without an id too; an empty table gives no rows;
    columns besides ``doc_id`` and ``text`` are not looked at.
    """
    if size % grain:
        raise ValueError("the sequence length must be a multiple of grain")
    spark = docs.sparkSession
    pieces = stored(cut_documents(docs, path, size), "pieces", batch_rows=TEXT_ROWS)
    pieces = pieces.withColumn("cls", F.ceil(F.col("length") / grain).cast("int"))
    histogram = {r["cls"]: r["count"] for r in pieces.groupBy("cls").count().collect()}  # size / grain rows at most
    slots = local_table(
        spark, _slots(plan(histogram, size // grain)), "cls int, first long, last long, per long, sequence long"
    )
    pieces = ranked(pieces, sum(histogram.values()))
    within = (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last"))
    # The slots are bounded by the patterns: at most size / grain, and the left-over ones.
    placed = pieces.join(F.broadcast(slots.withColumnRenamed("cls", "of")), (F.col("cls") == F.col("of")) & within)
    placed = placed.withColumn("sequence_id", F.expr("sequence + (rank - first) div per"))
    before = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "row", "start", "rank")
    offset = F.sum("length").over(before.rowsBetween(Window.unboundedPreceding, -1))
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
        F.coalesce(offset, F.lit(0)).alias("offset"),
    )
