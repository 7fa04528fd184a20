"""Language identification by prediction by partial matching.

Each language has a variable-order context tree over bytes, trained on a bounded sample
of labelled documents and then frozen. A byte's code length in a context is the sum of
the escapes from every context that has not seen it, and its own share in the first that
has. Contexts have up to four bytes; how long they get depends on what the sample holds,
since a context enters the trees only if it was seen often enough.

With frozen counts a code length is a function of the context and the byte. So the trees of
all languages are compiled to one table: a row for each string of a context and a byte that
any tree has, with its code length in every language, and a row of escapes for each context.
A byte takes the row of its longest string there is, plus the escapes of longer contexts.
Code lengths are whole multiples of 2**-16 bits, so sums are exact in any order.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .exchange import columns, stored, tidied, tidy
from .textbytes import text_buffer

#: Longest context in bytes.
ORDER = 4
#: Bound of the training sample: documents of each language.
DOCS_PER_LANGUAGE = 1500
#: Least number of times that a context must be in the sample to enter the trees.
LEAST_SEEN = 4
#: Bounds of the model, which is broadcast: strings of all languages together (those of the most
#: frequent contexts stay), and bytes of their code lengths.
STRINGS, MODEL_BYTES = 400_000, 32 << 20
#: Parts of a language in the search for its sample.
SAMPLE_PARTS = 64
#: Bytes that are looked at together.
SEGMENT = 1 << 18
UNDETERMINED = "und"


def fold(doc_id: Column) -> Column:
    """Fold of a document: the training documents are those whose fold is not 0."""
    return F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(5))


@dataclass(frozen=True)
class Model:
    """``cost[l, r]`` are bits of row ``r`` in a language. Rows 0 to 255 are bytes without a
    context; ``keys`` and ``rows`` are a hash table from a string (``_tagged``) to its row."""

    languages: tuple[str, ...]
    keys: np.ndarray
    rows: np.ndarray
    cost: np.ndarray

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """The row of each string, -1 for those without one."""
        out, left = np.full(len(wanted), -1, np.int64), np.arange(len(wanted))
        slot = _slots(wanted, len(self.keys))
        while len(left):
            there = self.keys[slot]
            hit = there == wanted[left]
            out[left[hit]] = self.rows[slot[hit]]
            on = ~hit & (there != 0)
            left, slot = left[on], slot[on] + 1 & len(self.keys) - 1
        return out


def _slots(keys: np.ndarray, size: int) -> np.ndarray:
    spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (spread >> np.uint64(65 - size.bit_length())).astype(np.int64)


def _hash_table(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Open addressing with linear steps, at most a quarter full; 0 is an empty place."""
    size = 1 << max(2, (4 * len(keys)).bit_length())
    held, to, slot = np.zeros(size, np.int64), np.zeros(size, np.int32), _slots(keys, size)
    while len(keys):
        free = np.flatnonzero(held[slot] == 0)
        taken = free[np.unique(slot[free], return_index=True)[1]]
        held[slot[taken]], to[slot[taken]] = keys[taken], rows[taken]
        left = np.ones(len(keys), bool)
        left[taken] = False
        keys, rows, slot = keys[left], rows[left], slot[left] + 1 & size - 1
    return held, to


def _tagged(order: int, string: np.ndarray, context: bool = False) -> np.ndarray:
    """A key for a string of a context of ``order`` bytes and a byte, or of a context alone."""
    return string | (order + (ORDER + 1 if context else 0)) << 8 * (ORDER + 1)


def _tail(length: int) -> int:
    return (1 << 8 * length) - 1


def strings(raw: np.ndarray, offsets: np.ndarray, a: int, b: int) -> np.ndarray:
    """Each of the bytes from ``a`` to ``b`` with the ``ORDER`` before it in its text, as one
    number; a text starts after zero bytes."""
    lead = max(a - ORDER, 0)
    x = np.zeros(ORDER + b - a, np.int64)
    x[ORDER - (a - lead) :] = raw[lead:b]
    out = reduce(np.bitwise_or, (x[ORDER - j : len(x) - j] << 8 * j for j in range(ORDER + 1)))
    first = offsets[np.searchsorted(offsets, a - ORDER, "right") : np.searchsorted(offsets, b, "left")]
    first = np.unique(np.append(first, 0))
    for k in range(ORDER):
        at = first + k - a
        out[at[(at >= 0) & (at < b - a)]] &= _tail(k + 1)
    return out


@tidied
def _train(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for lang, text in columns(batches, "lang", "text"):
        for name in lang.unique().to_pylist():
            raw, offsets = text_buffer(text.filter(pa.compute.equal(lang, name)))
            for a in range(0, len(raw), 8 * SEGMENT):
                found, counts = np.unique(strings(raw, offsets, a, min(a + 8 * SEGMENT, len(raw))), return_counts=True)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * len(found), pa.string()), "string": found, "n": counts})


def _rounded(bits: np.ndarray) -> np.ndarray:
    return np.round(bits * 65536) / 65536


def compile_trees(lang: np.ndarray, order: np.ndarray, string: np.ndarray, n: np.ndarray, languages: tuple[str, ...]) -> Model:
    """The model of counts ``n``: how often a language (by number) has a string of ``order`` bytes
    and one more.

    Order -1 is uniform. In a context with total ``t`` and ``d`` distinct bytes a seen
    byte has ``n / (t + d)`` and the escape ``d / (t + d)`` (method C). A language whose tree
    lacks a context goes on with the shorter one at no cost.
    """
    shorter, before = np.arange(256), np.full((256, len(languages)), 8.0)
    blocks, keys, rows, size = [], [], [], 0
    for o in range(ORDER + 1):
        own = order == o
        joint, at = np.unique(string[own], return_inverse=True)
        if o == 0:  # every byte has a row
            joint, at = np.arange(256), string[own]
        elif not len(joint):
            break
        count = np.zeros((len(joint), len(languages)))
        count[at, lang[own]] = n[own]
        contexts, start = np.unique(joint >> 8, return_index=True)
        of = np.repeat(np.arange(len(contexts)), np.diff(np.append(start, len(joint))))
        total, kinds = np.add.reduceat(count, start), np.add.reduceat((count > 0).astype(float), start)
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = _rounded(np.where(kinds > 0, np.log2(total + kinds) - np.log2(kinds), 0.0))
            seen = _rounded(np.log2(total + kinds)[of] - np.log2(count))
        further = before[np.searchsorted(shorter, joint & _tail(max(o, 1)))]
        before = np.where(count > 0, seen, escape[of] + further)
        shorter = joint
        blocks.append(before)
        if o:
            keys += [_tagged(o, joint), _tagged(o, contexts, context=True)]
            rows.append(np.arange(size, size + len(joint) + len(contexts)))
            blocks.append(escape)
        size += len(joint) + (len(contexts) if o else 0)
    table = _hash_table(*(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keys, rows)))
    return Model(languages, *table, np.ascontiguousarray(np.concatenate(blocks).T.astype(np.float32)))


def _threshold(tree: DataFrame, room: int, least: int) -> int:
    """The least number of times a context must be seen so that no more than ``room`` strings
    stay. There are fewer different numbers than the square root of twice the sample's bytes."""
    numbers = tree.where("`order` > 0").groupBy("seen").count().toArrow().sort_by([("seen", "descending")])
    seen, count = (numbers[c].to_numpy() for c in ("seen", "count"))
    fits = seen[np.cumsum(count) <= room]
    return max(least, int(fits[-1])) if len(fits) else (int(seen[0]) + 1 if len(seen) else least)


def train(docs: DataFrame, *, per_language: int = DOCS_PER_LANGUAGE, least: int = LEAST_SEEN) -> Model:
    """Fit on at most ``per_language`` documents of each language: those outside fold 0 with
    a text and a language whose hashed id is least. Whole texts are counted. Contexts seen fewer
    than ``least`` times are not in the trees, nor the rarest beyond the bounds of the model."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id")) != 0))
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    part = F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE_PARTS))
    chosen = usable.select("doc_id", "lang", part.alias("part"))
    # A language is cut into parts first, so that a frequent one is not ordered in one task; its
    # least ids are among the least of its parts.
    for keys in (("lang", "part"), ("lang",)):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        chosen = chosen.withColumn("place", place).where(F.col("place") <= per_language).drop("place")
    chosen = chosen.select("doc_id", "lang").distinct()
    sample = usable.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi")
    counted = sample.select("lang", F.col("text").cast("string")).mapInArrow(_train, "lang string, string long, n long")
    counted = counted.groupBy("lang", "string").agg(F.sum("n").alias("n"))
    # Each byte gave one string, so shorter ones are counted by adding up.
    cut = [F.struct(F.lit(o).alias("order"), F.col("string").bitwiseAND(_tail(o + 1)).alias("string")) for o in range(ORDER + 1)]
    every = counted.select("lang", "n", F.explode(F.array(*cut)).alias("at")).select("lang", "n", "at.*")
    every = every.groupBy("lang", "order", "string").agg(F.sum("n").alias("n"))
    context = Window.partitionBy("order", F.shiftright("string", 8))  # 256 rows a language at most
    tree = stored(every.withColumn("seen", F.sum("n").over(context)), "tree")
    languages = tuple(sorted(r["lang"] for r in tree.select("lang").distinct().collect()))
    room = min(STRINGS, MODEL_BYTES // (4 * max(1, len(languages))))
    kept = tree.where((F.col("order") == 0) | (F.col("seen") >= _threshold(tree, room, least)))
    rows = kept.select("lang", F.col("order").cast("long"), "string", "n").toArrow()  # the bound above
    lang = pa.compute.index_in(rows["lang"], pa.array(languages, pa.string())).to_numpy()
    model = compile_trees(lang, *(rows[c].to_numpy() for c in ("order", "string", "n")), languages)
    del rows
    tidy()
    return model


def code_lengths(model: Model, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits of each text in each language: ``(texts, languages)``."""
    out = np.zeros((len(offsets) - 1, len(model.languages)))
    for a in range(0, len(raw), SEGMENT):
        b = min(a + SEGMENT, len(raw))
        first, last = np.searchsorted(offsets, (a, b - 1), "right") - 1
        text = np.repeat(np.arange(last + 1 - first), np.diff(np.clip(offsets[first : last + 2], a, b)))
        string = strings(raw, offsets, a, b)
        row, left, escapes = string & 255, np.arange(b - a), []
        for o in range(ORDER, 0, -1):
            found = model.find(_tagged(o, string[left] & _tail(o + 1)))
            row[left[found >= 0]] = found[found >= 0]
            left = left[found < 0]
            escape = model.find(_tagged(o, string[left] >> 8 & _tail(o), context=True))
            escapes.append((left[escape >= 0], escape[escape >= 0]))
        at, more = (np.concatenate(x) for x in zip(*escapes))
        of, row = np.concatenate([text, text[at]]), np.concatenate([row, more])
        for k, cost in enumerate(model.cost):
            out[first : last + 1, k] += np.bincount(of, cost[row], last + 1 - first)
    return out


@tidied
def _predict(batches: Iterable[pa.RecordBatch], model, read: str) -> Iterator[pa.RecordBatch]:
    model = model.value
    for batch in batches:
        if not batch.num_rows:
            continue
        letters, text = batch.column("_letters"), batch.column(read)
        raw, offsets = text_buffer(text)
        bits = code_lengths(model, raw, offsets)
        known = letters.fill_null(False).to_numpy(zero_copy_only=False) & bool(model.languages)
        names, score = np.full(len(text), UNDETERMINED, object), np.zeros(len(text))
        if model.languages:
            best = bits.argmin(axis=1)
            share = 1 / np.exp2(np.maximum(bits.min(axis=1)[:, None] - bits, -1000)).sum(axis=1)
            names[known] = np.array(model.languages, object)[best[known]]
            score[known] = share[known]
        per_byte = bits.min(axis=1) / np.maximum(np.diff(offsets), 1) if model.languages else score
        kept = [n for n in batch.schema.names if n not in ("_letters", "_text")]
        made = [pa.array(names, pa.string()), pa.array(score), pa.array(np.where(known, per_byte, 0.0))]
        yield pa.RecordBatch.from_arrays([*map(batch.column, kept), *made], [*kept, "lang_pred", "score", "bits_per_byte"])


def with_language(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of ``docs`` and ``lang_pred, score, bits_per_byte``; see ``identify``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text = F.col("text").cast("string")
    rows = docs.drop("lang_pred", "score", "bits_per_byte")
    schema = T.StructType([*rows.schema.fields, *T._parse_datatype_string("lang_pred string, score double, bits_per_byte double").fields])
    own = any(f.name == "text" and f.dataType == T.StringType() for f in rows.schema.fields)
    rows = rows.withColumn("_letters", F.coalesce(text.rlike(r"\p{L}"), F.lit(False)))
    if not own:  # else the text goes to Python once
        rows = rows.withColumn("_text", text)
    return rows.mapInArrow(partial(_predict, model=shared, read="text" if own else "_text"), schema)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, bits_per_byte``: one row per row of ``docs``.

    ``lang_pred`` is the language with the shortest code for the whole text (of equal
    ones the first by name), ``score`` its share when all are equally likely beforehand.
    A text that is null or has no letter is ``und`` with score 0, and so is every text if
    nothing could be learned. A null ``doc_id`` counts as held out. Repeated rows are
    scored each for itself; an empty table gives no rows; other columns are not looked at.
    """
    held = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(True))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), "text")
    return with_language(rows, model).drop("text")
