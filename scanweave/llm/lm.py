"""Cross-entropy difference of documents under two n-gram models.

A target and a background model of word bigrams share one vocabulary, smoothing and mass:
the larger model's counts are scaled to the smaller's number of words, so that losses differ
by what the texts are like and not by how much was seen. A document's score is its mean loss
per word under the target less that under the background.

Words and bigrams are counted by 64-bit hashes, in tables that grow with the corpus. Neither
tables nor texts pass through the driver: texts are kept in chunks, sealed by the Python
workers so that the JVM only moves them, a chunk asks for each of its n-grams once, and
what the tables answer returns to the chunk. So a frequent n-gram
costs one key per chunk, and no table is held as a whole anywhere. Where the counted texts
are the scored ones (``score_corpus``), a chunk's counts are its question as well.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .exchange import columns, release_steps, stored, tidy
from .textbytes import mix, pieces, text_buffer, word_hashes, word_spans

#: Mass of the prior in each context, in words; mass of the uniform part per word.
PRIOR, UNIFORM = 50.0, 0.1
#: Words that the uniform part is over; a corpus that has more sets a larger number.
VOCABULARY = 1 << 18
#: Tables of words and of bigrams are cut by the upper bits of the hash, into buckets that each
#: hold the keys of about so many bytes of text.
BUCKET = 1 << 23
MAX_BITS = 24
#: Bytes of text in a chunk, one text at least.
CHUNK = 1 << 22
#: Up to so many target ids (8 bytes each) are broadcast; more are joined by a shuffle.
BROADCAST_IDS = 1 << 20
_START = np.uint64(0x5851F42D4C957F2D)
#: Counts of a word (seen, and seen as a context) and of a bigram, for background and target.
_WORD, _PAIR = 0, 1
_COUNTS = {_WORD: 4, _PAIR: 2}


def word_cells(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(word, context, pair, counts)``: hashes of each word, of the word before it (a text
    starts after a fixed one) and of both; words per text. ASCII letters are lowered."""
    start, end, counts = word_spans(raw, offsets)
    words = word_hashes(raw, start, end, lower=True)
    before = np.full(len(words), _START)
    before[1:] = words[:-1]
    first = (np.cumsum(counts) - counts)[counts > 0]
    before[first] = _START
    pair = mix(before * np.uint64(0x9E3779B97F4A7C15) + words)
    return words, before, pair, counts


def _cells(raw: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """``word_cells`` of a whole chunk, a piece at a time."""
    parts = [word_cells(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in pieces(offsets)]
    return [np.concatenate(x) for x in zip(*parts)]


def _chunks(batches: Iterable[pa.RecordBatch], *names: str) -> Iterator[list[pa.Array]]:
    """Columns of about ``CHUNK`` bytes of text, which is the first of ``names``."""
    held, size = [], 0
    for cols in columns(batches, *names):
        offsets = text_buffer(cols[0])[1]
        for a, b in pieces(offsets, CHUNK):
            n = int(offsets[b] - offsets[a])
            if held and size + n > CHUNK:
                yield [pa.concat_arrays(c) for c in zip(*held)]
                held, size = [], 0
            held.append([c.slice(a, b - a) for c in cols])
            size += n
    if held:
        yield [pa.concat_arrays(c) for c in zip(*held)]


def _sealed(texts: pa.Array, docs: pa.Array, targets: pa.Array) -> bytes:
    """A chunk as one compressed value: nested columns of its texts would be unpacked, padded
    and copied by each step of the JVM that they pass."""
    batch = pa.RecordBatch.from_arrays([texts, docs, targets], ["text", "doc_id", "target"])
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=1), use_threads=False)
    with pa.ipc.new_stream(sink, batch.schema, options=options) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _opened(docs: pa.BinaryScalar) -> pa.RecordBatch:
    options = pa.ipc.IpcReadOptions(use_threads=False)
    return pa.ipc.open_stream(docs.as_buffer(), options=options).read_next_batch()


def _narrow(counts: np.ndarray) -> bytes:
    """Counts in the smallest type that holds them, low bytes first: high ones are mostly zeros.
    ``_counts`` finds the type by the length."""
    small = np.ascontiguousarray(counts, np.min_scalar_type(int(counts.max(initial=0))))
    return small.view(np.uint8).reshape(-1, small.itemsize).T.tobytes()


def _counts(data: bytes, n: int, kind: int) -> np.ndarray:
    width = len(data) // (n * _COUNTS[kind])
    rows = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T)
    return rows.view(f"<u{width}").reshape(_COUNTS[kind], n).astype(np.int64)


def _packed(keys: np.ndarray) -> bytes:
    """Sorted keys as steps, all first bytes before all second ones: near keys share zeros,
    which shuffle and Parquet compress away."""
    return np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T)
    return np.cumsum(steps.view(np.uint64).ravel(), dtype=np.uint64)


def _by_bucket(keys: np.ndarray, kind: int, bits: int) -> Iterator[tuple[int, slice]]:
    """``(bucket, positions)`` of sorted keys, ascending."""
    own = (keys >> np.uint64(64 - bits)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(own, prepend=-1))
    for a, b in zip(cuts, [*cuts[1:], len(keys)]):
        yield (kind << bits) + int(own[a]), slice(int(a), int(b))


def bits_for(size: int) -> int:
    """Bits of the bucket for ``size`` bytes of text."""
    return min(MAX_BITS, max(3, (size // BUCKET).bit_length()))


def _count(batches: Iterable[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for chunks, docs in columns(batches, "chunk", "docs"):
        for chunk, held in zip(chunks, docs):
            text, _, target = _opened(held)
            word, context, pair, counts = _cells(*text_buffer(text))
            own = np.repeat(target.to_numpy(zero_copy_only=False).astype(np.int64), counts)
            # A word and its use as a context share a key: rows are seen 0, 1, as a context 0, 1.
            both = np.concatenate([own, own + 2])
            for kind, seen, row in ((_WORD, np.concatenate([word, context]), both), (_PAIR, pair, own)):
                keys, at = np.unique(seen, return_inverse=True)
                n = np.bincount(row * len(keys) + at, minlength=_COUNTS[kind] * len(keys)).reshape(_COUNTS[kind], len(keys))
                cut = list(_by_bucket(keys, kind, bits))
                yield pa.RecordBatch.from_pydict({
                    "chunk": pa.array([chunk.as_py()] * len(cut), pa.int64()),
                    "bucket": pa.array([b for b, _ in cut], pa.int32()),
                    "keys": pa.array([_packed(keys[s]) for _, s in cut], pa.binary()),
                    "counts": pa.array([_narrow(n[:, s]) for _, s in cut], pa.binary()),
                })
    tidy()


TABLE = "bucket int, keys binary, counts binary, known long, background long, target long"


def _rows(table: pa.Table, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of all rows, one after the other."""
    keys = [_unpacked(k) for k in table["keys"].to_pylist()]
    counts = [_counts(c, len(k), kind) for k, c in zip(keys, table["counts"].to_pylist())]
    if not keys:
        return np.zeros(0, np.uint64), np.zeros((_COUNTS[kind], 0), np.int64)
    return np.concatenate(keys), np.concatenate(counts, axis=1)


def _merge(table: pa.Table, bits: int) -> pa.Table:
    bucket = table["bucket"][0].as_py()
    keys, counts = _rows(table, bucket >> bits)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    n = np.add.reduceat(counts[:, order], first, axis=1)
    return pa.table({
        "bucket": pa.array([bucket], pa.int32()),
        "keys": pa.array([_packed(keys[first])], pa.binary()),
        "counts": pa.array([_narrow(n)], pa.binary()),
        "known": [int((n[:2].sum(axis=0) > 0).sum())], "background": [int(n[0].sum())], "target": [int(n[1].sum())],
    })


@dataclass(frozen=True)
class Mass:
    """What is the same for all words: words of each model (background, target), distinct
    words of both together."""

    words: tuple[int, int]
    known: int

    def scale(self, k: int) -> float:
        """Matched: the larger model is scaled to the mass of the smaller."""
        return min(self.words) / self.words[k] if min(self.words) else 1.0

    def alone(self, k: int, seen):
        """Probability of a word by itself; all words that neither model knows are one more."""
        s = self.scale(k)
        return (seen * s + UNIFORM) / (self.words[k] * s + UNIFORM * max(VOCABULARY, self.known + 1))

    def loss(self, k: int, seen, context, pair):
        """Bits of a word by the counts of itself, of its context and of both."""
        s = self.scale(k)
        return -np.log2((pair * s + PRIOR * self.alone(k, seen)) / (context * s + PRIOR))


@dataclass(frozen=True)
class Models:
    """Both models: ``table`` holds sorted keys and their counts by kind and bucket. For looking
    at one n-gram at a time, ``alone``, ``context`` and ``pair`` give its value by hash, per
    model (background, target)."""

    table: DataFrame
    mass: Mass
    bits: int

    def _seen(self, kind: int, row: int, key) -> int:
        bucket = (kind << self.bits) + (int(key) >> (64 - self.bits))
        for r in self.table.where(F.col("bucket") == bucket).collect():
            keys = _unpacked(r["keys"])
            at = int(np.searchsorted(keys, np.uint64(key)))
            if at < len(keys) and keys[at] == np.uint64(key):
                return int(_counts(bytes(r["counts"]), len(keys), kind)[row, at])
        return 0

    @property
    def alone(self) -> tuple[_One, _One]:
        return tuple(_One(lambda key, k=k: self.mass.alone(k, self._seen(_WORD, k, key))) for k in (0, 1))

    @property
    def context(self) -> tuple[_One, _One]:
        return tuple(_One(lambda key, k=k: self.mass.scale(k) * self._seen(_WORD, 2 + k, key)) for k in (0, 1))

    @property
    def pair(self) -> tuple[_One, _One]:
        return tuple(_One(lambda key, k=k: self.mass.scale(k) * self._seen(_PAIR, k, key)) for k in (0, 1))


class _One:
    def __init__(self, find):
        self.find = find

    def __getitem__(self, key) -> float:
        return self.find(key)


def _pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for cols in _chunks(batches, "text", "doc_id", "target"):
        size = int(text_buffer(cols[0])[1][-1])
        docs = pa.array([_sealed(*cols)], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array([size], pa.int64()), docs], ["size", "docs"])
    tidy()


def _stored_chunks(docs: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """``chunk, size, docs``: about ``CHUNK`` bytes of texts in a row (``size``), sealed with the ids
    and whether the id is in ``target``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if target is None:
        rows = rows.withColumn("target", F.lit(False))
    else:
        ids = target.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
        ids = stored(ids, "target")
        chosen = ids.withColumn("target", F.lit(True))
        if ids.count() <= BROADCAST_IDS:
            chosen = F.broadcast(chosen)
        rows = rows.join(chosen, "doc_id", "left").withColumn("target", F.coalesce("target", F.lit(False)))
    packed = rows.select("text", "doc_id", "target").mapInArrow(_pack, "size long, docs binary")
    return stored(packed.withColumn("chunk", F.monotonically_increasing_id()), "chunks")


def _bits_of(chunks: DataFrame) -> int:
    return bits_for(chunks.agg(F.sum("size")).first()[0] or 0)


def _counted(chunks: DataFrame, bits: int) -> DataFrame:
    rows = chunks.select("chunk", "docs")
    return rows.mapInArrow(partial(_count, bits=bits), "chunk long, bucket int, keys binary, counts binary")


def _mass(table: DataFrame, bits: int) -> Mass:
    words = table.where(F.col("bucket") < 1 << bits)
    sums = words.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("background", "target", "known"))).first()
    release_steps(table.sparkSession)
    return Mass((sums["background"], sums["target"]), sums["known"])


def train(docs: DataFrame, target: DataFrame) -> Models:
    """Count all texts; the documents whose ``doc_id`` is in ``target`` make its model, all
    others the background's."""
    chunks = _stored_chunks(docs, target)
    bits = _bits_of(chunks)
    counted = _counted(chunks, bits).drop("chunk")

    def merge(table: pa.Table) -> pa.Table:
        return _merge(table, bits)

    table = stored(counted.groupBy("bucket").applyInArrow(merge, TABLE), "ngrams")
    return Models(table, _mass(table, bits), bits)


def _keys(word: np.ndarray, pair: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(kind, keys, positions)``: a chunk's keys, ascending, and where each n-gram is among
    them; the text start comes last among the words."""
    if len(word):
        for kind, of in ((_WORD, np.append(word, _START)), (_PAIR, pair)):
            yield kind, *np.unique(of, return_inverse=True)


def _ask(batches: Iterable[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for chunks, docs in columns(batches, "chunk", "docs"):
        for chunk, held in zip(chunks, docs):
            word, _, pair, _ = _cells(*text_buffer(_opened(held)["text"]))
            for kind, keys, _ in _keys(word, pair):
                cut = list(_by_bucket(keys, kind, bits))
                yield pa.RecordBatch.from_pydict({
                    "chunk": pa.array([chunk.as_py()] * len(cut), pa.int64()),
                    "bucket": pa.array([b for b, _ in cut], pa.int32()),
                    "keys": pa.array([_packed(keys[s]) for _, s in cut], pa.binary()),
                })
    tidy()


def _answer(asked: pa.Table, table: pa.Table, bits: int) -> pa.Table:
    """Counts in the order of the keys that were asked for; none for unknown keys."""
    bucket = (asked if asked.num_rows else table)["bucket"][0].as_py()
    keys, counts = _rows(table, bucket >> bits)
    keys, counts = np.append(keys, np.uint64(0)), np.pad(counts, ((0, 0), (0, 1)))
    out = []
    for wanted in asked["keys"].to_pylist():
        wanted = _unpacked(wanted)
        at = np.searchsorted(keys[:-1], wanted)
        out.append(_narrow(np.where((at < len(keys) - 1) & (keys[at] == wanted), counts[:, at], 0)))
    return pa.table({"chunk": asked["chunk"], "bucket": asked["bucket"], "counts": pa.array(out, pa.binary())})


def _settle(counted: pa.Table, bits: int) -> pa.Table:
    """The answers to all chunks that counted in a bucket; the first row has the bucket's sums."""
    table = _merge(counted, bits)
    answers = _answer(counted, table, bits)
    for name in ("known", "background", "target"):
        answers = answers.append_column(name, pa.array([table[name][0].as_py()] + [0] * (len(answers) - 1), pa.int64()))
    return answers


def _score(chunk: pa.Table, answers: pa.Table, mass: Mass, bits: int) -> pa.Table:
    text, doc, _ = _opened(chunk["docs"][0])
    word, _, pair, words = _cells(*text_buffer(text))
    told = dict(zip(answers["bucket"].to_pylist(), answers["counts"].to_pylist()))
    known, at = {}, {}
    for kind, keys, at[kind] in _keys(word, pair):
        known[kind] = np.concatenate([_counts(told[b], s.stop - s.start, kind) for b, s in _by_bucket(keys, kind, bits)], axis=1)
    mean = np.zeros((2, len(words)))
    if known:
        ends = np.concatenate([[0], np.cumsum(words)])
        before = np.roll(at[_WORD], 1)[:-1]
        before[ends[:-1][words > 0]] = at[_WORD][-1]
        for k in (0, 1):
            bits = mass.loss(k, known[_WORD][k][at[_WORD][:-1]], known[_WORD][2 + k][before], known[_PAIR][k][at[_PAIR]])
            sums = np.concatenate([[0.0], np.cumsum(bits)])
            mean[k] = (sums[ends[1:]] - sums[ends[:-1]]) / np.maximum(words, 1)
    return pa.table({
        "doc_id": doc, "n_words": words.astype(np.int64), "target_loss": mean[1], "background_loss": mean[0], "score": mean[1] - mean[0],
    })


def cross_entropy_difference(docs: DataFrame, models: Models) -> DataFrame:
    """``doc_id, n_words, target_loss, background_loss, score``: one row per row of ``docs``.

    Losses are bits per word over the whole text; a low ``score`` is near the target. A text
    that is null or has no word has zeros. Repeated rows and rows without an id are scored
    each for itself; without any target document both models are priors and counts of the
    background. An empty table gives no rows; columns besides ``doc_id`` and ``text`` are
    not looked at.
    """
    chunks, bits = _stored_chunks(docs), models.bits
    asked = chunks.select("chunk", "docs").mapInArrow(partial(_ask, bits=bits), "chunk long, bucket int, keys binary")
    tables = models.table.select("bucket", "keys", "counts").groupBy("bucket")
    answers = asked.groupBy("bucket").cogroup(tables).applyInArrow(partial(_answer, bits=bits), "chunk long, bucket int, counts binary")
    return _scored(chunks, stored(answers, "answers"), models.mass, bits)


def _scored(chunks: DataFrame, answers: DataFrame, mass: Mass, bits: int) -> DataFrame:
    schema = "doc_id long, n_words long, target_loss double, background_loss double, score double"
    own = chunks.select("chunk", "docs").groupBy("chunk")
    answers = answers.select("chunk", "bucket", "counts").groupBy("chunk")
    return own.cogroup(answers).applyInArrow(partial(_score, mass=mass, bits=bits), schema)


def score_corpus(docs: DataFrame, target: DataFrame) -> DataFrame:
    """The rows of ``cross_entropy_difference(docs, train(docs, target))``, with the texts read
    and each chunk's n-grams sent to their buckets once instead of twice."""
    chunks = _stored_chunks(docs, target)
    bits = _bits_of(chunks)

    def settle(counted: pa.Table) -> pa.Table:
        return _settle(counted, bits)

    schema = "chunk long, bucket int, counts binary, known long, background long, target long"
    answers = stored(_counted(chunks, bits).groupBy("bucket").applyInArrow(settle, schema), "answers")
    return _scored(chunks, answers, _mass(answers, bits), bits)
