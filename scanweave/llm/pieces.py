"""SentencePiece encoding by merge rounds over flat arrays, and decoding by table lookups.

All words of a batch lie one after the other in one array of symbols. In each round every
word finds the best rank among its pairs (a segmented minimum), merges that pair wherever
it stands, from the left, and the array is compacted; words without a pair are done.
What the library would do one merge at a time is so done for all words at once.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from sentencepiece import SentencePieceProcessor

from .exchange import columns, texts

#: Fixed value: what stands for a space in the pieces of a model.
SPACE = "▁"
#: Words whose ids a worker remembers, and the longest of them in characters.
CACHE, CACHED_LENGTH = 150_000, 48
#: Characters that are encoded together, and ids that are decoded together.
SYMBOLS, IDS = 1 << 17, 1 << 16
#: Texts that are cut together.
TEXTS = 500
#: A word of more symbols whose merges depend on their order is merged one by one.
IN_ROUNDS = 64
NONE = np.int32(2**31 - 1)


class Table:
    """Byte strings by number, for joining many of them in one step."""

    def __init__(self, strings: list[bytes]):
        self.data = np.frombuffer(b"".join(strings), np.uint8)
        self.size = np.array([len(s) for s in strings], np.int64)
        self.start = np.cumsum(self.size) - self.size

    def join(self, numbers: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The strings one after the other, and where each begins (and the last ends)."""
        size = self.size[numbers]
        ends = np.cumsum(size)
        begin = ends - size
        at = np.repeat(self.start[numbers] - begin, size) + np.arange(ends[-1] if len(ends) else 0)
        return self.data[at].tobytes(), np.concatenate([[0], ends])


def _mixed(key: np.ndarray) -> np.ndarray:
    return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(42)).astype(np.int64)


def _apart(hit: np.ndarray) -> np.ndarray:
    """Of neighbouring hits every second one, from the left: merges that share no symbol."""
    at = np.flatnonzero(hit)
    new = np.diff(at, prepend=-2) > 1
    order = np.arange(len(at))
    in_run = order - np.maximum.accumulate(np.where(new, order, 0))
    out = np.zeros(len(hit), bool)
    out[at[in_run % 2 == 0]] = True
    return out


class Pieces:
    """A BPE model with byte fallback, read through the library's own accessors.

    Symbols are the ids of the vocabulary, and above them the characters that have no
    id of their own. ``merged`` and ``rank`` tell for each pair of symbols what they make
    and how good that is (0 is best); pairs are kept sorted for binary search.
    """

    def __init__(self, path: str):
        model = SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        self.names = [model.id_to_piece(i) for i in range(n)]
        self.byte_id = np.full(256, -1, np.int64)
        own = {}  # what text can become; control, unknown and byte pieces cannot be formed
        self.silent, self.unknown = np.zeros(n, bool), np.zeros(n, bool)
        for i, name in enumerate(self.names):
            if model.is_byte(i):
                self.byte_id[int(name[3:5], 16)] = i
            elif model.is_control(i):
                self.silent[i] = True
            elif model.is_unknown(i):
                self.unknown[i] = True
            else:
                own[name] = i
        self._demand(model, n)
        self.size, self.symbol = n, dict(own)
        for name in own:
            for c in name:
                self.symbol.setdefault(c, len(self.symbol) + n)
        self.symbols = max(self.symbol.values(), default=0) + 1
        self.of_char = np.full(0x110000, -1, np.int32)  # -1: no piece has this character
        for name, i in self.symbol.items():
            if len(name) == 1:
                self.of_char[ord(name)] = i

        score = np.array([model.get_score(i) for i in range(n)], np.float32)
        order = np.unique(-score, return_inverse=True)[1].astype(np.int32)
        pairs = {}
        for name, i in own.items():
            for cut in range(1, len(name)):
                a, b = self.symbol.get(name[:cut]), self.symbol.get(name[cut:])
                if a is not None and b is not None:
                    pairs[a * self.symbols + b] = i
        key = np.array(sorted(pairs), np.int64)
        self.key = np.append(key, np.int64(2**62))
        self.merged = np.array([*(pairs[k] for k in key.tolist()), 0], np.int32)
        self.rank = np.append(order[self.merged[:-1]], NONE).astype(np.int32)
        # A small hash of all pairs ends most lookups of what is no pair.
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[_mixed(key)] = True

        # A word ends where no piece goes on: before a space mark, and around characters
        # that occur in no longer piece.
        longer = [x for x in own if len(x) > 1]
        if any(SPACE in x.lstrip(SPACE) for x in longer):
            raise ValueError("pieces with a space inside are not supported")
        loose = {c for c in map(chr, range(33)) if not any(c in x for x in longer)}
        marks = re.escape("".join(sorted(loose - {" "})))
        self.plain = re.compile(rf"[{marks}]|{SPACE}?[^{SPACE}{marks}]+|{SPACE}") if marks else re.compile(f"{SPACE}?[^{SPACE}]+|{SPACE}")
        self.spaced = re.compile(rf"[{marks}]|{SPACE}*[^{SPACE}{marks}]+|{SPACE}+") if marks else re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")

        shown = [b"" if s else x.replace(SPACE, " ").encode() for x, s in zip(self.names, self.silent)]
        for byte, i in enumerate(self.byte_id):
            shown[i] = bytes([byte])
        for i in np.flatnonzero(self.unknown):
            shown[i] = " ⁇ ".encode()
        self.shown = Table(shown)
        self.is_byte = np.zeros(n, bool)
        self.is_byte[self.byte_id] = True
        self.byte_value = np.zeros(n, np.uint8)
        self.byte_value[self.byte_id] = np.arange(256)

    def _demand(self, model: SentencePieceProcessor, n: int) -> None:
        if (self.byte_id < 0).any() or any(model.is_unused(i) for i in range(n)):
            raise ValueError("the model must have byte fallback and no unused pieces")
        if model.normalize(" éﬁ  x ") != f"{SPACE}{SPACE}éﬁ{SPACE}{SPACE}x{SPACE}":
            raise ValueError("the model must keep texts as they are, behind one space")

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Where each pair stands among ``key``; the last place if it is none."""
        out = np.full(len(a), len(self.key) - 1, np.int32)
        key = a.astype(np.int64) * self.symbols + b
        some = np.flatnonzero((a >= 0) & (b >= 0) & self.maybe[_mixed(key)])
        at = np.searchsorted(self.key, key[some])
        out[some] = np.where(self.key[at] == key[some], at, len(self.key) - 1)
        return out

    def merge(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All words merged to their end: ``(symbols, word)``, ordered by word.

        ``symbols`` are those of single characters, ``word`` (ascending) is each one's word.
        """
        done_symbols, done_words = [], []
        pair = self._pairs(symbols, word)
        while len(symbols):
            rank = self.rank[pair]
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            best = np.minimum.reduceat(rank, starts)
            counts = np.diff(np.append(starts, len(word)))
            live = np.repeat(best < NONE, counts)
            if not live.all():
                done_symbols.append(symbols[~live])
                done_words.append(word[~live])
                symbols, word, pair, rank, best = symbols[live], word[live], pair[live], rank[live], best[best < NONE]
                if not len(symbols):
                    break
                starts = np.flatnonzero(np.diff(word, prepend=-1))
                counts = np.diff(np.append(starts, len(word)))
            hit = _apart(rank == np.repeat(best, counts))
            unsafe = self._unsafe(symbols, word, pair, hit, rank)
            if len(unsafe):
                long_ = unsafe[counts[unsafe] > IN_ROUNDS]
                for w in long_:  # equal ranks in a long word: one merge at a time, in the library's order
                    own = slice(starts[w], starts[w] + counts[w])
                    made = self._agenda(symbols[own].tolist())
                    done_symbols.append(np.array(made, symbols.dtype))
                    done_words.append(np.full(len(made), word[starts[w]], word.dtype))
                first = np.zeros(len(symbols), bool)
                for w in np.setdiff1d(unsafe, long_):
                    own = slice(starts[w], starts[w] + counts[w])
                    first[starts[w] + int(np.argmax(hit[own]))] = True
                of_unsafe = np.zeros(len(starts), bool)
                of_unsafe[unsafe] = True
                hit = np.where(np.repeat(of_unsafe, counts), first, hit)
                if len(long_):
                    gone = np.zeros(len(starts), bool)
                    gone[long_] = True
                    stay = ~np.repeat(gone, counts)
                    symbols, word, pair, hit = symbols[stay], word[stay], pair[stay], hit[stay]
            at = np.flatnonzero(hit)
            symbols[at] = self.merged[pair[at]]
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            symbols, word, pair, hit = symbols[stay], word[stay], pair[stay], hit[stay]
            # Only the pairs on either side of a merged symbol are new.
            fresh = hit.copy()
            fresh[:-1] |= hit[1:]
            fresh = np.flatnonzero(fresh)
            pair[fresh] = self._pairs(symbols, word, fresh)
        symbols = np.concatenate(done_symbols) if done_symbols else symbols
        word = np.concatenate(done_words) if done_words else word
        order = np.argsort(word, kind="stable")
        return symbols[order], word[order]

    def _pairs(self, symbols: np.ndarray, word: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
        """The pair of each symbol (of those at ``at``) and the next of its word."""
        if at is None:
            at = np.arange(len(symbols))
        out = np.full(len(at), len(self.key) - 1, np.int32)
        inner = np.flatnonzero(at < len(symbols) - 1)
        inner = inner[word[at[inner]] == word[at[inner] + 1]]
        out[inner] = self.find(symbols[at[inner]], symbols[at[inner] + 1])
        return out

    def _unsafe(self, symbols, word, pair, hit, rank) -> np.ndarray:
        """Words (by place) where a merge makes a pair that comes before the next merge of
        the same round, so that merges side by side could differ from one after the other."""
        at = np.flatnonzero(hit)
        place = np.cumsum(np.diff(word, prepend=-1) > 0) - 1
        several = np.bincount(place[at]) > 1
        at = at[several[place[at]]]
        if not len(at):
            return at
        made, own = self.merged[pair[at]], rank[at]
        # On the right stands the old symbol, on the left what the round has left there.
        right = at + 2
        has = right < len(symbols)
        has[has] = word[right[has]] == word[at[has]]
        worse = np.zeros(len(at), bool)
        worse[has] = self.rank[self.find(made[has], symbols[right[has]])] <= own[has]
        left = at - 1
        has = left >= 0
        has[has] = word[left[has]] == word[at[has]]
        joined = has.copy()
        joined[has] = (left[has] >= 1) & hit[left[has] - 1] & (word[left[has] - 1] == word[at[has]])
        before = symbols[np.maximum(left, 0)].copy()
        before[joined] = self.merged[pair[left[joined] - 1]]
        worse[has] |= self.rank[self.find(before[has], made[has])] <= own[has]
        return np.unique(place[at[worse]])

    def _agenda(self, symbols: list[int]) -> list[int]:
        """One word, one merge at a time: best rank first, of equal ones the leftmost."""
        n = len(symbols)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        queue: list[tuple[int, int, int, int]] = []

        def offer(pairs: list[tuple[int, int]]) -> None:
            found = self.find(np.array([symbols[i] for i, _ in pairs]), np.array([symbols[j] for _, j in pairs]))
            for (i, _), p in zip(pairs, found.tolist()):
                if p < len(self.key) - 1:
                    heapq.heappush(queue, (int(self.rank[p]), i, int(self.key[p]), int(self.merged[p])))

        if n > 1:
            offer([(i, i + 1) for i in range(n - 1)])
        while queue:
            _, i, key, made = heapq.heappop(queue)
            if not alive[i] or after[i] >= n or symbols[i] * self.symbols + symbols[after[i]] != key:
                continue
            gone = after[i]
            symbols[i], alive[gone], after[i] = made, False, after[gone]
            if after[i] < n:
                before[after[i]] = i
            new = [(i, after[i])] if after[i] < n else []
            if before[i] >= 0:
                new.append((before[i], i))
            if new:
                offer(new)
        return [s for s, x in zip(symbols, alive) if x]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word as little-endian 32-bit integers."""
        out: list[bytes] = []
        first = 0
        sizes = np.cumsum([len(w) for w in words])
        while first < len(words):
            base = sizes[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(sizes, base + SYMBOLS, "right")))
            out += self._encode("".join(words[first:last]), np.diff(sizes[first:last], prepend=base))
            first = last
        return out

    def _encode(self, text: str, lengths: np.ndarray) -> list[bytes]:
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        symbols = self.of_char[points]
        odd = symbols < 0
        # Characters that no piece has are told apart by their code points, below zero.
        symbols[odd] = -1 - points[odd]
        symbols, word = self.merge(symbols, np.repeat(np.arange(len(lengths)), lengths))
        # A symbol without an id becomes the bytes of its character.
        whole = (symbols >= 0) & (symbols < self.size)
        if not whole.all():
            symbols, word = self._as_bytes(symbols, word, whole)
        ids = symbols.astype("<u4").tobytes()
        ends = 4 * np.searchsorted(word, np.arange(len(lengths) + 1))
        return [ids[a:b] for a, b in zip(ends.tolist(), ends[1:].tolist())]

    def _as_bytes(self, symbols, word, whole) -> tuple[np.ndarray, np.ndarray]:
        names = {s: c for c, s in self.symbol.items() if s >= self.size}
        lone = symbols[~whole].tolist()
        data = [(names[s] if s >= 0 else chr(-1 - s)).encode() for s in lone]
        counts = np.ones(len(symbols), np.int64)
        counts[~whole] = [len(d) for d in data]
        out = np.repeat(symbols, counts)
        out[np.repeat(~whole, counts)] = self.byte_id[np.frombuffer(b"".join(data), np.uint8)]
        return out, np.repeat(word, counts)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The UTF-8 texts of several runs of ids, ``counts`` of them each.

        As the library does: the first space of a text goes, control pieces are silent, and
        each byte that is no UTF-8 becomes U+FFFD.
        """
        data, ends = self.shown.join(ids)
        stop = np.cumsum(counts)
        start = stop - counts
        broken = self._broken(ids, stop)
        out = []
        for a, b in zip(start.tolist(), stop.tolist()):
            part = data[ends[a] : ends[b]]
            if broken:
                part = self._mended(ids[a:b], part)
            head = a
            while head < b and self.silent[ids[head]]:
                head += 1
            leads = head < b and not self.is_byte[ids[head]] and not self.unknown[ids[head]]
            out.append(part[1:] if leads and part.startswith(b" ") else part)
        return out

    def _broken(self, ids: np.ndarray, stop: np.ndarray) -> bool:
        """Whether some text has byte pieces in a row that are no UTF-8."""
        at = np.flatnonzero(self.is_byte[ids])
        value = self.byte_value[ids[at]]
        if not (value >= 128).any():
            return False
        apart = np.flatnonzero((np.diff(at) > 1) | (np.diff(np.searchsorted(stop, at, "right")) > 0)) + 1
        try:
            np.insert(value, apart, 32).tobytes().decode()
        except UnicodeDecodeError:
            return True
        return False

    def _mended(self, ids: np.ndarray, part: bytes) -> bytes:
        """One text whose byte pieces may be no UTF-8: a replacement mark for each such byte."""
        out, run = [], bytearray()

        def flush() -> None:
            k = 0
            while k < len(run):
                for size in (1, 2, 3, 4):
                    try:
                        bytes(run[k : k + size]).decode()
                    except UnicodeDecodeError:
                        continue
                    if k + size <= len(run):
                        out.append(bytes(run[k : k + size]))
                        k += size
                        break
                else:
                    out.append("�".encode())
                    k += 1
            run.clear()

        shown, start, size = self.shown.data, self.shown.start, self.shown.size
        for i in ids.tolist():
            data = shown[start[i] : start[i] + size[i]].tobytes()
            if self.is_byte[i]:
                run += data
            else:
                flush()
                out.append(data)
        flush()
        return b"".join(out)


@lru_cache(maxsize=2)
def pieces_of(path: str) -> Pieces:
    return Pieces(path)


class Encoder:
    """Texts to ids. The ids of words are kept in two generations of bounded size: what the
    younger one lacks is fetched from the older, and only the rest is merged."""

    def __init__(self, model: Pieces):
        self.model = model
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def encode(self, some: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers; null and empty texts have none."""
        cut = []
        for text in some:
            if not text:
                cut.append(())
                continue
            text = SPACE + text.replace(" ", SPACE)
            cut.append((self.model.spaced if SPACE + SPACE in text else self.model.plain).findall(text))
        words = {w for of_text in cut for w in of_text} - self.young.keys()
        missing = list(words - self.old.keys())
        self.young.update((w, self.old[w]) for w in words & self.old.keys())
        self.young.update(zip(missing, self.model.encode_words(missing)))
        get = self.young.__getitem__
        out = [b"".join(map(get, of_text)) for of_text in cut]
        for w in missing:
            if len(w) > CACHED_LENGTH:
                del self.young[w]
        if len(self.young) > CACHE:
            self.old, self.young = self.young, {}
        return out


@lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    return Encoder(pieces_of(path))


def _lists(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Ids, how many each text has, and both as a column."""
    ids = np.frombuffer(b"".join(parts), "<i4")
    counts = np.array([len(p) // 4 for p in parts], np.int64)
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return ids, counts, pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))


def _decoded(model: Pieces, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    out: list[bytes] = []
    ends, first = np.cumsum(counts), 0
    while first < len(counts):
        base = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, base + IDS, "right")))
        out += model.decode(ids[base : ends[last - 1]], counts[first:last])
        first = last
    return pa.array(out, pa.binary()).cast(pa.string())


def _round_trip(batches: Iterable[pa.RecordBatch], path: str, decode: bool) -> Iterator[pa.RecordBatch]:
    encoder = encoder_of(path)
    for doc, text in columns(batches, "doc_id", "text"):
        for k in range(0, len(text), TEXTS):
            ids, counts, lists = _lists(encoder.encode(text[k : k + TEXTS].to_pylist()))
            made = {"doc_id": doc[k : k + TEXTS], "ids": lists}
            if decode:
                made["decoded"] = _decoded(encoder.model, ids, counts)
            yield pa.RecordBatch.from_pydict(made)


def _back(batches: Iterable[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    model = pieces_of(path)
    for doc, lists in columns(batches, "doc_id", "ids"):
        for k in range(0, len(lists), TEXTS):
            some = lists[k : k + TEXTS]
            counts = np.array([n or 0 for n in some.value_lengths().to_pylist()], np.int64)
            ids = some.flatten().to_numpy(zero_copy_only=False)
            if len(ids) and (ids.min() < 0 or ids.max() >= model.size):
                raise ValueError("ids outside the vocabulary")
            yield pa.RecordBatch.from_pydict({"doc_id": doc[k : k + TEXTS], "decoded": _decoded(model, ids, counts)})


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids``: one row per row of ``docs``, with the ids that the library gives for
    the whole text, without begin and end.

    A null or empty text has no ids. Repeated rows and rows without an id are encoded each
    for itself; a table without rows gives none; other columns are not looked at.
    """
    rows = texts(docs).select("doc_id", "text")
    return rows.mapInArrow(partial(_round_trip, path=path, decode=False), "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, decoded``: the texts that the library gives for ``ids`` of ``encoded``; null or
    no ids give an empty text, an id outside the vocabulary is an error."""
    rows = encoded.select("doc_id", "ids")
    return rows.mapInArrow(partial(_back, path=path), "doc_id long, decoded string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, decoded``: both of the above in one pass over the texts."""
    rows = texts(docs).select("doc_id", "text")
    return rows.mapInArrow(partial(_round_trip, path=path, decode=True), "doc_id long, ids array<int>, decoded string")
