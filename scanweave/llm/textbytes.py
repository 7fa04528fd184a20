"""Words, hashes and minimizers of many texts at once, on the bytes of an Arrow column.

A word is a run of bytes outside ``0x20`` and ``0x09-0x0D``. These separators are
ASCII, so words can be found without decoding UTF-8. All work is done on whole
arrays; ``pieces`` keeps those arrays a few megabytes long, whatever the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_STATE = np.random.RandomState(20240229)
_BYTE_CODE = _STATE.randint(0, 2**63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORD_BASE = np.uint64(0xD6E8FEB86659FD93)

PIECE_BYTES = 1 << 18


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a text column without copying; null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)
    at = at[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def pieces(offsets: np.ndarray, size: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges ``(first, last)`` of texts with about ``size`` bytes, one text at least."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit (the finalizer of murmur3)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_KNOWN: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """``base**0 .. base**(n-1)`` modulo ``2**64``."""
    have = _KNOWN.get(int(base))
    if have is None or len(have) < n:
        have = _powers(base, max(n, PIECE_BYTES + 4096))
        if n <= 4 * PIECE_BYTES:
            _KNOWN[int(base)] = have
    return have[:n]


def inverse(base: np.uint64) -> np.uint64:
    return np.uint64(pow(int(base), -1, 2**64))


def prefix_sums(codes: np.ndarray, base: np.uint64) -> np.ndarray:
    """``n + 1`` prefix sums of ``codes[i] * base**i`` modulo ``2**64``."""
    out = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * powers(base, len(codes)), out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray, base: np.uint64) -> np.ndarray:
    """Hash of ``codes[start:end]``; equal spans have equal hashes wherever they stand."""
    value = (sums[end] - sums[start]) * powers(inverse(base), len(sums))[start]
    return mix(value + (end - start).astype(np.uint64))


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, counts)``: where words start and end, and how many each text has."""
    word = np.zeros(len(raw) + 2, bool)
    np.logical_not(_SEPARATOR[raw], out=word[1:-1])
    first = word[1:-1] & ~word[:-2]
    last = word[1:-1] & ~word[2:]
    cuts = offsets[1:-1]
    inner = cuts[(cuts > 0) & (cuts < len(raw))]
    first[inner] = word[1:-1][inner]
    last[inner - 1] = word[1:-1][inner - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.diff(np.searchsorted(start, offsets))


def word_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray, *, lower: bool = False) -> np.ndarray:
    codes = _BYTE_CODE[_LOWER[raw] if lower else raw]
    return span_hash(prefix_sums(codes, _BASE), start, end, _BASE)


def byte_sums(raw: np.ndarray) -> np.ndarray:
    return prefix_sums(_BYTE_CODE[raw], _BASE)


def byte_span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return span_hash(sums, start, end, _BASE)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive words."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        out = out * _WORD_BASE + words[i : i + len(out)]
    return mix(out)


def word_sums(words: np.ndarray) -> np.ndarray:
    return prefix_sums(words, _WORD_BASE)


def word_span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return span_hash(sums, start, end, _WORD_BASE)


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the least value in every window of ``width``, compared by the upper 33
    bits; of equal ones the last. The choice depends on the window's values only.

    Blocks of ``width`` values get running minima from both ends; a window is the
    tail of one block and the head of the next, so the cost does not depend on ``width``.
    """
    n = len(values)
    if n < width:
        return np.zeros(0, np.int64)
    blocks = -(-n // width)
    # The low 31 bits hold the position, so that minima carry their place along.
    low = np.uint64(2**31 - 1)
    keys = (values & ~low) | (low - np.arange(n, dtype=np.uint64))
    padded = np.full(blocks * width, np.uint64(2**64 - 1))
    padded[:n] = keys
    grid = padded.reshape(blocks, width)
    head = np.minimum.accumulate(grid, axis=1).ravel()
    tail = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    best = np.minimum(tail[: n - width + 1], head[width - 1 : n])
    return (low - (best & low)).astype(np.int64)
