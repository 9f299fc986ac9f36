"""Word finding and hashing on whole Arrow string columns.

Inside a task the texts of a batch are looked at as one byte array, so that
words, their hashes and their shingles come from a few numpy passes instead
of a Python loop per word.  Memory is bounded by ``CHUNK`` bytes of text at a
time (a single longer document is handled alone).
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
#: for operators that keep much per byte of a chunk
SMALL_CHUNK = 1 << 18
SPACE = 0x20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(keep) -> np.ndarray:
    """A 0/1 table over byte values from a predicate."""
    return np.fromiter((1 if keep(b) else 0 for b in range(256)), np.uint8, 256)


#: ``[^\x20\x09-\x0D]``
NOT_SPACE = byte_class(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: lower-case ASCII letters and every byte of a non-ASCII character
LETTERISH = byte_class(lambda b: 97 <= b <= 122 or b >= 128)

try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # another C library
    _trim = None

_rng = np.random.Generator(np.random.PCG64(20240607))
BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64 (kept between calls)."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, CHUNK + (1 << 16))
        step = np.full(size, base & (2**64 - 1), np.uint64)
        step[0] = 1
        have = _powers[base] = np.cumprod(step, dtype=np.uint64)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Bit mixer over 64-bit values (in place on a fresh array)."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def prefix_sums(buf: np.ndarray) -> np.ndarray:
    """c with c[i] = sum of code(buf[j]) * P**j over j < i, modulo 2**64."""
    c = np.empty(len(buf) + 1, np.uint64)
    c[0] = 0
    v = BYTE_CODE[buf]
    v *= powers(_P, len(buf))
    np.cumsum(v, out=c[1:])
    return c


def span_hashes(c: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Unmixed hashes of the byte spans [start, end), equal for equal bytes."""
    return (c[ends] - c[starts]) * powers(_P_INV, len(c))[starts]


def arrow_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its len+1 offsets; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset: column.offset + len(column) + 1].astype(np.int64) if offs else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), offsets


def slices(batches, rows: int = 1024):
    """Record batches of at most ``rows`` rows, so that what a task makes
    from one stays small.  At the end freed memory goes back to the system:
    workers live on beside the executor's heap."""
    try:
        for b in batches:
            for at in range(0, b.num_rows, rows):
                yield b.slice(at, rows)
    finally:
        pa.default_memory_pool().release_unused()
        if _trim is not None:
            _trim(0)


def chunks(column: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes with one space between rows, row starts).

    ``starts`` has one entry per row and one past the end, so that row i of
    the chunk is ``buf[starts[i] : starts[i + 1] - 1]``.
    """
    data, offs = arrow_bytes(column)
    n, lo = len(column), 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + size, "right")) - 1)
        hi = min(hi, n)
        rel = offs[lo:hi + 1] - offs[lo]
        buf = np.insert(data[offs[lo]:offs[hi]], rel[1:], SPACE)
        yield lo, hi, buf, rel + np.arange(hi - lo + 1)
        lo = hi


def spans(buf: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes that ``table`` marks."""
    m = np.zeros(len(buf) + 2, np.uint8)
    m[1:-1] = table[buf]
    edges = np.flatnonzero(m[1:] != m[:-1])
    return edges[0::2], edges[1::2]


def per_row(row_starts: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For row i of a chunk, words [b[i], b[i+1]) are its own."""
    return np.searchsorted(starts, row_starts)


def gather(values: np.ndarray, offsets: np.ndarray, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate the slices ``values[offsets[i]:offsets[i+1]]`` for i in
    ``pick``; also returns the len(pick)+1 offsets of the result."""
    n = offsets[pick + 1] - offsets[pick]
    out = np.zeros(len(pick) + 1, np.int64)
    np.cumsum(n, out=out[1:])
    index = np.arange(out[-1]) - np.repeat(out[:-1] - offsets[pick], n)
    return values[index], out


class WordCache:
    """Fixed-size direct-mapped memory of per-word results.

    ``get`` returns the row of each word's result; words not held are passed
    to ``compute`` once each.  A slot taken by another word is overwritten,
    so memory stays at ``2**bits`` entries and results never depend on it.
    """

    def __init__(self, bits: int, width: int, dtype=np.float64):
        self.key = np.zeros(1 << bits, np.uint64)
        self.value = np.zeros((1 << bits, width), dtype)
        self.key[0] = 1  # an empty slot must not match the hash 0
        self.mask = np.uint64((1 << bits) - 1)

    def get(self, h: np.ndarray, compute) -> np.ndarray:
        """``h``: mixed word hashes; ``compute(first)`` gives the results of
        the words at those positions, one row each."""
        slot = (h & self.mask).astype(np.int64)
        miss = np.flatnonzero(self.key[slot] != h)
        out = self.value[slot]
        if len(miss):
            _, first, which = np.unique(h[miss], return_index=True, return_inverse=True)
            fresh = compute(miss[first])
            out[miss] = fresh[which]
            at = slot[miss[first]]
            self.value[at] = fresh
            # the key goes in last, for the word whose value stayed in the slot
            self.key[at] = h[miss[first]]
        return out


_held: dict[str, dict] = {}


def held(owner: str, key: str, make):
    """A large object that a worker keeps between tasks: a vocabulary, a
    tokenizer, a word cache.  A worker that goes on to another owner's work
    drops what it held before."""
    keep_only(owner)
    kept = _held.setdefault(owner, {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


def keep_only(owner: str) -> None:
    """Drops what the worker holds for others; for work that holds nothing too."""
    if owner not in _held:
        _held.clear()
