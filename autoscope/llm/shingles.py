"""Sets of hashed five-word shingles of whole texts.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z.  A shingle is the
64-bit hash of five consecutive words; a text of one to four words has its
whole word sequence as its only shingle, a text without words the empty set.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from . import textbytes as tb

WIDTH = 5
_MULTIPLIERS = np.random.Generator(np.random.PCG64(11)).integers(1, 2**63, WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def column_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of all rows, and the len+1 row offsets."""
    parts, counts = [np.zeros(0, np.uint64)], np.zeros(len(column) + 1, np.int64)
    for lo, hi, buf, rows in tb.chunks(column, tb.SMALL_CHUNK):
        buf = tb.LOWER[buf]
        starts, ends = tb.spans(buf, tb.NOT_SPACE)
        if not len(starts):
            continue
        words = tb.mix(tb.span_hashes(tb.prefix_sums(buf), starts, ends))
        bounds = tb.per_row(rows, starts)
        n = np.diff(bounds)
        grams = np.zeros(len(words), np.uint64)
        for j in range(WIDTH):
            grams[:len(words) - j] += words[j:] * _MULTIPLIERS[j]
        # the word at which a row's last whole shingle starts, or its first word
        last = np.maximum(bounds[1:] - WIDTH, bounds[:-1])
        row = np.repeat(np.arange(hi - lo), n)
        keep = np.arange(len(words)) <= last[row]
        for i in np.flatnonzero((n > 0) & (n < WIDTH)).tolist():
            w = words[bounds[i]:bounds[i + 1]]
            grams[bounds[i]] = (w * _MULTIPLIERS[:len(w)]).sum(dtype=np.uint64) + np.uint64(len(w))
        grams, row = tb.mix(grams[keep]), row[keep]
        order = np.lexsort((grams, row))
        grams, row = grams[order], row[order]
        new = np.ones(len(grams), bool)
        new[1:] = (grams[1:] != grams[:-1]) | (row[1:] != row[:-1])
        parts.append(grams[new])
        counts[lo + 1:hi + 1] = np.bincount(row[new], minlength=hi - lo)
    return np.concatenate(parts), np.cumsum(counts)


def parities(sets: np.ndarray, offsets: np.ndarray, longs: int) -> np.ndarray:
    """(rows, longs): bit i of a row tells whether an odd number of its
    shingles end in i.  Every bit in which two rows differ stands for a shingle
    that only one of them has."""
    rows, bits = len(offsets) - 1, 64 * longs
    out = np.zeros((rows, longs), np.int64)
    for lo in range(0, rows, 256):
        hi = min(rows, lo + 256)
        row = np.repeat(np.arange(hi - lo), np.diff(offsets[lo:hi + 1]))
        at = row * bits + (sets[offsets[lo]:offsets[hi]] & np.uint64(bits - 1)).astype(np.int64)
        count = np.bincount(at, minlength=(hi - lo) * bits).reshape(hi - lo, bits)
        out[lo:hi] = np.packbits((count & 1).astype(np.uint8), axis=1).view(np.int64)
    return out


def set_keys(sets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit key per row, equal for equal sets; 0 for the empty set."""
    run = np.zeros(len(sets) + 1, np.uint64)
    np.cumsum(tb.mix(sets ^ np.uint64(0x5851F42D4C957F2D)), out=run[1:])
    n = np.diff(offsets).astype(np.uint64)
    key = tb.mix((run[offsets[1:]] - run[offsets[:-1]]) + n * np.uint64(0x9E3779B97F4A7C15))
    key[n == 0] = 0
    return key
