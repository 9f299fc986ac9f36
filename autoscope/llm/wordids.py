"""Words of a text column as numbers: distinct words of a chunk, exactly.

A chunk's words are told apart by 64-bit hashes of their bytes and compared
byte by byte with the word that stands for them, so equal numbers mean equal
words without exception.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from . import textbytes as tb


def span_index(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of all bytes of the spans, one span after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def distinct(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, first): a number for each span, equal for equal bytes, and for
    each number a span that has it."""
    h = tb.mix(tb.span_hashes(tb.prefix_sums(buf), starts, ends))
    _, first, ids = np.unique(h, return_index=True, return_inverse=True)
    n = ends - starts
    like = first[ids]
    if (n == n[like]).all() and (buf[span_index(starts, n)] == buf[span_index(starts[like], n)]).all():
        return ids, first
    text, known, first = buf.tobytes(), {}, []  # two unlike words of one hash
    for i, (s, e) in enumerate(zip(starts.tolist(), ends.tolist())):
        if known.setdefault(text[s:e], len(first)) == len(first):
            first.append(i)
        ids[i] = known[text[s:e]]
    return ids, np.array(first)


@dataclass
class Words:
    """The words of rows [lo, hi) of a column; word i of row r has bounds[r] <= i < bounds[r + 1]."""
    lo: int
    hi: int
    buf: np.ndarray  # lower-cased
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    ids: np.ndarray
    first: np.ndarray

    def row(self) -> np.ndarray:
        return np.repeat(np.arange(self.hi - self.lo), np.diff(self.bounds))


def column_words(column: pa.Array, table: np.ndarray) -> Iterator[Words]:
    """The words (runs of bytes that ``table`` marks, A-Z lower-cased) of a
    column, a bounded chunk of whole rows at a time; null rows have none."""
    for lo, hi, raw, rows in tb.chunks(column):
        buf = tb.LOWER[raw]
        starts, ends = tb.spans(buf, table)
        yield Words(lo, hi, buf, starts, ends, tb.per_row(rows, starts), *distinct(buf, starts, ends))
