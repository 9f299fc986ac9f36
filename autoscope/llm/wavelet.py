"""A wavelet matrix over token ids: one file image per shard.

Ids are stored as bit planes, highest bit first; after each plane the ids are
reordered stably, zeros before ones.  With the ones counted up to every
512th position, any id can be read, counted up to a position, or its k-th
occurrence found, in one step per plane.

File image: magic, numbers of planes, tokens, documents and null ids; then
sections, each with its length, zstd-compressed: document ids, document
lengths, and one per plane.
"""

from __future__ import annotations

import struct

import numpy as np
import zstandard

MAGIC = b"WVMX0001"
BLOCK = 512
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def planes_of(ids: np.ndarray, bits: int) -> tuple[list[np.ndarray], list[int]]:
    """Packed bit planes and the number of zeros of each."""
    planes, zeros = [], []
    seq = ids
    for bit in range(bits - 1, -1, -1):
        one = (seq & seq.dtype.type(1 << bit)) != 0
        planes.append(np.packbits(one))
        low = np.flatnonzero(~one)
        zeros.append(len(low))
        seq = seq.take(np.concatenate([low, np.flatnonzero(one)]))
    return planes, zeros


class WaveletMatrix:
    def __init__(self, planes: list[np.ndarray], n: int, dtype=np.uint16):
        self.planes, self.n, self.bits, self.dtype = planes, n, len(planes), dtype
        self.zeros: list[int] = []
        self.ranks: list[np.ndarray] = []
        for p in planes:
            ones = _ONES[p].astype(np.int64)
            per = np.add.reduceat(ones, np.arange(0, len(ones), BLOCK // 8)) if len(ones) else ones
            self.ranks.append(np.r_[0, np.cumsum(per)])
            self.zeros.append(n - int(self.ranks[-1][-1]))

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        return cls(planes_of(ids, bits)[0], len(ids), ids.dtype.type)

    def _bit(self, level: int, i: int) -> int:
        return self.planes[level][i >> 3] >> (7 - (i & 7)) & 1

    def _ones(self, level: int, i: int) -> int:
        """Ones of a plane before position i."""
        block = i // BLOCK
        at = block * (BLOCK // 8)
        p = self.planes[level]
        count = int(self.ranks[level][block]) + int(_ONES[p[at:i >> 3]].sum())
        return count + (int(_ONES[p[i >> 3] >> (8 - (i & 7))]) if i & 7 else 0)

    def access(self, i: int) -> int:
        """The id at position i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level in range(self.bits):
            bit = self._bit(level, i)
            value = value << 1 | int(bit)
            ones = self._ones(level, i)
            i = self.zeros[level] + ones if bit else i - ones
        return value

    def _range(self, value: int, end: int) -> tuple[int, int]:
        """Where the occurrences of ``value`` before ``end`` lie at the bottom."""
        lo, hi = 0, end
        if value >> self.bits:
            return 0, 0
        for level in range(self.bits):
            a, b = self._ones(level, lo), self._ones(level, hi)
            if value >> (self.bits - 1 - level) & 1:
                lo, hi = self.zeros[level] + a, self.zeros[level] + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def rank(self, value: int, end: int) -> int:
        """Occurrences of ``value`` before position ``end``."""
        lo, hi = self._range(value, end)
        return hi - lo

    def count(self, value: int) -> int:
        return self.rank(value, self.n)

    def _select_bit(self, level: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) ``bit`` in a plane."""
        ones = self.ranks[level]
        before = ones if bit else np.minimum(np.arange(len(ones)) * BLOCK, self.n) - ones
        block = int(np.searchsorted(before, k, "right")) - 1
        at = block * (BLOCK // 8)
        unpacked = np.unpackbits(self.planes[level][at:at + BLOCK // 8])[:self.n - block * BLOCK]
        return block * BLOCK + int(np.flatnonzero(unpacked == bit)[k - int(before[block])])

    def select(self, value: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of ``value``."""
        lo, hi = self._range(value, self.n)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        i = lo + k
        for level in range(self.bits - 1, -1, -1):
            bit = value >> (self.bits - 1 - level) & 1
            i = self._select_bit(level, bit, i - self.zeros[level] if bit else i)
        return i

    def occurrences(self, value: int) -> list[int]:
        return [self.select(value, k) for k in range(self.count(value))]

    def tokens(self) -> np.ndarray:
        """All ids: from the bottom order back up through the planes."""
        seq = np.zeros(self.n, self.dtype)
        for level in range(self.bits - 1, -1, -1):
            one = np.unpackbits(self.planes[level], count=self.n).view(bool)
            z, up = self.zeros[level], np.empty(self.n, self.dtype)
            up[np.flatnonzero(~one)] = seq[:z]
            up[np.flatnonzero(one)] = seq[z:] | self.dtype(1 << (self.bits - 1 - level))
            seq = up
        return seq


def write_image(ids: np.ndarray, doc_ids: list[int | None], lengths: np.ndarray, bits: int) -> bytes:
    """The file image of a shard; null document ids come first."""
    nulls = sum(d is None for d in doc_ids)
    press = zstandard.ZstdCompressor(level=1).compress
    keys = np.array([d for d in doc_ids if d is not None], np.int64)
    sections = [press(keys.tobytes()), press(np.asarray(lengths, np.uint32).tobytes())]
    sections += [press(p.tobytes()) for p in planes_of(ids, bits)[0]]
    head = MAGIC + struct.pack("<IIQQQ", bits, ids.dtype.itemsize, len(ids), len(doc_ids), nulls)
    return head + b"".join(struct.pack("<Q", len(s)) + s for s in sections)


def read_image(image: bytes) -> tuple[WaveletMatrix, list[int | None], np.ndarray]:
    """(matrix, document ids, document lengths)."""
    if image[:8] != MAGIC:
        raise ValueError("not a shard image")
    bits, width, n, docs, nulls = struct.unpack_from("<IIQQQ", image, 8)
    at, sections = 8 + struct.calcsize("<IIQQQ"), []
    unpress = zstandard.ZstdDecompressor()
    for _ in range(bits + 2):
        size, = struct.unpack_from("<Q", image, at)
        at += 8
        sections.append(unpress.decompress(image[at:at + size], max_output_size=max(n, 8 * docs) + 64))
        at += size
    keys = [None] * nulls + np.frombuffer(sections[0], np.int64).tolist()
    planes = [np.frombuffer(s, np.uint8) for s in sections[2:]]
    matrix = WaveletMatrix(planes, n, np.uint16 if width == 2 else np.uint32)
    return matrix, keys, np.frombuffer(sections[1], np.uint32)
