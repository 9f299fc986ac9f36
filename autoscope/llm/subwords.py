"""Subword ids of whole texts with a public tokenizer, word by word.

The tokenizer never joins characters across white space, so the ids of a text
are the ids of its words in order.  Words repeat; each task encodes a word
once, keeps its ids in a fixed-size memory and assembles texts from there.
Texts holding the first characters of a special token are encoded whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from . import textbytes as tb

#: ids held per word; longer words are encoded each time they occur
HELD = 11
CACHE_BITS = 18
JOINED = 512
FENCE = "\x01"
_STOPS = tb.byte_class(lambda b: b in b".,;:!?")
_LETTERS = tb.byte_class(lambda b: 97 <= b <= 122)


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Ids of the texts of a column under the tokenizer file at ``path``."""

    def __init__(self, path: str):
        import tokenizers
        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        self.vocab = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.uint16 if self.vocab <= 1 << 16 else np.uint32
        self.cache = tb.WordCache(CACHE_BITS, HELD + 1, self.dtype)
        self.fence_id, = self.tokenizer.encode(FENCE, add_special_tokens=False).ids

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words in order and the number of each word's ids.

        Words are encoded in long lines with a fence between them: a control
        character that is a token of its own, or, for lines in which a word
        holds that character, one word at a time."""
        flat, counts = [], []
        for i in range(0, len(words), JOINED):
            block = words[i:i + JOINED]
            line = f" {FENCE} ".join(block)
            if line.count(FENCE) != len(block) - 1:
                for e in self.tokenizer.encode_batch(block, add_special_tokens=False):
                    flat.append(np.array(e.ids, self.dtype))
                    counts.append([len(e.ids)])
                continue
            ids = np.array(self.tokenizer.encode_batch_fast([line], add_special_tokens=False)[0].ids, self.dtype)
            fence = ids == self.fence_id
            counts.append(np.diff(np.flatnonzero(fence), prepend=-1, append=len(ids)) - 1)
            flat.append(ids[~fence])
        if not flat:
            return np.zeros(0, self.dtype), np.zeros(0, np.int64)
        return np.concatenate(flat), np.concatenate(counts).astype(np.int64)

    def column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the column in order, and the len+1 row offsets."""
        parts, counts = [], np.zeros(len(column), np.int64)
        for lo, hi, raw, rows in tb.chunks(column, tb.SMALL_CHUNK):
            ids, n = self._chunk(column, lo, raw, rows)
            parts.append(ids)
            counts[lo:hi] = n
        offsets = np.zeros(len(column) + 1, np.int64)
        np.cumsum(counts, out=offsets[1:])
        return (np.concatenate(parts) if parts else np.zeros(0, self.dtype)), offsets

    def _chunk(self, column, lo, raw, rows):
        buf = tb.LOWER[raw]
        starts, ends = split_stops(buf, *tb.spans(buf, tb.NOT_SPACE))
        special = (buf[:-1] == 60) & (buf[1:] == 124)  # "<|"
        odd = np.unique(np.searchsorted(rows, np.flatnonzero(special), "right") - 1)
        bounds = tb.per_row(rows, starts)
        text = buf.tobytes()
        spelled: dict[int, np.ndarray] = {}  # ids of words too long to be held

        def encode(first: np.ndarray) -> np.ndarray:
            spell = [text[s:e] for s, e in zip(starts[first].tolist(), ends[first].tolist())]
            flat, n = self.words(["" if b"<|" in w else w.decode("utf-8", "replace") for w in spell])
            held = np.zeros((len(first), HELD + 1), self.dtype)
            held[:, 0] = np.minimum(n, HELD + 1)
            fits = n <= HELD
            block = np.zeros((int(fits.sum()), HELD), self.dtype)
            block[np.arange(HELD) < n[fits, None]] = flat[np.repeat(fits, n)]
            held[fits, 1:] = block
            at = np.cumsum(n) - n
            for i in np.flatnonzero(~fits).tolist():
                spelled[int(h[first[i]])] = flat[at[i]:at[i] + n[i]]
            return held

        if not len(starts):
            return np.zeros(0, self.dtype), np.zeros(len(rows) - 1, np.int64)
        h = tb.mix(tb.span_hashes(tb.prefix_sums(buf), starts, ends))
        held = self.cache.get(h, encode)
        n = held[:, 0].astype(np.int64)
        long_words = np.flatnonzero(n > HELD)
        for i in long_words.tolist():
            key = int(h[i])
            if key not in spelled:
                word = text[starts[i]:ends[i]]
                spelled[key] = self.words(["" if b"<|" in word else word.decode("utf-8", "replace")])[0]
            n[i] = len(spelled[key])
        at = np.zeros(len(n) + 1, np.int64)
        np.cumsum(n, out=at[1:])
        if not len(long_words):
            ids = held[:, 1:][np.arange(HELD, dtype=n.dtype) < n[:, None]]
        else:
            ids = np.empty(at[-1], self.dtype)
            is_long = np.zeros(len(n), bool)
            is_long[long_words] = True
            ids[~np.repeat(is_long, n)] = held[~is_long, 1:][np.arange(HELD) < n[~is_long, None]]
            for i in long_words.tolist():
                ids[at[i]:at[i + 1]] = spelled[int(h[i])]
        edge = at[bounds]
        if len(odd):
            pieces = [ids[edge[i]:edge[i + 1]] for i in range(len(rows) - 1)]
            for i in odd.tolist():
                whole = self.tokenizer.encode(column[lo + i].as_py(), add_special_tokens=False).ids
                pieces[i] = np.array(whole, self.dtype)
            return np.concatenate(pieces), np.array([len(p) for p in pieces], np.int64)
        return ids, np.diff(edge)


def split_stops(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cut a single stop sign off words that end in an ASCII letter and it;
    the tokenizer cuts there too, and fewer different words remain."""
    if not len(starts):
        return starts, ends
    cut = (ends - starts >= 2) & (_STOPS[buf[ends - 1]] == 1) & (_LETTERS[buf[ends - 2]] == 1)
    at = np.flatnonzero(cut)
    inner = ends[at] - 1
    return np.insert(starts, at + 1, inner), np.insert(ends, at, inner)


def encoder(path: str) -> Encoder:
    return tb.held("subwords", path, lambda: Encoder(path))
