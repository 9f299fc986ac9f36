"""Deep-shallow sorting of byte strings in groups.

Shallow: a library sort by words of eight bytes, all groups at once, down to
``SHALLOW`` bytes.  It stands in for the multikey quicksort of the usual
method: numpy sorts whole columns, a three-way partition would be a Python
loop.  The order is the same.  Deep: strings that still agree are ordered by a blind
trie, whose nodes hold only the depth at which strings part and the byte that
each part has there; one comparison with a leaf finds a string's place.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 32
_STEP = 8


class BlindTrie:
    """Order of strings by insertion; a node is [depth, {byte: child}], a
    leaf the list of indexes of equal strings.  A string's end is byte -1."""

    def __init__(self, strings: list[bytes], first: int):
        self.strings, self.root = strings, [first]

    @staticmethod
    def _byte(s: bytes, depth: int) -> int:
        return s[depth] if depth < len(s) else -1

    def insert(self, i: int) -> None:
        s, node, path = self.strings[i], self.root, []
        while isinstance(node[-1], dict):  # descend blindly, by branch bytes alone
            path.append(node)
            children = node[1]
            node = children.get(self._byte(s, node[0])) or next(iter(children.values()))
        other = self.strings[node[0]]
        depth = common_prefix(s, other)
        if depth == len(s) == len(other):
            node.append(i)
            return
        # the place: under the last node on the path above that depth
        at = next((n for n, x in enumerate(path) if x[0] >= depth), len(path))
        if at < len(path) and path[at][0] == depth:
            path[at][1][self._byte(s, depth)] = [i]
            return
        below = path[at] if at < len(path) else node
        new = [depth, {self._byte(other, depth): below, self._byte(s, depth): [i]}]
        if at == 0:
            self.root = new
        else:
            parent = path[at - 1]
            parent[1][self._byte(s, parent[0])] = new

    def walk(self) -> tuple[list[int], list[int]]:
        """Indexes in order and, for each after the first, the length of the
        prefix it shares with the one before."""
        order, shared = [], []
        stack = [(self.root, 0)]
        while stack:
            node, depth = stack.pop()
            if isinstance(node[-1], dict):
                for n, key in enumerate(sorted(node[1], reverse=True)):
                    stack.append((node[1][key], depth if n == len(node[1]) - 1 else node[0]))
            else:
                size = len(self.strings[node[0]])
                order += node
                shared += [depth] + [size] * (len(node) - 1)
        return order, shared[1:]


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, step = 0, 32
    while a[lo:lo + step] == b[lo:lo + step]:
        lo += step
    x, y = a[lo:lo + step], b[lo:lo + step]
    return lo + next(i for i in range(min(len(x), len(y))) if x[i] != y[i])


def sort_groups(strings: list[bytes], group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, lcp): strings sorted by group, then bytes; ``lcp[i]`` is the
    length of the prefix that the i-th in order shares with the one before
    it, -1 at the first of a group."""
    m = len(strings)
    if not m:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sizes = np.fromiter(map(len, strings), np.int64, m)
    width = -(-SHALLOW // _STEP) * _STEP
    grid = np.zeros((m, width), np.uint8)
    flat = np.frombuffer(b"".join(s[:width] for s in strings), np.uint8)
    grid[np.arange(width) < np.minimum(sizes, width)[:, None]] = flat
    words = grid.view(">u8").astype(np.uint64)
    order = np.argsort(group, kind="stable")
    part = np.ones(m, bool)  # starts of the parts that agree so far
    part[1:] = group[order][1:] != group[order][:-1]
    lcp = np.where(part, -1, width)
    for step in range(width // _STEP):
        label = np.cumsum(part)
        again = np.flatnonzero(~part | np.r_[~part[1:], False])  # members of parts of two or more
        if not len(again):
            break
        key = words[order[again], step]
        by = np.lexsort((sizes[order[again]], key, label[again]))
        order[again] = order[again][by]
        key, lab = key[by], label[again]
        new = np.zeros(len(again), bool)
        new[1:] = (lab[1:] == lab[:-1]) & (key[1:] != key[:-1])
        if new.any():
            at = again[new]
            a, b = grid[order[at], step * _STEP:(step + 1) * _STEP], grid[order[at - 1], step * _STEP:(step + 1) * _STEP]
            lead = (a != b).argmax(axis=1)
            lcp[at] = step * _STEP + lead
            part[at] = True
    # padding is not part of a string
    lcp[1:] = np.where(lcp[1:] < 0, -1, np.minimum(lcp[1:], np.minimum(sizes[order[1:]], sizes[order[:-1]])))
    starts = np.flatnonzero(part)
    ends = np.r_[starts[1:], m]
    for s, e in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist()):
        members = order[s:e].tolist()
        trie = BlindTrie(strings, members[0])
        for i in members[1:]:
            trie.insert(i)
        ranked, shared = trie.walk()
        order[s:e] = ranked
        lcp[s + 1:e] = shared
    return order, lcp
