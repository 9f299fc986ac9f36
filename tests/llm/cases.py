"""Small documents with every awkward kind of row, and brute-force twins."""
import re
from collections import Counter

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, component_id string, score string, "
          "size string, k string, row string, `odd.name` string")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
BENCH_SCHEMA = "item_id long, text string, h string, p string"

_WORDS = ("the quick brown fox jumps over lazy dogs while seven small birds sing near an old stone bridge that "
          "crosses one cold river under grey winter skies").split()


def sentence(seed: int, n: int) -> str:
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(_WORDS[x // 65536 % len(_WORDS)] + ("" if x % 3 else str(x // 7 % 50)))
    return " ".join(out)


def texts() -> list[tuple]:
    """(doc_id, text, lang, source)"""
    base, passage = sentence(1, 60), sentence(2, 45)
    near = base.split()
    rows = [(10, base, "en", "a"), (10, base, "en", "a"), (None, base, None, None), (11, None, "en", "a"), (12, "", "en", None),
            (13, " \t\n ", None, "b"), (14, "one two", "en", "b"), (15, "ONE two", "en", "b"), (16, "12 345 .", "en", "c"),
            (17, sentence(9, 40000), "en", "c"), (18, "x" * 100_000, None, "c"), (19, "é ü ñ ß " * 30, "de", "c")]
    for i in range(30):  # a hot group of near copies, and exact copies
        w = list(near)
        w[(7 * i) % len(w)] = f"changed{i}"
        rows.append((100 + i, " ".join(w), "en", "a"))
        rows.append((200 + i, base, "en", "a"))
    for i in range(12):  # documents that share a long passage only
        rows.append((300 + i, sentence(50 + i, 70) + "\n" + passage + "\n" + sentence(80 + i, 70), "en", "b"))
    for i in range(20):
        rows.append((400 + i, sentence(500 + i, 30 + 3 * i), "en", "b" if i % 2 else None))
    for i in range(25):
        de = "und der die das nicht ich werde heute schöne bücher über straßen lesen wieder".split()
        rows.append((500 + i, " ".join(de[(i * 5 + j * j) % len(de)] for j in range(25)), "de", "d"))
    return rows


def frame(spark, rows=None):
    full = [(i, t, g, s, None if t is None else len(t), "c", "s", "z", "k", "r", "o") for i, t, g, s in (texts() if rows is None else rows)]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


class Groups:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def shingle_set(text):
    w = words(text)
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def similar_groups(sets):
    """Union-find over all pairs with Jaccard similarity 0.8 or more."""
    groups, holders = Groups(), {}
    for i, s in enumerate(sets):
        shared = Counter(j for g in s for j in holders.get(g, ()))
        for j, n in shared.items():
            if 5 * n >= 4 * (len(s) + len(sets[j]) - n):
                groups.join(i, j)
        for g in s:
            holders.setdefault(g, []).append(i)
    return groups
