"""Near duplicates, line dedup and suffix dedup against brute force."""
import hashlib
import os
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import cases
from autoscope.llm import common, components, jaccard_join, line_dedup, shingles, suffix_dedup, suffix_sort


def jaccard_twin(rows):
    sets = [cases.shingle_set(t) for _, t, *_ in rows]
    groups = cases.similar_groups(sets)
    least = {}
    for n, (i, *_rest) in enumerate(rows):
        if i is not None and sets[n]:
            r = groups.find(n)
            least[r] = min(i, least.get(r, i))
    return sorted((str(i), len(sets[n]), str(least.get(groups.find(n), i) if sets[n] else i)) for n, (i, *_rest) in enumerate(rows))


def test_jaccard_join(spark):
    rows = cases.texts()
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard_join.op1(cases.frame(spark)).collect())
    assert got == jaccard_twin(rows)


def test_jaccard_join_beyond_the_broadcast_bound(spark, monkeypatch):
    """The shuffled ways, taken beyond the bounds, give the same."""
    monkeypatch.setattr(jaccard_join, "BROADCAST_ROWS", 0)
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard_join.op1(cases.frame(spark)).collect())
    assert got == jaccard_twin(cases.texts())


def test_parities_differ_in_no_more_bits_than_the_sets_in_members():
    rng = np.random.default_rng(4)
    pool = rng.integers(0, 2**63, 900, dtype=np.uint64)
    sets = [np.sort(rng.choice(pool, n, replace=False)) for n in (0, 1, 5, 300, 310, 800)] * 60
    offs = np.r_[0, np.cumsum([len(s) for s in sets])]
    odd = shingles.parities(np.concatenate(sets), offs, 16).view(np.uint64)
    assert (odd[:6] == odd[354:]).all() and not odd[0].any()
    for i in range(6):
        for j in range(6):
            assert np.bitwise_count(odd[i] ^ odd[j]).sum() <= len(np.setxor1d(sets[i], sets[j]))


def test_unlike_texts_of_one_passage_make_no_pairs(spark):
    """All pairs of a frequent shingle's members were formed in the last step."""
    rng = np.random.default_rng(6)
    base, rows = rng.integers(0, 2**63, 100, dtype=np.uint64), []
    for i in range(60):  # 30 members that share 40 of 100 shingles, 30 that share 95
        kept = 40 if i < 30 else 95
        rows.append(np.unique(np.r_[base[:kept], rng.integers(0, 2**63, 100 - kept, dtype=np.uint64)]))
    odd = shingles.parities(np.concatenate(rows), np.arange(61) * 100, jaccard_join.PARITY).tolist()
    members = spark.createDataFrame([(7, i, 100, 1, 0, i, *p) for i, p in enumerate(odd)],
                                    "token long, k long, n int, match int, pos int, c long, " + ", ".join(f"{p} long" for p in jaccard_join._PARITY))
    got = {(r.a, r.b) for r in jaccard_join._pairs_apart(members).collect()}
    assert got == {(i, j) for i in range(30, 60) for j in range(i + 1, 60)}


def test_prefix_lengths_follow_the_cost():
    tokens = np.arange(1000, dtype=np.uint64)
    rare = jaccard_join.prefix(tokens, np.zeros(1000, np.uint8))
    busy = jaccard_join.prefix(tokens, np.full(1000, 9, np.uint8))
    assert (len(rare[0]), rare[1]) == (201, 1)
    assert busy[1] > 1 and len(busy[0]) == 200 + busy[1]


def test_keep_one(spark):
    docs = cases.frame(spark)
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    sets = {i: cases.shingle_set(t) for i, t, *_ in cases.texts()}
    # a copy without an id goes like any other
    assert ids.count(10) == 1 and ids.count(None) == 0 and not {i for i in ids if i and 100 <= i < 230}
    assert {11, 12, 13, 14} <= set(ids) and 15 not in ids  # "ONE two" repeats "one two"
    assert all(i in ids for i in sets if i is not None and 300 <= i < 500)


def test_components(spark):
    links = [(1, 2), (2, 3), (5, 4), (9, 9), (7, 8), (8, 6), (6, 10), (10, 11), (11, 12)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 7: 6, 8: 6, 10: 6, 11: 6, 12: 6}
    chain = spark.range(200).selectExpr("id as a", "id + 1 as b")
    assert {r.component for r in components.components(chain).collect()} == {0}
    assert components.components(chain.limit(0)).count() == 0


def line_twin(rows):
    seen = {}
    for i, t, *_ in rows:
        for n, line in enumerate((t or "").split("\n")):
            if line:
                # rows with the same id and text are one document
                seen.setdefault(line.translate(cases.LOWER), set()).add((-1 if i is None else i, t, n))
    lines = list(seen)
    sets = [frozenset(x[j:j + 10] for j in range(max(1, len(x) - 9))) for x in lines]
    groups, members = cases.similar_groups(sets), {}
    for n, x in enumerate(lines):
        members.setdefault(groups.find(n), set()).update(seen[x])
    first = {g: min((i, n) for i, _, n in m) for g, m in members.items()}
    gone = {(i, t, n) for g, m in members.items() for i, t, n in m if (i, n) != first[g]}
    out = []
    for i, t, *_ in rows:
        x = (t or "").split("\n")
        keep = [y for n, y in enumerate(x) if (-1 if i is None else i, t, n) not in gone]
        out.append((str(i), len(x), len(x) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest()))
    return sorted(out)


def test_line_dedup(spark):
    got = sorted((str(r.doc_id), r.n_lines, r.n_removed, r.kept_sha256) for r in line_dedup.op4(cases.frame(spark)).collect())
    assert got == line_twin(cases.texts())


def test_line_dedup_links_an_ordinary_line_with_one_character_changed(spark):
    """69 characters: 64 runs of six, of which the change touches six, so the
    similarity is 58 / 70; runs of ten would give 50 / 70."""
    line = "Every seventh boat on the river carries salt, timber or wool to town."
    assert len(line) == 69
    rows = [(1, line + "\nfirst", "en", "a"), (2, "second\n" + line.replace("salt", "sald"), "en", "a")]
    got = {r.doc_id: (r.n_lines, r.n_removed) for r in line_dedup.op4(cases.frame(spark, rows)).collect()}
    assert got == {1: (2, 0), 2: (2, 1)}


def test_no_similar_lines_fail_the_bound(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(400):
        a = rng.choice(np.frombuffer(b"abcdefgh ", np.uint8), int(rng.integers(1, 900)))
        b = a.copy()
        for _ in range(int(rng.integers(0, 2 + len(a) // 60))):
            b[rng.integers(len(b))] = 120
        texts = [bytes(x[:max(1, int(len(x) * rng.choice([1, 1, 1, 0.9, 0.6])))]).decode() for x in (a, b)]
        lines = next(line_dedup.chunk_lines(pa.array(texts)))
        par = line_dedup.bands(lines, np.arange(2))[1].tolist()
        p, q = line_dedup.line_sets(pa.array(texts))
        both = len(np.intersect1d(p, q))
        rows.append((i, 5 * both >= 4 * (len(p) + len(q) - both), *par))
    names = ["n", *line_dedup._PARITY]
    side = "struct<" + ", ".join(f"{c}: long" for c in names) + ">"
    listed = spark.createDataFrame([(i, s, tuple(p), tuple(q)) for i, s, p, q in rows], f"i int, similar boolean, x {side}, y {side}")
    got = listed.select("similar", line_dedup.may_be_similar("x", "y").alias("may")).collect()
    assert sum(r.similar for r in got) > 50 and all(r.may for r in got if r.similar) and not all(r.may for r in got)


def suffix_twin(rows):
    raw = [(t or "").encode() for _, t, *_ in rows]
    seen = Counter(b[k:k + 200] for b in raw for k in range(len(b) - 199))
    out = []
    for (i, *_), b in zip(rows, raw):
        mark, upto = bytearray(len(b)), 0
        for k in range(len(b) - 199):
            if seen[b[k:k + 200]] > 1:
                lo = max(k, upto)
                mark[lo:k + 200] = b"\1" * (k + 200 - lo)
                upto = k + 200
        runs = sum(1 for k in range(len(b)) if mark[k] and (k == 0 or not mark[k - 1]))
        kept = hashlib.sha256(bytes(x for x, m in zip(b, mark) if not m)).hexdigest()
        out.append((str(i), len(b), sum(mark), runs, kept))
    return sorted(out)


def suffix_got(df):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def small(rows):
    return [(i, t if t is None or len(t) < 20_000 else t[:3000], *x) for i, t, *x in rows]


@pytest.mark.parametrize("sorted_at_once", [20_000, 1])
def test_suffix_dedup(spark, monkeypatch, sorted_at_once):
    """Once by sorting, once by counting, the way for oversized grams."""
    monkeypatch.setattr(suffix_dedup, "SORTED_AT_ONCE", sorted_at_once)
    rows = small(cases.texts())
    assert suffix_got(suffix_dedup.op6(cases.frame(spark, rows))) == suffix_twin(rows)


def test_line_and_suffix_dedup_beyond_the_broadcast_bounds(spark, monkeypatch):
    """The shuffled ways, taken beyond the bounds, give the same."""
    for module in (common, line_dedup, suffix_dedup):
        monkeypatch.setattr(module, "BROADCAST_ROWS", 0, raising=False)
    monkeypatch.setattr(suffix_dedup, "BROADCAST_PLACES", 0)
    rows = small(cases.texts())
    assert suffix_got(suffix_dedup.op6(cases.frame(spark, rows))) == suffix_twin(rows)
    got = sorted((str(r.doc_id), r.n_lines, r.n_removed, r.kept_sha256) for r in line_dedup.op4(cases.frame(spark)).collect())
    assert got == line_twin(cases.texts())


def test_anchors_cover_every_window():
    rng = np.random.default_rng(3)
    for text in (rng.integers(97, 123, 3000), np.tile(rng.integers(97, 123, 7), 300), np.full(700, 97)):
        buf = np.r_[text, 32].astype(np.uint8)
        at = suffix_dedup.anchors(buf, np.array([0, len(buf)]))[0]
        for s in range(len(text) - 199):
            assert ((at >= s) & (at + suffix_dedup.GRAM <= s + 200)).any()


def test_deep_shallow_sort():
    rng = np.random.default_rng(1)
    for _ in range(60):
        base = [bytes(rng.choice(list(b"ab\0"), rng.integers(0, 200))) for _ in range(3)]
        strings = []
        for _ in range(int(rng.integers(0, 50))):
            b = bytearray(base[rng.integers(3)])
            if len(b):
                b[rng.integers(len(b))] = rng.choice(list(b"abc"))
            strings.append(bytes(b[:rng.integers(len(b) + 1)]) if rng.random() < 0.3 else bytes(b))
        group = rng.integers(0, 3, len(strings))
        order, lcp = suffix_sort.sort_groups(strings, group)
        listed = [(group[i], strings[i]) for i in order]
        assert listed == sorted(zip(group, strings))
        for n in range(1, len(listed)):
            same = listed[n][0] == listed[n - 1][0]
            assert lcp[n] == (len(os.path.commonprefix([listed[n][1], listed[n - 1][1]])) if same else -1)


@pytest.mark.parametrize("op", [jaccard_join.op1, line_dedup.op4, suffix_dedup.op6, jaccard_join.keep_one])
def test_empty_table(spark, op):
    assert op(cases.frame(spark, [])).count() == 0


def test_keep_one_matches_rows_by_id_and_text(spark):
    a, b = cases.sentence(1, 60), cases.sentence(2, 60)
    rows = [(1, a), (1, a), (2, a + " more"), (2, b), (None, a), (None, a + " more"), (None, cases.sentence(3, 40)), (3, ""), (3, None), (3, "")]
    kept = jaccard_join.keep_one(cases.frame(spark, [(i, t, "en", "s") for i, t in rows]))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(
        [(1, a), (2, b), (None, cases.sentence(3, 40)), (3, ""), (3, ""), (3, None)], key=repr)
    nulls = jaccard_join.keep_one(cases.frame(spark, [(None, a, "en", "s"), (None, a, "en", "s"), (None, a + " x", None, None)]))
    assert nulls.count() == 1
