"""Mixing, token files, top-k search, the pipeline and the registry."""
import zlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import cases
import __spark_entry__ as entry
import corpus_pipeline
from autoscope.llm import mixing, subwords, tokens, topk, wavelet


def mixing_targets(rows):
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len(cases.words(t))
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[n % 3] for n, s in enumerate(order)}
    total, target, free = 1.5 * sum(sizes.values()), {}, set(order)
    while free:
        left, w = total - sum(target.values()), sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / w > 2 * sizes[s]]
        if not over:
            target |= {s: left * weight[s] / w for s in free}
            break
        target |= {s: 2.0 * sizes[s] for s in over}
        free -= set(over)
    return sizes, target


def test_mixing(spark):
    rows = cases.texts()
    sizes, target = mixing_targets(rows)
    source = {i: s for i, _, _, s in rows}
    size = {i: len(cases.words(t)) for i, t, *_ in rows}
    got = mixing.op8(cases.frame(spark)).collect()
    assert len(got) == len(rows)
    took = dict.fromkeys(sizes, 0)
    for r in got:
        s = source[r.doc_id]
        assert r.size == size[r.doc_id] and r.source_size == sizes[s] and abs(r.target - target[s]) < 1e-6
        assert r.taken in (0, r.size, 2 * r.size)
        took[s] += r.taken
    # source c holds one document of most of its words: no subset comes near
    assert all(abs(took[s] - target[s]) <= max(2, 0.01 * target[s]) for s in sizes if s != "c")
    again = mixing.op8(cases.frame(spark)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mix_repeats_rows(spark):
    docs = cases.frame(spark)
    taken = {}
    for r in mixing.op8(docs).collect():
        taken.setdefault(str(r.doc_id), []).append(r.taken // r.size if r.size else 1)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    got = {}
    for r in mixed.collect():
        got[str(r.doc_id)] = got.get(str(r.doc_id), 0) + 1
    assert got == {k: sum(v) for k, v in taken.items() if sum(v)}


def test_mixing_rows_without_an_id_and_repeated_rows(spark):
    """Units are rows: many of no id and one size, and copies of one row, can
    be taken in part, and the sums meet the targets."""
    rows = [(None, f"w{i} " + "x " * 9, "en", "a") for i in range(600)]
    rows += [(7, "same text here", lang, "b") for lang in ["en", "de"] * 500]
    rows += [(i, "y " * (i % 30 + 1), "en", "c") for i in range(100, 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(6)
    sizes, target = mixing_targets([(i, t, g, s) for i, t, g, s in rows])
    got = mixing.op8(docs).collect()
    assert len(got) == len(rows)
    took = dict.fromkeys(sizes, 0)
    for r in got:
        assert r.taken in (0, r.size, 2 * r.size)
        s = "a" if r.doc_id is None else "b" if r.doc_id == 7 else "c"
        took[s] += r.taken
    assert all(abs(took[s] - target[s]) <= 10 for s in sizes), (took, target)
    _, units = mixing.decide(docs)
    split = units.where("extra > 0 and extra < m").collect()
    assert [(r.doc_id, r.m) for r in split] == [(7, 1000)]
    mixed = mixing.mix(docs).collect()
    assert {s: sum(len(cases.words(r.text)) for r in mixed if r.source == s) for s in sizes} == took
    # whole copies for every row, the rest of the row that is least as JSON
    count = {g: sum(r.lang == g for r in mixed if r.source == "b") for g in ("en", "de")}
    assert count["de"] - count["en"] == split[0].extra and count["en"] % 500 == 0
    assert sorted(map(str, mixing.mix(docs.repartition(3)).collect())) == sorted(map(str, mixed))


def test_fit_lengths_meets_the_budget():
    rng = np.random.default_rng(6)
    for _ in range(50):
        lengths = np.unique(rng.integers(1, 400, 40))
        counts = rng.integers(1, 50, len(lengths))
        total = int((lengths * counts).sum())
        budget = int(rng.integers(0, total + 1))
        take = mixing.fit_lengths(lengths, counts, budget)
        assert (take >= 0).all() and (take <= counts).all()
        assert budget - 3 <= (take * lengths).sum() <= budget
    # exact knapsack on small cases
    for budget in range(0, 30):
        take = mixing.fit_lengths(np.array([4, 7]), np.array([3, 2]), budget)
        best = max(4 * a + 7 * b for a in range(4) for b in range(3) if 4 * a + 7 * b <= budget)
        assert (take * [4, 7]).sum() == best
    assert mixing.fit_lengths(np.zeros(0, int), np.zeros(0, int), 5).sum() == 0


def test_token_output(spark, tmp_path):
    rows = sorted(cases.texts(), key=lambda r: (r[0] is not None, r[0] or 0))
    enc = Tokenizer.from_file(subwords.default_tokenizer())
    path = str(tmp_path / "shards")
    tokens.write_shards(cases.frame(spark), path, shard_tokens=500)
    got = sorted(tokens.op3(cases.frame(spark), str(tmp_path / "whole")).collect(), key=lambda r: r.start)
    at, everything = 0, []
    for r, (i, t, *_) in zip(got, rows):
        ids = np.array([*enc.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
        everything.append(ids)
    assert len(got) == len(rows)
    # small shards hold the same ids, in order
    images = spark.read.parquet(path).orderBy("part", "shard").collect()
    assert len(images) > 20
    assert (np.concatenate([wavelet.read_image(r.image)[0].tokens() for r in images]) == np.concatenate(everything)).all()


@pytest.mark.parametrize("n", [0, 1, 7, 512, 513, 4000])
def test_wavelet_matrix(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n), 49407).astype(np.uint16)
    matrix, keys, lengths = wavelet.read_image(wavelet.write_image(ids, [None, *range(n)], np.ones(n + 1, int), 16))
    assert (matrix.tokens() == ids).all() and keys == [None, *range(n)] and lengths.sum() == n + 1
    for i in rng.integers(0, max(n, 1), min(n, 40)).tolist():
        value = int(ids[i])
        assert matrix.access(i) == value and matrix.rank(value, i) == (ids[:i] == value).sum()
        assert matrix.select(value, matrix.rank(value, i)) == i
        assert matrix.count(value) == (ids == value).sum()
    assert matrix.count(49000) == (ids == 49000).sum() and matrix.count(1 << 20) == 0
    if n:
        assert matrix.occurrences(int(ids[0])) == np.flatnonzero(ids == ids[0]).tolist()
    with pytest.raises(IndexError):
        matrix.access(n)


def vectors(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in np.round(rng.standard_normal(8), 2)]) for i in range(450)]
    rows += [(1000 + i, rows[100][1]) for i in range(40)]  # ties
    rows += [rows[200], rows[5]]  # repeated rows
    rows += [(3000, None), (3100, [1.0, None] * 4), (3200, [float("nan")] * 8), (3300, [float("inf")] + [0.0] * 7), (None, [1.0] * 8),
             (4000, [1.0, 2.0]), (4001, [3.0, -1.0]), (5000, [1e30] * 8), (7, [9.0] * 8)]
    return spark.createDataFrame([(i, v, "r", "s", 1) for i, v in rows], "vec_id long, embedding array<double>, rank string, score string, label int")


def top_twin(df):
    rows = {(r.vec_id, tuple(r.embedding)) for r in df.collect() if r.vec_id is not None and r.embedding is not None
            and all(x is not None and np.isfinite(x) for x in r.embedding)}
    rows = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows]
    found, limit = {}, lambda s: min(max(s, -2**63), 2**63 - 1)
    for q, a in rows:
        if q % 100 == 0:
            found.setdefault(q, []).extend((-limit(sum(x * y for x, y in zip(a, b))), i) for i, b in rows if i != q and len(a) == len(b))
    return sorted((q, n + 1, i, -s) for q, xs in found.items() for n, (s, i) in enumerate(sorted(xs)[:10]))


@pytest.mark.parametrize("shard", [8192, 60])
def test_top_k(spark, monkeypatch, shard):
    monkeypatch.setattr(topk, "SHARD_ROWS", shard)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 2)
    df = vectors(spark)
    assert sorted(map(tuple, topk.op10(df).collect())) == top_twin(df)


def test_top_k_of_every_row(spark, monkeypatch, tmp_path):
    """The registered query: all rows but the query's own, repeated ones and those without an id too."""
    monkeypatch.setattr(topk, "SHARD_ROWS", 60)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 4)]) for i in range(260)]
    rows += [rows[7]] * 14 + [rows[100]] * 2 + [(200, [3.0] * 4), (None, [3.0] * 4), (None, None), (300, [float("nan")] * 4)]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    good = [(i, [int(1024 * x) for x in v]) for i, v in rows if v and np.isfinite(v).all()]
    want = []
    for n, (q, a) in enumerate(good):
        if q is not None and q % 100 == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), i is None, i or 0) for m, (i, b) in enumerate(good) if m != n)[:10]
            want += [(q, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(best)]
    got = entry.queries()["op10_topk_search"](spark, str(tmp_path)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_ball_tree_leaves_nodes_out():
    rng = np.random.default_rng(0)
    rows = np.concatenate([rng.normal(c, 1, (500, 6)) for c in (-50, 0, 50)])
    tree = topk.BallTree(np.arange(1500), np.floor(rows * 10))
    seen = []
    tree_products, q = topk.products, np.full((1, 6), 500.0)
    best = topk.Best(np.full(1, -np.inf), 10)
    topk.products = lambda a, b: seen.append(len(b)) or tree_products(a, b)
    try:
        topk.search(tree, np.array([-1]), q, best)
    finally:
        topk.products = tree_products
    exact = np.sort((np.floor(rows * 10) @ q[0]))[::-1][:10]
    assert (best.score[0] == exact).all() and sum(seen) < 900


@pytest.mark.parametrize("op", [mixing.op8, mixing.mix, tokens.op3])
def test_empty_table(spark, op):
    assert op(cases.frame(spark, [])).count() == 0


def test_empty_vectors(spark):
    assert topk.op10(vectors(spark).limit(0)).count() == 0


def test_pipeline_stages(spark, tmp_path):
    """Each stage on all that its predecessor kept, edge rows included."""
    docs = cases.frame(spark)
    bench = tmp_path / "sf"
    spark.createDataFrame([(1, cases.sentence(2, 45))], "item_id long, text string").write.parquet(f"{bench}/benchmark.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, before, str(bench))
        assert out.columns == docs.columns, name
        out.write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        ids = {r.doc_id for r in after.collect()}
        if name == "language_id":
            assert not ids & {11, 12, 13, 16} and {10, 300, 500} <= ids
        if name == "near_duplicates":
            assert not any(i and 100 <= i < 230 for i in ids) and 10 in ids
        if name == "decontamination":
            assert not any(i and 300 <= i < 312 for i in ids) and 400 in ids
        before = after
    found = corpus_pipeline.STAGES[-1][1](spark, before, str(bench))
    assert found.count() == before.count()


def test_every_operator_is_registered():
    names = entry.queries()
    assert "pipeline" in names and [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "near_duplicates", "decontamination", "source_mixing", "token_output"]
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1


@pytest.mark.parametrize("name", ["op5_decontamination", "op10_topk_search"])
def test_sql_twins(spark, name):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    rel = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in rel.description]
    df = entry.queries()[name](spark, sf)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, df.select(columns).collect()))) == sorted(map(repr, rel.fetchall()))
