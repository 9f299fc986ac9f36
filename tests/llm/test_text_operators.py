"""Language ID, personal data, decontamination and model scoring."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import cases
from autoscope.llm import attention, decontaminate, langid, lm_scoring, pii, subwords, textbytes


def remainder(i, n):
    return zlib.crc32(("" if i is None else str(i)).encode()) % n


def test_language_id(spark):
    got = langid.op7(cases.frame(spark)).collect()
    assert len(got) == len(cases.texts())
    lang = {i: g for i, _, g, _ in cases.texts()}
    for r in got:
        assert r.held_out == (remainder(r.doc_id, 3) == 1) and 0 <= r.score <= 1
        if r.doc_id in (11, 12, 13, 16):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.doc_id is not None and r.doc_id >= 100:
            assert r.lang_pred == lang[r.doc_id]


def test_forward_sums_all_segmentations():
    voc = langid.vocabulary(langid.default_vocabulary())
    prob = np.random.default_rng(0).dirichlet(np.full(voc.size, 0.3), 2).T.copy()
    index = {p: i for i, p in enumerate(voc.pieces)}
    for word in (b"a", b"the", b"keitsch", "étreêaux".encode(), b"z" * 70):
        raw = np.frombuffer(word, np.uint8)
        m, n = langid.word_block(raw, np.array([0]), np.array([len(raw)]))
        got = langid.forward(voc, prob, m, n)[0]
        text = b" " + word
        for k in range(2):
            sums = [1.0] + [0.0] * len(text)
            for j in range(1, len(text) + 1):
                sums[j] = sum(sums[i] * prob[index[text[i:j]], k] for i in range(j) if text[i:j] in index)
            assert math.isclose(got[k], math.log(sums[-1]), rel_tol=1e-9)


def test_long_runs_cost_what_short_ones_do():
    import time
    voc = langid.vocabulary(langid.default_vocabulary())
    prob = np.random.default_rng(0).dirichlet(np.full(voc.size, 0.3), 3).T.copy()
    chinese = "".join(chr(0x4E00 + i * 7919 % 20000) for i in range(16000))
    for word in (b"x" * 700, chinese[:300].encode(), b"ab\xc3\xa9" * 500):
        raw = np.frombuffer(word, np.uint8)
        m, n = langid.word_block(raw, np.array([0]), np.array([len(raw)]))
        got = langid.forward_long(voc, prob, m[0], ends=64)
        assert np.allclose(got, langid.forward(voc, prob, m, n)[0], rtol=1e-9)
        assert np.allclose(got, langid.forward_long(voc, prob, m[0]), rtol=1e-9)
    model = langid.Model(["a", "b", "c"], prob, langid.default_vocabulary())
    start = time.perf_counter()
    langid.score_column(model, pa.array([chinese, "x" * 100_000]))
    assert time.perf_counter() - start < 10  # about 1 s; minutes before
    assert langid.train_pieces(voc, [chinese[:3000]], 1).sum() == pytest.approx(1)


def test_language_id_without_labels(spark):
    got = langid.op7(cases.frame(spark, [(1, "some text", None, None)])).first()
    assert (got.lang_pred, got.score) == ("und", 0.0)


def test_texts_without_a_letter_have_no_language():
    """However many symbols they hold; one letter of any script is enough."""
    none = ["12 — 34 — 56 — 78 — 90", "😀 😂 🎉 👍 🚀 " * 40, "• 1 • 2 • 3 • 4", "“ ” ‘ ’ « »", "€ 5 £ 6 ¥ 7 ₹ 8", "٣ ٤ ٥ ٦ ٧ ٨", "— — — — 5\n– – – –"]
    some = ["— — — — — a", "A — — — — —", "• • • • • é", "• • • • • 語", "٣ ٤ ٥ ٦ ب ٧"]
    path = langid.default_vocabulary()
    prob = [langid.train_pieces(langid.vocabulary(path), [x]) for x in ("the sun and the sea", "der Tag und die schöne Nacht")]
    model = langid.Model(["de", "en"], np.ascontiguousarray(np.array(prob[::-1]).T), path)
    lang, score = langid.score_column(model, pa.array([x for pair in zip(none, some + some) for x in pair] + [None, ""]))
    assert lang[0::2] == ["und"] * 8 and score[0::2] == [0.0] * 8 and lang[-1] == "und"
    assert all(x != "und" for x in lang[1:14:2]) and all(x > 0 for x in score[1:14:2])


def base_twin(t):
    t = t or ""
    out = [(m.start(), m.end(), 0) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((m.start(), m.end(), 1))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub(r"[^0-9]", "", m.group())
        if 12 <= len(d) <= 19 and pii.luhn(d):
            out.append((m.start(), m.end(), 2))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(re.sub(r"[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), m.end(), 3))
    return sorted(out, key=lambda x: (x[0], x[2], x[1]))


def test_base_patterns_match_their_expressions():
    rng = random.Random(4)
    for _ in range(20_000):
        t = "".join(rng.choice("a1.@+-() 5_é") for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(t) == base_twin(t)
    assert pii.base_spans("9" * 200_000) == [] and pii.base_spans("a" * 200_000 + "@") == []


def personal(n):
    rng = random.Random(8)
    rows = []
    for i in range(n):
        card = [4] + [rng.randint(0, 9) for _ in range(14)]
        check = next(d for d in range(10) if pii.luhn("".join(map(str, card + [d]))))
        card = "".join(map(str, card + [check]))
        kinds = [f"ab.{i}@mail{i % 7}.example.com", ".".join(str(rng.randint(0, 255)) for _ in range(4)), card,
                 f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}", f"version {i}.0", f"password={rng.getrandbits(60):x}"]
        rows.append((i, f"some words {kinds[i % 6]} and more {kinds[(i + 2) % 6]} here", "en", "a"))
    rows.append((9001, "call +1 (269) 555-3296 4524132264652876 now", "en", "a"))  # neither is a base span
    return rows + [(None, None, None, None), (9002, "", None, None), (9003, "plain words only, number 12", None, None)]


def test_personal_data(spark):
    rows = personal(240)
    text = {i: t for i, t, *_ in rows}
    for r in pii.op9(cases.frame(spark, rows)).collect():
        base = base_twin(text[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for *_, k in base) for x in range(4)]
        assert r.base_sha256 == hashlib.sha256(pii.joined(base).encode()).hexdigest()
        spans = set(r.spans.split(",")) - {""}
        assert set(pii.joined(base).split(",")) - {""} <= spans
        if r.doc_id == 9001:  # the random field cuts what the patterns ran over
            assert spans == {"phone:5:22", "card:23:39"}
        if r.doc_id == 9003:
            assert not spans


def test_field_sums_match_enumeration():
    lattice = pii.Lattice("+1 (988) 555-2485 x", 0, 17)
    weights = {f: random.Random(f).uniform(-1, 1) for *_, fs in lattice.edges for f in fs}
    score = pii.scores(lattice, weights)
    totals = {0: [0.0]}
    for j in range(1, lattice.n + 1):
        totals[j] = [t + s for (i, e, *_), s in zip(lattice.edges, score) if e == j for t in totals[i]]
    ahead, back = lattice.sums(score)
    exact = math.log(sum(math.exp(t) for t in totals[lattice.n]))
    assert math.isclose(ahead[lattice.n], exact, rel_tol=1e-9) and math.isclose(back[0], exact, rel_tol=1e-9)
    assert math.isclose(sum(score[e] for e in lattice.best(score)), max(totals[lattice.n]), rel_tol=1e-9)


def contamination_twin(rows, items):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(cases.LOWER))
    windows = {}
    for i, t in items:
        w = cut(t)
        if w:
            m = min(10, len(w))
            for k in range(len(w) - m + 1):
                windows.setdefault(tuple(w[k:k + m]), set()).add("" if i is None else str(i))
    sizes, out = {len(w) for w in windows}, []
    for i, t, *_ in rows:
        w, hit, names = cut(t), set(), set()
        for m in sizes:
            for k in range(len(w) - m + 1):
                found = windows.get(tuple(w[k:k + m]))
                if found:
                    hit.update(range(k, k + m))
                    names |= found
        out.append((str(i), len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


BENCH = [(1, cases.sentence(2, 45)), (2, cases.sentence(52, 30)), (2, cases.sentence(52, 30)), (10, cases.sentence(1, 14).upper()),
         (3, None), (4, "..."), (None, cases.sentence(83, 12))]


@pytest.mark.parametrize("items", [BENCH, [*BENCH, (6, "winter skies")], [*BENCH, (6, "fox")], [(3, None)], []])
def test_decontamination(spark, items):
    bench = spark.createDataFrame([(i, t, "h", "p") for i, t in items], cases.BENCH_SCHEMA)
    got = decontaminate.op5(cases.frame(spark), bench).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got) == \
        contamination_twin(cases.texts(), items)


def test_keep_clean(spark):
    docs = cases.frame(spark)
    bench = spark.createDataFrame([(i, t, "h", "p") for i, t in BENCH], cases.BENCH_SCHEMA)
    kept = decontaminate.keep_clean(docs, bench)
    assert kept.columns == docs.columns
    clean = [x[0] for x in contamination_twin(cases.texts(), BENCH) if not x[5]]
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(clean)


def test_decontamination_beyond_the_broadcast_bound(spark, monkeypatch):
    items = [*BENCH, (6, "fox")]
    monkeypatch.setattr(decontaminate, "BROADCAST_FINGERPRINTS", 0)
    bench = spark.createDataFrame([(i, t, "h", "p") for i, t in items], cases.BENCH_SCHEMA)
    got = decontaminate.op5(cases.frame(spark), bench)
    assert sum(r.n_hit for r in got.collect()) == sum(x[2] for x in contamination_twin(cases.texts(), items))


def test_short_items_change_nothing_for_long_ones(spark):
    docs = cases.frame(spark).selectExpr("doc_id", "text").where("doc_id between 400 and 419")
    rows = docs.withColumn("words", decontaminate.words(docs.text)).drop("text")

    def whole(needs):
        found = decontaminate.fingerprints(rows, needs).where("need = 10")
        return sorted((r.doc_id, r.p, r.h) for r in found.collect())

    assert whole([1, 3, 10]) == whole([10])
    # a row too short for a class has no fingerprint of it; with a header it comes anyway
    short = spark.createDataFrame([(1, ["a", "b"]), (2, [])], "doc_id int, words array<string>")
    assert [(r.doc_id, r.need) for r in decontaminate.fingerprints(short, [10], header=True).orderBy("doc_id").collect()] == [(1, None), (2, None)]
    assert decontaminate.op5(cases.frame(spark, []), spark.createDataFrame([(1, "fox", "h", "p")], cases.BENCH_SCHEMA)).count() == 0


def test_model_scoring(spark, monkeypatch):
    monkeypatch.setattr(attention, "STEPS", 20)
    monkeypatch.setattr(lm_scoring, "FREQUENT_WORDS", 20)  # most words take the join
    rows = cases.texts()
    tokens = [cases.words(t) + [None] for _, t, *_ in rows]
    held = [remainder(i, 7) == 2 for i, *_ in rows]
    c = Counter(w for ws, h in zip(tokens, held) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), h, len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6))
                  for (i, *_), ws, h in zip(rows, tokens, held))
    got = lm_scoring.op2(cases.frame(spark)).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)


def test_model_is_a_distribution_and_learns():
    """Over all ids, the probabilities of the next one sum to 1; training
    lowers the loss; windows of whole texts give what one window gives."""
    rng = np.random.default_rng(2)
    text = np.tile([3, 1, 4, 1, 5, 9, 2, 6], 40)
    v = attention.Vocabulary.of(np.bincount(text, minlength=300).astype(float))
    net = attention.Network(v)
    window, want, opens = attention.training_blocks(v, text)
    losses = net.train(window, want, opens, steps=60)
    assert np.mean(losses[-5:]) < 0.7 * np.mean(losses[:5])
    start = rng.choice(text, 40)
    ids = np.concatenate([np.r_[start, x] for x in range(300)])
    whole = net.log_probs(ids, np.arange(301) * 41)
    before = net.log_probs(start, np.array([0, 40]))[0]
    assert math.isclose((10 ** (whole - before)).sum(), 1.0, rel_tol=1e-4)
    loss, _ = net.gradients(window, want, opens)
    direct = -loss * len(text) / math.log(10) + v.log_within[text].sum()
    assert math.isclose(net.log_probs(text, np.array([0, len(text)]))[0], direct, rel_tol=1e-4)


def test_the_224_most_frequent_ids_have_classes_of_their_own():
    counts = np.arange(2000, 0, -1)
    voc = attention.Vocabulary.of(counts)
    assert voc.classes == 256
    assert (np.bincount(voc.to_class)[voc.to_class[:224]] == 1).all() and (voc.log_within[:224] == 0).all()


def test_subword_ids_equal_the_tokenizers():
    enc = subwords.encoder(subwords.default_tokenizer())
    rng = random.Random(5)
    texts = ["", None, "a.", "Don't stop!! we'll.", "<|endoftext|> x <|ENDOFTEXT|>", "x<|y", "É é.", "ΣΑΣ. ΟΔΟΣ", "日本語。", "f" * 3000,
             "\x00\x01 b.", "it's. 's 't", "word.… x….", "\x01", "K. İ."]
    texts += ["".join(rng.choice("abC'.,;!?<|>éß \n\t1́ … \x01") for _ in range(60)) for _ in range(800)]
    ids, offs = enc.column(pa.array(texts))
    for i, t in enumerate(texts):
        assert enc.tokenizer.encode(t or "", add_special_tokens=False).ids == ids[offs[i]:offs[i + 1]].tolist()


def test_word_cache_never_changes_results():
    cache = textbytes.WordCache(2, 1)
    h = np.arange(1, 50, dtype=np.uint64).repeat(3)
    for _ in range(3):
        assert (cache.get(h, lambda at: h[at, None] * 2.0)[:, 0] == h * 2.0).all()


@pytest.mark.parametrize("op", [langid.op7, pii.op9, lm_scoring.op2, langid.keep_identified])
def test_empty_table(spark, op, monkeypatch):
    monkeypatch.setattr(attention, "STEPS", 1)
    assert op(cases.frame(spark, [])).count() == 0


def test_samples_of_any_rate(spark):
    from pyspark.sql import functions as F

    from autoscope.llm.common import drawn
    rows = spark.range(1 << 18).select(F.xxhash64("id").alias("h"))
    for rate in (1.0, 0.25, 1e-3):
        n = rows.where(drawn(F.col("h"), rate)).count()
        assert abs(n - rate * (1 << 18)) <= 5 * math.sqrt(rate * (1 - rate) * (1 << 18))
    # 4,000 of 10**11 rows: the bound is not 0, and sharp
    bound = int(4e-8 * 2**62)
    few = spark.createDataFrame([(0,), ((bound - 1) << 22,), (bound << 22,), (1,)], "h long")
    assert [r[0] for r in few.select(drawn(F.col("h"), 4e-8)).collect()] == [True, True, False, False]


def test_the_network_learns_from_documents_outside_its_sample(spark, monkeypatch):
    monkeypatch.setattr(attention, "STEPS", 5)
    monkeypatch.setattr(lm_scoring, "SAMPLE_DOCS", 0)  # nothing is drawn
    monkeypatch.setattr(lm_scoring, "SHARD_DOCS", 7, raising=False)  # several shards
    docs = cases.frame(spark)
    path = subwords.default_tokenizer()
    nets = [lm_scoring.fit(d, path)[0] for d in (docs, docs.repartition(5))]
    start = attention.Network(nets[0].v)
    # classes follow all training documents, and the weights moved from their start
    assert any(not np.array_equal(nets[0].p[k], start.p[k]) for k in start.p)
    assert nets[0].v.log_within.max() < 0 or len(np.unique(nets[0].v.log_within)) > 1
    # however the rows lie
    assert all(np.allclose(nets[0].p[k], nets[1].p[k], atol=1e-5) for k in start.p)
