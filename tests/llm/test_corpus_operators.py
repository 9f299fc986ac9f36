"""URL rules, importance resampling and the divergence audit."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np

import cases
from autoscope.llm import divergence, resample, url_cascade, wordids

# ---- URL rules --------------------------------------------------------------

PAGES = "page_id long, url string, host string, path string, rule string, verdict string, key string, keys string, fits string, `odd.name` string"


def pages(spark, urls):
    return spark.createDataFrame([(i, u, *["z"] * 8) for i, u in urls], PAGES).repartition(3)


def url_twin(url, rules, words, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host):]).group()
        host = host.translate(cases.LOWER)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        best = max(f[:3] for f in fits)
        return host, path, best[2], "block" if any(f[3] == "block" for f in fits if f[:3] == best) else "allow"
    return host, path, None, "block" if set(re.findall(r"[a-z0-9]+", host)) & set(words) else default


AWKWARD = [None, "", "example.org/es/", "://", "http://", "https:///es/1", "http://EXAMPLE.ORG/es/x?y=/de/#z", "http://a.example.org/en/1",
           "http://badexample.org/es/", "http://org/", "http://org", "http://org?x=/", "x://com/de/", "x://y.com/fr/é/ü", "http://example.org/es",
           "http://casino.example.net/", "http://my-casino.org/", "http://casinos.net/x", "http://a..org/", "http://.com/de/", "ftp://u:p@h.com:80/de/",
           "http://" + "a." * 20000 + "org/" + "x" * 50000, "http://example.net/\n/es/", "HTTP://Spam.Example.Com/fr/", "a://b://c.org/"]


def test_urls_against_every_rule(spark):
    rows = [(i, u) for i, u in enumerate(AWKWARD)] + [(None, "http://example.org/es/"), (3, "http://com/de/"), (3, "http://com/de/")]
    got = [tuple(r) for r in url_cascade.op11(pages(spark, rows)).collect()]
    want = [(i, *url_twin(u, url_cascade.RULES, url_cascade.WORDS)) for i, u in rows]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_many_rules_in_segments(spark, monkeypatch):
    monkeypatch.setattr(url_cascade, "SEGMENT_KEYS", 200)
    rng = random.Random(5)
    hosts = [".".join(rng.choice("abcd") for _ in range(rng.randint(1, 4))) for _ in range(400)]
    rules = [(rng.choice(hosts), "/" + "".join(rng.choice("xy/") for _ in range(rng.randint(0, 3))), rng.choice(["allow", "block"])) for _ in range(450)]
    rows = [(i, f"http://{rng.choice(hosts)}/{''.join(rng.choice('xy/') for _ in range(rng.randint(0, 6)))}") for i in range(1500)]
    words = ["c", "zz"]
    table = url_cascade.rule_table(spark, rules + [(None, "/", "block"), ("a", None, "block"), ("a", "/", None), ("b", "/", "maybe")])
    got = url_cascade.judge(pages(spark, rows), table, spark.createDataFrame([(w,) for w in words] + [(None,)], "word string"), "block")
    want = [(i, *url_twin(u, rules, words, "block")) for i, u in rows]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_cascade_is_exact_on_the_universe(spark):
    keys = spark.range(20000).select(url_cascade.F.concat(url_cascade.F.lit("k"), "id").alias("key"))
    listed = keys.where("pmod(xxhash64(key), 37) = 0")
    levels = url_cascade.cascade(listed, keys, 40000)
    assert len(levels) >= 3
    wrong = keys.select((url_cascade.member(levels, url_cascade.F.col("key")) == (url_cascade.F.expr("pmod(xxhash64(key), 37) = 0"))).alias("ok"))
    assert wrong.where("not ok").count() == 0


def test_urls_without_pages_rules_or_python(spark):
    none = pages(spark, []).limit(0)
    assert url_cascade.op11(none).collect() == []
    got = url_cascade.judge(pages(spark, [(1, "http://a.org/")]), url_cascade.rule_table(spark, []).limit(0)).collect()
    assert [tuple(r) for r in got] == [(1, "a.org", "/", None, "allow")]
    plan = url_cascade.op11(pages(spark, [(1, "http://a.org/")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "Join" not in plan


# ---- importance resampling --------------------------------------------------

def feature_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(cases.LOWER))


def bag(text):
    w = feature_words(text)
    return w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10000


def resample_twin(docs, target):
    s, t = (Counter(bucket(f) for x in side for f in bag(x)) for side in ([x for _, x in docs], target))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in range(10000)]
    out = []
    for i, text in docs:
        f = bag(text)
        weight = sum(gain[bucket(x)] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(feature_words(text))])
    enough = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(enough[:25 * len(enough) // 100]):
        r[4] = k + 1
    return [tuple(r[:5]) for r in out]


def test_crc_of_many_lengths():
    rng = np.random.default_rng(3)
    n = np.concatenate([rng.integers(0, 40, 500), [0, resample.LONG, resample.LONG + 1, 5000]])
    ends = np.cumsum(n)
    buf = rng.integers(0, 256, ends[-1]).astype(np.uint8)
    got = resample.crc32s(buf, ends - n, ends)
    assert got.tolist() == [zlib.crc32(buf[e - k:e].tobytes()) for e, k in zip(ends, n)]


def test_resampling(spark):
    rows = [(r[0], r[1]) for r in cases.texts()] + [(900, "Ünïcode wörter, 語 語 und-und " * 10), (901, "\x00 \x7f {} @"), (10, "a b " * 30)]
    target = [cases.sentence(50, 70), None, "", "語 語 語", cases.sentence(7, 5)]
    docs = cases.frame(spark, [(i, t, None, None) for i, t in rows])
    got = resample.op12(docs, spark.createDataFrame([(i, t, "h", "p") for i, t in enumerate(target)], cases.BENCH_SCHEMA)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, resample_twin(rows, target)))


def test_resampling_without_rows(spark):
    docs, bench = cases.frame(spark), spark.createDataFrame([], cases.BENCH_SCHEMA)
    assert resample.op12(docs.limit(0), bench).collect() == []
    got = resample.op12(docs, bench).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, resample_twin([(r[0], r[1]) for r in cases.texts()], [])))


def test_longer_features_and_text_ids(spark):
    rows = [("a1", "one two three four one two three"), ("b", None)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    counts = {r["bucket"]: r["n"] for r in resample.bucket_counts(docs, order=3).collect()}
    w = rows[0][1].split()
    assert counts == Counter(bucket(" ".join(w[i:i + n])) for n in (1, 2, 3) for i in range(len(w) - n + 1))
    assert {r["doc_id"] for r in resample.resample(docs, docs).collect()} == {"a1", "b"}


def test_unlike_words_of_one_hash_stay_apart(monkeypatch):
    monkeypatch.setattr(wordids.tb, "span_hashes", lambda c, s, e: np.zeros(len(s), np.uint64))
    buf = np.frombuffer(b"ab cd ab e", np.uint8)
    ids, first = wordids.distinct(buf, np.array([0, 3, 6, 9]), np.array([2, 5, 8, 10]))
    assert ids.tolist() == [0, 1, 0, 2] and first.tolist() == [0, 1, 3]


# ---- divergence audit -------------------------------------------------------

def audit_twin(rows, min_docs, top=50):
    df, count, groups = Counter(), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        w = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(cases.LOWER))
        groups[lang].add(source)
        count[lang, source].update(w)
        df.update((lang, t) for t in set(w))
    out = []
    for lang, sources in groups.items():
        kept = [t for g, t in df if g == lang and df[g, t] >= min_docs]

        def share(c):
            total = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + math.floor(Fraction(10**9 * (c[t] + 5), total)) for t in kept}

        whole = share(sum((count[lang, s] for s in sources), Counter()))
        p = {s: share(count[lang, s]) for s in sources}
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            terms = [(-(p[s][t] - whole[t]), t.encode()) for t in kept if count[lang, s][t] and p[s][t] > whole[t]]
            out += [(lang, s, "pair", o.decode(), -v, k + 1) for k, (v, o) in enumerate(sorted(pairs))]
            out += [(lang, s, "term", t.decode(), -v, k + 1) for k, (v, t) in enumerate(sorted(terms)[:top])]
    return out


def test_audit(spark):
    rows = cases.texts() + [(700 + i, f"Wörter {'über ' * i} 語 zahl{i % 3}x", "de" if i % 2 else "", f"s{i % 5}") for i in range(40)]
    for options in ({}, {"min_docs": 2, "spill": 20, "tile": 2}, {"min_docs": 1, "top": 3}):
        got = [tuple(r) for r in divergence.audit(cases.frame(spark, rows), **options).collect()]
        want = audit_twin(rows, options.get("min_docs", 30), options.get("top", 50))
        assert sorted(got) == sorted(want), options


def test_audit_without_rows_or_terms(spark):
    assert divergence.op13(cases.frame(spark).limit(0)).collect() == []
    got = divergence.op13(cases.frame(spark, [(1, None, None, "a"), (2, "x", None, "b"), (3, "x", "en", "a")])).collect()
    assert sorted(tuple(r) for r in got) == [("", "a", "pair", "b", 0, 1), ("", "b", "pair", "a", 0, 1)]


def test_shares_are_exact():
    total = np.array([7, 3 * 10**14 + 7, 8 * 10**15], np.int64)
    count = np.array([5, 10**14, 8 * 10**15 - 1], np.int64)
    assert divergence.shares(count, total).tolist() == [1 + 10**9 * int(c) // int(t) for c, t in zip(count, total)]
