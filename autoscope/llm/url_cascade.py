"""URL rules judged by cascades of Bloom filters, with DataFrame functions only.

A rule names a host, a start of the path and a verdict; it fits a url whose
host is the rule's or one of its subdomains and whose path starts with the
rule's.  Listed words block hosts that hold one of them, where no rule fits.
What a url could be listed by -- its keys -- is finite: for every shape (host
labels, path length) that occurs in the list, the end of the host and the
start of the path of that shape, and the words of the host.

A cascade encodes the listed keys of one verdict.  Level 1 is a Bloom filter
of them.  The keys of the corpus that pass it wrongly make level 2, the listed
keys that pass level 2 make level 3, and so on until a level lets nothing pass
wrongly.  A key is listed if the first level that rejects it is an even one.
That is exact for every key of the corpus, and the test is an expression on
the url's own row: urls are neither joined nor moved.  Level 1 is sized by the
number of keys in the corpus, so that about as many pass wrongly as are listed,
and each further level halves what is left.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from autoscope.session import materialize

ALLOW, BLOCK = "allow", "block"
#: listed keys that one pair of cascades holds (about 4 bytes a key at 10^6
#: corpus keys a listed one); longer lists are split by hash into segments,
#: each of which takes a pass over the urls
SEGMENT_KEYS = 1_000_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# fixed values: the rules of the registered query
RULES = [
    ("org", "/", ALLOW),
    ("example.org", "/es/", BLOCK),
    ("example.org", "/en/1", BLOCK),
    ("com", "/fr/", ALLOW),
    ("com", "/de/", BLOCK),
]
#: words of a host that block it where no rule fits
WORDS = ["ads", "adult", "bets", "betting", "casino", "gambling", "lottery", "pills", "poker", "porn", "spam", "viagra", "warez", "xxx"]


def lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null and for
    a url without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return lower(host), path


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")


# ---- keys -------------------------------------------------------------------

def listed_keys(rules: DataFrame, words: DataFrame) -> DataFrame:
    """(key, blocks, labels, length): each listed key once; a rule that is
    both allowed and blocked blocks.  Rules with a null or another verdict
    than the two are ignored."""
    host, path = lower(F.col("host")), F.col("path")
    ruled = rules.where(F.col("verdict").isin(ALLOW, BLOCK)).select(
        F.concat(host, path).alias("key"), (F.col("verdict") == BLOCK).alias("blocks"),
        F.size(F.split(host, r"\.")).alias("labels"), F.length(path).alias("length"))
    worded = words.select(F.concat(F.lit("#"), lower(F.col("word"))).alias("key"), F.lit(True).alias("blocks"),
                          F.lit(None).cast("int").alias("labels"), F.lit(None).cast("int").alias("length"))
    return ruled.union(worded).where("key is not null").groupBy("key").agg(
        F.max("blocks").alias("blocks"), F.first("labels").alias("labels"), F.first("length").alias("length"))


def url_keys(shapes: list[tuple[int, int]]) -> Column:
    """The keys by which a list of these ``shapes`` could hold the row's
    ``host`` and ``path``: (size, host, key), size 0 for words."""
    labels = F.split("host", r"\.")
    known = F.array(*[F.struct(F.lit(n).alias("labels"), F.lit(m).alias("length")) for n, m in shapes] or [
        F.struct(F.lit(0).alias("labels"), F.lit(0).alias("length"))])
    fits = F.filter(known, lambda s: (s["labels"] > 0) & (s["length"] <= F.length("path")) & (s["labels"] <= F.size(labels)))

    def key(s: Column) -> Column:
        end = F.array_join(F.slice(labels, -s["labels"], s["labels"]), ".")
        text = F.concat(end, F.substring(F.col("path"), F.lit(1), s["length"]))
        return F.struct((F.length(text) + 1).alias("size"), F.length(end).alias("host"), text.alias("key"))

    words = F.array_distinct(F.regexp_extract_all("host", F.lit(r"[a-z0-9]+"), F.lit(0)))
    return F.concat(F.transform(fits, key), F.transform(words, lambda w: F.struct(
        F.lit(0).alias("size"), F.lit(0).alias("host"), F.concat(F.lit("#"), w).alias("key"))))


# ---- filters ----------------------------------------------------------------

@dataclass
class Bloom:
    bits: int
    hashes: int
    seed: int
    words: list[int]

    def holds(self, key: Column) -> Column:
        # a folded literal, once in the expression
        held = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")
        return F.forall(places(key, self.bits, self.hashes, self.seed), lambda p: F.getbit(
            F.get(held, F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")) == 1)


def places(key: Column, bits: int, hashes: int, seed: int) -> Column:
    return F.array(*[F.pmod(F.xxhash64(key, F.lit(64 * seed + j)), F.lit(bits).cast("long")) for j in range(hashes)])


def bloom(keys: DataFrame, n: int, rate: float, seed: int) -> Bloom:
    """A filter of the ``n`` distinct ``key`` values that lets others pass at
    about ``rate``."""
    hashes = max(1, round(-math.log2(rate)))
    bits = 64 * max(1, math.ceil(n * hashes / math.log(2) / 64))
    set_bits = keys.select(F.explode(places(F.col("key"), bits, hashes, seed)).alias("p")).groupBy(
        F.shiftright("p", 6).alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 as int)))").alias("word"))
    words = [0] * (bits // 64)
    for r in set_bits.toLocalIterator():
        words[r["at"]] = r["word"]
    return Bloom(bits, hashes, seed, words)


def cascade(listed: DataFrame, keys: DataFrame, n_keys: int) -> list[Bloom]:
    """The levels that hold exactly the ``key`` values of ``listed`` among
    those of ``keys`` (``n_keys`` of them at most, repeats allowed)."""
    n = listed.count()
    if not n:
        return []
    levels, encoded, others = [], listed, keys
    rate = min(0.5, max(n / max(n_keys, 1), 2.0 ** -32))
    while n:
        level = bloom(encoded, n, rate, len(levels))
        passed = others.where(level.holds(F.col("key"))).select("key", F.lit(False).alias("own"))
        if not levels:  # what is listed passes rightly
            passed = passed.union(listed.select("key", F.lit(True)))
        levels.append(level)
        wrong = materialize(passed.groupBy("key").agg(F.max("own").alias("own")).where(~F.col("own")).select("key"), "cascade")
        n, rate = wrong.count(), 0.5
        encoded, others = wrong, encoded
    return levels


def member(levels: list[Bloom], key: Column) -> Column:
    """Whether the first level that rejects ``key`` is an even one."""
    out = F.lit(len(levels) % 2 == 1)
    for i in reversed(range(len(levels))):
        out = F.when(levels[i].holds(key), out).otherwise(i % 2 == 1)
    return out


# ---- verdicts ---------------------------------------------------------------

def judge(pages: DataFrame, rules: DataFrame, words: DataFrame | None = None, default: str = ALLOW) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages``.

    ``rules``: (host, path, verdict), the longest fitting key wins, of equally
    long ones that with the longer host.  ``words``: (word), words of a host
    that block it where no rule fits; else the verdict is ``default``.  Null
    urls and urls without ``://`` have an empty host and path, which only a
    rule with both empty fits.  Rows are judged one by one, repeated rows and
    null ids too; an empty list leaves every url the default.
    """
    spark = pages.sparkSession
    words = spark.createDataFrame([], "word string") if words is None else words
    listed = materialize(listed_keys(rules, words), "listed")
    shapes = [tuple(r) for r in listed.where("labels is not null").select("labels", "length").distinct().collect()]
    host, path = url_parts(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    own = url_keys(shapes)
    n_keys = urls.agg(F.sum(F.size(own))).first()[0] or 0
    every = urls.select(F.explode(F.transform(own, lambda k: k["key"])).alias("key"))
    segments = max(1, -(-listed.count() // SEGMENT_KEYS))
    rows = urls.withColumn("fits", F.array().cast("array<struct<size:int,host:int,key:string,blocks:boolean>>"))
    for s in range(segments):
        part = listed.where(F.pmod(F.xxhash64("key", F.lit(-1)), F.lit(segments)) == s)
        blocked, allowed = (cascade(part.where(F.col("blocks") == b).select("key"), every, n_keys) for b in (True, False))
        tested = F.transform(own, lambda k: F.struct(
            k["size"].alias("size"), k["host"].alias("host"), k["key"].alias("key"),
            F.when(member(blocked, k["key"]), True).when(member(allowed, k["key"]), False).alias("blocks")))
        rows = rows.withColumn("fits", F.concat("fits", F.filter(tested, lambda k: k["blocks"].isNotNull())))
        if segments > 1:
            rows = materialize(rows, "judged")
    # the longest rule; a word only where there is none
    best = rows.select("page_id", "host", "path", F.array_max("fits").alias("best"))
    return best.select("page_id", "host", "path", F.when(F.col("best.size") > 0, F.col("best.key")).alias("rule"),
                       F.when(F.col("best").isNull(), default).when(F.col("best.blocks"), BLOCK).otherwise(ALLOW).alias("verdict"))


def op11(pages: DataFrame) -> DataFrame:
    spark = pages.sparkSession
    return judge(pages, rule_table(spark), spark.createDataFrame([(w,) for w in WORDS], "word string"))


def _oracle() -> str:
    """DuckDB: every rule against every page."""
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
    words = ", ".join(f"'{w}'" for w in WORDS)
    return f"""
WITH rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
part AS (SELECT row_number() OVER () AS n, page_id, translate(regexp_extract(r, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
                regexp_extract(substr(r, length(regexp_extract(r, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM rest),
rules(rh, rp, rv) AS (VALUES {rules}),
fit AS (SELECT n, arg_max(rh || rp, length(rh || rp) * 100000 + length(rh)) AS rule, arg_max(rv, length(rh || rp) * 100000 + length(rh)) AS rv
        FROM part JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY n)
SELECT page_id, host, path, rule, coalesce(rv, CASE WHEN len(list_intersect(regexp_extract_all(host, '[a-z0-9]+'), [{words}])) > 0
       THEN 'block' ELSE 'allow' END) AS verdict
FROM part LEFT JOIN fit USING (n)
"""


ORACLE = _oracle()
