"""URL rules through Bloom filter cascades.

A cascade answers membership of a listed set exactly for every key of a known universe: level 1 encodes the listed
keys, level 2 the other keys of the universe that level 1 takes for listed, level 3 the listed keys that level 2
takes for its own, and so on until a level makes no error. The levels are small constant arrays in the
expression, so rows are judged in the scan, without a join.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sievelight.llm.tables import saved
from sievelight.llm.text import LOWER, UPPER

#: Levels after which a cascade can only be stuck on equal hashes, and bits of one level, at most (8 MB).
MOST_LEVELS, MOST_BITS = 64, 1 << 26


@dataclass
class Cascade:
    """Levels as (bits, hash functions, words of 64 bits)."""

    levels: list[tuple[int, int, list[int]]] = field(default_factory=list)

    def has(self, key: Column) -> Column:
        """Whether ``key``, a key of the universe, is listed."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for i in range(len(self.levels) - 1, -1, -1):
            answer = F.when(_hit(key, i, self.levels[i]), answer).otherwise(F.lit(i % 2 == 1))
        return answer


def _places(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level * 64 + i)), F.lit(bits)) for i in range(hashes)]


def _hit(key: Column, level: int, spec: tuple[int, int, list[int]]) -> Column:
    bits, hashes, words = spec
    table = F.split(F.lit(",".join(map(str, words))), ",").cast("array<bigint>")
    out = F.lit(True)
    for p in _places(key, level, bits, hashes):
        word = F.get(table, F.shiftright(p, 6).cast("int"))
        out = out & (F.call_function("bit_get", word, F.pmod(p, F.lit(64)).cast("int")) == 1)
    return out


def _level(keys: DataFrame, level: int, n: int, rate: float) -> tuple[int, int, list[int]]:
    hashes = max(1, round(-math.log2(rate)))
    bits = min(MOST_BITS, 64 * max(1, math.ceil(n * hashes / math.log(2) / 64)))
    at = keys.select(F.explode(F.array(*_places(F.col("key"), level, bits, hashes))).alias("p"))
    parts = at.groupBy(F.shiftright("p", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(pmod(p, 64) AS INT))")).alias("b")).collect()
    words = [0] * (bits // 64)
    for r in parts:
        words[r["w"]] = r["b"]
    return bits, hashes, words


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """A cascade for ``listed(key)`` over ``universe(key)``; both without repeats, null keys are ignored.

    The first level is sized so that its errors are about as many as the listed keys; each later level halves.
    What reaches the driver is the bits of the levels, in proportion to the listed keys. An empty list gives no
    level, and nothing is listed.
    """
    own = saved(listed.where("key is not null").select("key"))
    rest = universe.where("key is not null").select("key").join(own, "key", "left_anti")
    cascade, n, others = Cascade(), own.count(), rest.count()
    inside, outside = own, rest
    while n:
        if len(cascade.levels) == MOST_LEVELS:
            raise ValueError("two keys share all hashes")
        rate = min(0.5, 0.7 * n / max(1, others)) if not cascade.levels else 0.5
        spec = _level(inside, len(cascade.levels), n, max(rate, 1e-6))
        wrong = saved(outside.where(_hit(F.col("key"), len(cascade.levels), spec)))
        cascade.levels.append(spec)
        inside, outside, n = wrong, inside, wrong.count()
    return cascade


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://`` or for null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(F.coalesce(host, F.lit("")), UPPER, LOWER), F.coalesce(path, F.lit(""))


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str


def judge(pages: DataFrame, rules: list[Rule], url_col: str = "url", default: str = "allow") -> DataFrame:
    """``(row, host, path, rule, verdict)`` of every row of ``pages``.

    A rule fits its host and all subdomains if the path starts with its path; the longest rule (host and path together) wins.
    Without a fitting rule ``rule`` is null and the verdict ``default``. The key universe is every host ending
    and path beginning in the table that has the shape of a rule. A null url, or one without ``://``, has an empty
    host and path; repeated rows are judged alike; ``row`` is a struct of the input row. An empty table gives an
    empty result. The rules are a list on the driver.
    """
    spark: SparkSession = pages.sparkSession
    labels = sorted({r.host.count(".") + 1 for r in rules})
    lengths = sorted({len(r.path) for r in rules})
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.struct("*").alias("row"), F.struct(host.alias("host"), path.alias("path")).alias("u"))
    shapes = [(n, m) for n in labels for m in lengths]

    def key(n: int, m: int) -> Column:
        return F.when(F.length("u.path") >= m, F.concat(F.substring_index("u.host", ".", -n), F.substring("u.path", 1, m)))

    keyed = rows.withColumn("keys", F.array_compact(F.array(*[key(n, m) for n, m in shapes])) if shapes else F.array().cast("array<string>"))
    universe = saved(keyed.select(F.explode("keys").alias("key")).distinct())

    def listed(which: list[Rule]) -> Cascade:
        names = spark.createDataFrame([(k,) for k in sorted({r.host + r.path for r in which})], "key string")
        return build_cascade(names, universe)

    known, blocked = listed(rules), listed([r for r in rules if r.verdict == "block"])
    fitting = F.filter("keys", known.has)
    longest = F.get(F.sort_array(F.transform(fitting, lambda k: F.struct(F.length(k).alias("n"), k.alias("k"))), False), F.lit(0))["k"]
    found = keyed.select("row", "u", F.explode(F.array(F.struct(longest.alias("rule")))).alias("r"))
    verdict = F.when(F.col("r.rule").isNull(), default).when(blocked.has(F.col("r.rule")), "block").otherwise("allow")
    return found.select("row", "u.host", "u.path", "r.rule", verdict.alias("verdict"))
