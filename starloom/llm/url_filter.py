"""URL rules by a Bloom filter cascade, with DataFrame functions only.

A URL is judged by the longest rule that fits: a rule (host, path) fits its host and
all subdomains when the URL's path starts with the rule's.  The keys a URL could
match are the suffixes of its host times the prefixes of its path, restricted
to the label counts and path lengths that occur among the rules.

The cascade decides which keys are listed without a join.  Level 1 encodes the listed
keys; the keys of the corpus's whole key universe that pass it wrongly are
encoded in level 2; listed keys that pass level 2 go to level 3, and so on until a
level lets nothing wrong through.  Over that universe the answer is exact.  A
level's bits are sized by the keys it encodes: the first by the list and the universe's
size so that the next stays as small as the list.  Bits travel inside the expression as a
binary literal, so their size is bounded by the rule list, not by the corpus.

Defined cases: a URL that is null or has no ``://`` has an empty host and path and fits no
rule; repeated rows are judged each; an empty table gives an empty result; other
columns are kept unless their names are those of the result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import ascii_lower, table
from starloom.operators.materialize import materialize

# The rules of the registered query (host, path, verdict).
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
DEFAULT_VERDICT = "allow"  # of a URL that fits no rule: it is on no list
MAX_LEVELS = 64


@dataclass(frozen=True)
class Level:
    bits: bytes
    size: int
    hashes: int
    seed: int

    def passes(self, key: Column) -> Column:
        """Whether every bit of ``key`` is set."""
        found = F.lit(True)
        for pos in positions(key, self.size, self.hashes, self.seed):
            byte = F.conv(F.hex(F.substring(F.lit(self.bits), F.shiftright(pos, 3) + 1, F.lit(1))), 16, 10)
            mask = F.call_function("shiftleft", F.lit(1), pos.bitwiseAND(7))
            found = found & (byte.cast("int").bitwiseAND(mask) != 0)
        return found


def positions(key: Column, size: int, hashes: int, seed: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(seed * 64 + j)), F.lit(size)).cast("int") for j in range(hashes)]


def build_level(keys: DataFrame, n: int, rate: float, seed: int, most_bits: int | None = None) -> Level:
    """A Bloom filter over the ``n`` rows of ``keys(key)`` with about ``rate`` false positives.

    ``most_bits`` bounds its size; beyond that the rate rises.
    """
    hashes = max(1, round(-math.log2(rate)))
    size = max(64, math.ceil(n * hashes / math.log(2)))
    if most_bits and size > most_bits:
        size, hashes = most_bits, 1
    at = F.explode(F.array(*positions(F.col("key"), size, hashes, seed))).alias("at")
    mask = F.call_function("shiftleft", F.lit(1), F.col("at").bitwiseAND(7))
    rows = (keys.select(at).groupBy(F.shiftright("at", 3).alias("byte")).agg(F.bit_or(mask).alias("bits"))).collect()
    bits = bytearray((size + 7) // 8)
    for row in rows:
        bits[row["byte"]] = row["bits"]
    return Level(bytes(bits), size, hashes, seed)


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def holds(self, key: Column) -> Column:
        """Whether ``key``, a key of the universe, is listed: decided by the first level it fails."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for depth in range(len(self.levels) - 1, -1, -1):
            answer = F.when(~self.levels[depth].passes(key), F.lit(depth % 2 == 1)).otherwise(answer)
        return answer


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """Exact membership of ``listed(key)`` over ``universe(key)``; both hold distinct keys.

    A key of the list is marked 1, any other key of the universe 0; the level at
    depth d encodes the marked side d % 2 == 0 or the other, as far as it is still wrong.
    """
    marked = materialize(universe.select("key", F.lit(0).alias("on")).unionByName(listed.select("key", F.lit(1).alias("on")))
                         .groupBy("key").agg(F.max("on").alias("on")))
    counts = marked.agg(F.count(F.lit(1)).alias("all"), F.sum("on").alias("on")).first()
    inside, outside = counts["on"] or 0, counts["all"] - (counts["on"] or 0)
    levels: list[Level] = []
    wrong, n = marked.filter("on = 1"), inside
    # the first level lets through about as many others as there are listed keys
    rate = min(0.5, max(1e-6, inside / max(1, outside) / math.sqrt(2)))
    while n and len(levels) < MAX_LEVELS:
        level = build_level(wrong, n, rate, len(levels) + 1)
        levels.append(level)
        side = len(levels) % 2  # the keys that this level should have turned away
        alive = marked.filter(F.col("on") == (1 - side))
        for other in levels:
            alive = alive.filter(other.passes(F.col("key")))
        wrong, n, rate = alive, alive.count(), 0.5
    if n:
        raise RuntimeError("the cascade did not become exact")
    return Cascade(tuple(levels))


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first ``://`` up to ``/``, ``?``, ``#``; then up to ``?``, ``#``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``rules`` as a JVM-side frame (host, path, verdict)."""
    one = F.array(*[F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict"))
                    for h, p, v in rules])
    return spark.range(1).select(F.explode(one).alias("r")).select("r.*")


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def candidate_keys(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """Array of the keys of ``shapes`` (labels, path length) that a URL has, longest key first."""
    made = []
    for labels, length in shapes:
        suffix = F.substring_index(host, ".", -labels)
        key = F.concat(suffix, F.substring(path, 1, length))
        made.append(F.when((_labels(host) >= labels) & (F.length(path) >= length) & (host != ""), key))
    keys = F.filter(F.array(*made), lambda k: k.isNotNull())
    return F.array_sort(keys, lambda a, b: F.length(b) - F.length(a))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT_VERDICT) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (or null) and ``verdict``.

    ``rules`` (host, path, verdict 'allow' or 'block') hold each (host, path) once;
    a host has no upper case.  Among rules of equal length the order of keys decides nothing: two
    different keys of one length cannot both be a suffix-prefix of one URL unless their hosts differ
    in labels, and then the one with the longer path is put first.
    """
    shapes = [(r["labels"], r["length"]) for r in
              rules.select(_labels(F.col("host")).alias("labels"), F.length("path").alias("length"))
              .distinct().collect()]
    shapes.sort(key=lambda s: (-s[1], -s[0]))
    host, path = split_url(F.col(url))
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    split = pages.select(*kept, host.alias("host"), path.alias("path"))
    keyed = split.withColumn("_keys", candidate_keys(F.col("host"), F.col("path"), shapes))

    listed = rules.select(F.concat("host", "path").alias("key"), "verdict").distinct()
    universe = keyed.select(F.explode("_keys").alias("key")).distinct()
    any_rule = build_cascade(listed.select("key"), universe)
    blocked = build_cascade(listed.filter("verdict = 'block'").select("key"), listed.select("key"))

    rule = F.get(F.filter("_keys", lambda k: any_rule.holds(k)), 0)
    ruled = keyed.withColumn("rule", rule)
    verdict = (F.when(F.col("rule").isNull(), F.lit(default))
               .when(blocked.holds(F.col("rule")), F.lit("block")).otherwise(F.lit("allow")))
    return ruled.select(*kept, "host", "path", "rule", verdict.alias("verdict"))


def op6_url_filter(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, rule_table(spark, RULES)).select("page_id", "host", "path", "rule", "verdict")


OP6_SQL = r"""
WITH split AS (
  SELECT page_id,
         CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id, COALESCE(translate(regexp_extract(rest, '^[^/?#]*'),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         COALESCE(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM split
), judged AS (
  SELECT page_id, host, path,
         CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
              WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
              WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
              WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
              WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM parts
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""
