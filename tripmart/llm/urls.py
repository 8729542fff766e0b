"""URL filters by a Bloom filter cascade.

The complete key universe is known: every (host suffix, path prefix) of a shape
that a list uses, over all urls of the corpus.  Level 1 of a cascade encodes the
listed keys; level 2 encodes the unlisted keys of the universe that level 1
lets through; level 3 the listed keys that level 2 lets through; and so on until
a level lets nothing false through.  Asking the levels in turn then answers
membership exactly for every key of the universe, without a join: the filters
are small literals inside the expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import materialize, table, without

#: (host, path, verdict) rules of the contract (fixed values).
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: Hosts that the method itself blocks, with all their subdomains.
BLOCKED_HOSTS = ("ads-track.example.com", "adult-x.example.com", "casino-win.example.net",
                 "cheap-pills.example.net", "free-bets.example.net", "spam-farm.example.org")
HASHES = 4
BITS_PER_KEY = 10
#: A level above this many bits (8 MB) is refused: the list is then joined by key.
MAX_BITS = 1 << 26
MAX_LEVELS = 40


@dataclass(frozen=True)
class Shape:
    """A key shape: the last ``labels`` host labels and ``chars`` path characters."""
    labels: int
    chars: int

    def key(self, host: Column, path: Column) -> Column:
        """The url's key of this shape; null if the url has none."""
        dots = F.length(host) - F.length(F.replace(host, F.lit("."), F.lit("")))
        key = F.concat(F.substring_index(host, ".", -self.labels), F.substring(path, 1, self.chars))
        return F.when((host != "") & (dots >= self.labels - 1) & (F.length(path) >= self.chars), key)


def shape_of(host: str, path: str) -> Shape:
    return Shape(host.count(".") + 1, len(path))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://``, A-Z lower-cased) and path; both empty without ``://``."""
    pattern = r"://([^/?#]*)([^?#]*)"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    url = F.coalesce(url, F.lit(""))
    return (F.translate(F.regexp_extract(url, pattern, 1), upper, lower),
            F.regexp_extract(url, pattern, 2))


def _positions(key: Column, level: int, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(i)), F.lit(bits)) for i in range(HASHES)]


@dataclass(frozen=True)
class Level:
    number: int
    bits: int
    words: tuple[int, ...]

    def contains(self, key: Column) -> Column:
        words = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")  # folded once
        hit = None
        for pos in _positions(key, self.number, self.bits):
            word = F.element_at(words, (F.floor(pos / 64) + 1).cast("int"))
            bit = F.getbit(word, F.pmod(pos, F.lit(64)).cast("int")) == 1
            hit = bit if hit is None else hit & bit
        return hit


def _encode(keys: DataFrame, level: int, n: int) -> Level:
    """One level over ``n`` distinct keys; the words are OR-ed in Spark."""
    bits = max(64, 64 * math.ceil(n * BITS_PER_KEY / 64))
    if bits > MAX_BITS:
        raise ValueError(f"{n} keys need {bits} bits, more than {MAX_BITS}: join the list by key")
    rows = (keys.select(F.explode(F.array(*_positions(F.col("key"), level, bits))).alias("pos"))
            .groupBy(F.floor(F.col("pos") / 64).alias("w"))
            .agg(F.bit_or(F.expr("shiftleft(1L, CAST(pmod(pos, 64) AS INT))")).alias("v"))
            .collect())  # at most MAX_BITS / 64 numbers
    words = [0] * (bits // 64)
    for r in rows:
        words[r["w"]] = r["v"]
    return Level(level, bits, tuple(words))


class Cascade:
    """Exact membership in ``listed`` for every key of ``universe``."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    @classmethod
    def build(cls, universe: DataFrame) -> Cascade:
        """``universe``: distinct ``key`` strings with a boolean ``listed``."""
        levels: list[Level] = []
        inside, outside = universe.filter("listed"), universe.filter("NOT listed")
        n = inside.count()
        while n:
            if len(levels) == MAX_LEVELS:
                raise ValueError("the cascade does not converge")
            level = _encode(inside, len(levels) + 1, n)
            levels.append(level)
            # What passes by mistake is what the next level encodes.
            inside, outside = outside.filter(level.contains(F.col("key"))), inside
            if len(levels) % 8 == 0:
                inside, outside = materialize(inside, "cascade"), materialize(outside, "cascade")
            n = inside.count()
        return cls(levels)

    def contains(self, key: Column) -> Column:
        """False for a null key.  Level 1 fails: unlisted; level 2 fails: listed; ..."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            answer = F.when(level.contains(key), answer).otherwise(F.lit(level.number % 2 == 0))
        return F.coalesce(F.when(key.isNotNull(), answer), F.lit(False)) if self.levels else F.lit(False)


def universe(urls: DataFrame, shapes: set[Shape], listed: set[str], spark: SparkSession) -> DataFrame:
    """Distinct keys of all urls (columns host, path) in ``shapes``, marked if listed."""
    keys = F.array_compact(F.array(*[s.key(F.col("host"), F.col("path")) for s in sorted(shapes, key=lambda s: (s.labels, s.chars))]))
    corpus = urls.select(F.explode(keys).alias("key"), F.lit(False).alias("listed"))
    marks = spark.createDataFrame([(k, True) for k in sorted(listed)], "key string, listed boolean")
    return corpus.union(marks).groupBy("key").agg(F.max("listed").alias("listed"))


def judge(df: DataFrame, rules=RULES, blocked_hosts=BLOCKED_HOSTS) -> DataFrame:
    """Add host, path, rule and verdict to every row by its ``url``.

    The longest fitting rule decides; without one, a url on a blocked host (or
    a subdomain) is blocked and any other allowed.  A null url, or one without
    ``://``, has empty host and path, fits nothing and is allowed; repeated rows
    are each judged; an empty table stays empty; extra columns named like an
    output are replaced."""
    df = without(df, "host", "path", "rule", "verdict")
    host, path = host_and_path(F.col("url"))
    df = df.withColumns({"host": host, "path": path})
    lists = {"block": {h + p for h, p, v in rules if v == "block"}, "allow": {h + p for h, p, v in rules if v == "allow"},
             "hosts": set(blocked_hosts)}
    shapes = {"block": {shape_of(h, p) for h, p, v in rules if v == "block"},
              "allow": {shape_of(h, p) for h, p, v in rules if v == "allow"},
              "hosts": {shape_of(h, "") for h in blocked_hosts}}
    h, p = F.col("host"), F.col("path")
    found: dict[str, list[tuple[Shape, Column]]] = {}
    for name, keys in lists.items():
        if not keys:
            found[name] = []
            continue
        known = materialize(universe(df.select("host", "path"), shapes[name], keys, df.sparkSession), "keys")
        cascade = Cascade.build(known)
        found[name] = [(s, F.when(cascade.contains(s.key(h, p)), s.key(h, p))) for s in shapes[name]]
    fits = [c for name in ("block", "allow") for _, c in found[name]]
    longest = F.array_sort(F.array_compact(F.array(*fits, F.lit(None).cast("string"))),
                           lambda x, y: F.length(y) - F.length(x))
    blocked = F.lit(False)
    for _, c in found["hosts"]:
        blocked = blocked | c.isNotNull()
    df = df.withColumn("rule", F.get(longest, F.lit(0)))
    said = F.lit(None).cast("string")
    for host_, path_, verdict in rules:
        said = F.when(F.col("rule") == host_ + path_, verdict).otherwise(said)
    return df.withColumn("verdict", F.coalesce(said, F.when(blocked, "block").otherwise("allow")))


def query(spark, sf_dir):
    """op6: every page's url."""
    return judge(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


_HOST = "translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE = f"""
WITH u AS (
  SELECT page_id, {_HOST} AS host, regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
r AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM u)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
    WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
    WHEN host IN ('ads-track.example.com', 'adult-x.example.com', 'casino-win.example.net', 'cheap-pills.example.net',
                  'free-bets.example.net', 'spam-farm.example.org')
      OR ends_with(host, '.ads-track.example.com') OR ends_with(host, '.adult-x.example.com')
      OR ends_with(host, '.casino-win.example.net') OR ends_with(host, '.cheap-pills.example.net')
      OR ends_with(host, '.free-bets.example.net') OR ends_with(host, '.spam-farm.example.org') THEN 'block'
    ELSE 'allow' END AS verdict
FROM r
"""
