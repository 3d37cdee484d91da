"""URL filters: path rules, and a cascade of Bloom filters for exact membership in a list.

Level 1 holds the listed keys; each further level holds the false positives of the level
before among all keys of the corpus, until there are none. A key is judged by the first level
that does not have it, which is exact for every key of that universe. Levels are arrays of
64-bit words, made and asked by Spark expressions; nothing is joined to the pages. A list too
large for one cascade's words is dealt by hash into parts, each with its own cascade, so a
task never holds more than one part's words.

Defined results: a null url, or one without ://, has an empty host and path, fits no rule and
has the empty key; a null listed key is ignored; an empty list lists nothing; repeated rows get
equal verdicts; an empty table gives no rows; result columns replace input columns of the same
name, and working columns take names that the input does not have. A very long url costs time
in proportion.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brontide.llm.common import free_names, new_path, text_of, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bits of a first level; a larger list is dealt into parts of about so many.
MAX_BITS = 1 << 28
MAX_LEVELS = 64
Rule = tuple[str, str, str]  # host, path, allow or block


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fits(rule: Rule, host: Column, path: Column) -> Column:
    own = (host == rule[0]) | F.endswith(host, F.lit(f".{rule[0]}"))
    return own & F.startswith(path, F.lit(rule[1]))


def longest_rule(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r[0] + r[1])):
        name = F.when(fits(rule, host, path), F.lit(rule[0] + rule[1])).otherwise(name)
        verdict = F.when(fits(rule, host, path), F.lit(rule[2])).otherwise(verdict)
    return name, verdict


class Level:
    """One filter: bits, hash functions, and the path of its words."""

    def __init__(self, number: int, bits: int, hashes: int, path: str):
        self.number, self.bits, self.hashes, self.path = number, bits, hashes, path

    def positions(self, key: Column) -> list[Column]:
        a, b = (F.xxhash64(key, F.lit(2 * self.number + i)) for i in (0, 1))
        step = F.call_function("shiftright", b, F.lit(1)).bitwiseOR(F.lit(1).cast("long"))
        return [F.pmod(F.call_function("shiftright", a, F.lit(2)) + F.pmod(step, F.lit(self.bits)) * i, F.lit(self.bits)) for i in range(self.hashes)]

    def build(self, keys: DataFrame) -> None:
        """Writes the array of words for the column key of keys."""
        spark = keys.sparkSession
        at = keys.select(F.explode(F.array(*self.positions(F.col("key")))).alias("p"))
        one = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("p") % 64).cast("int"))
        words = at.groupBy(F.floor(F.col("p") / 64).alias("id")).agg(F.bit_or(one).alias("word"))
        full = spark.range(-(-self.bits // 64)).join(words, "id", "left").select(F.struct("id", F.coalesce("word", F.lit(0).cast("long")).alias("word")).alias("x"))
        row = full.agg(F.array_sort(F.collect_list("x")).alias("x")).select(F.transform("x", lambda x: x["word"]).alias("words"))
        row.write.parquet(self.path)

    def has(self, spark, key: Column) -> Column:
        words = spark.read.schema("words array<bigint>").parquet(self.path).scalar()
        out = F.lit(True)
        for p in self.positions(key):
            bit = F.call_function("shiftright", F.get(words, F.floor(p / 64).cast("int")), (p % 64).cast("int"))
            out = out & (bit.bitwiseAND(F.lit(1).cast("long")) == 1)
        return out


class Cascade:
    """Exact membership for every key of the universe it was built over."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    def listed(self, spark, key: Column) -> Column:
        out = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            out = F.when(~level.has(spark, key), F.lit(level.number % 2 == 0)).otherwise(out)
        return out


def _first_level(size: int, rest: int) -> tuple[float, int]:
    """Rate of false positives and bits: as sharp as makes false positives few beside the list."""
    p = min(0.5, size / (rest * math.sqrt(2)) if rest else 0.5)
    return p, max(64, math.ceil(size * math.log2(1 / p) / math.log(2)))


def build_cascade(inside: DataFrame, outside: DataFrame, size: int, rest: int) -> Cascade:
    """inside and outside: the distinct listed keys and the other keys of the universe, as key;
    size and rest: their numbers."""
    spark = inside.sparkSession
    levels: list[Level] = []
    held, others = inside, outside
    while size:
        if len(levels) >= MAX_LEVELS:
            raise RuntimeError("the cascade does not end")
        p, bits = _first_level(size, rest) if not levels else (0.5, max(64, math.ceil(size / math.log(2))))
        level = Level(len(levels) + 1, bits, max(1, round(math.log2(1 / p))), new_path(spark, "bloom"))
        level.build(held)
        levels.append(level)
        wrong = written(others.where(level.has(spark, F.col("key"))), "false-positives")
        held, others = wrong, held
        size, rest = wrong.count(), size
    return Cascade(levels)


def _part(key: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("part")), F.lit(parts)).cast("int")


def build_cascades(keys: DataFrame) -> list[Cascade]:
    """A cascade for each part of the universe by hash. keys: distinct, as key and listed."""
    keys = written(keys, "universe")
    n = {r["listed"]: r["count"] for r in keys.groupBy("listed").count().collect()}
    if not n.get(True):
        return []
    parts = -(-_first_level(n[True], n.get(False, 0))[1] // MAX_BITS)
    if parts == 1:
        return [build_cascade(keys.where("listed").select("key"), keys.where("NOT listed").select("key"), n[True], n.get(False, 0))]
    dealt = written(keys.withColumn("part", _part(F.col("key"), parts)), "parts")
    counts = {(r["part"], r["listed"]): r["count"] for r in dealt.groupBy("part", "listed").count().collect()}
    own = lambda k, inside: dealt.where((F.col("part") == k) & (F.col("listed") == inside)).select("key")
    return [build_cascade(own(k, True), own(k, False), counts.get((k, True), 0), counts.get((k, False), 0)) for k in range(parts)]


def filter_urls(pages: DataFrame, rules: list[Rule], listed: DataFrame | None = None, url_col: str = "url") -> DataFrame:
    """pages with host, path, rule, listed and verdict (allow or block).

    listed: blocked keys in a column key; a key is host and path, joined. A url that fits a
    rule has the longest one's verdict; any other is blocked if its key is listed.
    """
    spark = pages.sparkSession
    url = F.col(url_col).cast("string")
    own_url, own_verdict = free_names(pages, "given_url", "rule_verdict")
    out = pages.withColumn(own_url, url)
    out = out.withColumns({"host": host_of(F.col(own_url)), "path": path_of(F.col(own_url))}).drop(own_url)
    name, verdict = longest_rule(rules, F.col("host"), F.col("path"))
    out = out.withColumns({"rule": name, own_verdict: verdict})
    key = F.concat("host", "path")
    cascades: list[Cascade] = []
    if listed is not None:
        own = listed.select(F.col("key").cast("string")).where("key IS NOT NULL")
        universe = out.select(key.alias("key"), F.lit(False).alias("listed")).union(own.select("key", F.lit(True).alias("listed")))
        cascades = build_cascades(universe.groupBy("key").agg(F.max("listed").alias("listed")))
    if len(cascades) <= 1:
        out = out.withColumn("listed", cascades[0].listed(spark, key) if cascades else F.lit(False))
    else:
        # One pass for each part, so that no task holds the words of several.
        parts = [out.where(_part(key, len(cascades)) == k).withColumn("listed", x.listed(spark, key)) for k, x in enumerate(cascades)]
        out = reduce(DataFrame.union, parts)
    method = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return out.withColumn("verdict", F.coalesce(own_verdict, method)).drop(own_verdict)


#: Words of hosts whose pages the registered query lists.
SPAM_WORDS = ("casino", "pills", "bets")


def spam_keys(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Keys of all pages on hosts that carry a spam word."""
    url = text_of(url_col)
    return pages.where(host_of(url).rlike("|".join(SPAM_WORDS))).select(F.concat(host_of(url), path_of(url)).alias("key")).distinct()
