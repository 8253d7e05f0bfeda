"""Operator 2: URL filters with Bloom filter cascades.

Every key that some url of the corpus could be listed under (its universe: host
suffixes with path prefixes, and host suffixes alone) is known.  The first
filter of a cascade encodes the listed keys; the next one the keys of the
universe that pass it wrongly; the next one the listed keys that pass that one;
and so on until nothing passes wrongly.  Membership is then exact for every key
of the universe and is one expression on the row: nothing is joined.

Filters are bitmaps built by Spark's bitmap aggregates and sized at ``BITS`` bits
a key; a list beyond ``MOST_BITS`` is refused rather than broadcast.

A null url, or one without ``://``, has an empty host and path, fits no rule and
is allowed.  Repeated rows are judged alike; an empty table gives no rows.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

BITS, HASHES, MOST_BITS, MOST_LEVELS = 12, 6, 1 << 25, 40
#: Bits of one bitmap of Spark's bitmap aggregates.
BITMAP = 32_768

#: Hosts with one of these labels (or parts of a label between hyphens) are listed unless a rule says otherwise.
LISTED_LABELS = ("ad", "ads", "adserver", "banner", "casino", "click", "malware", "phish", "porn", "spam", "track", "tracker", "tracking")


@dataclass(frozen=True)
class Rule:
    action: str
    host: str
    path: str

    @property
    def key(self) -> str:
        return self.host + self.path


#: The rules of the registered query.
RULES = (
    Rule("block", "com", "/en/"),
    Rule("allow", "example.com", "/en/7"),
    Rule("allow", "net", "/de/"),
    Rule("block", "example.net", "/de/8"),
    Rule("block", "org", "/es/"),
)


@dataclass(frozen=True)
class Filter:
    """A Bloom filter; ``words`` holds its bits, 64 to a word."""

    level: int
    bits: int
    words: tuple[int, ...]

    @staticmethod
    def places(key: Column, level: int, bits: int) -> Column:
        return F.array(*[F.pmod(F.xxhash64(key, F.lit(level), F.lit(i)), F.lit(bits).cast("long")) for i in range(HASHES)])

    @classmethod
    def of(cls, keys: DataFrame, level: int, n: int) -> Filter:
        bits = -(-max(1, n * BITS) // BITMAP) * BITMAP
        if bits > MOST_BITS:
            raise ValueError(f"{n} keys need {bits} bits; at most {MOST_BITS} are broadcast")
        place = keys.select(F.explode(cls.places(F.col("key"), level, bits)).alias("p")).select(F.expr(f"p div {BITMAP}").alias("part"), F.expr(f"p % {BITMAP}").alias("p"))
        words = np.zeros(bits // 64, "<i8")
        for row in place.groupBy("part").agg(F.expr("bitmap_construct_agg(p)").alias("bitmap")).collect():
            words[row.part * BITMAP // 64 : (row.part + 1) * BITMAP // 64] = np.frombuffer(row.bitmap, "<i8")
        return cls(level, bits, tuple(words.tolist()))

    def passes(self, key: Column) -> Column:
        words = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<long>")
        out = None
        for i in range(HASHES):
            place = F.pmod(F.xxhash64(key, F.lit(self.level), F.lit(i)), F.lit(self.bits).cast("long"))
            one = F.getbit(F.get(words, F.shiftright(place, 6).cast("int")), (place % 64).cast("int")) == 1
            out = one if out is None else out & one
        return out


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Filter, ...]

    @classmethod
    def of(cls, universe: DataFrame) -> Cascade:
        """``universe``: distinct keys with ``listed``; read a few times, so a written table."""
        inside, outside, levels = universe.where("listed").select("key"), universe.where("not listed").select("key"), []
        n = inside.count()
        while n:
            if len(levels) == MOST_LEVELS:
                raise ValueError("the cascade does not end")
            levels.append(Filter.of(inside, len(levels), n))
            inside, outside = outside.where(levels[-1].passes(F.col("key"))), inside
            n = inside.count()
        return cls(tuple(levels))

    def holds(self, key: Column) -> Column:
        out = F.lit(False)
        for level in reversed(self.levels):
            out = level.passes(key) & ~out
        return out


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def suffixes(host: Column, labels: list[int]) -> Column:
    """The last so many labels of a host."""
    return F.array_distinct(F.array(*[F.substring_index(host, ".", -n) for n in labels]))


def rule_keys(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The keys of a url that a rule could have, the longest first, a longer host before a shorter one."""
    labels = sorted({r.host.count(".") + 1 for r in rules}, reverse=True)
    lengths = sorted({len(r.path) for r in rules}, reverse=True)
    prefixes = F.array_distinct(F.filter(F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]), lambda p: p.isNotNull()))
    keys = F.flatten(F.transform(suffixes(host, labels), lambda h: F.transform(prefixes, lambda p: F.concat(h, p))))
    return F.array_distinct(F.array_sort(keys, lambda a, b: F.length(b) - F.length(a)))


def judged(pages: DataFrame, listed_hosts: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, host, path, rule and verdict of each row of ``pages`` (page_id, url).

    ``listed_hosts`` (host) are blocked together with their subdomains where no rule fits.
    """
    spark = pages.sparkSession
    urls = common.staged(pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")), "urls")
    host, path = F.col("host"), F.col("path")
    known = {action: [r.key for r in rules if r.action == action] for action in ("block", "allow")}
    cascades = {}
    if rules:
        universe = common.staged(urls.select(F.explode(rule_keys(host, path, rules)).alias("key")).distinct(), "rule-keys")
        cascades = {action: Cascade.of(universe.withColumn("listed", F.col("key").isin(keys))) for action, keys in known.items()}
    hosts = urls.where("host <> ''").select("host").distinct()
    all_suffixes = F.transform(F.sequence(F.lit(1), F.size(F.split(host, "\\."))), lambda n: F.call_function("substring_index", host, F.lit("."), -n))
    if listed_hosts is None:
        listed_hosts = hosts.where(host.rlike(rf"(^|[.-])({'|'.join(LISTED_LABELS)})([.-]|$)"))
    suffix_universe = hosts.select(F.explode(all_suffixes).alias("key")).distinct()
    listed = listed_hosts.select(F.col("host").alias("key")).where("key is not null").distinct().withColumn("listed", F.lit(True))
    on_list = Cascade.of(common.staged(suffix_universe.join(listed, "key", "left").na.fill(False, ["listed"]), "host-keys"))
    rule = F.lit(None).cast("string")
    if rules:
        either = lambda key: cascades["block"].holds(key) | cascades["allow"].holds(key)
        rule = F.get(F.filter(rule_keys(host, path, rules), either), 0)
    found = urls.withColumn("rule", rule)
    by_rule = F.when(cascades["block"].holds(F.col("rule")), "block").otherwise("allow") if rules else F.lit("allow")
    by_list = F.when(F.exists(all_suffixes, on_list.holds), "block").otherwise("allow")
    del spark
    return found.withColumn("verdict", F.when(F.col("rule").isNotNull(), by_rule).otherwise(by_list))
