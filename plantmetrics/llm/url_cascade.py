"""Judge urls by a few rules and by a list of any length, which a cascade of Bloom filters makes exact.

The first filter holds the listed keys that occur in the corpus, the second those unlisted keys of the corpus that
the first takes for listed, the third the listed keys that the second holds by mistake, and so on until no mistake
is left. All keys of the corpus take part, so for these the cascade's answer is exact, and pages need no join: the
filters travel as literals inside the expression. DataFrame functions only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantmetrics.sources import stage

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
WORD_BITS = 64


@dataclass(frozen=True)
class UrlRule:
    """``host`` and its subdomains, if the url's path begins with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the query, and the hosts on its block list (all paths, subdomains too).
RULES = (
    UrlRule("block", "net", "/"),
    UrlRule("allow", "example.net", "/en/"),
    UrlRule("block", "example.com", "/de/"),
    UrlRule("allow", "org", "/fr/"),
)
BLOCKED_HOSTS = tuple(
    f"{name}.example.{top}"
    for name in ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")
    for top in ("com", "net", "org")
)


@dataclass(frozen=True)
class CascadeSettings:
    #: Bits of the largest filter that is shipped. A list that needs more is joined by key instead.
    max_bits: int = 1 << 26
    #: Share of wrong answers from the second filter on.
    rate: float = 0.5


@dataclass(frozen=True)
class Level:
    """One Bloom filter; its words are a literal."""

    number: int
    bits: int
    hashes: int
    keys: int
    words: tuple[int, ...]

    def positions(self, key: Column) -> list[Column]:
        return _positions(key, self.number, self.bits, self.hashes)

    def holds(self, key: Column) -> Column:
        # folded by the optimizer to one literal array
        words = F.split(F.lit(" ".join(map(str, self.words))), " ").cast("array<bigint>")
        found = F.lit(True)
        for at in self.positions(key):
            word = F.get(words, F.floor(at / WORD_BITS).cast("int"))
            found = found & (F.getbit(word, F.pmod(at, F.lit(WORD_BITS)).cast("int")) == 1)
        return found


def _positions(key: Column, number: int, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(number), F.lit(k)), F.lit(bits)) for k in range(hashes)]


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def holds(self, key: Column) -> Column:
        """Whether ``key`` is listed; exact for every key of the corpus that the cascade was made of.

        A key passes the filters up to the first that doesn't hold it: it is listed if that one encodes
        unlisted keys (an even number), or if it passes all and the last one encodes listed keys.
        """
        listed = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            listed = F.when(level.holds(key), listed).otherwise(F.lit(level.number % 2 == 0))
        return listed


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): the host after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; the
    path from there up to ``?``, ``#`` or the end. Both empty for a null url or one without ``://``.
    """
    host, path = (F.coalesce(F.regexp_extract(url, URL, k), F.lit("")) for k in (1, 2))
    return F.translate(host, CAPITALS, SMALL), path


def _labels(host: Column) -> Column:
    return F.size(F.split(host, r"\."))


def candidate_keys(host: Column, path: Column, shapes: Sequence[tuple[int, int]]) -> Column:
    """The keys under which a url can be listed: its last ``labels`` labels and the first ``length`` characters of
    its path, for each (labels, length) in ``shapes`` that the url has; longest first as ``shapes`` are.
    """
    if not shapes:
        return F.array().cast("array<string>")
    pairs = F.array(*(F.struct(F.lit(n).alias("labels"), F.lit(m).alias("length")) for n, m in shapes))
    fits = F.filter(pairs, lambda p: (p["labels"] <= _labels(host)) & (p["length"] <= F.length(path)))

    def key(p: Column) -> Column:
        suffix = F.call_function("substring_index", host, F.lit("."), -p["labels"])
        return F.concat(suffix, F.substring(path, F.lit(1), p["length"]))

    return F.transform(fits, key)


def rule_of(host: Column, path: Column, rules: Sequence[UrlRule]) -> Column:
    """Index of the rule that fits: the longest (host and path together; among equals the longer host), else null."""
    order = sorted(range(len(rules)), key=lambda k: (-len(rules[k].name), -len(rules[k].host), k))
    found = F.lit(None).cast("int")
    for k in reversed(order):
        one = rules[k]
        inside = (host == one.host) | host.endswith("." + one.host)
        found = F.when(inside & path.startswith(one.path), F.lit(k)).otherwise(found)
    return found


def _level(encoded: DataFrame, number: int, bits: int, hashes: int, keys: int) -> Level:
    """The filter that holds the keys of ``encoded``; at most ``bits / 64`` words come to the driver."""
    spots = encoded.select(F.explode(F.array(*_positions(F.col("key"), number, bits, hashes))).alias("at"))
    word = F.floor(F.col("at") / WORD_BITS).cast("int")
    mask = F.expr(f"shiftleft(1L, CAST(pmod(at, {WORD_BITS}L) AS INT))")
    rows = spots.groupBy(word.alias("word")).agg(F.bit_or(mask).alias("set")).collect()
    words = [0] * -(-bits // WORD_BITS)
    for row in rows:
        words[row["word"]] = row["set"]
    return Level(number, bits, hashes, keys, tuple(words))


def build_cascade(universe: DataFrame, settings: CascadeSettings = CascadeSettings()) -> Cascade | None:
    """The cascade of ``universe`` (``key`` distinct, ``listed``: written, all keys of the corpus); None if its first
    filter would need more than ``max_bits``.

    The first filter's share of wrong answers follows from the counts, so that about as many unlisted keys pass
    as there are listed ones; those of the later filters halve the rest. Every filter hashes anew, so the number
    of levels grows with the logarithm of the listed keys.
    """
    levels: list[Level] = []
    while True:
        number = len(levels) + 1
        rest = universe
        for level in levels:
            rest = rest.where(level.holds(F.col("key")))
        counts = {row["listed"]: row["count"] for row in rest.groupBy("listed").count().collect()}
        encodes = number % 2 == 1
        here, others = counts.get(encodes, 0), counts.get(not encodes, 0)
        if not here:
            return Cascade(tuple(levels))
        rate = settings.rate if levels else min(settings.rate, here / max(1, others) / math.sqrt(2))
        hashes = max(1, round(-math.log2(rate)))
        bits = max(WORD_BITS, math.ceil(-here * math.log(rate) / math.log(2) ** 2))
        if bits > settings.max_bits:
            if levels:
                raise ValueError(f"filter {number} of the cascade needs {bits} bits: raise max_bits")
            return None
        levels.append(_level(rest.where(F.col("listed") == encodes), number, bits, hashes, here))


def key_universe(parts: DataFrame, listed: DataFrame, shapes: Sequence[tuple[int, int]]) -> DataFrame:
    """``(key, listed)``: each key that a url of ``parts`` (``host``, ``path``) can be listed under, once.

    Keys are combined before the shuffle, so a hot host costs no task more than others. Listed keys that no url has are left out.
    """
    longest = max((m for _, m in shapes), default=0)
    hosts = parts.select("host", F.substring("path", 1, longest).alias("path")).distinct()
    found = hosts.select(F.explode(candidate_keys(F.col("host"), F.col("path"), shapes)).alias("key"))
    both = found.select("key", F.lit(True).alias("seen"), F.lit(False).alias("listed")).unionByName(
        listed.select("key", F.lit(False).alias("seen"), F.lit(True).alias("listed"))
    )
    keys = both.groupBy("key").agg(F.max("seen").alias("seen"), F.max("listed").alias("listed"))
    return keys.where("seen").select("key", "listed")


def listed_hosts(spark: SparkSession, hosts: Sequence[str]) -> DataFrame:
    """A block list ``(host, path)`` of whole hosts."""
    names = F.array(*map(F.lit, hosts)).cast("array<string>")
    return spark.range(1).select(F.explode(names).alias("host"), F.lit("").alias("path"))


def judge_urls(
    pages: DataFrame,
    listed: DataFrame,
    rules: Sequence[UrlRule] = RULES,
    settings: CascadeSettings = CascadeSettings(),
    *,
    page_id: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, listed, verdict``.

    The longest rule that fits decides, else the block list: a url is blocked if ``listed`` has a key that fits it
    (its host or a parent domain, and a prefix of its path; an empty path fits all), else allowed. ``rules`` are
    few and go into the expression; ``listed`` is a table of any length (columns ``host`` in lower case, ``path``;
    null hosts are ignored, a null path is empty, repeated keys count once).

    A null url, or one without ``://``, has an empty host and path and is allowed. Repeated rows give repeated
    rows, other columns are ignored, an empty table gives an empty result, an empty list blocks nothing. Of rules
    of one length the one with the longer host wins, then the earlier.

    Pages are read twice (keys, verdicts) and never shuffled; only their distinct keys are.
    """
    host, path = split_url(F.col(url))
    parts = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    entries = listed.where("host IS NOT NULL").select("host", F.coalesce("path", F.lit("")).alias("path"))
    keys = entries.select(F.concat("host", "path").alias("key"))
    # as many shapes as there are combinations of a label count and a path length in the list
    shape = entries.select(_labels(F.col("host")).alias("labels"), F.length("path").alias("length")).distinct()
    shapes = sorted(((row["labels"], row["length"]) for row in shape.collect()), reverse=True)
    universe = stage(key_universe(parts, keys, shapes), "url-keys")
    cascade = build_cascade(universe, settings)
    if cascade is None:
        parts = _listed_by_join(parts, universe, shapes)
    else:
        mine = candidate_keys(F.col("host"), F.col("path"), shapes)
        parts = parts.withColumn("listed", F.exists(mine, cascade.holds))
    number = rule_of(F.col("host"), F.col("path"), rules)
    names = F.array(*(F.lit(one.name) for one in rules)).cast("array<string>")
    verdicts = F.array(*(F.lit(one.verdict) for one in rules)).cast("array<string>")
    by_list = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return parts.withColumn("number", number).select(
        "page_id",
        "host",
        "path",
        F.get(names, F.col("number")).alias("rule"),
        "listed",
        F.coalesce(F.get(verdicts, F.col("number")), by_list).alias("verdict"),
    )


def _listed_by_join(parts: DataFrame, universe: DataFrame, shapes: Sequence[tuple[int, int]]) -> DataFrame:
    """``parts`` with ``listed`` for a list too long to ship: distinct (host, path) are joined by key."""
    where = universe.where("listed").select("key")
    urls = parts.select("host", "path").distinct()
    keyed = urls.select("host", "path", F.explode(candidate_keys(F.col("host"), F.col("path"), shapes)).alias("key"))
    hit = keyed.join(where, "key", "left_semi").select(F.col("host").alias("h"), F.col("path").alias("p")).distinct()
    same = (F.col("host") == F.col("h")) & (F.col("path") == F.col("p"))
    return parts.join(hit, same, "left").withColumn("listed", F.col("h").isNotNull()).drop("h", "p")
