"""URL lists: a blocked Bloom filter in front of an exact hash join.

Keys that a list may hold are cut from each URL (one per host suffix and listed
path length, or the canonical URL itself).  The filter has one row of eight
64-bit words per block; a key sets one bit in each word of its block.  Keys that pass
are joined exactly, which removes the false positives.  Only the filter, whose
size is measured, is sent to every task; a large one is joined by block.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsubo.operators.lookup import attach
from tsubo.sources.staging import measure, stage

WORDS = 8
# Bits per key, before rounding the number of blocks up.
BITS_PER_KEY = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Verdict, host and path prefix.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
ALLOW, BLOCK = "allow", "block"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.regexp_extract(_after(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path(url: Column) -> Column:
    """From the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1)


def _after(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host without ``www.``, ``m.``; path without a page suffix or closing slashes."""
    return F.concat(F.regexp_replace(host, r"^(www|m)\.", ""), F.regexp_replace(path, r"(\.html?|/+)$", ""))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks).cast("bigint"))


def _bit(key: Column, word: int) -> Column:
    """The one bit that a key sets in a word of its block."""
    place = F.pmod(F.xxhash64(F.lit(word), key), F.lit(64).cast("bigint")).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)


def bloom(keys: DataFrame, blocks: int) -> DataFrame:
    """``block, w0 ... w7`` of the distinct ``key`` column; blocks without a key have no row."""
    bits = keys.select(_block(F.col("key"), blocks).alias("block"), *(_bit(F.col("key"), w).alias(f"w{w}") for w in range(WORDS)))
    return bits.groupBy("block").agg(*(F.bit_or(f"w{w}").alias(f"w{w}") for w in range(WORDS)))


def listed(probes: DataFrame, entries: DataFrame) -> DataFrame:
    """Rows of ``probes`` whose ``key`` is in ``entries``, with the other columns of ``entries``.

    ``entries`` has one row per ``key``.  NULL keys are in no list.  The exact
    join shuffles only what passes the filter.
    """
    entries = stage(entries, "listed")
    size = measure(entries)
    blocks = max(1, -(-size.rows * BITS_PER_KEY // (64 * WORDS)))
    words = stage(bloom(entries.select("key"), blocks), "bloom")
    marked = probes.filter(F.col("key").isNotNull()).withColumn("block", _block(F.col("key"), blocks))
    passed = attach(marked, words, ["block"], "inner")
    hits = reduce(lambda a, b: a & b, (F.col(f"w{w}").bitwiseAND(_bit(F.col("key"), w)) != 0 for w in range(WORDS)))
    passed = passed.filter(hits).select(*probes.columns)
    return passed.join(entries, "key")


def rule_keys(pages: DataFrame, lengths: DataFrame) -> DataFrame:
    """``url_key, key``: each host suffix with each listed length of path prefix.

    ``lengths`` is one row, ``lengths``: all different path lengths of the
    rules.  Suffixes begin at the host or after a dot.
    """
    dots = F.split("host", r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(dots)), lambda i: F.array_join(F.slice(dots, i, F.size(dots)), "."))
    prefixes = F.transform(F.filter("lengths", lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    keyed = pages.crossJoin(F.broadcast(lengths)).withColumns({"suffixes": suffixes, "prefixes": prefixes})
    opened = keyed.select("url_key", F.explode_outer("suffixes").alias("suffix"), "prefixes").select("url_key", "suffix", F.explode_outer("prefixes").alias("prefix"))
    return opened.select("url_key", F.concat("suffix", "prefix").alias("key"))


def rules_table(spark, rules=RULES) -> DataFrame:
    rows = [(h + p, v, len(h) + len(p), len(p)) for v, h, p in rules]
    return spark.createDataFrame(rows, "key STRING, verdict STRING, length INT, path_length INT")


def judge(pages: DataFrame, rules: DataFrame, blocklist: DataFrame, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict`` per row of ``pages``.

    ``rules`` has ``key`` (host and path prefix), ``verdict``, ``length`` and
    ``path_length``: a rule fits its host and all subdomains where the path
    starts with the rule's; the longest wins, of equally long ones the first in
    text order.  Without a rule the canonical URL decides: block if
    ``blocklist`` (a ``key`` column) holds it, else allow.  A NULL url, or one
    without ``://``, has empty host and path, no rule, and is allowed.  Repeated
    rows and ids are rows of their own; other columns are not read.

    Each different (host, path) is judged once, so a hot host costs no more than its paths.
    """
    rows = pages.select(F.col(page_id).alias("page_id"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    rows = rows.withColumns({c: F.coalesce(c, F.lit("")) for c in ("host", "path")}).withColumn("url_key", F.xxhash64("host", "path"))
    urls = stage(rows.select("url_key", "host", "path").distinct().filter("host != '' OR path != ''"), "urls")
    lengths = rules.agg(F.collect_set("path_length").alias("lengths"))
    # a URL without a host has no rule, but may be listed
    fits = listed(rule_keys(urls.filter("host != ''"), lengths), rules.select("key", "verdict", "length", "path_length").dropDuplicates(["key"]))
    by_rule = fits.groupBy("url_key").agg(F.min(F.struct((-F.col("length")).alias("order"), "key", "verdict")).alias("best"))
    by_rule = stage(by_rule.select("url_key", F.col("best.key").alias("rule"), F.col("best.verdict").alias("rule_verdict")), "by_rule")
    names = urls.select("url_key", canonical(F.col("host"), F.col("path")).alias("key"))
    blocked = stage(listed(names, blocklist.select("key").filter("key IS NOT NULL").distinct()).select("url_key").distinct().withColumn("blocked", F.lit(True)), "blocked")
    out = attach(attach(rows, by_rule, ["url_key"]), blocked, ["url_key"])
    verdict = F.coalesce("rule_verdict", F.when(F.col("blocked"), BLOCK).otherwise(ALLOW))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"))


def mirrored(pages: DataFrame, url: str = "url") -> DataFrame:
    """``key``: canonical URLs that stand under more than one different URL, a list for ``judge``."""
    names = pages.select(F.col(url).alias("url"), canonical(host(F.col(url)), path(F.col(url))).alias("key")).filter(F.col("key") != "")
    return names.groupBy("key").agg(F.min("url").alias("a"), F.max("url").alias("b")).filter("a != b").select("key")
