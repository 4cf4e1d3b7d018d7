"""URL filter: a blocked Bloom filter of listed canonical URLs in front of an exact hash join.

A listed URL is a host and the beginning of a path; it fits that host and its subdomains. A page's url gives a key
for each ending of its host, at a dot, that is as long as some listed host, with each beginning of its path that is as
long as some listed path: the list bounds the keys of a page, however long its url is. Keys go through
the filter: blocks of eight 32-bit words, each key sets one bit in each word of one block. What passes is joined
with the list by key, which removes false positives, and the longest fit decides.

The filter never exceeds MAX_FILTER_BYTES (a longer list makes it let more through, no more), so it is broadcast.
The list itself is broadcast up to BROADCAST_RULES entries; beyond that the join is by shuffle, with every rule
copied SALT times so that a key that a third of all pages hit is spread.

Defined results: a null url, or one without `://`, has an empty host and path; such pages, and pages nothing fits,
have a null rule and the verdict `default`. Repeated rows and null ids are returned as often as given. Of rules
with the same host and path `allow` wins; of fits of equal length the longer host wins. Null hosts or paths in the
list are empty. No column but page_id and url is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITS_PER_KEY, BLOCK_WORDS = 16, 8
MAX_FILTER_BYTES = 16 << 20
BROADCAST_RULES = 200_000
SALT = 16
#: Odd multipliers that choose the bit in each of a block's words (fixed values of split block Bloom filters).
WORD_SALTS = [0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31]
#: The rules of op1.
RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]

_ASCII_UPPER, _ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, lower-cased in A-Z, and path of a url; both empty without `://`."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    host = F.coalesce(F.regexp_extract(rest, r"\A([^/?#]*)", 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1), F.lit(""))
    return F.translate(host, _ASCII_UPPER, _ASCII_LOWER), path


def _bit(key_hash: Column, salt: int) -> Column:
    """Which of 32 bits of a word a key sets: the top five bits of a 32-bit product."""
    low = F.shiftrightunsigned(key_hash, 33)
    return F.shiftright((low * F.lit(salt)).bitwiseAND(F.lit(0xFFFFFFFF)), 27).cast("int")


def bloom_filter(keys: DataFrame, n_keys: int) -> tuple[DataFrame, int]:
    """The filter of column key as rows (block, w0..w7), and the number of blocks."""
    wanted = max(1, n_keys * BITS_PER_KEY // (32 * BLOCK_WORDS))
    blocks = min(wanted, MAX_FILTER_BYTES // (4 * BLOCK_WORDS + 8))
    h = F.xxhash64("key")
    words = [F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), _bit(F.col("h"), s))).alias(f"w{i}") for i, s in enumerate(WORD_SALTS)]
    return keys.select(h.alias("h")).groupBy(F.pmod(F.col("h"), F.lit(blocks)).alias("block")).agg(*words), blocks


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict of every row of pages (page_id, url).
    rules: host, path, verdict."""
    key = F.concat("host", F.lit("\t"), "path")
    listed = rules.select(F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
    listed = listed.groupBy(key.alias("key"), F.concat("host", "path").alias("rule"), F.length("host").alias("host_chars")).agg(F.min("verdict").alias("verdict"))
    facts = listed.agg(F.count("*").alias("n"), F.sort_array(F.collect_set(F.length("rule") - F.col("host_chars"))).alias("sizes"), F.sort_array(F.collect_set("host_chars")).alias("hosts")).first()
    bloom, blocks = bloom_filter(listed, facts["n"])

    host, path = host_and_path(F.col("url"))
    given = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    size = F.length("host")
    at_dot = lambda n: (n == size) | ((n < size) & (F.substr(F.col("host"), size - n, F.lit(1)) == "."))
    suffixes = F.transform(F.filter(F.array(*map(F.lit, facts["hosts"])).cast("array<int>"), at_dot), lambda n: F.right(F.col("host"), n))
    beginnings = F.transform(F.filter(F.array(*map(F.lit, facts["sizes"])).cast("array<int>"), lambda n: n <= F.length("path")), lambda n: F.left(F.col("path"), n))
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(beginnings, lambda b: F.concat(s, F.lit("\t"), b))))
    # The first of a page's keys is null and keeps its place in the counts.
    tried = given.select("page_id", "url", "host", "path", F.posexplode(F.concat(F.array(F.lit(None).cast("string")), F.when(F.col("host") != "", keys).otherwise(F.array().cast("array<string>")))).alias("pos", "key"))
    tried = tried.withColumn("h", F.xxhash64("key")).withColumn("block", F.pmod(F.col("h"), F.lit(blocks)))
    hit = F.lit(True)
    for i, s in enumerate(WORD_SALTS):
        hit = hit & (F.call_function("shiftright", F.col(f"w{i}"), _bit(F.col("h"), s)).bitwiseAND(F.lit(1)) == 1)
    passed = tried.join(F.broadcast(bloom), "block", "left").where((F.col("pos") == 0) | hit).select("page_id", "url", "host", "path", "pos", "key")

    if facts["n"] <= BROADCAST_RULES:
        found = passed.join(F.broadcast(listed), "key", "left")
    else:
        salted = listed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        found = passed.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALT)).cast("int")).join(salted, ["key", "salt"], "left")
    best = F.max(F.when(F.col("rule").isNotNull(), F.struct(F.length("rule").alias("size"), "host_chars", "rule", "verdict")))
    each = found.groupBy("page_id", "url", "host", "path").agg(F.count_if(F.col("pos") == 0).alias("copies"), best.alias("best"))
    return each.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: every page's url under RULES."""
    rules = spark.sql("VALUES " + ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES) + " AS rules(host, path, verdict)")
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules)


ORACLE_SQL = r"""
WITH rules(rhost, rpath, rverdict) AS (VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'),
  ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')),
cut AS (SELECT page_id, row_number() OVER () AS r, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
parts AS (SELECT page_id, r, translate(coalesce(regexp_extract(rest, '\A[^/?#]*'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  coalesce(regexp_extract(rest, '\A[^/?#]*([^?#]*)', 1), '') AS path FROM cut),
fits AS (SELECT r, rhost || rpath AS rule, rverdict, row_number() OVER (PARTITION BY r ORDER BY length(rhost || rpath) DESC, length(rhost) DESC) AS k
  FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict FROM parts LEFT JOIN fits ON parts.r = fits.r AND k = 1
"""
