"""URL filters: a blocked Bloom filter of listed canonical URLs, then an exact hash join of what it lets through.

A list has rows (host, path, verdict). An entry fits a URL whose host is the entry's or below it and whose path starts
with the entry's; of several the longest (host and path together) wins, at equal length the one with the longer host,
and of one entry with two verdicts the greater one in text order ("block" before "allow").

All URLs that an entry can fit are found by cutting: for an entry of k labels and a path of m characters, the last k
labels of the host and the first m characters of the path must be the entry itself. Each page asks for one such key per
*shape* (k, m) that the list has. The filter is a table of 512-bit blocks: a key's hash names one block and one bit in
each of its eight words, so a question is one look-up. Only keys whose eight bits are set meet the list, in an equi-join
that removes the false positives. Everything is DataFrame code without Python workers.

Null URLs, and URLs without "://", have an empty host and an empty path; only an entry with both empty fits them, as
an entry with an empty host has nothing below it.
List rows without a host or a path count for nothing. Repeated pages are judged each; an empty list leaves every page
to the default verdict, an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm.common import kept_columns, table
from candlewick.operators.joins import spread_join

WORDS = 8
BITS_PER_KEY = 16
#: A filter of at most so many blocks of 64 bytes (32 MB, two million keys of 16 bits) is broadcast; a larger one is joined by its blocks.
BROADCAST_BLOCKS = 1 << 19
DEFAULT_VERDICT = "allow"

#: Fixed by the contract of op12.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PARTS = "://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """Between the first "://" and the next of / ? #, with A-Z lower-cased; empty without one."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    """From the end of the host up to ? or #."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _bit(key: str, word: int) -> Column:
    """The one bit that a key sets in a word of its block: six bits of its second hash choose it."""
    return F.expr(f"shiftleft(1L, cast(shiftrightunsigned(xxhash64(7L, {key}), {6 * word}) & 63 as int))")


def blocked_filter(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """(block, w0..w7): the bits of all keys, or-ed per block before and after the shuffle."""
    bits = keys.select(_block(F.col(key), blocks).alias("block"), *[_bit(key, i).alias(f"w{i}") for i in range(WORDS)])
    return bits.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def possible(keys: DataFrame, key: str, bloom: DataFrame, blocks: int) -> DataFrame:
    """The rows whose key may be in the filter; none that is gets lost."""
    asked = keys.withColumn("block", _block(F.col(key), blocks))
    found = asked.join(F.broadcast(bloom), "block") if blocks <= BROADCAST_BLOCKS else spread_join(asked, bloom, ["block"], "inner")
    every = None
    for i in range(WORDS):
        one = F.col(f"w{i}").bitwiseAND(_bit(key, i)) != 0
        every = one if every is None else every & one
    return found.where(every).select(*keys.columns)


def judge(
    pages: DataFrame,
    listed: DataFrame,
    url_col: str = "url",
    keep: list[str] | None = None,
    default: str = DEFAULT_VERDICT,
    bits_per_key: int = BITS_PER_KEY,
) -> DataFrame:
    """The kept columns of pages, then host, path, rule (host and path of the entry, or null) and verdict.

    A kept column with one of these names gives way. The list may have any size; from it the driver gets one row, with
    its number of keys and its distinct shapes (a few per length of path).
    """
    keys = (
        listed.where("host IS NOT NULL AND path IS NOT NULL")
        .select(F.translate("host", _UPPER, _UPPER.lower()).alias("host"), "path", "verdict")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .withColumn("key", F.concat_ws("\n", "host", "path"))
    )
    labels = F.when(F.col("host") == "", 0).otherwise(F.size(F.split("host", "[.]")))
    shape = F.struct(labels.alias("k"), F.length("path").alias("m"))
    known = keys.agg(F.count("*").alias("n"), F.collect_set(shape).alias("shapes")).first()
    blocks = max(1, -(-known["n"] * bits_per_key // (64 * WORDS)))
    others = kept_columns(pages, ["host", "path", "rule", "verdict"], keep)
    url = F.col(f"`{url_col}`").cast("string")
    judged = pages.select(*[F.col(f"`{f.name}`") for f in others], host_of(url).alias("host"), path_of(url).alias("path"))

    shapes = sorted((s["k"], s["m"]) for s in known["shapes"])
    in_list = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(m).alias("m")) for k, m in shapes])
    cut = in_list if shapes else F.from_json(F.lit("[]"), "array<struct<k:int,m:int>>")
    urls = judged.select("host", "path", labels.alias("labels"))
    # An empty host is no parent: neither of all hosts nor, as their empty last label, of those that end with a dot.
    nested = lambda s: F.when(s["k"] == 0, F.col("host") == "").when(s["k"] == 1, ~F.endswith("host", F.lit("."))).otherwise(True)
    fits = F.filter(cut, lambda s: (s["k"] <= F.col("labels")) & (s["m"] <= F.length("path")) & nested(s))
    asked = urls.select("host", "path", F.explode(fits).alias("s")).select(
        "host", "path", F.expr("concat_ws('\n', substring_index(host, '.', -s.k), left(path, s.m))").alias("key")
    )
    hits = possible(asked, "key", blocked_filter(keys, "key", blocks), blocks)
    entries = keys.select(
        "key",
        F.struct(F.length("key").alias("n"), F.length("host").alias("h"), F.concat("host", "path").alias("rule"), "verdict").alias("entry"),
    )
    best = (
        spread_join(hits, entries, ["key"], "inner")
        .groupBy("host", "path")
        .agg(F.max("entry").alias("entry"))
        .select("host", "path", F.col("entry.rule").alias("__rule"), F.col("entry.verdict").alias("__verdict"))
    )
    return spread_join(judged, best, ["host", "path"], "left").select(
        *[F.col(f"`{f.name}`") for f in others],
        "host",
        "path",
        F.col("__rule").alias("rule"),
        F.coalesce("__verdict", F.lit(default)).alias("verdict"),
    )


_RULES_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)


def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with its host, path, the rule that fits and the verdict; a page that no rule fits is allowed."""
    listed = spark.sql(f"SELECT * FROM VALUES {_RULES_SQL} AS listed(host, path, verdict)")
    return judge(table(spark, sf_dir, "pages"), listed, keep=["page_id"])


OP12_SQL = f"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {_RULES_SQL}),
parts AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '{_PARTS}', 1), ''), '{_UPPER}', '{_UPPER.lower()}') AS host,
    coalesce(regexp_extract(url, '{_PARTS}', 2), '') AS path
  FROM pages
),
urls AS (SELECT DISTINCT host, path FROM parts),
best AS (
  SELECT host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    arg_max(rule_verdict, length(rule_host || rule_path)) AS verdict
  FROM urls JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY host, path
)
SELECT p.page_id, p.host, p.path, b.rule, coalesce(b.verdict, '{DEFAULT_VERDICT}') AS verdict
FROM parts p LEFT JOIN best b ON p.host = b.host AND p.path = b.path
"""
