"""URL rules by a blocked Bloom filter and an exact hash join.

Rules are listed as ``host/path``. A rule fits its host and all subdomains if the URL's path starts
with the rule's path; the longest rule wins, of equally long ones that of the longer host. Each URL yields the canonical
keys under which a rule could be listed: its host's last labels and its path's first characters, in
the few shapes that the list has. A blocked Bloom filter of the listed keys (one block of 256 bits
for each key) passes the possible hits on; an exact join with the list removes the false ones.

Only DataFrame functions run here. Defined results: a null URL, or one without ``://``, has an empty
host and path and no rule; a URL that no rule fits gets the verdict ``allow``, as nothing lists it;
repeated rows are judged one by one; only ``page_id`` and ``url`` are read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonflow.llm.common import once, table
from seasonflow.llm.registry import query
from seasonflow.session import literal_table

#: The listed rules.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
#: Words of 64 bits in a block, and bits set in it for each key.
WORDS, PROBES = 4, 6
KEYS_PER_BLOCK = 16


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    """verdict, rule, its host and path, and their shape."""
    rows = []
    for verdict, rule in rules:
        host, slash, path = rule.partition("/")
        rows.append((verdict, rule, host, slash + path))
    listed = literal_table(spark, rows, "verdict string, rule string, rule_host string, rule_path string")
    return listed.select(
        "verdict", "rule", "rule_host", "rule_path",
        F.size(F.split("rule_host", r"\.")).alias("labels"), F.length("rule_path").alias("path_length"),
        F.concat("rule_host", "rule_path").alias("key"),
    )


def _bits(key: Column, word: int) -> Column:
    """The bits that a key sets in one 64-bit word of its block."""
    bits = F.lit(0).cast("long")
    for probe in range(PROBES):
        if probe % WORDS == word:
            at = F.pmod(F.xxhash64(key, F.lit(probe)), F.lit(64)).cast("int")
            bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), at))
    return bits


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def bloom_blocks(listed: DataFrame, blocks: int) -> DataFrame:
    """The filter as a table: one row for each block that has a key."""
    words = [F.bit_or(_bits(F.col("key"), w)).alias(f"word{w}") for w in range(WORDS)]
    return listed.groupBy(_block(F.col("key"), blocks).alias("block")).agg(*words)


def judge(pages: DataFrame, listed: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages`` (page_id, url).

    The shapes of the list (numbers of labels and of path characters) and its number of keys are
    small summaries; the list and the filter stay tables, which Spark sends to every task while they
    are small and joins by their key when they are not.
    """
    shapes = listed.select("labels", "path_length").distinct().collect()  # pairs of small numbers
    blocks = max(1, listed.count() // KEYS_PER_BLOCK)
    with_parts = pages.select(
        "page_id", F.monotonically_increasing_id().alias("row"),
        once(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")),
    )
    keys = [
        F.when(
            F.length("path") >= s.path_length,
            F.concat(F.substring_index("host", ".", -s.labels), F.substring("path", 1, s.path_length)),
        )
        for s in shapes
    ]
    if not keys:
        return with_parts.select(
            "page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict")
        )
    probes = with_parts.withColumn("keys", F.array_distinct(F.array_compact(F.array(*keys))))
    probes = probes.withColumn("key", F.explode_outer("keys")).drop("keys").withColumn("block", _block(F.col("key"), blocks))
    bloom = bloom_blocks(listed, blocks).withColumnRenamed("block", "bloom_block")
    passes = F.lit(True)
    for w in range(WORDS):
        bits = _bits(F.col("key"), w)
        passes = passes & (F.col(f"word{w}").bitwiseAND(bits) == bits)
    possible = probes.join(bloom, F.col("block") == F.col("bloom_block"), "left").select(
        "page_id", "row", "host", "path", F.when(passes, F.col("key")).alias("key")
    )
    exact = listed.select("key", "rule", "verdict", F.struct(F.length("rule").alias("length"), F.length("rule_host").alias("host_length"), "verdict").alias("rank"))
    hits = possible.join(exact, "key", "left")
    best = F.max_by(F.struct("rule", "verdict"), F.col("rank"))
    judged = hits.groupBy("row", "page_id", "host", "path").agg(best.alias("best"))
    return judged.select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"),
    )


SQL = """
WITH parts AS (
  SELECT page_id, coalesce(url, '') AS url, instr(coalesce(url, ''), '://') AS cut_at FROM pages),
rests AS (SELECT page_id, CASE WHEN cut_at > 0 THEN substr(url, cut_at + 3) ELSE '' END AS rest FROM parts),
hosts AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM rests),
cut AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM hosts),
rules(v, r, h, p) AS (VALUES ('allow', 'com/', 'com', '/'), ('block', 'example.com/en/', 'example.com', '/en/'),
  ('allow', 'www.example.com/en/', 'www.example.com', '/en/'), ('block', 'net/es/', 'net', '/es/'),
  ('block', 'net/fr/', 'net', '/fr/')),
fits AS (
  SELECT c.page_id, arg_max(r, length(r)) AS rule, arg_max(v, length(r)) AS verdict
  FROM cut c JOIN rules ON (c.host = h OR ends_with(c.host, '.' || h)) AND starts_with(c.path, p)
  GROUP BY c.page_id)
SELECT c.page_id, c.host, c.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM cut c LEFT JOIN fits f ON f.page_id = c.page_id
"""


@query("op3_url_rules", SQL)
def url_rules(spark: SparkSession, folder: str) -> DataFrame:
    return judge(table(spark, folder, "pages"), rule_table(spark))
