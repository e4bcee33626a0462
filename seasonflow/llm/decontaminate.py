"""Benchmark decontamination by a prefix-filtered set join.

A window is a run of consecutive item words (a short item is one window). A document is contaminated
where it contains a whole window. A window is seen as the set of its word shingles, ordered from the
rarest in the benchmark to the most common; since all of them must be found (a containment of one),
the necessary prefix is the rarest shingle alone. Document shingles are joined with these prefix
tokens; positional and length bounds drop candidates whose window would stick out of the document;
what is left is compared word for word over the window.

A bit map of the prefix tokens, of a fixed size whatever the benchmark, is sent to all tasks and thins
the documents' shingles before they leave their task; the join by token is exact. The words around a
candidate travel with it, so texts are read once and never shuffled.

Defined results: a null text has no words; an item without words has no window; a null or repeated
item id counts as its value does, and repeated windows are joined once; repeated documents are judged
one by one, by their texts; an empty benchmark leaves every document clean; other columns are not read.
"""

from __future__ import annotations

import re
import string

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seasonflow.llm.common import WordHashes, bit_map, by_batch, shingle_hashes, table, text_content, without
from seasonflow.llm.registry import query
from seasonflow.session import settle

WINDOW, SHINGLE = 10, 5
#: The word rule: digits, a-z (after A-Z is lower-cased) and everything beyond ASCII.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
#: Bits of the token map: 2 MB, whatever the size of the benchmark.
MAP_BITS = 24


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(_LOWER))


def item_windows(items: DataFrame, key: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """item, words of every window of every item, and its shingles' hashes in order of position."""

    def work():
        hashes = WordHashes()

        def step(keys, texts):
            out = {"item": [], "words": [], "shingles": []}
            for item, text in zip(keys.to_pylist(), texts.to_pylist()):
                words = words_of(text)
                for at in range(max(1, len(words) - window + 1) if words else 0):
                    part = words[at : at + window]
                    out["item"].append(item)
                    out["words"].append(part)
                    size = min(SHINGLE, len(part))
                    out["shingles"].append(shingle_hashes(hashes.of(part), size).view(np.int64).tolist())
            return out

        return step

    kind = items.schema[key].dataType.simpleString()
    return by_batch(items.select(key, text), f"item {kind}, words array<string>, shingles array<long>", work)


def with_prefix(windows: DataFrame) -> DataFrame:
    """Adds token (the rarest shingle, ties by its hash) and offset (its place in the window).

    One row for each distinct window and item.
    """
    windows = settle(windows.distinct())
    each = windows.select("item", "words", F.posexplode("shingles").alias("offset", "token"))
    rarity = each.groupBy("token").agg(F.count("*").alias("frequency"))
    ranked = each.join(rarity, "token")
    order = Window.partitionBy("item", "words").orderBy("frequency", "token", "offset")  # at most WINDOW rows
    return ranked.withColumn("nth", F.row_number().over(order)).where("nth = 1").select("item", "words", "token", "offset")


def candidates(docs: DataFrame, prefixes: DataFrame, keys: list[str], text: str = "text", window: int = WINDOW) -> DataFrame:
    """For every row: keys, n_words and found, an array of possible hits: token, its place ``at``,
    the place ``first`` of the first word that travels along, and these words.
    """
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(np.packbits(bit_map(prefixes, "token", MAP_BITS), bitorder="little").tobytes())
    # windows shorter than a shingle have tokens of fewer words: which lengths there are is a small set
    sizes = sorted({r[0] for r in prefixes.select(F.least(F.size("words"), F.lit(SHINGLE))).distinct().collect()})

    def work():
        bits = np.unpackbits(np.frombuffer(known.value, dtype=np.uint8), bitorder="little").view(bool)
        hashes = WordHashes()
        mask = np.uint64((1 << MAP_BITS) - 1)

        def step(*columns):
            counts, found = [], []
            for text in columns[-1]:
                words = words_of(text.as_py())
                counts.append(len(words))
                hits = []
                numbers = hashes.of(words) if words and sizes else None
                for size in sizes if words else ():
                    tokens = shingle_hashes(numbers, size)
                    for at in np.flatnonzero(bits[tokens & mask]).tolist():
                        first = max(0, at - window + 1)
                        hits.append({"token": int(tokens[at].astype(np.int64)), "at": at, "first": first, "words": words[first : at + window]})
                found.append(hits)
            return {**{f"k{i}": c for i, c in enumerate(columns[:-1])}, "n_words": counts, "found": found}

        return step

    kinds = ", ".join(f"k{i} {docs.schema[k].dataType.simpleString()}" for i, k in enumerate(keys))
    schema = f"{kinds}, n_words long, found array<struct<token: long, at: int, first: int, words: array<string>>>"
    return by_batch(docs.select(*keys, text), schema, work)


def occurrences(found: DataFrame, prefixes: DataFrame, keys: list[str]) -> DataFrame:
    """keys, item, start and length of every window that occurs, verified word for word."""
    each = found.where(F.size("found") > 0).select(*keys, F.inline("found"))
    p = prefixes.select("item", F.col("words").alias("window"), "token", "offset")
    start = F.col("at") - F.col("offset")
    inside = F.slice("words", F.greatest(start - F.col("first") + 1, F.lit(1)), F.size("window"))
    fits = (start >= F.col("first")) & (start - F.col("first") + F.size("window") <= F.size("words"))
    joined = each.join(p, "token").where(fits & (inside == F.col("window")))
    return joined.select(*keys, "item", start.alias("start"), F.size("window").alias("length")).distinct()


def hit_words(runs: Column) -> Column:
    """Words covered by sorted runs of (start, length): each adds what lies beyond the ones before."""
    begin = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    def add(state, run):
        end = F.greatest(state.end, run.start + run.length)
        return F.struct((state.n + end - F.greatest(state.end, F.least(run.start, end))).alias("n"), end.alias("end"))
    return F.aggregate(runs, begin, add, lambda s: s.n.cast("long"))


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id") -> DataFrame:
    """doc_id, n_words, n_hit, n_items, item ids (sorted as strings) and contaminated of every row."""
    prefixes = settle(with_prefix(item_windows(items, item_key)))
    # a null or repeated id must not mix rows: they are told apart by a number given once, in a written table
    found = settle(candidates(docs, prefixes, [key], text).withColumn("row", F.monotonically_increasing_id()))
    where = occurrences(found, prefixes, ["row"])
    # a document's runs are at most its words, its items at most the benchmark
    by_row = where.groupBy("row").agg(
        F.sort_array(F.collect_set(F.struct("start", "length"))).alias("runs"),
        F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("items"),
    )
    all_rows = found.select("row", F.col("k0").alias("doc_id"), "n_words").join(by_row, "row", "left")
    n_hit = F.coalesce(hit_words(F.col("runs")), F.lit(0).cast("long"))
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    return all_rows.select("doc_id", "n_words", n_hit.alias("n_hit"), items_of.alias("items"), (n_hit > 0).alias("contaminated"))


@query("op4_decontaminate")
def decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Every document against every benchmark item."""
    found = contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds no window of the benchmark."""
    content = text_content()
    prefixes = settle(with_prefix(item_windows(table(spark, sf_dir, "benchmark"))))
    keyed = docs.select("text", *(v.alias(n) for n, v in content.items()))
    found = settle(candidates(keyed, prefixes, list(content)).where(F.size("found") > 0))
    keys = [f"k{i}" for i in range(len(content))]
    hit = occurrences(found, prefixes, keys).select(*(F.col(k).alias(n) for k, n in zip(keys, content)))
    return without(docs, settle(hit.distinct()), content)
