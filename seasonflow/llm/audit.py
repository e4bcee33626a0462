"""How filters of a corpus overlap.

Each text gets one flag for each filter. Four filters look at the text alone. The fifth, a text that a
smaller id holds too, needs the whole table, and a prepass keeps most texts out of its shuffle: every text
is hashed to a few cells of a counting Bloom sketch (cells saturate at two), the sketches of all tasks are
merged, and a text with a cell of its own is certainly unique. Only the others are dealt by their full text,
already combined in their tasks, to find the least id of each; what returns is one narrow row for each text.

The flags of a document make a mask. Documents are counted by part, mask and label, and every order of the
filters is read off these additive counts, which no longer depend on the number of documents.

Defined results: a null text is an empty one; a null id is neither smaller nor larger than another, so it
neither makes a copy nor is one; rows that agree in id and text are no copies of each other; a null language
is the part named by the empty text; labels of one id count as 1 if any is, ids without labels as 0;
repeated rows count each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seasonflow.llm.common import by_batch, mixed, table
from seasonflow.llm.registry import query
from seasonflow.session import settle

FILTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, UPPER_PERCENT = 200, 50, 3
#: Cells that a text marks, and cells of the sketch for each text.
PROBES, CELLS = 4, 16
#: Most cells, as a power of two: 128 MB of bits in every task. Beyond 67 million texts the cells fill up, at
#: 268 million a sixth of the unique texts is dealt too, and at thousands of millions nearly all: slower, not wrong.
MOST_BITS = 30
#: Cells of a block, the unit in which sketches are merged.
BLOCK_BITS = 15
_UPPER = bytes(range(65, 91))
_SYMBOLS = b"#$%&*|"


def text_flags(raw: bytes, points: int) -> int:
    """The bits of the four filters that look at one text, A the lowest."""
    words = raw.split()  # blanks are \x20 and \x09-\x0D
    n = len(words)
    upper = len(raw) - len(raw.translate(None, _UPPER))
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    return (n < MIN_WORDS) | (100 * len(set(words)) < DISTINCT_PERCENT * n) << 1 | (100 * upper > UPPER_PERCENT * points) << 2 | (symbols > 0) << 3


def marked(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """doc_id, part, hash of the text and flags of every row, without the text."""
    body = F.coalesce(F.col(text), F.lit(""))
    kind = docs.schema[key].dataType.simpleString()

    def work():
        def step(keys, parts, hashes, points, texts):
            sizes = points.to_pylist()
            return {"doc_id": keys, "part": parts, "hash": hashes, "flags": [text_flags(t, n) for t, n in zip(texts.cast("binary").to_pylist(), sizes)]}

        return step

    rows = docs.select(key, F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.xxhash64(body).alias("hash"), F.length(body).alias("points"), body.alias("text"))
    return by_batch(rows, f"doc_id {kind}, part string, hash long, flags int", work)


def cells_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The cells of every text: PROBES columns."""
    step = np.arange(1, PROBES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed(hashes.view(np.uint64)[:, None] + step) >> np.uint64(64 - bits)).astype(np.int64)


def sketch_bits(rows: int) -> int:
    return min(MOST_BITS, max(BLOCK_BITS + 1, int(rows * CELLS).bit_length()))


def crowded(marks: DataFrame, bits: int) -> np.ndarray:
    """The merged sketch: one bit for each cell that two texts or more have marked.

    A task keeps the cells that its texts have marked, and how often up to two, as sorted numbers. They are merged block by
    block; the bits of all blocks together are at most ``2**(MOST_BITS - 3)`` bytes.
    """
    size = 1 << BLOCK_BITS

    def count(batches):
        held, amount = [], 0

        def sum_up():
            cells, times = np.unique(np.concatenate(held), return_counts=True)
            block = cells >> BLOCK_BITS
            starts = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
            stops = np.append(starts[1:], len(cells))
            # the cell within the block, and in the top bit whether it is marked twice
            within = ((cells & (size - 1)) | (times > 1).astype(np.int64) << 15).astype(np.uint16)
            values = [within[a:b].tobytes() for a, b in zip(starts.tolist(), stops.tolist())]
            return pa.RecordBatch.from_pydict({"block": block[starts], "cells": pa.array(values, pa.binary())})

        for batch in batches:
            # a text's cells may meet: each counts once for it
            cells = np.sort(cells_of(batch.column(0).to_numpy(zero_copy_only=False), bits), axis=1)
            first = np.concatenate((np.ones((len(cells), 1), dtype=bool), cells[:, 1:] != cells[:, :-1]), axis=1)
            held.append(cells[first])
            amount += len(held[-1])
            if amount > 1 << 22:
                yield sum_up()
                held, amount = [], 0
        if amount:
            yield sum_up()

    def merge(batches):
        once: dict[int, np.ndarray] = {}
        twice: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                within = np.frombuffer(cells, dtype=np.uint16)
                place, again = within & (size - 1), within >> 15 == 1
                if block not in once:
                    once[block], twice[block] = np.zeros(size, dtype=bool), np.zeros(size, dtype=bool)
                twice[block][place[again | once[block][place]]] = True
                once[block][place] = True
        kept = [b for b in twice if twice[b].any()]
        if kept:
            yield pa.RecordBatch.from_pydict({"block": np.array(kept, dtype=np.int64), "bits": [np.packbits(twice[b]).tobytes() for b in kept]})

    counted = marks.select("hash").mapInArrow(count, "block long, cells binary")
    # as many parts as keep the blocks of one of them within 64 MB
    merged = counted.repartition(max(8, 1 << max(0, bits - BLOCK_BITS - 10)), "block").mapInArrow(merge, "block long, bits binary")
    found = np.zeros((1 << bits) // 8, dtype=np.uint8)
    for r in merged.collect():  # the bits of one sketch
        found[r.block * size // 8 : (r.block + 1) * size // 8] = np.frombuffer(r.bits, dtype=np.uint8)
    return found


def _possible(hashes: np.ndarray, found: np.ndarray, bits: int) -> np.ndarray:
    """Whether all cells of a text are shared with another."""
    cells = cells_of(hashes, bits)
    return ((found[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1).all(axis=1)


def with_copies(marks: DataFrame, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """part, doc_id and flags with that of a text which a smaller id holds too."""
    bits = sketch_bits(marks.count())
    sent = docs.sparkSession.sparkContext.broadcast(crowded(marks, bits))
    kind = marks.schema["doc_id"].dataType.simpleString()

    def tell(batches):
        for batch in batches:
            again = _possible(batch.column(2).to_numpy(zero_copy_only=False), sent.value, bits)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(again)], names=[*batch.schema.names, "possible"])

    def drop(batches):
        for batch in batches:
            kept = _possible(batch.column(1).to_numpy(zero_copy_only=False), sent.value, bits)
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(kept)) for i in (0, 2)], names=["doc_id", "text"])

    told = marks.select("doc_id", "part", "hash", "flags").mapInArrow(tell, f"doc_id {kind}, part string, hash long, flags int, possible boolean")
    body = F.coalesce(F.col(text), F.lit(""))
    repeats = docs.where(F.col(key).isNotNull()).select(key, F.xxhash64(body).alias("hash"), body.alias("text")).mapInArrow(drop, f"doc_id {kind}, text string")
    # one row for each text: its least id names it, so no row of a large group meets the others again
    least = repeats.groupBy("text").agg(F.min("doc_id").alias("first_id")).select("first_id", F.xxhash64("text").alias("first_hash"))
    named = F.col("possible") & F.col("doc_id").isNotNull()
    wanted = told.where(named).join(least, (F.col("doc_id") == F.col("first_id")) & (F.col("hash") == F.col("first_hash")), "left")
    copy = F.when(F.col("first_id").isNull(), 1 << FILTERS.index("E")).otherwise(0)
    judged = wanted.select("doc_id", "part", (F.col("flags") + copy).alias("flags"))
    return judged.unionByName(told.where(~named).select("doc_id", "part", "flags"))


def mask_counts(flagged: DataFrame, labels: DataFrame) -> DataFrame:
    """Additive counts by part and mask: n, good (quality 1) and toxic documents."""
    own = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    rows = flagged.join(own, "doc_id", "left")
    one = lambda c: F.sum(F.when(F.col(c) == 1, 1).otherwise(0))
    return rows.groupBy("part", "flags").agg(F.count("*").alias("n"), one("quality").alias("good"), one("toxic").alias("toxic"))


def interactions(counts: DataFrame) -> DataFrame:
    """Every order of the filters over the counts of ``mask_counts``: at most 32 rows of a part enter."""
    orders = F.array(*(F.lit("".join(p)) for p in permutations(FILTERS)))
    every = counts.select("*", F.explode(orders).alias("filter_order")).select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    at = lambda s: F.substring("filter_order", s, F.lit(1))
    bit = lambda letter: F.call_function("shiftleft", F.lit(1), F.call_function("locate", letter, F.lit(FILTERS)) - 1)
    earlier_steps = F.filter(F.sequence(F.lit(1), F.lit(len(FILTERS))), lambda s: s < F.col("step"))
    earlier = F.aggregate(earlier_steps, F.lit(0), lambda total, s: total + bit(at(s)))
    rows = every.withColumns({"letter": at(F.col("step")), "own": bit(at(F.col("step"))), "earlier": earlier})
    fails, before = F.col("flags").bitwiseAND(F.col("own")) != 0, F.col("flags").bitwiseAND(F.col("earlier")) != 0
    total = lambda when, c="n": F.sum(F.when(when, F.col(c)).otherwise(0))
    found = rows.groupBy("part", "filter_order", "step", "letter").agg(
        total(~fails & ~before).alias("kept"), total(fails & ~before).alias("removed"), total(fails & before).alias("redundant"),
        total(F.col("flags") == F.col("own")).alias("unique_fails"), total(fails & ~before, "good").alias("good_lost"), total(fails & ~before, "toxic").alias("toxic_lost"),
    )
    return found.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "letter"))).drop("letter")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The interactions of all five filters (docs: doc_id, text, lang; labels: doc_id, quality, toxic)."""
    marks = settle(marked(docs))
    return interactions(settle(mask_counts(with_copies(marks, docs), labels)))


SQL = """
WITH docs AS (SELECT doc_id, coalesce(text, '') AS body, coalesce(lang, '') AS part FROM documents),
worded AS (SELECT *, regexp_extract_all(body, '[^\\x20\\x09-\\x0D]+') AS words, min(doc_id) OVER (PARTITION BY body) AS first_id FROM docs),
failed AS (
  SELECT doc_id, part,
    CASE WHEN len(words) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END ||
    CASE WHEN 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 3 * length(body) THEN 'C' ELSE '' END ||
    CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN doc_id > first_id THEN 'E' ELSE '' END AS fails
  FROM worded),
own AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
counts AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE quality = 1) AS good, count(*) FILTER (WHERE toxic = 1) AS toxic
  FROM failed LEFT JOIN own USING (doc_id) GROUP BY part, fails),
letters(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.x NOT IN (b.x, c.x, d.x, e.x) AND b.x NOT IN (c.x, d.x, e.x) AND c.x NOT IN (d.x, e.x) AND d.x <> e.x),
steps AS (SELECT filter_order, CAST(s AS INTEGER) AS step, substr(filter_order, s, 1) AS letter, substr(filter_order, 1, s - 1) AS earlier FROM orders, range(1, 6) t(s)),
rows AS (
  SELECT part, filter_order, step, letter, n, good, toxic, fails, contains(fails, letter) AS fail,
    length(translate(earlier, fails, '')) < length(earlier) AS before
  FROM counts, steps),
summed AS (
  SELECT part, filter_order, step, letter,
    coalesce(sum(n) FILTER (WHERE NOT fail AND NOT before), 0) AS kept, coalesce(sum(n) FILTER (WHERE fail AND NOT before), 0) AS removed,
    coalesce(sum(n) FILTER (WHERE fail AND before), 0) AS redundant, coalesce(sum(n) FILTER (WHERE fails = letter), 0) AS unique_fails,
    coalesce(sum(good) FILTER (WHERE fail AND NOT before), 0) AS good_lost, coalesce(sum(toxic) FILTER (WHERE fail AND NOT before), 0) AS toxic_lost
  FROM rows GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM summed
"""


@query("op11_filter_audit", SQL)
def filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Five filters over all documents, in every order."""
    return audit(table(spark, folder, "documents"), table(spark, folder, "labels"))
