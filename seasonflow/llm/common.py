"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The separators of the word rule ``[^\x20\x09-\x0D]+``.
BLANKS = " \t\n\x0b\f\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def once(*columns: Column) -> Column:
    """A generator of one row: unlike a projection the optimizer never merges it with
    what is above it, so an expensive value is computed once however often it is used."""
    return F.inline(F.array(F.struct(*columns)))


def by_batch(df: DataFrame, schema: str, work: Callable[..., Iterator[dict] | None]) -> DataFrame:
    """Maps ``work(lists of the columns of a batch) -> dict of lists`` over Arrow batches.

    ``work`` may be a factory of state: it is called once for each task and returns the function.
    """
    target = _arrow(df.sparkSession, schema)

    def run(batches):
        step = work()
        for batch in batches:
            if batch.num_rows:
                out = step(*(batch.column(i) for i in range(batch.num_columns)))
                yield pa.RecordBatch.from_pydict(out, schema=target)

    return df.mapInArrow(run, schema)


def _arrow(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], schema).schema)


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __init__(self, bound: int = 400_000):
        super().__init__()
        self.bound = bound

    def __missing__(self, word: str) -> int:
        if len(self) >= self.bound:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    v = values.astype(np.uint64, copy=True)
    v ^= v >> np.uint64(32)
    v *= np.uint64(0xD6E8FEB86659FD93)
    v ^= v >> np.uint64(32)
    v *= np.uint64(0xD6E8FEB86659FD93)
    v ^= v >> np.uint64(32)
    return v


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` word hashes; the order of the words counts."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        total *= np.uint64(0x9E3779B97F4A7C15)
        total += words[i : i + n]
    return mixed(total)


def bit_map(rows: DataFrame, column: str, bits: int) -> np.ndarray:
    """Which remainders of a long column modulo ``2**bits`` occur, as one boolean for each.

    The marks are joined in Spark: at most ``2**(bits - 6)`` numbers reach the driver.
    """
    place = F.pmod(column, F.lit(1 << bits))
    mark = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int"))
    words = rows.groupBy(F.floor(place / 64).cast("int").alias("word")).agg(F.bit_or(mark).alias("marks")).collect()
    found = np.zeros(1 << (bits - 6), dtype=np.uint64)
    for r in words:
        found[r.word] = np.uint64(r.marks & 0xFFFFFFFFFFFFFFFF)
    return np.unpackbits(found.view(np.uint8), bitorder="little").view(bool)


def without(docs: DataFrame, rejected: DataFrame, content: dict[str, Column]) -> DataFrame:
    """Rows of ``docs`` whose content is not among ``rejected``, which has the columns of ``content``.

    A verdict that depends on content alone is looked up by content, so null and repeated ids are safe.
    Nulls are equal here. Columns and their names stay as they are.
    """
    left, names = docs, {}
    for name, value in content.items():
        names[name] = fresh(left, f"left_{name}")
        left = left.withColumn(names[name], value)
    right = rejected.select(*(F.col(n).alias(fresh(left, f"right_{n}")) for n in content)).distinct()
    match = [left[names[n]].eqNullSafe(right[r]) for n, r in zip(content, right.columns)]
    return left.join(right, match, "left_anti").select(*docs.columns)


def text_content(text: str = "text") -> dict[str, Column]:
    """What tells texts apart: a hash and the length."""
    return {"text_hash": F.xxhash64(text), "text_bytes": F.octet_length(text)}
