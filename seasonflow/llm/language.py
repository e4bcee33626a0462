"""Language identification by rank-order profiles.

Each language's profile is the list of its most frequent letter n-grams (one to three letters, words
set off by blanks). A document's own most frequent n-grams are compared with each profile by the
out-of-place distance: the difference of the two ranks, or the greatest rank for n-grams that a
profile lacks. The nearest language wins, ties go to the first name.

Defined results: ``und`` with score 0 for texts that are null or have no letter, and where there is
nothing to learn from; null languages are not learned; repeated rows count each in learning; other
columns are not read.
"""

from __future__ import annotations

import sys
import unicodedata

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seasonflow.llm.common import by_batch, table
from seasonflow.llm.registry import query

#: N-grams in a profile, and in what a document is judged by.
PROFILE = 400
#: N-grams that a task holds before it sums them up.
HELD = 1 << 22
UNKNOWN = "und"


def letter_table() -> np.ndarray:
    """For each code point itself if it is a letter, else a blank."""
    points = np.arange(sys.maxunicode + 1, dtype=np.uint32)
    letters = np.fromiter((unicodedata.category(chr(i))[0] == "L" for i in range(sys.maxunicode + 1)), dtype=bool, count=len(points))
    points[~letters] = 32
    return points


def ngrams(text: str | None, letters: np.ndarray) -> np.ndarray:
    """Codes of all n-grams of a text: 21 bits for each of up to three characters; empty without letters."""
    raw = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    points = np.concatenate(([32], letters[raw], [32])).astype(np.int64)
    blank = points == 32
    points = points[~(blank & np.concatenate(([False], blank[:-1])))]  # one blank between words
    if len(points) < 2:
        return np.empty(0, dtype=np.int64)
    one = points[points != 32]
    two = points[:-1] << 21 | points[1:]
    three = points[:-2] << 42 | points[1:-1] << 21 | points[2:]
    three = three[points[1:-1] != 32]  # no n-gram spans two words
    return np.concatenate((one, two, three))


def counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(codes, return_counts=True)


def ranked(codes: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams, the more frequent first; ties by code."""
    values, counts = counted(codes)
    if len(values) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        keep = counts >= least
        values, counts = values[keep], counts[keep]
    order = np.lexsort((values, -counts))[:size]
    return values[order]


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", size: int = PROFILE) -> DataFrame:
    """lang, gram and rank: the profiles. Counts come from every row that has a language."""

    def run(batches):
        import pyarrow as pa

        letters = letter_table()
        held: dict[str, list[np.ndarray]] = {}
        amount = 0  # over all languages

        def sum_up(name):
            values, counts = counted(np.concatenate(held.pop(name)))
            return pa.RecordBatch.from_pydict({"lang": [name] * len(values), "gram": values, "n": counts})

        for batch in batches:
            for name, text in zip(batch.column(0), batch.column(1)):
                name = name.as_py()
                codes = ngrams(text.as_py(), letters)
                held.setdefault(name, []).append(codes)
                amount += len(codes)
                if amount > HELD:
                    yield from map(sum_up, list(held))
                    amount = 0
        yield from map(sum_up, list(held))

    rows = docs.where(F.col(lang).isNotNull()).select(F.col(lang).cast("string"), text)
    sums = rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # Spark limits the rows of a language in every task before it deals them, whatever the size of the alphabet
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    first = sums.withColumn("place", F.row_number().over(order)).where(F.col("place") <= size)
    return first.select("lang", "gram", (F.col("place") - 1).alias("rank"))


class Profiles:
    """The profiles as arrays, in one task."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int):
        self.names = sorted({r[0] for r in rows})
        self.size = size
        self.grams, self.ranks = [], []
        for name in self.names:
            own = sorted((g, k) for n, g, k in rows if n == name)
            self.grams.append(np.array([g for g, _ in own], dtype=np.int64))
            self.ranks.append(np.array([k for _, k in own], dtype=np.int64))

    def distances(self, mine: np.ndarray) -> np.ndarray:
        place = np.arange(len(mine))
        out = []
        for grams, ranks in zip(self.grams, self.ranks):
            at = np.minimum(np.searchsorted(grams, mine), len(grams) - 1)
            here = grams[at] == mine
            out.append(np.where(here, np.abs(ranks[at] - place), self.size).sum())
        return np.array(out, dtype=np.int64)

    def predict(self, codes: np.ndarray) -> tuple[str, float]:
        """The nearest language, and how near it is: 1 at distance 0, 0 if it shares no n-gram."""
        if not len(codes) or not self.names:
            return UNKNOWN, 0.0
        mine = ranked(codes, self.size)
        away = self.distances(mine)
        best = int(np.argmin(away))
        return self.names[best], 1.0 - float(away[best]) / (self.size * len(mine))


def identify(docs: DataFrame, profiles: DataFrame, keys: list[str], text: str = "text", size: int = PROFILE) -> DataFrame:
    """keys, lang_pred and score of every row. Profiles are ``size`` rows for each language."""
    rows = [tuple(r) for r in profiles.select("lang", "gram", "rank").collect()]
    sent = docs.sparkSession.sparkContext.broadcast(rows)

    def work():
        letters, known = letter_table(), Profiles(sent.value, size)

        def step(*columns):
            found = [known.predict(ngrams(t.as_py(), letters)) for t in columns[-1]]
            out = dict(zip(keys, columns))
            return {**out, "lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}

        return step

    kinds = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys)
    return by_batch(docs.select(*keys, text), f"{kinds}, lang_pred string, score double", work)


@query("op10_language_profiles")
def language_profiles(spark: SparkSession, folder: str) -> DataFrame:
    """Every document, by profiles of those not held out."""
    docs = table(spark, folder, "documents")
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))
    docs = docs.select("doc_id", held.alias("held_out"), "text", "lang")
    return identify(docs, learn(docs.where("not held_out")), ["doc_id", "held_out"])
