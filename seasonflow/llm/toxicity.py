"""Toxicity: a convolutional text classifier.

A word is the sum of two hashed embeddings, so that two words are mixed up only if both hashes agree.
Filters of several widths run over the words, each filter keeps its greatest value in the whole text
(max pooling), and a logistic layer scores what they found. It learns from all labelled rows: few are fitted
at once, in numpy; of many a bounded number gives the first weights, from which the tasks go on over all rows, and
their moves are averaged after each pass. Scoring runs in the tasks, over whole texts.
Thresholds are calibrated by language on a fifth of the labelled rows that training does not see; the language
chooses a threshold only, it is no input of a score.

Defined results: a null or empty text, or one without letters, has the score of a text in which no
filter finds anything; without rows of both labels to learn from, every score is the share of toxic
ones (0 without any); repeated labels of one id count as toxic if any is; a null language takes the
general threshold; repeated rows are scored alike, and of the texts of a labelled id the one of the least
hash is learned from; other columns are not read.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonflow.llm.common import bit_map, by_batch, table
from seasonflow.llm.registry import query

#: Rows of each label that give the first weights, in the order of a hash of their ids.
SAMPLE = 3000
#: Passes over all rows that follow where there are more, and labelled ids of a partition then.
PASSES, PART = 3, 5000
#: Size of the map of labelled ids that documents are looked up in before they travel; the ids themselves decide.
MAP_BITS = 24
#: Words that are convolved at a time.
PIECE = 1 << 14
WIDTHS, FILTERS, DIM = (1, 2, 3), 12, 8
#: At most 2^16: both buckets of a word travel in four bytes.
BUCKETS = 1 << 15
EPOCHS, BATCH, RATE = 14, 64, 0.02
THRESHOLD = 0.3
WORD = re.compile(r"[^\W\d_]+")


class Buckets(dict):
    """Both buckets of a word, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) > 400_000:
            self.clear()
        h = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        value = self[word] = (h % BUCKETS) << 32 | (h >> 40) % BUCKETS
        return value

    def of(self, text: str | None) -> np.ndarray:
        words = WORD.findall((text or "").lower())
        return np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))


def packed(words: np.ndarray) -> bytes:
    """The buckets of :class:`Buckets` in four bytes a word."""
    return ((words >> 32) << 16 | (words & 0xFFFF)).astype("<u4").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    words = np.frombuffer(data, dtype="<u4").astype(np.int64)
    return (words >> 16) << 32 | (words & 0xFFFF)


@dataclass
class Network:
    """Weights of the classifier and the thresholds by language ('' is the general one)."""

    first: np.ndarray
    second: np.ndarray
    filters: list[np.ndarray]  # for each width: (width, DIM, FILTERS)
    shifts: list[np.ndarray]
    out: np.ndarray
    bias: float
    thresholds: dict[str, float] = field(default_factory=dict)

    @classmethod
    def fresh(cls, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        make = lambda *shape: rng.normal(0, 1, shape).astype(np.float32)
        return cls(
            0.1 * make(BUCKETS, DIM), 0.1 * make(BUCKETS, DIM),
            [make(w, DIM, FILTERS) / np.float32(np.sqrt(w * DIM)) for w in WIDTHS],
            [np.zeros(FILTERS, dtype=np.float32) for _ in WIDTHS],
            0.3 * make(FILTERS * len(WIDTHS)), 0.0,
        )

    def embedded(self, words: np.ndarray) -> np.ndarray:
        return self.first[words >> 32] + self.second[words & 0xFFFFFFFF]

    def convolved(self, x: np.ndarray, i: int) -> np.ndarray:
        width = WIDTHS[i]
        n = len(x) - width + 1
        total = np.zeros((max(n, 0), FILTERS), dtype=np.float32)
        for k in range(width if n > 0 else 0):
            total += x[k : k + n] @ self.filters[i][k]
        return total

    def places(self, words: np.ndarray, part: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
        """The greatest value of every filter over the whole text, a stretch at a time, and the first word
        where it is; zero and -1 where a text is shorter than the filter."""
        best = np.zeros(FILTERS * len(WIDTHS), dtype=np.float32)
        top = np.full(len(best), -1, dtype=np.int64)
        for at in range(0, len(words), part):
            x = self.embedded(words[at : at + part + max(WIDTHS) - 1])
            for i in range(len(WIDTHS)):
                y = self.convolved(x, i)
                if len(y):
                    own = slice(i * FILTERS, (i + 1) * FILTERS)
                    here = y.argmax(axis=0)
                    value = y[here, np.arange(FILTERS)]
                    more = (value > best[own]) | (top[own] < 0)
                    best[own] = np.where(more, value, best[own])
                    top[own] = np.where(more, here + at, top[own])
        return best, top

    def pooled(self, words: np.ndarray, part: int = PIECE) -> np.ndarray:
        """The greatest positive value of every filter over the whole text, a stretch at a time."""
        best = np.zeros(FILTERS * len(WIDTHS), dtype=np.float32)
        for at in range(0, len(words), part):
            x = self.embedded(words[at : at + part + max(WIDTHS) - 1])
            for i in range(len(WIDTHS)):
                y = self.convolved(x, i)
                if len(y):
                    own = slice(i * FILTERS, (i + 1) * FILTERS)
                    best[own] = np.maximum(best[own], y.max(axis=0) + self.shifts[i])
        return best

    def score(self, words: np.ndarray) -> float:
        z = float(self.pooled(words) @ self.out) + self.bias
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def constant(share: float) -> Network:
    net = Network.fresh()
    net.out = np.zeros_like(net.out)
    net.bias = float(np.log(share / (1 - share))) if 0 < share < 1 else (40.0 if share >= 1 else -40.0)
    return net


class Adam:
    def __init__(self, rate: float):
        self.rate, self.t, self.state = rate, 0, {}

    def step(self, name, weights: np.ndarray, slope: np.ndarray, rows: np.ndarray | None = None) -> None:
        """Moves ``weights``, or only its ``rows``, against the slope."""
        m, v = self.state.setdefault(name, (np.zeros_like(weights), np.zeros_like(weights)))
        at = slice(None) if rows is None else rows
        m[at] = 0.9 * m[at] + 0.1 * slope
        v[at] = 0.99 * v[at] + 0.01 * slope * slope
        up, low = 1 - 0.9**self.t, 1 - 0.99**self.t
        weights[at] -= self.rate * (m[at] / up) / (np.sqrt(v[at] / low) + 1e-6)


def step(net: Network, adam: Adam, bias: np.ndarray, texts: list[np.ndarray], labels: np.ndarray) -> None:
    """One minibatch: moves the weights of ``net`` and the ``bias``."""
    adam.t += 1
    pooled = np.zeros((len(texts), FILTERS * len(WIDTHS)), dtype=np.float32)
    sources = []
    for b, words in enumerate(texts):
        best, places = net.places(words)
        for i in range(len(WIDTHS)):
            own = slice(i * FILTERS, (i + 1) * FILTERS)
            if places[own][0] >= 0:
                pooled[b, own] = best[own] + net.shifts[i]
                sources.append((b, i, words, places[own]))
    active = pooled > 0
    value = np.where(active, pooled, 0)
    z = value @ net.out + bias[0]
    slope = (1 / (1 + np.exp(-z)) - labels) / len(texts)
    below = (slope[:, None] * net.out[None, :]) * active
    to_filters = [np.zeros_like(f) for f in net.filters]
    to_shifts = [np.zeros_like(s) for s in net.shifts]
    rows, parts = [], []
    for b, i, words, top in sources:
        g = below[b, i * FILTERS : (i + 1) * FILTERS]
        used = np.flatnonzero(g)
        if not len(used):
            continue
        to_shifts[i][used] += g[used]
        for k in range(WIDTHS[i]):
            here = words[top[used] + k]
            to_filters[i][k][:, used] += net.embedded(here).T * g[used]
            rows.append(here)
            parts.append((net.filters[i][k][:, used] * g[used]).T)
    adam.step("out", net.out, value.T @ slope + 1e-4 * net.out)
    adam.step("bias", bias, np.array([slope.sum()], dtype=np.float32))
    for i in range(len(WIDTHS)):
        adam.step(f"f{i}", net.filters[i], to_filters[i])
        adam.step(f"s{i}", net.shifts[i], to_shifts[i])
    if rows:
        rows, parts = np.concatenate(rows), np.concatenate(parts)
        for name, weights, own in (("e1", net.first, rows >> 32), ("e2", net.second, rows & 0xFFFFFFFF)):
            unique, place = np.unique(own, return_inverse=True)
            total = np.zeros((len(unique), DIM), dtype=np.float32)
            np.add.at(total, place, parts)
            adam.step(name, weights, total, unique)


def train(texts: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Network:
    """Logistic loss, Adam, minibatches; the slope of a pooled value goes to the place of its maximum."""
    net, rng, adam = Network.fresh(seed), np.random.default_rng(seed), Adam(RATE)
    labels = labels.astype(np.float32)
    bias = np.zeros(1, dtype=np.float32)
    for epoch in range(epochs):
        adam.rate = RATE * (1 - epoch / (epochs + 1))
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            step(net, adam, bias, [texts[t] for t in chosen], labels[chosen])
    net.bias = float(bias[0])
    return net


def best_threshold(scores: np.ndarray, labels: np.ndarray) -> float:
    """The threshold of the best F1; the middle of the gap above which it holds."""
    if not labels.any():
        return THRESHOLD
    order = np.argsort(-scores, kind="stable")
    s, hit = scores[order], np.cumsum(labels[order])
    f1 = 2 * hit / (np.arange(1, len(s) + 1) + labels.sum())
    f1[:-1][s[:-1] == s[1:]] = -1  # a threshold does not part equal scores
    k = int(np.argmax(f1))
    return float((s[k] + s[k + 1]) / 2) if k + 1 < len(s) else float(s[k])


def fit(rows: list[tuple[np.ndarray, int, str | None]], share: float, seed: int = 7) -> Network:
    """Trains on four fifths of the rows, calibrates thresholds on the rest.

    ``share`` is the share of toxic rows among all that could have been drawn: the sample takes more
    of them, and the bias is moved back by the difference of the odds.
    """
    labels = np.array([r[1] for r in rows], dtype=np.int64)
    if not len(rows) or labels.min() == labels.max():
        return constant(share)
    apart = np.arange(len(rows)) % 5 == 4
    learned = [i for i in np.flatnonzero(~apart)]
    net = train([rows[i][0] for i in learned], labels[learned], seed=seed)
    mean = labels[learned].mean()
    if 0 < share < 1 and 0 < mean < 1:
        net.bias += float(np.log(share / (1 - share)) - np.log(mean / (1 - mean)))
    held = np.flatnonzero(apart)
    scores = np.array([net.score(rows[i][0]) for i in held])
    net.thresholds[""] = best_threshold(scores, labels[held])
    for lang in {rows[i][2] for i in held} - {None}:
        own = np.array([rows[i][2] == lang for i in held])
        if labels[held][own].sum() >= 10:
            net.thresholds[lang] = best_threshold(scores[own], labels[held][own])
    return net


def remainder(key: Column, by: int) -> Column:
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(by))


def weights(net: Network, bias: float) -> dict[str, np.ndarray]:
    """All weights by name, as rows of ``DIM`` numbers (the last row of a name is filled up with zeros)."""
    named = {"first": net.first, "second": net.second, "out": net.out, "bias": np.array([bias])}
    named |= {f"filter{i}": x for i, x in enumerate(net.filters)} | {f"shift{i}": x for i, x in enumerate(net.shifts)}
    flat = {name: np.asarray(x, dtype=np.float64).ravel() for name, x in named.items()}
    return {name: np.pad(x, (0, -len(x) % DIM)).reshape(-1, DIM) for name, x in flat.items()}


def of_weights(rows: dict[str, np.ndarray]) -> Network:
    """The network of :func:`weights`."""
    put = lambda name, x: rows[name].ravel()[: x.size].reshape(x.shape).astype(np.float32)
    like = Network.fresh()
    return Network(
        put("first", like.first), put("second", like.second),
        [put(f"filter{i}", x) for i, x in enumerate(like.filters)], [put(f"shift{i}", x) for i, x in enumerate(like.shifts)],
        put("out", like.out), float(rows["bias"][0, 0]),
    )


def refine(net: Network, rows: DataFrame, passes: int = PASSES, seed: int = 7) -> Network:
    """Goes on from ``net`` over all ``rows`` (words, toxic), each partition from the same weights.

    After each pass a row of weights moves by the mean of the moves of the partitions that moved it, so a word that
    few partitions know counts in full. Moves are whole multiples of 2^-32: their sums do not depend on an order.
    """
    numbers = [f"v{i}" for i in range(DIM)]
    for turn in range(passes):
        sent, rate = rows.sparkSession.sparkContext.broadcast(net), RATE / 4 * (1 - turn / (passes + 1))

        def moves(batches, sent=sent, rate=rate, turn=turn):
            from copy import deepcopy

            own, adam, rng = deepcopy(sent.value), Adam(rate), np.random.default_rng([seed, turn])
            bias = np.array([own.bias], dtype=np.float32)
            for batch in batches:
                labels = batch.column(1).to_numpy(zero_copy_only=False).astype(np.float32)
                order = rng.permutation(batch.num_rows)
                for at in range(0, len(order), BATCH):
                    chosen = order[at : at + BATCH]
                    step(own, adam, bias, [unpacked(batch.column(0)[int(i)].as_py()) for i in chosen], labels[chosen])
            if adam.t:
                before = weights(sent.value, sent.value.bias)
                for name, after in weights(own, float(bias[0])).items():
                    move = np.rint((after - before[name]) * 2.0**32).astype(np.int64)
                    at = np.flatnonzero(move.any(axis=1))
                    columns = {"name": [name] * len(at), "at": at.astype(np.int32), **{v: move[at, i] for i, v in enumerate(numbers)}}
                    yield pa.RecordBatch.from_pydict(columns)

        moved = rows.select("words", "toxic").mapInArrow(moves, "name string, at int, " + ", ".join(f"{v} long" for v in numbers))
        mean = moved.groupBy("name", "at").agg(*[(F.sum(v) / F.count(F.lit(1)) / 2.0**32).alias(v) for v in numbers])
        found = mean.toPandas()  # at most one row for each row of weights
        rows_of = weights(net, net.bias)
        for name, own in found.groupby("name"):
            rows_of[name][own["at"].to_numpy()] += own[numbers].to_numpy()
        net = of_weights(rows_of)
    return net


def calibrate(net: Network, rows: DataFrame) -> dict[str, float]:
    """Thresholds by language from the scores of all ``rows`` (words, toxic, lang), counted by ten-thousandths."""

    def work():
        def score(words, toxic, lang):
            return {"toxic": toxic, "lang": lang, "bin": [round(net.score(unpacked(w)) * 10_000) for w in words.to_pylist()]}

        return score

    binned = by_batch(rows.select("words", "toxic", "lang"), "toxic int, lang string, bin int", work)
    cells = binned.groupBy("lang", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("hits")).persist()
    try:
        enough = cells.groupBy("lang").agg(F.sum("hits").alias("all")).where("all >= 10 AND lang IS NOT NULL").select("lang")
        general = cells.groupBy("bin").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")).collect()
        thresholds = {"": best_of_bins(general)}
        by_lang = cells.join(enough, "lang").groupBy("lang").agg(F.collect_list(F.struct("bin", "n", "hits")).alias("bins"))
        thresholds |= {r.lang: best_of_bins(r.bins) for r in by_lang.collect()}  # languages; at most 10,001 bins each
    finally:
        cells.unpersist()
    return thresholds


def best_of_bins(bins) -> float:
    """:func:`best_threshold` of scores that are counted by ten-thousandths."""
    bins = sorted(bins, key=lambda r: -r["bin"])
    s, n, hit = (np.array([r[c] for r in bins], dtype=float) for c in ("bin", "n", "hits"))
    if not hit.sum():
        return THRESHOLD
    k = int(np.argmax(2 * hit.cumsum() / (n.cumsum() + hit.sum())))
    return float((s[k] + s[k + 1]) / 20_000 if k + 1 < len(s) else s[k] / 10_000)


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Network:
    """Learns from all labelled ids, one text of each (docs: doc_id, text, lang; labels: doc_id, toxic).

    Up to ``sample`` ids of each label are fitted at once. With more, that many give the first weights only: all
    rows but a fifth go on from them in the tasks, and the thresholds come from all rows of that fifth.
    """
    marked = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r.toxic: r["count"] for r in marked.groupBy("toxic").count().collect()}  # two rows
    total = sum(counts.values())
    if not total:
        return constant(0.0)
    apart = F.pmod(F.xxhash64("doc_id", F.lit("apart")), F.lit(5)) == 4
    more = max(counts.values()) > sample
    start = marked.where(~apart) if more else marked
    drawn = [start.where(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for t in (0, 1)]
    chosen = drawn[0].unionByName(drawn[1])  # at most twice the sample: small enough to send to all tasks
    rows = sorted(_words(docs, F.broadcast(chosen)).collect(), key=lambda r: (xxhash.xxh64_intdigest(str(r.doc_id)), r.words))
    net = fit([(unpacked(r.words), r.toxic, r.lang) for r in rows], counts.get(1, 0) / total)
    if not more:
        return net
    # parts of some size: a pass takes as many steps as a part has minibatches, however many parts there are
    whole = _dealt(docs, marked, math.ceil(total / PART)).withColumn("apart", apart).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        net = refine(net, whole.where("NOT apart"))
        net.thresholds = calibrate(net, whole.where("apart"))
    finally:
        whole.unpersist()
    return net


def _words(docs: DataFrame, marked: DataFrame) -> DataFrame:
    """doc_id, words, lang, toxic of the marked ids, few enough to send to all tasks, one text of each."""
    found = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).join(marked, "doc_id")
    # rows of one id are reduced before they leave their task, so the rows that reach the driver are bounded too
    one = F.min(F.struct(F.xxhash64("text").alias("h"), "text", "lang", F.col("toxic").cast("int").alias("toxic")))
    texts = found.groupBy("doc_id").agg(one.alias("one")).select("doc_id", "one.text", "one.lang", "one.toxic")

    def work():
        buckets = Buckets()

        def step(ids, texts, langs, toxic):
            return {"doc_id": ids, "words": [packed(buckets.of(t)) for t in texts.to_pylist()], "lang": langs, "toxic": toxic}

        return step

    kind = docs.schema["doc_id"].dataType.simpleString()
    return by_batch(texts, f"doc_id {kind}, words binary, lang string, toxic int", work)


def _dealt(docs: DataFrame, marked: DataFrame, parts: int) -> DataFrame:
    """doc_id, words, lang, toxic of all marked ids, one text of each, in ``parts`` by a hash of the id and in its order.

    They are shuffled once, as buckets of words, and documents that no label can belong to stay behind.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    own = F.col("doc_id").try_cast(kind)
    ids = marked.select(F.xxhash64(own).alias("h"), own.alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    one = "struct<text_hash: bigint, words: binary, lang: string>"
    texts = _likely_marked(docs, ids).select("h", "doc_id", F.lit(None).cast("int").alias("toxic"), F.struct("text_hash", "words", "lang").cast(one).alias("one"))
    met = texts.unionByName(ids.withColumn("one", F.lit(None).cast(one))).repartition(parts, "h")
    # the parts hold whole groups: the rows are grouped where they are
    chosen = met.groupBy("h", "doc_id").agg(F.max("toxic").alias("toxic"), F.min("one").alias("one")).where("toxic IS NOT NULL AND one IS NOT NULL")
    return chosen.sortWithinPartitions("h").select("doc_id", "one.words", "one.lang", "toxic")


def _likely_marked(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """h, doc_id, text_hash, words, lang of the rows whose hash of the id has the last bits of one of ``ids`` (h)."""
    bits = np.packbits(bit_map(ids.select("h"), "h", MAP_BITS), bitorder="little")
    sent = docs.sparkSession.sparkContext.broadcast(bits.tobytes())
    asked = docs.where("doc_id IS NOT NULL").select(
        F.xxhash64("doc_id").alias("h"), "doc_id", F.xxhash64("text").alias("text_hash"), "text", F.col("lang").cast("string").alias("lang")
    )

    def work():
        known, buckets = np.frombuffer(sent.value, dtype=np.uint8), Buckets()

        def step(h, ids, hashes, texts, langs):
            place = h.to_numpy(zero_copy_only=False) & ((1 << MAP_BITS) - 1)
            at = pa.array(np.flatnonzero(known[place >> 3] >> (place & 7) & 1))
            words = [packed(buckets.of(t)) for t in texts.take(at).to_pylist()]
            return {"h": h.take(at), "doc_id": ids.take(at), "text_hash": hashes.take(at), "words": words, "lang": langs.take(at)}

        return step

    kind = docs.schema["doc_id"].dataType.simpleString()
    return by_batch(asked, f"h long, doc_id {kind}, text_hash long, words binary, lang string", work)


def scored(docs: DataFrame, network: Network, keys: list[str], text: str = "text") -> DataFrame:
    """keys and score of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(network)

    def work():
        net, buckets = sent.value, Buckets()

        def step(*columns):
            return {**dict(zip(keys, columns)), "score": [net.score(buckets.of(t.as_py())) for t in columns[-1]]}

        return step

    kinds = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys)
    return by_batch(docs.select(*keys, text), f"{kinds}, score double", work)


def flagged(network: Network, score: Column, lang: Column) -> Column:
    """Whether a score reaches the threshold of its language."""
    general = F.lit(network.thresholds.get("", THRESHOLD))
    limit = general
    for name, value in sorted(network.thresholds.items()):
        if name:
            limit = F.when(lang == name, F.lit(value)).otherwise(limit)
    return score >= F.coalesce(limit, general)


@query("op1_toxicity")
def toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Every document, by a network that learns from labelled rows not held out."""
    held = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", held.alias("held_out"))
    labels = table(spark, folder, "labels").select("doc_id", "toxic").where(remainder(F.col("doc_id"), 4) != 2)
    network = learn(docs.where("not held_out"), labels)
    found = scored(docs, network, ["doc_id", "held_out", "lang"])
    return found.select(
        "doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        flagged(network, F.col("score"), F.col("lang")).alias("flagged_by_language"),
    )
