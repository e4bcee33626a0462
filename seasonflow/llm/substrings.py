"""Substring deduplication by suffix automata of reference shards.

A window is a run of ``window`` words of one document. A word is removed if a window that covers it
begins earlier too: in a document with a smaller id, or in the same one further ahead.

The reference is the corpus itself. To send automata of all of it to all documents would be quadratic
and unbounded, so shards and documents meet by content. Every window has an anchor, the run of
``ANCHOR`` words in it with the least hash; equal windows have equal anchors. Anchors that occur once
are settled at once: their windows are first occurrences. The passages around each other anchor are
that anchor's shard. In a shard the distinct passages are streamed in document order through a suffix
automaton of those before them; where the matching statistic reaches the threshold the window is a
repetition. Anchors of very many passages are lengthened to the whole window, so a shard is bounded.

What travels back to a document are its first occurrences, each of them once: all other windows of
repeated anchors are repetitions. So no hot passage is ever joined with all documents that hold it.

Defined results: null and empty texts have no words and lose none; a null id comes before all others;
rows that agree in id and text are one document and share a result, rows of one id with different
texts are ordered by a hash of the text; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seasonflow.llm.common import bit_map, by_batch, mixed, shingle_hashes, table
from seasonflow.llm.registry import query
from seasonflow.session import settle

WINDOW, ANCHOR = 20, 6
#: Occurrences above which an anchor is lengthened to the whole window.
HOT = 400
#: Bits of the map of such anchors; anchors that share a bit are lengthened too, to no harm.
HOT_BITS = 22
_NULL_ORDER = -(1 << 63)


#: Bytes of text that a task works on at a time; a longer text is a stretch of its own.
STRETCH = 1 << 21
_BLANKS = np.zeros(256, dtype=bool)
_BLANKS[list(b" \t\n\x0b\x0c\r")] = True
_TO_SPACE = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")
_BASE = 0x9E3779B97F4A7C15
_LETTERS = mixed(np.arange(1, 257, dtype=np.uint64))


class Stretch:
    """The words of some texts, one text after the other, as places in one buffer.

    A word's hash is a polynomial of its bytes, taken from running sums over the buffer, so no word
    becomes a Python object. Places of words and windows count through all texts of the stretch.
    """

    def __init__(self, texts: list[bytes]):
        self.raw = b"".join(texts).translate(_TO_SPACE)
        buffer = np.frombuffer(self.raw, dtype=np.uint8)
        self.offsets = np.cumsum([0] + [len(t) for t in texts])
        inside = np.concatenate(([False], ~_BLANKS[buffer], [False]))
        begins, finishes = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
        edges = np.unique(self.offsets[1:-1])  # a word does not go on in the next text
        edges = edges[(edges > 0) & (edges < len(buffer))]
        begins[edges] = inside[1:-1][edges]
        finishes[edges - 1] = inside[1:-1][edges - 1]
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
        # the first word of each text, and the text of each word
        self.first_word = np.searchsorted(self.starts, self.offsets)
        self.text_of = np.repeat(np.arange(len(texts)), np.diff(self.first_word))
        self.hashes = self._hashes(buffer)

    def _hashes(self, buffer: np.ndarray) -> np.ndarray:
        if not len(self.starts):
            return np.empty(0, dtype=np.uint64)
        powers = np.full(len(buffer) + 1, _BASE, dtype=np.uint64)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(_LETTERS[buffer] * powers[:-1], dtype=np.uint64)))
        # words of one content at two places differ by a power of the base, which is divided out
        inverse = np.full(len(buffer) + 1, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
        inverse[0] = 1
        inverse = np.multiply.accumulate(inverse)
        return mixed((sums[self.ends] - sums[self.starts]) * inverse[self.starts])

    def anchors(self, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """hash, place, first and last window of every anchor: windows in a row share one."""
        grams, n = shingle_hashes(self.hashes, ANCHOR), len(self.hashes) - window + 1
        if n <= 0:
            none = np.empty(0, dtype=np.int64)
            return np.empty(0, dtype=np.uint64), none, none, none
        least, place = grams[:n].copy(), np.zeros(n, dtype=np.int64)
        for j in range(1, window - ANCHOR + 1):
            here = grams[j : j + n]
            better = here < least
            np.copyto(least, here, where=better)
            np.copyto(place, j, where=better)
        whole = np.flatnonzero(self.text_of[:n] == self.text_of[window - 1 :])  # windows within one text
        place = place[whole] + whole
        new = np.concatenate(([True], place[1:] != place[:-1])) if len(place) else np.empty(0, dtype=bool)
        begin = np.flatnonzero(new)
        finish = np.concatenate((begin[1:], [len(place)]))[: len(begin)] - 1
        return grams[place[begin]], place[begin], whole[begin], whole[finish]

    def words(self, a: int, b: int) -> bytes:
        """The words from place a to before b, joined by one space."""
        part = self.raw[self.starts[a] : self.ends[b - 1]] if b > a else b""
        exact = b <= a or len(part) == int((self.ends[a:b] - self.starts[a:b]).sum()) + b - a - 1
        return part if exact else b" ".join(part.split())


def stretches(texts: list[bytes]):
    """Row range and stretch, over all rows."""
    at = 0
    while at < len(texts):
        upto, size = at, 0
        while upto < len(texts) and (upto == at or size + len(texts[upto]) <= STRETCH):
            size += len(texts[upto])
            upto += 1
        yield at, upto, Stretch(texts[at:upto])
        at = upto


class SuffixAutomaton:
    """Of all word sequences added so far; sequences are set apart by marks that match nothing."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.last = [-1], [0], 0

    def _append(self, word) -> None:
        nexts, link, length = self.next, self.link, self.length
        new = len(nexts)
        nexts.append({})
        link.append(0)
        length.append(length[self.last] + 1)
        p = self.last
        while p >= 0 and word not in nexts[p]:
            nexts[p][word] = new
            p = link[p]
        if p >= 0:
            q = nexts[p][word]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                copy = len(nexts)
                nexts.append(dict(nexts[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and nexts[p].get(word) == q:
                    nexts[p][word] = copy
                    p = link[p]
                link[q] = link[new] = copy
        self.last = new

    def add(self, words: list[bytes]) -> None:
        for word in words:
            self._append(word)
        self._append(len(self.next))  # a number is no word

    def statistics(self, words: list[bytes]) -> list[int]:
        """For each word, how many words up to it occur together in what was added."""
        nexts, link, length = self.next, self.link, self.length
        state = matched = 0
        out = []
        for word in words:
            while state and word not in nexts[state]:
                state = link[state]
                matched = length[state]
            if word in nexts[state]:
                state = nexts[state][word]
                matched += 1
            out.append(matched)
        return out


def first_windows(passages: list[list[bytes]], window: int = WINDOW) -> list[int]:
    """For distinct passages in order, bits of the windows that occur in no passage (or place) before."""
    reference, found = SuffixAutomaton(), []
    for words in passages:
        known = reference.statistics(words) if found else [0] * len(words)
        bits, seen = 0, set()
        for j in range(len(words) - window + 1):
            own = tuple(words[j : j + window]) if len(words) > window else ()
            if known[j + window - 1] < window and own not in seen:
                bits |= 1 << j
            seen.add(own)
        found.append(bits)
        if len(found) < len(passages):
            reference.add(words)
    return found


def _numbered(docs: DataFrame, key: str, text: str) -> DataFrame:
    """id, place in the order of documents (rank, tie) and text. Only ids that repeat need a tie."""
    rank = F.coalesce(F.col(key).cast("long"), F.lit(_NULL_ORDER))
    rows = docs.select(F.col(key).alias("id"), rank.alias("rank"), F.col(text).alias("text"))
    twice = settle(rows.groupBy("rank").count().where("count > 1").select(F.col("rank").alias("twice")))
    if twice.isEmpty():
        return rows.withColumn("tie", F.lit(0).cast("long"))
    tied = rows.join(twice, F.col("rank") == F.col("twice"), "left")
    return tied.select("id", "rank", "text", F.when(F.col("twice").isNotNull(), F.xxhash64("text")).otherwise(F.lit(0)).cast("long").alias("tie"))


def _all_anchors(rows: DataFrame, window: int) -> DataFrame:
    def work():
        def step(ranks, ties, texts):
            ranks, ties = (c.to_numpy(zero_copy_only=False) for c in (ranks, ties))
            out = {"anchor": [], "rank": [], "tie": [], "place": []}
            for a, b, part in stretches([t or b"" for t in texts.cast("binary").to_pylist()]):
                h, place, _, _ = part.anchors(window)
                own = part.text_of[place]
                out["anchor"].append(h.view(np.int64))
                out["rank"].append(ranks[a:b][own])
                out["tie"].append(ties[a:b][own])
                out["place"].append((place - part.first_word[own]).astype(np.int32))
            return {k: np.concatenate(v) for k, v in out.items()}

        return step

    return by_batch(rows.select("rank", "tie", "text"), "anchor long, rank long, tie long, place int", work)


def _compressed(rows: DataFrame) -> DataFrame:
    """Texts as they go through a shuffle: half as large as under the shuffle's own compression."""
    kind = rows.schema["id"].dataType.simpleString()

    def work():
        compress = zstandard.ZstdCompressor(level=3).compress

        def step(ids, ranks, ties, texts):
            return {"id": ids, "rank": ranks, "tie": ties, "body": [compress(t or b"") for t in texts.cast("binary").to_pylist()]}

        return step

    return by_batch(rows.select("id", "rank", "tie", "text"), f"id {kind}, rank long, tie long, body binary", work)


def _opened(bodies) -> list[bytes]:
    expand = zstandard.ZstdDecompressor().decompress
    return [expand(b) for b in bodies.to_pylist()]


def _flat(lists, a: int, b: int) -> tuple[np.ndarray, object]:
    """Row (from 0) and value of every entry of the lists of rows a to b; null lists are empty."""
    part = lists.slice(a, b - a)
    lengths = part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(b - a), lengths), part.flatten()


def _repeated(part: Stretch, place: np.ndarray, once, a: int, b: int) -> np.ndarray:
    """Which anchors occur more than once."""
    row, value = _flat(once, a, b)
    single = np.zeros(len(part.hashes) + 1, dtype=bool)
    single[part.first_word[row] + value.to_numpy(zero_copy_only=False)] = True
    return ~single[place]


def _once_and_hot(found: DataFrame) -> DataFrame:
    """For each document the places of its anchors that occur once; beside them, under null ranks, hot anchors."""
    counts = found.groupBy("anchor").agg(F.count("*").alias("n"), F.min("rank").alias("rank"), F.min("tie").alias("tie"), F.min("place").alias("place"))
    single = F.col("n") == 1
    kept = counts.where(single | (F.col("n") > HOT)).select(
        F.when(single, F.col("rank")).alias("rank"),
        F.when(single, F.col("tie")).otherwise(F.pmod("anchor", F.lit(1 << 16))).alias("tie"),
        F.when(single, F.col("place")).alias("place"),
        F.when(~single, F.col("anchor")).alias("anchor"),
    )
    return settle(kept.groupBy("rank", "tie").agg(F.collect_list("place").alias("once"), F.collect_list("anchor").alias("hot")))


def _passages(rows: DataFrame, hot, window: int) -> DataFrame:
    """anchor, passage (its words, joined) and place of every repeated anchor of rows with ``once``.

    For a hot anchor each window is a passage of its own, under a hash of the whole window and with
    another hash in place of its words.
    """
    sent = rows.sparkSession.sparkContext.broadcast(hot.tobytes())

    def work():
        bits = np.frombuffer(sent.value, dtype=bool)
        mask = np.uint64((1 << HOT_BITS) - 1)

        def step(ranks, ties, bodies, once):
            out = {"anchor": [], "passage": [], "rank": [], "tie": [], "start": []}
            ranks, ties = ranks.to_pylist(), ties.to_pylist()

            def put(part, a, anchor, passage, window_at):
                row = int(part.text_of[window_at])
                values = (anchor, passage, ranks[a + row], ties[a + row], window_at - int(part.first_word[row]))
                for name, value in zip(out, values):
                    out[name].append(value)

            for a, b, part in stretches(_opened(bodies)):
                h, place, first, last = part.anchors(window)
                repeated = _repeated(part, place, once, a, b)
                much = repeated & bits[h & mask]
                for i in np.flatnonzero(repeated & ~much).tolist():
                    put(part, a, int(h[i].astype(np.int64)), part.words(int(first[i]), int(last[i]) + window), int(first[i]))
                if much.any():
                    whole = shingle_hashes(part.hashes, window).view(np.int64)
                    other = shingle_hashes(mixed(part.hashes + np.uint64(1)), window)
                    for i in np.flatnonzero(much).tolist():
                        for j in range(int(first[i]), int(last[i]) + 1):
                            put(part, a, int(whole[j]), b"#" + other[j].tobytes(), j)
            return out

        return step

    return by_batch(rows.select("rank", "tie", "body", "once"), "anchor long, passage binary, rank long, tie long, start int", work)


def _firsts(passages: DataFrame, window: int) -> DataFrame:
    """rank, tie, start and bits: the windows from ``start`` on that are first occurrences."""
    distinct = passages.groupBy("anchor", "passage").agg(F.min(F.struct("rank", "tie", "start")).alias("at"))
    # the count by anchor makes Spark deal the rows, already combined, by the anchor
    counted = distinct.withColumn("variants", F.count("*").over(Window.partitionBy("anchor"))).sortWithinPartitions("anchor", "at")
    rows = counted.select("anchor", "passage", "at.rank", "at.tie", "at.start", "variants")

    def work():
        import pyarrow as pa

        def judged(group):
            texts = [g[1].split(b" ") for g in group]
            return first_windows(texts, window)

        def run(batches):
            group: list[tuple] = []
            for batch in batches:
                out: list[tuple] = []
                for row in zip(*(batch.column(i).to_pylist() for i in range(6))):
                    anchor, passage, rank, tie, start, variants = row
                    if group and group[0][0] != anchor:
                        out += zip(group, judged(group))
                        group = []
                    if passage[:1] == b"#" and len(passage) == 9:
                        out.append((row, 1))
                    elif variants == 1 and passage.count(b" ") == window - 1:
                        out.append((row, 1))
                    else:
                        group.append(row)
                yield pack(out)
            if group:
                yield pack(list(zip(group, judged(group))))

        def pack(out):
            kept = [(r[2], r[3], r[4], bits) for r, bits in out if bits]
            columns = list(zip(*kept)) or [(), (), (), ()]
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64())
            return pa.RecordBatch.from_pydict({n: pa.array(c, k) for n, c, k in zip(("rank", "tie", "start", "bits"), columns, kinds)})

        return run

    return rows.mapInArrow(work(), "rank long, tie long, start int, bits long")


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """id, n_words, n_removed, kept_sha256 (and kept, the text that is left) of every row."""
    if not ANCHOR < window < ANCHOR + 62:
        raise ValueError("the window must be longer than an anchor, by less than 62 words")
    rows = _numbered(docs, key, text)
    lists = _once_and_hot(_all_anchors(rows, window))
    hot = bit_map(lists.where("rank IS NULL").select(F.explode("hot").alias("anchor")), "anchor", HOT_BITS)
    once = lists.where("rank IS NOT NULL").select("rank", "tie", "once")
    listed = _compressed(rows).join(once, ["rank", "tie"], "left")
    firsts = _firsts(_passages(listed, hot, window), window)
    first = settle(firsts.groupBy("rank", "tie").agg(F.collect_list(F.struct("start", "bits")).alias("first")))
    lined = listed.join(first, ["rank", "tie"], "left")
    kind = docs.schema[key].dataType.simpleString()

    def work():
        def step(ids, bodies, once, first):
            out = {"id": ids, "n_words": [], "n_removed": [], "kept_sha256": [], "kept": []}
            for a, b, part in stretches(_opened(bodies)):
                _, place, begin, last = part.anchors(window)
                change = np.zeros(len(part.hashes) + 1, dtype=np.int64)
                again = _repeated(part, place, once, a, b)
                np.add.at(change, begin[again], 1)
                np.add.at(change, last[again] + 1, -1)
                repeats = np.cumsum(change) > 0  # by window
                row, value = _flat(first, a, b)
                at = part.first_word[row] + value.field("start").to_numpy(zero_copy_only=False)
                bits = value.field("bits").to_numpy(zero_copy_only=False)
                for j in range(int(bits.max(initial=0)).bit_length()):
                    repeats[at[(bits >> j) & 1 == 1] + j] = False
                change[:] = 0
                where = np.flatnonzero(repeats)
                change[where] += 1
                np.add.at(change, where + window, -1)
                gone = np.cumsum(change) > 0  # by word
                for i in range(b - a):
                    p, q = int(part.first_word[i]), int(part.first_word[i + 1])
                    lost = int(gone[p:q].sum())
                    kept = part.words(p, q)
                    if lost:
                        kept = b" ".join([w for w, g in zip(kept.split(b" "), gone[p:q].tolist()) if not g])
                    out["n_words"].append(q - p)
                    out["n_removed"].append(lost)
                    out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                    if with_text:
                        out["kept"].append(kept.decode())
            if not with_text:
                del out["kept"]
            return out

        return step

    schema = f"id {kind}, n_words long, n_removed long, kept_sha256 string" + (", kept string" if with_text else "")
    return by_batch(lined.select("id", "body", "once", "first"), schema, work)


@query("op2_substring_dedup")
def substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document, without the windows of 20 words that begin earlier in the corpus."""
    return deduplicated(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")
