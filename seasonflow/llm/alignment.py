"""Alignment of the tokens of two tokenizers.

A text is encoded by a byte-level BPE (A, of a blank and the text) and by a piece model (B, which adds
the blank itself). Where tokens of both end at the same byte the text is cut into groups, and an A and a
B token are linked where their bytes overlap. Every byte place where a token of either ends closes
one such overlap, so links are read off the merged ends.

Corpus-wide, a pair of ids counts the documents that hold it linked. Most links join an A id to the B
piece of the same bytes. An array from each A id to that B id is made beforehand, and these identity
pairs are counted in vectors as long as the vocabulary. Only the other pairs are shuffled: they are summed
in their tasks first, the most frequent of them (``HOT``, a fixed number) are sent to all tasks, and what
is left of a document's pairs is joined with the counts by pair.

Defined results: texts that are null or empty, or whose bytes a tokenizer does not give back, have no
tokens, zero counts and an empty digest; repeated rows are documents of their own and count each; a
null or repeated id is carried along; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonflow.llm.common import table
from seasonflow.llm.registry import query
from seasonflow.session import settle

#: Bytes of text that are aligned at a time; a longer text is aligned by itself.
STRETCH = 1 << 20
#: The most frequent irregular pairs, whose counts go to all tasks: 4 MB; the others are joined.
HOT = 1 << 18
BLANK = "▁"
#: Fixed value: how byte-level tokenizers cut a text before they merge.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def default_models() -> tuple[bytes, bytes]:
    import public_tokenizers

    found = []
    for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"):
        with open(public_tokenizers.path(name), "rb") as f:
            found.append(f.read())
    return found[0], found[1]


def byte_letters() -> dict[str, int]:
    """The byte of each letter of a byte-level vocabulary: printable bytes stand for themselves, the others
    take the letters from 256 on, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def by_ranks(a_json: bytes) -> tiktoken.Encoding | None:
    """The same encoder by the ranks of its pieces, which is some times as fast, for a plain byte-level BPE whose
    merges are numbered in their order after the single bytes; None for any other."""
    found = json.loads(a_json)
    cut, model = found["pre_tokenizer"] or {}, found["model"]
    plain = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space") and not found["normalizer"]
    odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    if not plain or model["type"] != "BPE" or any(model.get(name) for name in odd):
        return None
    special = {t["content"] for t in found["added_tokens"]}
    letters, ids = byte_letters(), {piece: i for piece, i in model["vocab"].items() if piece not in special}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if sorted(i for piece, i in ids.items() if len(piece) == 1) != list(range(256)):
        return None
    if [ids.get(a + b) for a, b in merges] != list(range(256, len(ids))):
        return None
    ranks = {bytes(map(letters.__getitem__, piece)): i for piece, i in ids.items()}
    return tiktoken.Encoding("byte-level", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})


class Tokenizers:
    """Both tokenizers, the bytes of their ids, and the identity map, in one task."""

    def __init__(self, a_json: bytes, b_model: bytes):
        self.a = tokenizers.Tokenizer.from_str(a_json.decode())
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.ranked = by_ranks(a_json)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        letters = byte_letters()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for piece, i in vocabulary.items():
            self.a_bytes[i] = bytes(letters[c] for c in piece) if all(c in letters for c in piece) else piece.encode()
        self.b_bytes = [self._b_bytes(i) for i in range(self.b.vocab_size())]
        plain = {}
        for i, raw in enumerate(self.b_bytes):
            if not (self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_byte(i)):
                plain.setdefault(raw, i)
        #: For each A id the B id of the same bytes, or -1.
        self.same = np.array([plain.get(raw, -1) for raw in self.a_bytes], dtype=np.int64)
        self.a_sizes = np.array([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], dtype=np.int64)
        #: How a group of an A token and its identity is written, and how ids are.
        self.written = [f"{i}|{j}" for i, j in enumerate(self.same.tolist())]
        self.numbers = [str(i) for i in range(max(len(self.a_sizes), len(self.b_sizes)))]
        #: Bits that hold an id of B, and of A.
        self.b_bits, self.a_bits = len(self.b_sizes).bit_length(), len(self.a_sizes).bit_length()

    def _b_bytes(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(BLANK, " ").encode()

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both for every text; empty where the bytes of either are not those of a blank and the text."""
        use = [i for i, t in enumerate(texts) if t]
        a_ids, b_ids = [[] for _ in texts], [[] for _ in texts]
        if self.ranked is not None:
            found_a = [self.ranked.encode_ordinary(" " + texts[i]) for i in use]
        else:
            found_a = [e.ids for e in self.a.encode_batch([" " + texts[i] for i in use], add_special_tokens=False)]
        found_b = self.b.encode([texts[i] for i in use], num_threads=1)
        a_bytes, b_bytes = self.a_bytes.__getitem__, self.b_bytes.__getitem__
        for i, a, b in zip(use, found_a, found_b):
            raw = b" " + texts[i].encode("utf-8", "surrogatepass")
            if b"".join(map(a_bytes, a)) == raw and b"".join(map(b_bytes, b)) == raw:
                a_ids[i], b_ids[i] = a, b
        return a_ids, b_ids


class Aligned:
    """The tokens of some texts, one after the other, as ends in one run of bytes."""

    def __init__(self, known: Tokenizers, a_ids: list[list[int]], b_ids: list[list[int]]):
        self.known = known
        self.a_counts = np.array([len(x) for x in a_ids], dtype=np.int64)
        self.b_counts = np.array([len(x) for x in b_ids], dtype=np.int64)
        self.a = np.fromiter(chain.from_iterable(a_ids), dtype=np.int64, count=self.a_counts.sum())
        self.b = np.fromiter(chain.from_iterable(b_ids), dtype=np.int64, count=self.b_counts.sum())
        self.a_ends, self.b_ends = np.cumsum(known.a_sizes[self.a]), np.cumsum(known.b_sizes[self.b])
        self.text_of = np.repeat(np.arange(len(a_ids)), self.a_counts)
        common = np.searchsorted(self.b_ends, self.a_ends)
        together = np.zeros(len(self.a), dtype=bool)
        inside = common < len(self.b)
        together[inside] = self.b_ends[common[inside]] == self.a_ends[inside]
        #: For each group the place after its last token of A, and of B.
        self.a_stops = np.flatnonzero(together) + 1
        self.b_stops = common[together] + 1
        self.groups = np.bincount(self.text_of[self.a_stops - 1], minlength=len(a_ids)) if len(self.a) else np.zeros(len(a_ids), dtype=np.int64)

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """text, A id and B id of every distinct pair linked in a text, and how often."""
        if not len(self.a):
            none = np.empty(0, dtype=np.int64)
            return none, none, none, none
        # both are in order: the tokens that end at a byte, and the ends of either after it
        ends = np.sort(np.concatenate((self.a_ends, self.b_ends)), kind="stable")
        ends = ends[np.concatenate(([True], ends[1:] != ends[:-1]))]
        at = np.searchsorted(self.a_ends, ends)
        b = self.b[np.searchsorted(self.b_ends, ends)]
        m, n = self.known.b_bits, self.known.a_bits
        keys = np.sort((self.text_of[at] << n | self.a[at]) << m | b)
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        pairs = keys[first]
        return pairs >> (n + m), pairs >> m & ((1 << n) - 1), pairs & ((1 << m) - 1), np.diff(np.append(first, len(keys)))

    def digests(self) -> list[str]:
        """For each text the digest of its groups as they are written."""
        a_first, b_first = np.append(0, self.a_stops), np.append(0, self.b_stops)
        parts: list[str] = []
        if len(self.a_stops):
            one = (np.diff(a_first) == 1) & (np.diff(b_first) == 1)
            lead = self.a[a_first[:-1]]
            parts = list(map(self.known.written.__getitem__, lead.tolist()))
            number = self.known.numbers.__getitem__
            other = np.flatnonzero(~(one & (self.known.same[lead] == self.b[b_first[:-1]])))
            a, b = self.a.tolist(), self.b.tolist()
            for k, p, p2, q, q2 in zip(other.tolist(), a_first[other].tolist(), a_first[other + 1].tolist(), b_first[other].tolist(), b_first[other + 1].tolist()):
                parts[k] = f"{','.join(map(number, a[p:p2]))}|{','.join(map(number, b[q:q2]))}"
        out, g = [], 0
        for count in self.groups.tolist():
            out.append(hashlib.sha256(";".join(parts[g : g + count]).encode()).hexdigest() if count else "")
            g += count
        return out


def _stretches(sizes: list[int]) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(sizes):
        upto, total = at, 0
        while upto < len(sizes) and (upto == at or total + sizes[upto] <= STRETCH):
            total += sizes[upto]
            upto += 1
        yield at, upto
        at = upto


def _lists(of: np.ndarray, rows: int, values: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum(np.bincount(of, minlength=rows)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def aligned(docs: DataFrame, key: str = "doc_id", text: str = "text", models: tuple[bytes, bytes] | None = None) -> DataFrame:
    """One row for each document: row (its number), key, n_a, n_b, n_groups, groups_sha256, and its distinct linked
    pairs: same (A ids linked to their identity) with same_times, odd (A id << 32 | B id) with odd_times."""
    sent = docs.sparkSession.sparkContext.broadcast(models or default_models())  # two files of a fixed size
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        known = Tokenizers(*sent.value)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for p, q in _stretches([len(t or "") for t in texts]):
                part = Aligned(known, *known.encode([t or "" for t in texts[p:q]]))
                of, a, b, times = part.links()
                same = known.same[a] == b
                odd = ~same
                columns = [
                    batch.column(0).slice(p, q - p), batch.column(1).slice(p, q - p),
                    pa.array(part.a_counts), pa.array(part.b_counts), pa.array(part.groups.astype(np.int64)), pa.array(part.digests(), pa.string()),
                    _lists(of[same], q - p, a[same].astype(np.int32)), _lists(of[same], q - p, times[same].astype(np.int32)),
                    _lists(of[odd], q - p, a[odd] << 32 | b[odd]), _lists(of[odd], q - p, times[odd].astype(np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["row", key, "n_a", "n_b", "n_groups", "groups_sha256", "same", "same_times", "odd", "odd_times"]
    schema = f"row long, `{key}` {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, same array<int>, same_times array<int>, odd array<long>, odd_times array<int>"
    return docs.select(F.monotonically_increasing_id().alias("row"), key, text).mapInArrow(run, schema)


def identity_counts(found: DataFrame, size: int) -> np.ndarray:
    """For each A id the documents that hold it linked to its identity: one vector for each task, then their sum."""

    def run(batches):
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"a": seen.astype(np.int64), "n": total[seen]})

    counted = found.select("same").mapInArrow(run, "a long, n long").groupBy("a").agg(F.sum("n").alias("n"))
    total = np.zeros(size, dtype=np.int64)
    for r in counted.collect():  # at most the vocabulary
        total[r.a] = r.n
    return total


def pair_counts(found: DataFrame) -> DataFrame:
    """pair and n: the documents that hold an irregular pair, summed in the tasks before pairs are dealt."""
    return found.select(F.explode("odd").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))


def most_frequent(counts: DataFrame, most: int) -> tuple[DataFrame, bool]:
    """The pairs of the greatest counts, at most ``most`` of them, and whether there are others.

    Counts are binned by size, so that nothing is sorted: a few hundred numbers tell from which on they are taken.
    """
    size = F.floor(F.log2("n") * 16)
    bins = sorted(((r["size"], r["count"]) for r in counts.groupBy(size.alias("size")).count().collect()), reverse=True)
    taken, least = 0, None
    for at, count in bins:
        if taken + count > most:
            break
        taken, least = taken + count, at
    return counts.where(F.lit(False) if least is None else size >= least), taken < sum(c for _, c in bins)


def linked(docs: DataFrame, key: str = "doc_id", text: str = "text", models: tuple[bytes, bytes] | None = None, hot: int = HOT) -> DataFrame:
    """key, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every document."""
    models = models or default_models()
    size = len(Tokenizers(*models).a_sizes)
    found = settle(aligned(docs, key, text, models))
    counts = settle(pair_counts(found))
    vector = identity_counts(found, size)
    best = vector.copy()
    tops = counts.groupBy(F.shiftrightunsigned("pair", 32).alias("a")).agg(F.max("n").alias("n"))
    for r in tops.collect():  # at most the vocabulary
        best[r.a] = max(best[r.a], r.n)
    frequent, rest = most_frequent(counts, hot)
    pairs = np.array(sorted((r.pair, r.n) for r in frequent.collect()), dtype=np.int64).reshape(-1, 2)
    sent = docs.sparkSession.sparkContext.broadcast((vector, best, pairs))
    kind = docs.schema[key].dataType.simpleString()
    carried = ["row", key, "n_a", "n_b", "n_groups", "groups_sha256"]
    schema = f"row long, `{key}` {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, n_best long, count_sum long, rest array<struct<pair:long,times:int,best:long>>"

    def flat(lists) -> tuple[np.ndarray, np.ndarray]:
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        return np.repeat(np.arange(len(lists)), sizes), lists.flatten().to_numpy(zero_copy_only=False)

    def run(batches):
        vector, best, pairs = sent.value
        for batch in batches:
            rows = batch.num_rows
            of, a = flat(batch.column(6))
            times = flat(batch.column(7))[1]
            total = np.bincount(of, vector[a] * times, rows).astype(np.int64)
            top = np.bincount(of, (vector[a] == best[a]) * times, rows).astype(np.int64)
            of, pair = flat(batch.column(8))
            times = flat(batch.column(9))[1]
            at = np.minimum(np.searchsorted(pairs[:, 0], pair), max(len(pairs) - 1, 0))
            here = pairs[at, 0] == pair if len(pairs) else np.zeros(len(pair), dtype=bool)
            n = pairs[at[here], 1]
            total += np.bincount(of[here], n * times[here], rows).astype(np.int64)
            top += np.bincount(of[here], (n == best[pair[here] >> 32]) * times[here], rows).astype(np.int64)
            left = ~here
            entries = pa.StructArray.from_arrays([pa.array(pair[left]), pa.array(times[left]), pa.array(best[pair[left] >> 32])], ["pair", "times", "best"])
            offsets = np.concatenate(([0], np.cumsum(np.bincount(of[left], minlength=rows)))).astype(np.int32)
            rest = pa.ListArray.from_arrays(pa.array(offsets), entries)
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(top), pa.array(total), rest], names=[*carried, "n_best", "count_sum", "rest"])

    summed = found.select(*carried, "same", "same_times", "odd", "odd_times").mapInArrow(run, schema)
    if rest:  # pairs beyond the most frequent ones, each rarer than all of these
        summed = settle(summed)
        rare = summed.select("row", F.inline("rest")).join(counts, "pair")
        joined = rare.groupBy("row").agg(
            F.sum(F.col("n") * F.col("times")).alias("more_sum"), F.sum(F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(0)).alias("more_best")
        )
        summed = summed.join(joined, "row", "left").withColumns({
            "n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0)),
        })
    # each token but the last of a group ends one overlap more
    links = F.col("n_a") + F.col("n_b") - F.col("n_groups")
    return summed.select(key, "n_a", "n_b", "n_groups", links.alias("n_links"), "n_best", "count_sum", "groups_sha256")


@query("op13_token_alignment")
def token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's tokens in two vocabularies, and how its links count in the corpus."""
    return linked(table(spark, folder, "documents"))
