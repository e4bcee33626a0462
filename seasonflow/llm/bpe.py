"""Byte-level BPE by a sentencepiece model made from a rank file.

The vocabulary is not trained: a rank file (base64 piece and rank in each line) is written as a
sentencepiece BPE model. Every byte becomes one character, a piece's score is its negative rank, and
normalisation is the identity, so that the model's best-score-first merges are the lowest-rank-first
merges of the rank file. Texts are cut by the pattern, each match is encoded by itself, and decoding
maps pieces back to bytes.

Defined results: a null or empty text has no tokens and decodes to nothing; any Unicode text comes
back exactly; repeated rows give repeated results; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import struct

import numpy as np
import regex
import sentencepiece
from pyspark.sql import DataFrame, SparkSession

from seasonflow.llm.common import by_batch, table
from seasonflow.llm.registry import query

#: Bytes become the 256 characters from here on: all printable, none of them blank.
FIRST_CHARACTER = 0x2800
_TO_PIECE = {b: chr(FIRST_CHARACTER + b) for b in range(256)}
#: Distinct matches that a task remembers before it starts anew.
REMEMBERED = 200_000
#: Longer matches are not remembered.
LONGEST_REMEMBERED = 64


def default_vocabulary() -> bytes:
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return f.read()


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(vocabulary: bytes) -> dict[bytes, int]:
    return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, vocabulary.splitlines()) if piece}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _bytes(field: int, body: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(body)) + body


def as_piece(raw: bytes) -> str:
    return raw.decode("latin-1").translate(_TO_PIECE)


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """The serialised model. Piece 0 is the unknown one, which byte pieces make unreachable; a rank
    is its piece's number less one.

    Fixed values: field numbers and enumerations of the public model format.
    """
    if sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError("ranks are not numbered from 0 without gaps")
    normal, unknown, bpe = 1, 2, 2
    pieces = [_bytes(1, _bytes(1, b"<unk>") + b"\x15" + struct.pack("<f", 0.0) + _number(3, unknown))]
    for raw, rank in sorted(ranks.items(), key=lambda item: item[1]):
        body = _bytes(1, as_piece(raw).encode()) + b"\x15" + struct.pack("<f", -float(rank)) + _number(3, normal)
        pieces.append(_bytes(1, body))
    trainer = _number(3, bpe) + _number(4, len(pieces))
    none = _varint((1 << 64) - 1)  # -1: the model has no such piece
    trainer += _number(40, 0) + b"".join(_varint(f << 3) + none for f in (41, 42, 43))
    normalizer = _bytes(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(pieces) + _bytes(2, trainer) + _bytes(3, normalizer)


class Codec:
    """Encodes and decodes in one task. ``ids`` of a match are kept as their decimal text."""

    def __init__(self, vocabulary: bytes, pattern: str):
        self.ranks = read_ranks(vocabulary)
        self.pieces = [b""] * len(self.ranks)
        for raw, rank in self.ranks.items():
            self.pieces[rank] = raw
        self.model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(self.ranks))
        self.find = regex.compile(pattern).findall
        self.known: dict[str, str] = {}
        self.spelled: dict[str, bytes] = {}

    def encode_match(self, match: str) -> list[int]:
        raw = match.encode("utf-8")
        rank = self.ranks.get(raw)  # a whole piece needs no merges
        return [rank] if rank is not None else [i - 1 for i in self.model.encode(as_piece(raw))]

    def encode(self, text: str) -> list[str]:
        """For each match, its ids as decimals joined by a space."""
        matches = self.find(text)
        known = self.known
        try:
            return [known[m] for m in matches]
        except KeyError:
            pass
        if len(known) > REMEMBERED:
            known.clear()
        return [known[m] if m in known else self._learn(m) for m in matches]

    def _learn(self, match: str) -> str:
        ids = " ".join(map(str, self.encode_match(match)))
        if len(match) <= LONGEST_REMEMBERED:
            self.known[match] = ids
        return ids

    def decode(self, groups: list[str]) -> bytes:
        """The bytes of the ids, by the inverse mapping."""
        spelled = self.spelled
        try:
            return b"".join([spelled[g] for g in groups])
        except KeyError:
            pass
        if len(spelled) > REMEMBERED:
            spelled.clear()
        out = []
        for g in groups:
            raw = spelled.get(g)
            if raw is None:
                raw = b"".join([self.pieces[int(i)] for i in g.split()])
                if len(g) <= 4 * LONGEST_REMEMBERED:
                    spelled[g] = raw
            out.append(raw)
        return b"".join(out)


def _codec(spark: SparkSession, vocabulary: bytes | None, pattern: str | None):
    """The vocabulary (under a megabyte, whatever the data) goes to every executor once."""
    sent = spark.sparkContext.broadcast((vocabulary or default_vocabulary(), pattern or default_pattern()))
    return lambda: Codec(*sent.value)


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: bytes | None = None, pattern: str | None = None) -> DataFrame:
    """key and ids (array of int) of every row."""
    codec = _codec(docs.sparkSession, vocabulary, pattern)
    kind = docs.schema[key].dataType.simpleString()

    def work():
        own = codec()

        def step(keys, texts):
            ids = [list(map(int, " ".join(own.encode(t or "")).split())) for t in texts.to_pylist()]
            return {key: keys, "ids": ids}

        return step

    return by_batch(docs.select(key, text), f"`{key}` {kind}, ids array<int>", work)


def decode(tokens: DataFrame, key: str = "doc_id", ids: str = "ids", vocabulary: bytes | None = None) -> DataFrame:
    """key and bytes (binary) of every row of ids; null ids decode to nothing."""
    codec = _codec(tokens.sparkSession, vocabulary, None)
    kind = tokens.schema[key].dataType.simpleString()

    def work():
        pieces = codec().pieces

        def step(keys, lists):
            return {key: keys, "bytes": [b"".join([pieces[i] for i in x or ()]) for x in lists.to_pylist()]}

        return step

    return by_batch(tokens.select(key, ids), f"`{key}` {kind}, bytes binary", work)


def round_trip(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: bytes | None = None, pattern: str | None = None, with_ids: bool = False) -> DataFrame:
    """key, n_tokens and the digests of a text's ids and of the bytes that they decode to, and the ids if wanted."""
    codec = _codec(docs.sparkSession, vocabulary, pattern)
    kind = docs.schema[key].dataType.simpleString()

    def work():
        own = codec()

        def step(keys, texts):
            counts, ids, decoded, lists = [], [], [], []
            for text in texts:
                groups = own.encode(text.as_py() or "")
                joined = " ".join(groups)
                counts.append(joined.count(" ") + 1 if joined else 0)
                ids.append(hashlib.sha256(joined.encode()).hexdigest())
                decoded.append(hashlib.sha256(own.decode(groups)).hexdigest())
                if with_ids:
                    lists.append(np.array(joined.split(), dtype=np.int32) if joined else np.empty(0, dtype=np.int32))
            out = {key: keys, "n_tokens": counts, "ids_sha256": ids, "decoded_sha256": decoded}
            return {**out, "ids": lists} if with_ids else out

        return step

    schema = f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return by_batch(docs.select(key, text), schema, work)


@query("op5_byte_bpe")
def byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document, encoded and decoded again."""
    return round_trip(table(spark, folder, "documents"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's last stage: doc_id and tokens of every document that is left."""
    return round_trip(docs, with_ids=True)
