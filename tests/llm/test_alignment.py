"""Token alignment against a brute-force version."""

import collections
import hashlib
import random

import numpy as np
import pytest
import sentencepiece
import tokenizers

from seasonflow.llm import alignment
from tests.llm.test_operators import FOLDER, ROWS, SCHEMA


def slow_alignment(rows):
    """Tokens and links by loops over byte ranges; counts over all documents."""
    import public_tokenizers

    a = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    decode = tokenizers.decoders.ByteLevel()
    docs, counts = [], collections.Counter()
    raw_a = {}
    letters = {c: x for x, c in zip(range(256), gpt_letters())}
    for i, text in rows:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        parts_a = [raw_a.setdefault(t, bytes(letters[c] for c in a.id_to_token(t))) for t in ids_a]
        parts_b = [bytes([int(p[3:5], 16)]) if b.is_byte(t) else p.replace("▁", " ").encode() for t in ids_b for p in [b.id_to_piece(t)]]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(parts_a) != whole or b"".join(parts_b) != whole:
            ids_a, ids_b, parts_a, parts_b = [], [], [], []
        groups, links = [], []
        p = q = end_p = end_q = 0
        spans_a, spans_b = spans(parts_a), spans(parts_b)
        ends = {e for _, e in spans_a} & {e for _, e in spans_b}
        while p < len(ids_a):
            group_a, group_b = [], []
            while True:
                group_a.append(p)
                p += 1
                if spans_a[p - 1][1] in ends:
                    break
            while True:
                group_b.append(q)
                q += 1
                if spans_b[q - 1][1] in ends:
                    break
            groups.append(f"{','.join(str(ids_a[x]) for x in group_a)}|{','.join(str(ids_b[x]) for x in group_b)}")
            for x in group_a:
                for y in group_b:
                    if max(spans_a[x][0], spans_b[y][0]) < min(spans_a[x][1], spans_b[y][1]):
                        links.append((ids_a[x], ids_b[y]))
        counts.update(set(links))
        docs.append((i, len(ids_a), len(ids_b), groups, links))
    top = collections.Counter()
    for (x, _), n in counts.items():
        top[x] = max(top[x], n)
    return collections.Counter(
        (i, n_a, n_b, len(g), len(links), sum(counts[k] == top[k[0]] for k in links), sum(counts[k] for k in links), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
        for i, n_a, n_b, g, links in docs
    )


def gpt_letters():
    kept = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    more = iter(range(256, 512))
    return [chr(b) if b in kept else chr(next(more)) for b in range(256)]


def spans(parts):
    ends = np.cumsum([len(x) for x in parts]).tolist()
    return list(zip([0, *ends], ends))


HARD = [
    "a  b", " lead", "trail ", "\t\ttabs\n\n\nlines", "café naïve", "\U0001f600\U0001f601 emoji", "<|endoftext|> and <s> and </s>", "▁ mark",
    "ﬁ ligature", " ", "x" * 3000, "中文字", "á", "...!!!???", "<0x41>", "\x00\x01", "12345678901234567890", "\r\n",
]


@pytest.mark.parametrize("hot", [0, 300, alignment.HOT])
def test_alignment(spark, hot):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    hard = spark.createDataFrame([(r[0], r[1]) for r in ROWS if len(r[1] or "") < 10_000] + [(50_000 + i, t) for i, t in enumerate(HARD)] + [(None, "a  b")] * 2, "doc_id long, text string")
    both = docs.unionByName(hard).repartition(4)
    got = collections.Counter(tuple(r) for r in alignment.linked(both, hot=hot).collect())
    assert got == slow_alignment([tuple(r) for r in both.collect()])


def test_alignment_of_odd_tables(spark):
    rows = alignment.linked(spark.createDataFrame(ROWS, SCHEMA))
    assert rows.count() == len(ROWS) and rows.where("n_a = 0 AND groups_sha256 = '' AND n_links = 0 AND count_sum = 0").count() >= 2
    assert alignment.linked(spark.createDataFrame([], SCHEMA)).count() == 0


def test_identity_map():
    known = alignment.Tokenizers(*alignment.default_models())
    for i, j in enumerate(known.same.tolist()):
        assert j < 0 or known.a_bytes[i] == known.b_bytes[j]
    assert (known.same >= 0).sum() > 5000


def test_stretches_do_not_change_the_result(monkeypatch):
    known = alignment.Tokenizers(*alignment.default_models())
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["the", "café", "\U0001f600", "  x", "Wort"]) for _ in range(rng.randint(0, 30))) for _ in range(40)]
    whole = alignment.Aligned(known, *known.encode(texts)).digests()
    assert whole == [alignment.Aligned(known, *known.encode([t])).digests()[0] for t in texts]


def test_encoder_by_ranks_equals_the_tokenizer():
    a_json, b_model = alignment.default_models()
    known = alignment.Tokenizers(a_json, b_model)
    assert known.ranked is not None
    rng = random.Random(9)
    units = ["a", "aa", "the", " ", "  ", "\n", "'s", "'S", "1", "é", "中", "\U0001f600", "ing", "\t", "_", "--", ".", "<|endoftext|>", "\u3000", "\u200b", "tion"]
    texts = ["".join(rng.choice(units) for _ in range(rng.randint(1, 40))) for _ in range(4000)]
    texts += ["".join(chr(rng.choice((rng.randrange(32, 0xD800), rng.randrange(0xE000, 0x110000)))) for _ in range(rng.randint(1, 30))) for _ in range(4000)]
    texts += ["xq" * 100_000, " " * 50_000, "7" * 50_000]
    expected = [e.ids for e in known.a.encode_batch(texts, add_special_tokens=False)]
    assert [known.ranked.encode_ordinary(t) for t in texts] == expected
    # another kind of tokenizer is taken as it is
    assert alignment.by_ranks(a_json.replace(b'"add_prefix_space":false', b'"add_prefix_space":true', 1).replace(b'"add_prefix_space": false', b'"add_prefix_space": true', 1)) is None
    other = alignment.Tokenizers(a_json, b_model)
    other.ranked = None
    assert other.encode(texts[:500]) == known.encode(texts[:500])
