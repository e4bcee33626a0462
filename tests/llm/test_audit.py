"""The filter audit against loops over all orders."""

import collections
import itertools
import random
import re

import numpy as np
import pytest

from seasonflow.llm import audit
from tests.llm.test_operators import FOLDER, ROWS, SCHEMA, blank_words


def slow_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    parts = collections.defaultdict(list)
    for i, t, lang in rows:
        t, words = t or "", blank_words(t)
        failed = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t)}
        failed |= {"D": bool(re.search("[#$%&*|]", t)), "E": i is not None and least[t] < i}
        parts[lang or ""].append((i, {k for k, v in failed.items() if v}))
    out = {}
    for part, docs in parts.items():
        total = collections.Counter()
        for order in itertools.permutations("ABCDE"):
            left = docs
            for step, letter in enumerate(order, 1):
                gone = [d for d in left if letter in d[1]]
                left = [d for d in left if letter not in d[1]]
                redundant = sum(letter in d[1] for d in docs) - len(gone)
                total[letter] += len(gone)
                unique = sum(d[1] == {letter} for d in docs)
                out[part, "".join(order), step] = [len(left), len(gone), redundant, unique, sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone), letter]
        for key in list(out):
            if key[0] == part:
                out[key][-1] = total[out[key][-1]]
    return {k: tuple(v) for k, v in out.items()}


def read(df):
    rows = df.collect()
    assert df.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {tuple(r[:3]): tuple(r[3:]) for r in rows}


def test_audit_of_odd_rows(spark):
    labels = [(6, 1, 0), (6, 0, 1), (7, 1, 1), (8, 0, 0), (None, 1, 1), (99, 1, 1), (9, None, None)]
    rows = [(r[0], r[1], r[2]) for r in ROWS] + [(20, "", None), (20, "A B", "en"), (21, "A B", "en"), (20, "A B", "en")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, part string").repartition(3)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert read(audit.audit(docs, table)) == slow_audit(rows, labels)
    assert audit.audit(spark.createDataFrame([], SCHEMA), table).count() == 0
    # without labels nothing is lost
    assert read(audit.audit(docs, table.limit(0))) == slow_audit(rows, [])


def test_audit_of_the_smallest_table(spark):
    docs, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    expected = slow_audit([tuple(r) for r in docs.select("doc_id", "text", "lang").collect()], [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])
    assert read(audit.audit(docs, labels)) == expected


@pytest.mark.parametrize("bits", [16, 18])
def test_sketch_clears_unique_texts_only(spark, bits):
    rng = random.Random(4)
    hashes = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(3000)]
    rows = hashes + hashes[:300] + [hashes[0]] * 500
    marks = spark.createDataFrame([(h,) for h in rows], "hash long").repartition(7)
    found = audit.crowded(marks, bits)
    assert len(found) == 1 << bits - 3
    values = np.array(hashes, dtype=np.int64)
    again = audit._possible(values, found, bits)
    assert again[:300].all()  # no repeated text is cleared
    assert again[300:].mean() < 0.2  # and most others are
    # the same as counting the cells of all rows together
    cells = collections.Counter(c for row in audit.cells_of(np.array(rows, dtype=np.int64), bits).tolist() for c in set(row))
    assert np.array_equal(np.flatnonzero(np.unpackbits(found)), np.array(sorted(c for c, n in cells.items() if n > 1)))


def test_sketch_size_is_bounded():
    assert audit.sketch_bits(0) == 16 and audit.sketch_bits(10**12) == audit.MOST_BITS
    assert all((1 << audit.sketch_bits(n)) >= audit.CELLS * n for n in (10**4, 10**6, 5 * 10**7))
