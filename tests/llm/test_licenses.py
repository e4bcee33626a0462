"""Licence rules against a loop over all rules, and the rules themselves."""

import collections
import itertools
import random
import re
import re._parser as parser

import pytest

from seasonflow.llm import licenses
from seasonflow.llm.license_rules import BASE, Rule, rules
from tests.llm.test_operators import FOLDER, ROWS, SCHEMA

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))


def slow_detections(text, listed):
    """(rule, first word, last word, suppressed) of all rules, without keywords."""
    norm = f" {' '.join(words_of(text).copy())} "
    found = []
    for i, r in enumerate(listed):
        for m in re.finditer(f"(?<= )(?:{r.pattern})(?= )", norm):
            first = norm[: m.start()].count(" ") - 1
            found.append((i, first, first + m[0].count(" ")))
    out = []
    for i, a, b in found:
        own = listed[i].level
        gone = False
        for j, c, d in found:
            if (j, c, d) != (i, a, b) and c <= a and b <= d:
                level = listed[j].level
                longer = d - c > b - a
                gone |= level < own or level == own and (longer or j < i)
        out.append((i, a, b, gone))
    return out


def slow_labels(rows, listed):
    out = []
    for i, text in rows:
        found = slow_detections(text, listed)
        base = [f for f in found if f[0] < len(BASE)]
        stays = [f for f in found if not f[3] or f[0] < len(BASE)]
        named = lambda some: ",".join(sorted({listed[f[0]].label for f in some}))
        out.append((
            i, len(words_of(text)), len(base), min((f[1] for f in base), default=None), max((f[1] for f in base), default=None),
            named(base), named(stays), max((licenses.CONFIDENCE[listed[f[0]].level] for f in stays), default=0.0), sum(not f[3] for f in found),
        ))
    return collections.Counter(out)


def spelled(pattern, most=400):
    """Texts that a pattern matches: every branch of it is taken by one of them at least."""

    def of(node):
        kind, value = node
        name = str(kind)
        if name == "LITERAL":
            return [chr(value)]
        if name == "NOT_LITERAL":
            return ["q"]
        if name == "IN":
            first = value[0]
            if str(first[0]) == "NEGATE":
                return ["q"]
            return [chr(x[1]) if str(x[0]) == "LITERAL" else chr(x[1][0]) for x in value]
        if name == "BRANCH":
            return [t for branch in value[1] for t in series(branch)]
        if name == "SUBPATTERN":
            return series(value[-1])
        if name == "MAX_REPEAT":
            low, high, inner = value
            times = sorted({low, min(high, low + 1)})
            return ["".join(p) for n in times for p in (zip(*[series(inner)] * n) if n else [("",)])]
        raise AssertionError(name)

    def series(nodes):
        parts = [""]
        for node in nodes:
            parts = list(itertools.islice((a + b for a in parts for b in of(node)), most))
        return parts

    return series(parser.parse(pattern))


@pytest.mark.parametrize("rule", rules(), ids=lambda r: f"{r.label}:{r.pattern[:24]}")
def test_every_match_holds_the_keyword(rule):
    texts = spelled(rule.pattern)
    assert texts and any(re.fullmatch(rule.pattern, t) for t in texts)
    for t in texts:
        if re.fullmatch(rule.pattern, t):
            assert rule.keyword in t.split(" "), t
            assert words_of(t) == t.split(" "), t


def test_rules_are_hundreds_and_distinct():
    listed = rules()
    assert len(listed) > 250 and len({(r.label, r.pattern) for r in listed}) == len(listed)


def random_texts(count, seed=3):
    rng = random.Random(seed)
    listed = rules()
    texts = []
    for _ in range(count):
        parts = []
        for _ in range(rng.randint(1, 8)):
            parts.append(rng.choice(spelled(rng.choice(listed).pattern, 40)) if rng.random() < 0.6 else rng.choice(["mit", "the", "license", "1.0", "é", "\n", "public", "GNU", "x-y"]))
        text = rng.choice([" ", "-", ", "]).join(parts)
        texts.append(text.upper() if rng.random() < 0.2 else text)
    return texts


def test_scan(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()] + [(r[0], r[1]) for r in ROWS] + [(None, t) for t in random_texts(400)]
    rows += [(70, "MIT License"), (71, "mit license mit license, MIT-LICENSE"), (72, "xmit license"), (73, "cc by nc 4.0"), (74, "apache license, version 2.0 apache license"), (75, "GNU GENERAL PUBLIC LICENSE")]
    got = licenses.labelled(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert got.columns[:8] == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    listed = rules()
    assert collections.Counter(tuple(r) for r in got.collect()) == slow_labels(rows, listed)
    assert licenses.labelled(spark.createDataFrame([], SCHEMA)).count() == 0


def test_suppression(spark):
    listed = [*BASE, Rule(2, "two", "b", "b c d"), Rule(2, "long", "b", "a b c d"), Rule(1, "one", "c", "c"), Rule(3, "same", "b", "a b c d"), Rule(2, "cross", "d", "d e"), Rule(2, "again", "d", "d e")]
    rows = [(1, "a b c d e"), (2, "b c d"), (3, "c d e c"), (4, "a b c d a b c d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = licenses.detections(docs, listed=listed).where("rule IS NOT NULL").collect()
    expected = {(i, *f) for i, t in rows for f in slow_detections(t, listed)}
    assert {(r.doc_id, r.rule, r.first_word, r.last_word, r.suppressed) for r in got} == expected and len(got) == len(expected)
    kept = {(r.doc_id, r.label) for r in got if not r.suppressed}
    assert kept == {(1, "long"), (1, "one"), (1, "cross"), (2, "two"), (2, "one"), (3, "one"), (3, "cross"), (4, "long"), (4, "one")}


def test_one_text_of_very_many_detections(spark):
    docs = spark.createDataFrame([(1, "mit license " * 40_000), (2, "gnu " * 100_000)], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.labelled(docs).collect()}
    assert (got[1].n_base, got[1].first_word, got[1].last_word, got[1].labels) == (40_000, 0, 79_998, "mit")
    assert got[2].n_base == 0 and got[2].n_words == 100_000


def test_no_python_runs(spark):
    plan = licenses.labelled(spark.createDataFrame(ROWS, SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
