"""Personal data, also where it is disguised.

Plain identifiers (email, ip, card, phone) are found in the text as it is. Then small transducers
rewrite the text: look-alike and full-width characters become the plain ones and invisible ones go,
spelled digits become digits, and the words or brackets that stand for @ and . become these signs. Each
written character keeps the place it came from, so identifiers found in the rewritten text are mapped
back to the source. The disguised finds are added to the plain ones, which stay as they are.

Defined results: a null or empty text has no spans; spans count code points, the end is exclusive;
texts that nothing in a transducer's alphabet occurs in are not rewritten; repeated rows are searched
one by one; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonflow.llm.common import by_batch, table
from seasonflow.llm.registry import query

KINDS = ("email", "ip", "card", "phone")

# ------------------------------------------------------------------ plain identifiers

_LOCAL = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a run of digits is taken whole: no part of it could match where the whole does not
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def emails(text: str) -> list[tuple[int, int]]:
    """From each @ to the left as far as the local part reaches, to the right as far as the domain does."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, domain.end()))
            free = domain.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", max(at + 1, free))
    return found


def passes_luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _ips(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split("."))]


def _cards(text: str) -> list[tuple[int, int]]:
    found = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and passes_luhn(digits):
                found.append(m.span())
    return found


def _phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15]


def identifiers(text: str) -> list[tuple[str, int, int]]:
    """kind, start and end of every plain identifier, by start, then by kind as listed."""
    found = [("email", *s) for s in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        found += [("ip", *s) for s in _ips(text)]
        found += [("card", *s) for s in _cards(text)]
        if "+" in text:
            found += [("phone", *s) for s in _phones(text)]
    return in_order(found)


def in_order(found: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0]), f[2]))


# ------------------------------------------------------------------ transducers

#: Characters of other scripts that look like plain ones.
_LOOKALIKES = dict(
    zip(
        "АВСЕНІЈКМОРЅТХУаԁеһіјӏорԛѕсухѵΑΒΕΖΗΙΚΜΝΟΡΤΥΧαειοντρυχ",
        "ABCEHIJKMOPSTXYadehijlopqscyxvABEZHIKMNOPTYXaeiovtpux",
        strict=True,
    )
)
#: Invisible characters.
_INVISIBLE = set("­​‌‍⁠﻿᠎‎‏")
_ODD = re.compile(r"[^\x00-¬®-ʯ]")  # and the soft hyphen
#: Names of digits in the languages served.
_DIGIT_NAMES = {
    "zero": 0, "oh": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9,
    "null": 0, "eins": 1, "zwei": 2, "zwo": 2, "drei": 3, "vier": 4, "fünf": 5, "sechs": 6, "sieben": 7, "acht": 8, "neun": 9,
    "zéro": 0, "un": 1, "deux": 2, "trois": 3, "quatre": 4, "cinq": 5, "sept": 7, "huit": 8, "neuf": 9,
    "cero": 0, "uno": 1, "dos": 2, "tres": 3, "cuatro": 4, "cinco": 5, "seis": 6, "siete": 7, "ocho": 8, "nueve": 9,
}
_AT, _DOT, _PLUS = r"(?:at|arroba|aroba|arobase|klammeraffe)", r"(?:dot|punkt|point|punto)", r"(?:plus|más|mas)"
_OPEN, _CLOSE = r"\s{0,3}[\[({<]\s{0,3}", r"\s{0,3}[\])}>]\s{0,3}"
_BRACKET_AT = re.compile(rf"{_OPEN}(?:{_AT}|@){_CLOSE}", re.I)
_BRACKET_DOT = re.compile(rf"{_OPEN}(?:{_DOT}|\.){_CLOSE}", re.I)
_SPACED_AT = re.compile(r"(?<=[A-Za-z0-9])[ \t]{1,3}@[ \t]{0,3}(?=[A-Za-z0-9])|(?<=[A-Za-z0-9])@[ \t]{1,3}(?=[A-Za-z0-9])")
_WORD_DOT = re.compile(rf"(?<=[\w-])(?:\s{{1,3}}|[-_]){_DOT}(?:\s{{1,3}}|[-_])(?=[\w-])", re.I)
# the word itself; that a domain follows is seen by ``Domains``, which reads each of them once
_WORD_AT = re.compile(rf"(?<=[A-Za-z0-9])(?:\s{{1,3}}|[-_]){_AT}(?:\s{{1,3}}|[-_])(?=[A-Za-z0-9-])", re.I)
_CHAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*", re.I)
_TOP_LEVEL = re.compile(r"\.[A-Za-z]{2,}\b", re.I)
_NAMES = {
    "zero": 0, "oh": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9,
    "null": 0, "eins": 1, "zwei": 2, "zwo": 2, "drei": 3, "vier": 4, "fünf": 5, "sechs": 6, "sieben": 7, "acht": 8, "neun": 9,
    "zéro": 0, "un": 1, "deux": 2, "trois": 3, "quatre": 4, "cinq": 5, "sept": 7, "huit": 8, "neuf": 9,
    "cero": 0, "uno": 1, "dos": 2, "tres": 3, "cuatro": 4, "cinco": 5, "seis": 6, "siete": 7, "ocho": 8, "nueve": 9,
}
_AT, _DOT, _PLUS = r"(?:at|arroba|aroba|arobase|klammeraffe)", r"(?:dot|punkt|point|punto)", r"(?:plus|más|mas)"
_OPEN, _CLOSE = r"\s{0,3}[\[({<]\s{0,3}", r"\s{0,3}[\])}>]\s{0,3}"
_BRACKET_AT = re.compile(rf"{_OPEN}(?:{_AT}|@){_CLOSE}", re.I)
_BRACKET_DOT = re.compile(rf"{_OPEN}(?:{_DOT}|\.){_CLOSE}", re.I)
_SPACED_AT = re.compile(r"(?<=[A-Za-z0-9])[ \t]{1,3}@[ \t]{0,3}(?=[A-Za-z0-9])|(?<=[A-Za-z0-9])@[ \t]{1,3}(?=[A-Za-z0-9])")
_WORD_DOT = re.compile(rf"(?<=[\w-])(?:\s{{1,3}}|[-_]){_DOT}(?:\s{{1,3}}|[-_])(?=[\w-])", re.I)
_WORD_AT = re.compile(rf"(?<=[A-Za-z0-9])(?:\s{{1,3}}|[-_]){_AT}(?:\s{{1,3}}|[-_])(?=[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{{2,}}\b)", re.I)
_NAMES = "|".join(sorted(_DIGIT_NAMES, key=lambda n: (-len(n), n)))
_GAP = r"(?:[\s,;]{1,3}|-|\s-\s)"
_SPELLED = re.compile(rf"(?<!\w)(?:{_PLUS}[\s,-]{{1,3}})?(?:{_NAMES})(?:{_GAP}(?:{_NAMES}|{_DOT}|[0-9]+)|\.(?:{_NAMES}))*(?!\w)", re.I)
_TOKEN = re.compile(r"\w+|\.")
#: Names of digits in a row from which on they are taken for digits.
LEAST_SPELLED = 4


class Tape:
    """A text with the source place of every character; ``ends`` are where what it came from ends."""

    __slots__ = ("text", "starts", "ends", "changed")

    def __init__(self, text: str, starts: list[int], ends: list[int], changed: list[int]):
        self.text, self.starts, self.ends, self.changed = text, starts, ends, changed

    @classmethod
    def of(cls, text: str) -> Tape:
        return cls(text, list(range(len(text))), list(range(1, len(text) + 1)), [])

    def rewrite(self, edits: list[tuple[int, int, str]]) -> Tape:
        """Replaces stretches (in order, apart). What is written for a stretch came from all of it."""
        if not edits:
            return self
        text, starts, ends, changed, at = [], [], [], [], 0
        size = 0
        marks = sorted(self.changed)
        for a, b, new in edits:
            text.append(self.text[at:a])
            starts += self.starts[at:a]
            ends += self.ends[at:a]
            changed += [size + m - at for m in _between(marks, at, a)]
            size += a - at
            if new:
                text.append(new)
                starts += [self.starts[a]] * len(new)
                ends += [self.ends[b - 1]] * len(new)
                changed += range(size, size + len(new))
                size += len(new)
            elif size:
                changed.append(size - 1)  # a deletion marks its neighbour
            at = b
        text.append(self.text[at:])
        starts += self.starts[at:]
        ends += self.ends[at:]
        changed += [size + m - at for m in _between(marks, at, len(self.text))]
        return Tape("".join(text), starts, ends, changed)

    def source(self, start: int, end: int) -> tuple[int, int]:
        return self.starts[start], self.ends[end - 1]


def _between(marks: list[int], a: int, b: int) -> list[int]:
    return marks[bisect_right(marks, a - 1) : bisect_right(marks, b - 1)]


def _plain(c: str) -> str:
    if c in _INVISIBLE:
        return ""
    if c in _LOOKALIKES:
        return _LOOKALIKES[c]
    digit = unicodedata.digit(c, None)
    if digit is not None:
        return str(digit)
    folded = unicodedata.normalize("NFKC", c)
    return folded if folded.isascii() and len(folded) == 1 else c


def plain_characters(tape: Tape) -> Tape:
    """Look-alikes, other digits and full-width forms become plain, invisible characters go."""
    edits = []
    for m in _ODD.finditer(tape.text):
        new = _plain(m[0])
        if new != m[0]:
            edits.append((m.start(), m.end(), new))
    return tape.rewrite(edits)


def spelled_digits(tape: Tape) -> Tape:
    """Rows of digit names become digits; a name of the dot or plus sign among them becomes the sign."""
    edits = []
    for m in _SPELLED.finditer(tape.text):
        names, out, last = 0, [], m.start()
        for t in _TOKEN.finditer(tape.text, m.start(), m.end()):
            word = t[0].lower()
            if word in _DIGIT_NAMES:
                names += 1
                out.append((t.start(), t.end(), str(_DIGIT_NAMES[word])))
            elif word.isdigit():
                out.append((t.start(), t.end(), t[0]))
            else:
                out.append((t.start(), t.end(), "+" if re.fullmatch(_PLUS, word) else "."))
        if names < LEAST_SPELLED:
            continue
        while out and out[-1][2] == "." and tape.text[out[-1][0] : out[-1][1]] != ".":
            out.pop()
        last = out[0][0]
        for a, b, new in out:  # the gap before a sign belongs to it
            edits.append((min(last, a), b, new))
            last = b
    return tape.rewrite(edits)


class Domains:
    """Whether a domain begins at a place; places are asked for in rising order, each chain of labels is read once."""

    def __init__(self, text: str):
        self.text, self.end, self.last = text, -1, -1

    def begins(self, at: int) -> bool:
        if at >= self.end:
            chain = _CHAIN.match(self.text, at)
            if chain is None:
                return False
            self.end, self.last = chain.end(), -1
            for m in _TOP_LEVEL.finditer(self.text, at, self.end + 1):
                self.last = m.start()
        return self.last > at


def words_for_at(text: str) -> list[tuple[int, int]]:
    """Where a word for @ stands between a local part and a domain."""
    found, domains, m = [], Domains(text), _WORD_AT.search(text)
    while m:
        good = domains.begins(m.end())
        if good:
            found.append(m.span())
        m = _WORD_AT.search(text, m.end() if good else m.start() + 1)
    return found


def signs(tape: Tape) -> Tape:
    """Words and brackets that stand for @ and . become the signs: dots first, as they make domains."""
    for pattern, sign in ((_BRACKET_DOT, "."), (_BRACKET_AT, "@"), (_SPACED_AT, "@"), (_WORD_DOT, ".")):
        tape = tape.rewrite([(m.start(), m.end(), sign) for m in pattern.finditer(tape.text)])
    return tape.rewrite([(*span, "@") for span in words_for_at(tape.text)])


_DOT_NAMES = frozenset(("dot", "punkt", "point", "punto"))
_DIGIT_WORDS = frozenset(_DIGIT_NAMES)
_WORDS = re.compile(r"[\W_]+")
_AT_NAMES = re.compile(r"(?:at|arroba|aroba|arobase|klammeraffe)[\s_-]{1,3}(?=[a-z0-9-])")
_FOLDED = re.compile("[İıſ]")  # match plain letters where case is ignored
_BRACKETED = re.compile(r"[\[({<]\s{0,3}(?:at|arroba|aroba|arobase|klammeraffe|dot|punkt|point|punto|@|\.)\s{0,3}[\])}>]")


def _named(run: str) -> int:
    """Digit names in a row that ``_SPELLED`` found."""
    return sum(t.lower() in _DIGIT_WORDS for t in _TOKEN.findall(run))


def disguised(text: str) -> bool:
    """Whether a transducer could change anything that matters: a cheap necessary condition."""
    if not text.isascii() and (_ODD.search(text) or _FOLDED.search(text)):
        return True
    low = text.lower()
    if any(c in low for c in "([{<") and _BRACKETED.search(low):
        return True
    if "@" in low and _SPACED_AT.search(low):
        return True
    words = _WORDS.split(low)
    if not _DOT_NAMES.isdisjoint(words):
        return True
    if not _DIGIT_WORDS.isdisjoint(words):
        # as many names as count, wherever digits or signs stand between them
        if sum(map(_DIGIT_WORDS.__contains__, words)) >= LEAST_SPELLED and any(_named(m[0]) >= LEAST_SPELLED for m in _SPELLED.finditer(text)):
            return True
    domains = Domains(low)
    return any(domains.begins(m.end()) for m in _AT_NAMES.finditer(low))


def revealed(text: str) -> list[tuple[str, int, int]]:
    """Identifiers that show only after rewriting, by their place in the source."""
    if not disguised(text):
        return []
    tape = signs(spelled_digits(plain_characters(Tape.of(text))))
    marks = sorted(set(tape.changed))
    found = []
    for kind, a, b in identifiers(tape.text):
        if _between(marks, a, b):
            found.append((kind, *tape.source(a, b)))
    return found


def all_identifiers(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """The plain finds, and these with the disguised ones."""
    base = identifiers(text)
    known = set(base)
    return base, in_order(base + [f for f in dict.fromkeys(revealed(text)) if f not in known])


def written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span (overlapping ones together) replaced by the kind of its first."""
    out, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


# ------------------------------------------------------------------ tables


def spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, counts of plain finds by kind, digest of these, all spans, and how many were disguised."""

    def work():
        def step(keys, texts):
            out = {key: keys, **{f"n_{k}": [] for k in KINDS}, "base_sha256": [], "spans": [], "n_disguised": []}
            for text in texts:
                base, every = all_identifiers(text.as_py() or "")
                for k in KINDS:
                    out[f"n_{k}"].append(sum(f[0] == k for f in base))
                out["base_sha256"].append(hashlib.sha256(written(base).encode()).hexdigest())
                out["spans"].append(written(every))
                out["n_disguised"].append(len(every) - len(base))
            return out

        return step

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    kind = docs.schema[key].dataType.simpleString()
    return by_batch(docs.select(key, text), f"`{key}` {kind}, {counts}, base_sha256 string, spans string, n_disguised long", work)


def mask(texts):
    """A pandas UDF's work: masks a series of texts; null stays null."""
    return texts.map(lambda t: None if t is None else masked(t, all_identifiers(t)[1]))


@query("op7_pii_deobfuscation")
def pii_deobfuscation(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of personal data in every document."""
    return spans(table(spark, folder, "documents"))


def mask_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in every text; all rows and columns stay."""
    masking = F.pandas_udf(mask, "string")
    return docs.withColumn("text", masking("text")).select(*docs.columns)
