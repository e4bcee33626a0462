"""SimHash near-duplicates by a binary trie self-join.

Fingerprints of 64 bits are majority votes over the hashes of a text's word shingles. Distinct
fingerprints are joined with themselves in a binary trie: pairs of nodes are walked together, the
bits in which they differ are counted, and a pair is dropped when its errors exceed the budget.

To spread the trie over tasks the bits are cut into one block more than the budget. Two fingerprints
within the budget agree in some block, so for each block the bits are turned until it leads, and the
subtrees under its values are joined each with itself. In such a subtree fingerprints that are
already connected are not compared again, so a dense group costs no pairs, and what leaves a task is
a spanning forest of its links. Components are then found over these links by contraction.

Defined results: texts with fewer words than a shingle are one shingle; texts without words (null and
empty ones too) have fingerprint zero and are linked like others; repeated rows share a component;
a null id never names a component, and a component of null ids alone has none; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import string

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonflow.llm.common import by_batch, fresh, table, text_content
from seasonflow.llm.registry import query
from seasonflow.session import settle

SHINGLE, BUDGET, SEED = 4, 4, 42
#: Node pairs that a task walks at a time (as many wait at each of 64 depths, some 100 MB in all), and pairs of leaves below which a node pair is spelled out.
FRONTIER, SMALL = 1 << 14, 16
_LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode("utf-8").translate(_LOWER).split()  # blanks are \x20 and \x09-\x0D
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=n) + 1) - 1
    last = ends[shingle - 1 :] if n >= shingle else ends[-1:]
    first = np.concatenate(([0], ends + 1))[: len(last)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(first.tolist(), last.tolist())), dtype=np.uint64, count=len(last)
    )
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)].astype(">u8").view(np.uint8)
        votes += np.unpackbits(part).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes)).view(">u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash and text_bytes (what tells the text) and fp (the 64 bits as a long) of every row."""

    def work():
        def step(keys, hashes, sizes, texts):
            values = np.array([fingerprint(t.as_py(), shingle) for t in texts], dtype=np.uint64)
            return {"doc_id": keys, "text_hash": hashes, "text_bytes": sizes, "fp": values.view(np.int64)}

        return step

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(key, *(c.alias(n) for n, c in text_content(text).items()), text)
    return by_batch(rows, f"doc_id {kind}, text_hash long, text_bytes int, fp long", work)


def turned(bits: np.ndarray, by: int) -> np.ndarray:
    """Rotates left, so that the block that begins after ``by`` bits leads."""
    if by % 64 == 0:
        return bits
    return (bits << np.uint64(by)) | (bits >> np.uint64(64 - by))


def blocks(budget: int) -> list[tuple[int, int]]:
    """Start and width of each block of bits, one more than the budget."""
    edges = [64 * i // (budget + 1) for i in range(budget + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


class Forest:
    """Union-find over places in an array."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
        """The pairs that connected something new."""
        made = []
        for x, y in zip(a.tolist(), b.tolist()):
            p, q = self.root(x), self.root(y)
            if p != q:
                self.up[max(p, q)] = min(p, q)
                made.append((x, y))
        return made

    def labels(self) -> np.ndarray:
        up = self.up
        while True:
            higher = up[up]
            if np.array_equal(higher, up):
                self.up = up
                return up
            up = higher


class Numbers:
    """Sorted distinct numbers of 64 bits as the leaves of a trie."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.depth = bits, 64

    def __len__(self) -> int:
        return len(self.bits)

    def halves(self, first: np.ndarray, last: np.ndarray, depth: int) -> np.ndarray:
        """Where the ones of the bit at ``depth`` begin in every node (first, last), whose bits above agree."""
        mark = np.uint64(1 << (63 - depth))
        above = np.uint64(~((1 << (64 - depth)) - 1) & 0xFFFFFFFFFFFFFFFF)
        return np.searchsorted(self.bits, (self.bits[first] & above) | mark)

    def errors(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.bitwise_count(self.bits[x] ^ self.bits[y])


def trie_links(bits: np.ndarray, lead: int, budget: int) -> list[tuple[int, int]]:
    """Pairs of places in ``bits`` (sorted, distinct) within the budget that span all such links
    between numbers with the same ``lead`` first bits."""
    if len(bits) < 2:
        return []
    head = bits >> np.uint64(64 - lead)
    return walked(Numbers(bits), np.flatnonzero(head[1:] != head[:-1]) + 1, lead, budget)


def walked(leaves: Numbers, cuts: np.ndarray, depth: int, budget: int) -> list[tuple[int, int]]:
    """Pairs of leaves within the budget that span all such links inside the subtrees which begin at
    the ``cuts``; the bits of a subtree agree above ``depth``."""
    return [pair for found in walk(leaves, cuts, depth, budget) for pair in found]


def walk(leaves: Numbers, cuts: np.ndarray, depth: int, budget: int):
    """Lists of such pairs as they are found."""
    n = len(leaves)
    starts = np.concatenate(([0], cuts))
    stops = np.concatenate((cuts, [n]))
    many = stops - starts > 1
    forest = Forest(n)
    root = np.stack([starts[many], stops[many], starts[many], stops[many], np.zeros(many.sum(), dtype=np.int64)])
    stack = [(root[:, i : i + FRONTIER // 16], depth) for i in range(0, root.shape[1], FRONTIER // 16)]
    labels = forest.labels()
    changes = np.concatenate(([0], np.cumsum(labels[1:] != labels[:-1])))
    while stack:
        pairs, depth = stack.pop()
        # a pair of nodes whose leaves all are connected can add nothing
        low, high = pairs[0], pairs[2]
        joined = (changes[pairs[1] - 1] == changes[low]) & (changes[pairs[3] - 1] == changes[high]) & (labels[low] == labels[high])
        pairs = pairs[:, ~joined]
        sizes = (pairs[1] - pairs[0]) * (pairs[3] - pairs[2])
        small = (sizes <= SMALL) | (depth == leaves.depth)
        found = _leaves(leaves, pairs[:, small], budget)
        if len(found[0]):
            apart = labels[found[0]] != labels[found[1]]
            if made := forest.join(found[0][apart], found[1][apart]):
                yield made
                labels = forest.labels()
                changes = np.concatenate(([0], np.cumsum(labels[1:] != labels[:-1])))
        rest = pairs[:, ~small]
        if rest.shape[1]:
            below = _children(leaves, rest, depth, budget)
            stack += [(below[:, i : i + FRONTIER], depth + 1) for i in range(0, below.shape[1], FRONTIER)]


def _children(leaves: Numbers, pairs: np.ndarray, depth: int, budget: int) -> np.ndarray:
    a, b, c, d, errors = pairs
    m, k, itself = leaves.halves(a, b, depth), leaves.halves(c, d, depth), a == c
    # a node with itself has three pairs of children, two nodes have four
    parts = [
        (a, m, c, k, errors, np.ones(len(a), dtype=bool)), (m, b, k, d, errors, np.ones(len(a), dtype=bool)),
        (a, m, k, d, errors + 1, np.ones(len(a), dtype=bool)), (m, b, c, k, errors + 1, ~itself),
    ]
    kept = []
    for p, q, r, s, e, use in parts:
        good = use & (q > p) & (s > r) & (e <= budget) & ~((p == r) & (q - p == 1))
        kept.append(np.stack([p[good], q[good], r[good], s[good], e[good]]))
    return np.concatenate(kept, axis=1)


def _leaves(leaves: Numbers, pairs: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    a, b, c, d, _ = pairs
    width, sizes = d - c, (b - a) * (d - c)
    which = np.repeat(np.arange(len(a)), sizes)
    within = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    x, y = a[which] + within // width[which], c[which] + within % width[which]
    close = (x < y) & (leaves.errors(x, y) <= budget)
    return x[close], y[close]


def links(distinct: DataFrame, budget: int = BUDGET) -> DataFrame:
    """u and v: links between distinct fingerprints (fp), at least a spanning forest of them."""
    cut = blocks(budget)
    value = lambda start, width: F.call_function("shiftrightunsigned", F.call_function("shiftleft", F.col("fp"), F.lit(start)), F.lit(64 - width))
    copies = [F.struct(F.lit(i).alias("block"), value(*at).alias("value")) for i, at in enumerate(cut)]
    dealt = distinct.select("fp", F.inline(F.array(*copies))).repartition("block", "value").select("fp", "block")

    def run(batches):
        import pyarrow as pa

        held = [(b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)) for b in batches]
        if not held:
            return
        fps, block = np.concatenate([h[0] for h in held]).view(np.uint64), np.concatenate([h[1] for h in held])
        for i, (start, width) in enumerate(cut):
            bits = np.unique(turned(fps[block == i], start))
            made = trie_links(bits, width, budget)
            if made:
                ends = turned(bits[np.array(made)], 64 - start).view(np.int64)
                yield pa.RecordBatch.from_pydict({"u": ends[:, 0].copy(), "v": ends[:, 1].copy()})

    return dealt.mapInArrow(run, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """node and root for every end of the edges (u, v); the same root for all of a component.

    Each round every node points to the neighbour whose hash is the least, or to itself, the pointers
    are followed twice, and edges are drawn between what is pointed to. Rounds are few: they fall with
    the logarithm of the number of nodes. Every round is a written table.
    """
    edges = settle(edges.where("u <> v").distinct())
    maps = []
    while not edges.isEmpty():
        order = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(len(maps))).alias("rank"), F.col(c).alias("id"))
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min(order("v")).alias("least"))
        up = settle(least.select(F.col("u").alias("node"), F.least(F.col("least"), order("u")).getField("id").alias("up")))
        for _ in range(2):
            next_up = up.select(F.col("node").alias("up"), F.col("up").alias("further"))
            up = settle(up.join(next_up, "up").select("node", F.col("further").alias("up")))
        maps.append(up)
        a = up.select(F.col("node").alias("u"), F.col("up").alias("p"))
        b = up.select(F.col("node").alias("v"), F.col("up").alias("q"))
        edges = settle(edges.join(a, "u").join(b, "v").select(F.col("p").alias("u"), F.col("q").alias("v")).where("u <> v").distinct())
    if not maps:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    found = maps[0].withColumnRenamed("up", "root")
    for up in maps[1:]:
        step = up.select(F.col("node").alias("root"), "up")
        found = found.join(step, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
    return settle(found)


def grouped(docs: DataFrame, shingle: int = SHINGLE, budget: int = BUDGET) -> DataFrame:
    """doc_id, text_hash, text_bytes, fp, root (a fingerprint of the component) and component_id (the
    least id of all documents that links reach) of every row."""
    marks = settle(fingerprints(docs, shingle=shingle))
    distinct = settle(marks.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(distinct.select("fp"), budget)).withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = settle(rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    ids = settle(rooted.join(named, "root").select("fp", "root", "component_id"))
    return marks.join(ids, "fp")


@query("op6_simhash")
def simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Components of all documents."""
    found = grouped(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of ``grouped``: that of the least id, null last, and of its texts the least by
    hash and length.

    The row is looked up by id and content, so other texts of its id are judged by their own components; repeated
    rows of that id and text leave one.
    """
    found = settle(grouped(docs.select("doc_id", "text")))
    content = {"doc_id": F.col("doc_id"), **text_content()}
    rows = found.groupBy("root", *content).agg(F.count("*").alias("times"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), *content, "times")).alias("least")
    keepers = settle(rows.groupBy("root").agg(least).select("least.*"))
    left, names = docs, {}
    for name, value in content.items():
        names[name] = fresh(left, f"left_{name}")
        left = left.withColumn(names[name], value)
    right = keepers.select(*(F.col(n).alias(fresh(left, f"right_{n}")) for n in content))
    match = [left[names[n]].eqNullSafe(right[r]) for n, r in zip(content, right.columns)]
    kept = left.join(right, match, "left_semi")
    if not keepers.where("times > 1").isEmpty():
        kept = kept.dropDuplicates(list(names.values()))
    return kept.select(*docs.columns)
