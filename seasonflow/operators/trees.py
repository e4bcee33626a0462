"""Boosted trees as a table: one row for each tree of a key's model, its nodes as arrays.

A model is read, stored and counted like any table, and rows are scored in Arrow batches. For many models
at once rows meet the trees of their key in one shuffle: trees come first in the order of a partition, so a
task holds one model at a time and no group of rows. Keys with many rows are cut into parts, each of which
gets the trees.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

#: What stands for a missing number: no feature that can be missing takes it.
MISSING = -1.0
#: Values of a nominal column from which on it is taken as a number: a tree's bins are counted for every
#: feature, and they may not be fewer than the values of any.
MOST_VALUES = 512
#: Rows of a key that meet one copy of its trees.
PART_ROWS = 200_000

NODES = "feature array<int>, threshold array<double>, left_child array<int>, right_child array<int>, value array<double>, left_categories array<array<int>>"
SCHEMA = f"key string, tree int, weight double, {NODES}, gain array<double>, inputs string"


@dataclass(frozen=True)
class Inputs:
    """The columns of a model and, for nominal ones, their known values in order.

    A value that is not known, or missing, is one more category. A nominal column of more than
    ``MOST_VALUES`` values is a number.
    """

    columns: tuple[str, ...]
    values: Mapping[str, tuple[float, ...]] = field(default_factory=dict)

    @classmethod
    def of(cls, df: DataFrame, columns: Sequence[str], nominal: Sequence[str], most: int = MOST_VALUES) -> Inputs:
        values = {}
        for c in nominal:
            if c in columns:
                known = df.select(F.col(c).cast("double").alias("v")).where("v IS NOT NULL").distinct().limit(most + 1).collect()
                if len(known) <= most:
                    values[c] = tuple(sorted(r.v for r in known))
        return cls(tuple(columns), values)

    @property
    def most_categories(self) -> int:
        return max((len(v) + 1 for v in self.values.values()), default=0)

    def numbers(self) -> list[Column]:
        """The columns as doubles: what :meth:`matrix` takes."""
        return [F.coalesce(F.col(c).cast("double"), F.lit(None if c in self.values else MISSING)) for c in self.columns]

    def vectors(self, df: DataFrame) -> DataFrame:
        """Adds ``features``: a vector whose attributes say which columns are nominal."""
        made = {}
        for c, number in zip(self.columns, self.numbers()):
            if c in self.values:
                known = self.values[c]
                place = F.array_position(F.array(*map(F.lit, known)), number) if known else F.lit(0)
                index = F.when(F.coalesce(place, F.lit(0)) > 0, place - 1).otherwise(len(known)).cast("double")
                made[c] = index.alias(f"{c}__i", metadata={"ml_attr": {"type": "nominal", "num_vals": len(known) + 1}})
            else:
                made[c] = number.alias(f"{c}__i")
        wide = df.select("*", *made.values())
        return VectorAssembler(inputCols=[f"{c}__i" for c in self.columns], outputCol="features").transform(wide).drop(*[f"{c}__i" for c in self.columns])

    def matrix(self, raw: np.ndarray) -> np.ndarray:
        """Numbers with the nominal columns replaced by the places of their values."""
        out = raw.copy()
        for c, known in self.values.items():
            i, known = self.columns.index(c), np.array(known)
            at = np.minimum(np.searchsorted(known, raw[:, i]), max(len(known) - 1, 0))
            out[:, i] = np.where(known[at] == raw[:, i], at, len(known)) if len(known) else 0
        return out

    def written(self) -> str:
        return json.dumps({"columns": self.columns, "values": self.values})

    @classmethod
    def read(cls, text: str) -> Inputs:
        found = json.loads(text)
        return cls(tuple(found["columns"]), {c: tuple(v) for c, v in found["values"].items()})


@dataclass(frozen=True)
class Tree:
    """Nodes from the root on, each before what is below it; ``feature`` is -1 in a leaf."""

    weight: float
    feature: list[int]
    threshold: list[float]
    left_child: list[int]
    right_child: list[int]
    value: list[float]
    left_categories: list[list[int]]
    gain: list[float]

    @property
    def leaves(self) -> list[int]:
        """The places of the leaves, from left to right: Spark numbers them in this order."""
        return [i for i, feature in enumerate(self.feature) if feature < 0]

    def with_values(self, values: Sequence[float]) -> Tree:
        """The same splits with other values in the leaves."""
        out = list(self.value)
        for i, value in zip(self.leaves, values, strict=True):
            out[i] = value
        return replace(self, value=out)


_SPLIT = re.compile(r"If \(feature (\d+) (?:<= (\S+)|in \{(.*)\})\)$")


def tree_of(text: str, weight: float = 1.0, gain: Sequence[float] = ()) -> Tree:
    """The tree that Spark's ``toDebugString`` writes out."""
    tree = Tree(weight, [], [], [], [], [], [], list(gain))
    waiting: list[int] = []  # inner nodes whose right side is still to come
    parent = None
    for line in map(str.strip, text.splitlines()):
        if line.startswith("Else"):
            parent = (waiting.pop(), tree.right_child)
            continue
        if not line.startswith(("If", "Predict")):
            continue
        here = len(tree.feature)
        if parent:
            parent[1][parent[0]] = here
        split = _SPLIT.match(line)
        tree.feature.append(int(split[1]) if split else -1)
        tree.threshold.append(float(split[2]) if split and split[2] else 0.0)
        tree.left_categories.append([int(float(c)) for c in split[3].split(",")] if split and split[3] else [])
        tree.value.append(0.0 if split else float(line.split(":")[1]))
        tree.left_child.append(-1)
        tree.right_child.append(-1)
        parent = (here, tree.left_child) if split else None
        if split:
            waiting.append(here)
    return tree


class Packed:
    """Trees as arrays in one task."""

    def __init__(self, inputs: Inputs, trees: Sequence[Tree]):
        self.inputs = inputs
        self.weights = [t.weight for t in trees]
        sizes = [len(t.feature) for t in trees]
        self.roots = np.concatenate(([0], np.cumsum(sizes)))[:-1].astype(np.int64)
        flat = lambda name, kind: np.array([x for t in trees for x in getattr(t, name)], dtype=kind)
        shift = np.repeat(self.roots, sizes)
        self.feature, self.threshold, self.value = flat("feature", np.int64), flat("threshold", float), flat("value", float)
        self.left, self.right = flat("left_child", np.int64) + shift, flat("right_child", np.int64) + shift
        lists = [c for t in trees for c in t.left_categories]
        width = inputs.most_categories
        self.sets = np.full(len(lists), -1)
        members = [i for i, c in enumerate(lists) if c]
        self.sets[members] = np.arange(len(members))
        self.members = np.zeros((len(members), max(width, 1)), dtype=bool)
        for k, i in enumerate(members):
            self.members[k, lists[i]] = True

    def predict(self, raw: np.ndarray) -> np.ndarray:
        """The weighted sum of the trees for rows of numbers."""
        x = self.inputs.matrix(raw)
        rows, total = np.arange(len(x)), np.zeros(len(x))
        for root, weight in zip(self.roots, self.weights):
            at = np.full(len(x), root)
            while True:
                feature = self.feature[at]
                inner = feature >= 0
                if not inner.any():
                    break
                value = x[rows, np.maximum(feature, 0)]
                go_left = value <= self.threshold[at]
                nominal = inner & (self.sets[at] >= 0)
                if nominal.any():
                    go_left[nominal] = self.members[self.sets[at[nominal]], value[nominal].astype(np.int64)]
                at = np.where(inner, np.where(go_left, self.left[at], self.right[at]), at)
            total += weight * self.value[at]
        return total


@dataclass(frozen=True)
class TreeModel:
    """A fitted sum of trees; ``errors`` are those of every round on the validation rows."""

    inputs: Inputs
    trees: list[Tree]
    errors: list[float] = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``prediction``. The trees, whose size the settings bound, go to every executor once."""
        sent = df.sparkSession.sparkContext.broadcast((self.inputs, self.trees))
        packed: list[Packed] = []

        def score(*columns: pd.Series) -> pd.Series:
            if not packed:
                packed.append(Packed(*sent.value))
            return pd.Series(packed[0].predict(np.column_stack([c.to_numpy(dtype=float) for c in columns])))

        return df.withColumn("prediction", F.pandas_udf(score, "double")(*self.inputs.numbers()))

    def rows(self, key: str = "") -> list[tuple]:
        inputs = self.inputs.written()
        return [
            (key, i, t.weight, t.feature, t.threshold, t.left_child, t.right_child, t.value, t.left_categories, t.gain, None if i else inputs)
            for i, t in enumerate(self.trees)
        ]


def model_table(spark: SparkSession, models: Mapping[str, TreeModel]) -> DataFrame:
    """Models by key as one table; a single model has the empty key."""
    return spark.createDataFrame([r for key in sorted(models) for r in models[key].rows(key)], SCHEMA)


def _tree(row) -> Tree:
    return Tree(row["weight"], row["feature"], row["threshold"], row["left_child"], row["right_child"], row["value"], row["left_categories"], row["gain"])


def model_of(table: DataFrame, key: str = "") -> TreeModel:
    """One model of a stored table: as many rows as it has trees."""
    rows = sorted(table.where(F.col("key") == key).collect(), key=lambda r: r["tree"])
    if not rows:
        raise KeyError(key)
    return TreeModel(Inputs.read(rows[0]["inputs"]), [_tree(r) for r in rows])


def split_counts(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``key, feature, importance``: how often the trees of each model split on each feature, 0 included."""
    named = F.array(*map(F.lit, columns))
    used = table.select("key", F.explode("feature").alias("i")).where("i >= 0").groupBy("key", "i").agg(F.count(F.lit(1)).alias("n"))
    every = table.select("key").distinct().select("key", F.posexplode(named).alias("i", "feature"))
    return every.join(used, ["key", "i"], "left").select("key", "feature", F.coalesce("n", F.lit(0)).cast("double").alias("importance"))


def score_by_key(df: DataFrame, models: DataFrame, key: str = "key", spread: Sequence[str] = ("ds", "hour"), part_rows: int = PART_ROWS) -> DataFrame:
    """Adds ``prediction`` of the row's key's model; null where the key has none.

    All models have the same columns; their known values may differ. ``spread`` are columns that tell
    the rows of a key apart.
    """
    first = models.where("inputs IS NOT NULL").select("inputs").first()
    if first is None:
        return df.withColumn("prediction", F.lit(None).cast("double"))
    columns = Inputs.read(first["inputs"])
    numbers = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(MISSING if c not in columns.values else float("nan"))) for c in columns.columns])
    named = models.where("inputs IS NOT NULL").select(F.col("key").alias("_key"))
    counts = df.groupBy(F.col(key).alias("_key")).agg(F.ceil(F.count(F.lit(1)) / part_rows).cast("int").alias("_parts"))
    parts = named.join(counts, "_key")
    part = F.pmod(F.xxhash64(*spread), F.col("_parts")).cast("int") if spread else F.lit(0)
    body = F.struct(*[F.col(c) for c in df.columns]).alias("_row")
    sided = df.select(F.col(key).alias("_key"), numbers.alias("_x"), body, *spread).join(parts, "_key", "left")
    has_model = F.col("_parts").isNotNull()
    rows = sided.where(has_model).select("_key", part.alias("_part"), F.lit(0).alias("_tree"), F.lit(None).cast("struct<" + ",".join(_model_fields()) + ">").alias("_model"), "_x", "_row")
    fields = F.struct(*[c for c in models.columns if c not in ("key", "tree")]).alias("_model")
    copies = models.withColumnRenamed("key", "_key").join(parts, "_key").select(
        "_key", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"), (F.col("tree") - F.lit(1 << 30)).alias("_tree"), fields,
        F.lit(None).cast("array<double>").alias("_x"), F.lit(None).cast(df.select(body).schema["_row"].dataType).alias("_row"),
    )
    dealt = copies.unionByName(rows).repartition("_key", "_part").sortWithinPartitions("_key", "_part", "_tree")

    def run(batches):
        import pyarrow as pa

        here, trees, packed = None, [], None
        for batch in batches:
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            models, xs = batch.column(3), batch.column(4)
            at = 0
            while at < len(keys):
                if keys[at] != here:
                    here, trees, packed = keys[at], [], None
                if models[at].is_valid:
                    trees.append(models[at].as_py())
                    at += 1
                    continue
                upto = at
                while upto < len(keys) and keys[upto] == here:
                    upto += 1
                if packed is None:
                    packed = Packed(Inputs.read(trees[0]["inputs"]), [_tree(t) for t in trees])
                x = xs.slice(at, upto - at).flatten().to_numpy(zero_copy_only=False).reshape(upto - at, -1)
                yield pa.RecordBatch.from_arrays([batch.column(5).slice(at, upto - at), pa.array(packed.predict(x))], names=["_row", "prediction"])
                at = upto

    out = StructType([df.select(body).schema["_row"], StructField("prediction", DoubleType())])
    scored = dealt.mapInArrow(run, out).select("_row.*", "prediction")
    rest = sided.where(~has_model).select("_row.*", F.lit(None).cast("double").alias("prediction"))
    return scored.unionByName(rest)


def _model_fields() -> list[str]:
    fields = re.findall(r"(\w+) ((?:array<)*\w+>*)", SCHEMA)
    return [f"{n}:{t}" for n, t in fields if n not in ("key", "tree")]
