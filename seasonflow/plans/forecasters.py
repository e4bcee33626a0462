"""Regressors on the log of demand: global, per key, walk-forward and searched.

All of them are Spark ML pipelines, so fitting is spread over the executors. The
target is ``log1p(y)``; predictions are clipped at 0 and returned by ``expm1``.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from typing import Any

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import ElementwiseProduct, Imputer, OneHotEncoder, SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonflow.operators import growing, trees
from seasonflow.operators.baseline import clip, fold_forecasts
from seasonflow.operators.evaluate import BASELINE, improvements, metrics_by, prediction_rows
from seasonflow.operators.growing import BinnedRows, Bins, Grown, TreeOfRounds
from seasonflow.operators.split import Fold, fold_rows, fold_sizes, key_sizes, learned_from, tail_split
from seasonflow.operators.trees import Inputs, TreeModel
from seasonflow.session import literal_table, scratch_path, settle

RIDGE_CATEGORICAL = ("key_code", "kind_code")
#: Columns whose values have no order.
NOMINAL = ("key_code", "kind_code", "weekday", "month", "hour_of_day")
#: Models of keys that are stored together.
STORED_MODELS = 16
#: Rows of a task that are ordered and put into bins, or that a forest learns from.
TASK_ROWS = 16_000


@dataclass(frozen=True)
class Boosting:
    """Settings of a boosted-tree forecaster."""

    rounds: int
    step: float
    depth: int
    least_leaf: int
    row_share: float
    column_share: str
    patience: int = 100
    bins: int = 64
    seed: int = 42
    nominal: tuple[str, ...] = NOMINAL
    l1: float = 0.0
    l2: float = 0.0

    def leaf(self, total: float, count: int) -> float:
        """What a leaf adds to ``count`` rows whose errors sum to ``total``: the sum is drawn to 0 by ``l1`` and
        shared among ``l2`` rows more. Without penalties it is their mean."""
        drawn = math.copysign(max(abs(total) - self.l1, 0.0), total)
        return drawn / (count + self.l2) if count + self.l2 else 0.0


# The settings of the compared learners. Leaf counts become depths, since
# Spark grows trees by level. Fewer rounds can be asked for with ``dataclasses.replace``.
LIGHTGBM = Boosting(rounds=2000, step=0.02, depth=8, least_leaf=10, row_share=1.0, column_share="0.8", l1=0.1, l2=0.1)
LIGHTGBM_PER_KEY = Boosting(rounds=2000, step=0.02, depth=7, least_leaf=5, row_share=1.0, column_share="0.8", l1=0.1, l2=0.1)
XGBOOST = Boosting(rounds=397, step=0.0995, depth=7, least_leaf=10, row_share=0.961, column_share="0.713", l2=1.0)
SEARCH_PATIENCE = 50
XGBOOST_DEFAULT = Boosting(rounds=2000, step=0.02, depth=8, least_leaf=10, row_share=0.8, column_share="0.8", l2=1.0)


def with_target(df: DataFrame) -> DataFrame:
    return df.withColumn("target", F.log1p("y"))


def _imputed(columns: Sequence[str]) -> tuple[Imputer, list[str]]:
    """Medians for missing values; the sketch keeps them within one part in 10,000 of rank."""
    out = [f"{c}__f" for c in columns]
    return Imputer(strategy="median", inputCols=list(columns), outputCols=out, relativeError=1e-4), out


def _as_double(columns: Sequence[str]) -> SQLTransformer:
    """Numeric copies, so that every input of the imputer is a double."""
    cast = ", ".join(f"CAST(`{c}` AS DOUBLE) AS `{c}__d`" for c in columns)
    return SQLTransformer(statement=f"SELECT *, {cast} FROM __THIS__")


def _tree_inputs(features: Sequence[str]) -> list:
    """Doubles in one vector. A missing value becomes -1, which no feature that can be
    missing takes, so a tree can split it off as the compared learners do."""
    cast = ", ".join(f"coalesce(CAST(`{c}` AS DOUBLE), -1.0D) AS `{c}__d`" for c in features)
    return [
        SQLTransformer(statement=f"SELECT *, {cast} FROM __THIS__"),
        VectorAssembler(inputCols=[f"{c}__d" for c in features], outputCol="features"),
    ]


# ------------------------------------------------------------------ global models


def fit_ridge(train: DataFrame, features: Sequence[str], alpha: float = 1.0) -> PipelineModel:
    """Ridge on imputed, standardised numbers and one-hot key and kind codes.

    Numbers are scaled by the deviation of the population. ``regParam`` is scaled so that the coefficients equal those of the closed form
    with penalty ``alpha``; an unknown category encodes to all zeros.
    """
    train = with_target(train)
    numeric = [c for c in features if c not in RIDGE_CATEGORICAL]
    coded = [c for c in RIDGE_CATEGORICAL if c in features]
    stats = train.agg(
        F.count("target").alias("n"), F.stddev_pop("target").alias("s"), *[F.count(c).alias(f"n__{c}") for c in numeric]
    ).first()
    numeric = [c for c in numeric if stats[f"n__{c}"]]  # a column without a value has no median
    imputer, filled = _imputed([f"{c}__d" for c in numeric])
    penalty = alpha * (stats["s"] or 0.0) / max(stats["n"], 1)
    whole = math.sqrt(stats["n"] / (stats["n"] - 1)) if stats["n"] > 1 else 1.0  # from sample to population
    categories = []
    if coded:
        cast = ", ".join(f"CAST(coalesce(`{c}`, -1) + 1 AS DOUBLE) AS `{c}__c`" for c in coded)
        categories = [
            SQLTransformer(statement=f"SELECT *, {cast} FROM __THIS__"),
            OneHotEncoder(inputCols=[f"{c}__c" for c in coded], outputCols=[f"{c}__h" for c in coded], handleInvalid="keep", dropLast=True),
        ]
    return Pipeline(
        stages=[
            _as_double(numeric),
            imputer,
            VectorAssembler(inputCols=filled, outputCol="numbers"),
            StandardScaler(inputCol="numbers", outputCol="by_sample", withMean=True, withStd=True),
            ElementwiseProduct(scalingVec=Vectors.dense([whole] * len(numeric)), inputCol="by_sample", outputCol="scaled"),
            *categories,
            VectorAssembler(inputCols=["scaled", *[f"{c}__h" for c in coded]], outputCol="features"),
            LinearRegression(
                featuresCol="features",
                labelCol="target",
                elasticNetParam=0.0,
                regParam=penalty,
                standardization=False,
                solver="auto",  # normal equations while they are small enough, iterations beyond
            ),
        ]
    ).fit(train)


def fit_forest(
    train: DataFrame, features: Sequence[str], trees: int = 200, depth: int = 15, least_leaf: int = 5, seed: int = 42
) -> PipelineModel:
    forest = RandomForestRegressor(
        featuresCol="features",
        labelCol="target",
        numTrees=trees,
        maxDepth=depth,
        minInstancesPerNode=least_leaf,
        featureSubsetStrategy="all",
        seed=seed,
    )
    rows = with_target(train)
    parts = math.ceil(rows.count() / TASK_ROWS)
    if parts > rows.rdd.getNumPartitions():  # a stored table is read by as many tasks as its bytes fill, however many trees
        rows = in_order(rows.withColumn("_order", F.xxhash64(*Inputs(tuple(features)).numbers(), "target")), parts)
    return Pipeline(stages=[*_tree_inputs(features), forest]).fit(rows)


def best_round(errors: Sequence[float], patience: int) -> tuple[int, bool]:
    """The round (from 1) of least error before ``patience`` rounds in a row bring no gain, and
    whether these rounds were seen. The first of equal rounds wins; without errors it is 0."""
    best = 0
    for i, error in enumerate(errors, start=1):
        if not best or error < errors[best - 1]:
            best = i
        elif i - best >= patience:
            return best, True
    return best, False


def in_order(df: DataFrame, parts: int, by: str = "_order") -> DataFrame:
    """Rows dealt and ordered by a hash of their content. A stored table is read in whatever order its files are
    listed, and sums in another order differ in their last digit, which decides between splits that tie."""
    return df.repartition(parts, by).sortWithinPartitions(by)


def fit_boosted(
    train: DataFrame, features: Sequence[str], settings: Boosting, is_val: str | None = "is_val", start: TreeModel | None = None
) -> TreeModel:
    """Boosted trees; rows marked ``is_val`` only decide how many.

    Every row keeps its prediction so far, and each round fits one tree to what is left, so a round is fitted
    once: the trees are those of Spark's ``GBTRegressor`` (whose candidate splits come from a draw of the rows
    where these are over 10,000, and from all of them here). Rows are put into bins once and rounds are grown
    from these (:mod:`seasonflow.operators.growing`). The error on the marked rows is kept as rounds
    go on; the fit ends ``patience`` rounds after the best one, whose trees are kept. Without marked rows all
    rounds are kept. ``start`` goes on from a model: its trees count as rounds and stay.

    With a penalty (``l1``, ``l2``) the leaves of every tree but the first, which stands for the level, take the
    value of :meth:`Boosting.leaf`, from the sums of all rows that are learned from; splits are Spark's own. The same
    sums by leaf give the error on the marked rows.

    Predictions are held by the executors and written to the shared folder every few rounds, so a lost executor costs
    these rounds at most. Rows are taken in the order of a hash and sums are added in one order, so a fit repeats itself
    exactly. Nominal columns are split by sets of their values.
    """
    rounds = list(start.trees) if start else []
    inputs = start.inputs if start else Inputs.of(train, features, settings.nominal)
    marked = F.coalesce(F.col(is_val), F.lit(False)) if is_val else F.lit(False)
    rows = with_target(start.transform(train) if start else train.withColumn("prediction", F.lit(0.0)))
    numbers = [n.alias(f"c{i}") for i, n in enumerate(inputs.numbers())]
    state = settle(rows.select(*numbers, "target", marked.alias("_val"), F.col("prediction").alias("so_far"), F.xxhash64(*inputs.numbers(), "target").alias("_order")))
    count = {r["_val"]: r["n"] for r in state.groupBy("_val").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not count.get(False):
        raise ValueError("no row to learn from")
    watched = True in count
    most = max(settings.bins, inputs.most_categories)
    columns = [f"c{i}" for i in range(len(numbers))]
    bins = Bins.of(state.where("NOT _val").select(*columns), inputs, count[False], most)
    parts = math.ceil(sum(count.values()) / TASK_ROWS)
    dealt = in_order(state, parts).select(*columns, "target", "_val", "so_far")
    held = BinnedRows(dealt, inputs, bins, parts, max(1, growing.CHUNK_ROWS // TASK_ROWS))
    errors = list(start.errors) if start else []
    learner = TreeOfRounds(
        numTrees=1,
        bootstrap=False,
        maxDepth=settings.depth,
        minInstancesPerNode=settings.least_leaf,
        subsamplingRate=settings.row_share,
        featureSubsetStrategy=settings.column_share,
        maxBins=most,
    )

    def valued(grown: Grown) -> trees.Tree:
        """Leaves but those of the first tree by the sums of what was left."""
        if first or not (settings.l1 or settings.l2):
            return grown.tree
        slopes = [grown.sums.get((i, False)) for i in range(len(grown.tree.leaves))]
        return grown.tree.with_values([2 * settings.leaf(s[1], s[0]) if s else 0.0 for s in slopes])

    while len(rounds) < settings.rounds:
        first = not rounds
        learner.setSeed(settings.seed + len(rounds))
        # the negative slope of the squared error is learned from
        learner.weight, learner.first, learner.valued = 1.0 if first else settings.step, first, valued
        grown = learner.fit(held)
        tree = valued(grown)
        rounds.append(tree)
        if watched:
            # the squared errors of a leaf's rows after the step: q - 2 v s + n v v
            moved_by = [(r, tree.weight * tree.value[tree.leaves[i]]) for (i, val), r in grown.sums.items() if val]
            errors.append(math.fsum(q - 2 * v * s + n * v * v for (n, s, q), v in moved_by) / sum(r[0] for r, _ in moved_by))
            if best_round(errors, settings.patience)[1]:
                break
    held.close()
    if watched:
        rounds = rounds[: max(best_round(errors, settings.patience)[0], 1)]
    return TreeModel(inputs, rounds, errors)


def predict(model: PipelineModel | TreeModel, df: DataFrame) -> DataFrame:
    """Adds ``pred`` in the original scale: clipped at 0 in the log, then inverted."""
    scored = model.transform(df)
    kept = [c for c in df.columns]
    return scored.select(*kept, F.expm1(clip(F.col("prediction"))).alias("pred"))


def feature_importance(model: PipelineModel | TreeModel, features: Sequence[str], by: str = "splits") -> DataFrame:
    """``feature, importance``, largest first: how many splits of the trees use a feature, or by ``gain`` its
    mean share of a tree's gain in impurity, which is what a forest has."""
    from pyspark.sql import SparkSession

    spark = SparkSession.active()
    if isinstance(model, TreeModel) and by == "splits":
        found = trees.split_counts(trees.model_table(spark, {"": model}), model.inputs.columns)
        return found.select("feature", "importance").orderBy(F.desc("importance"), "feature")
    if isinstance(model, TreeModel):
        values = np.mean([t.gain for t in model.trees], axis=0).tolist()
    else:
        values = model.stages[-1].featureImportances.toArray().tolist()
    rows = sorted(zip(features, values), key=lambda r: (-r[1], r[0]))
    return literal_table(spark, rows, "feature string, importance double")


# ------------------------------------------------------------------ one model per key


def fit_per_key(split: DataFrame, features: Sequence[str], settings: Boosting, threads: int = 4, path: str | None = None) -> DataFrame:
    """A boosted model for every key with enough rows, fitted in a bounded pool: the table of their trees.

    Every key is fitted, whatever their number, and its trees are stored before the next ones are fitted;
    :func:`fit_ridge_per_key` costs one job for all of them.
    """
    spark = split.sparkSession
    path = path or scratch_path(spark, "models")
    sizes = key_sizes(split).where("kept").select("key").orderBy("key").collect()  # one row per model
    marked = learned_from(split).withColumn("is_val", F.col("split") == "val")

    def fit(key: str) -> TreeModel:
        return fit_boosted(marked.where(F.col("key") == key), features, settings)

    keys = [row["key"] for row in sizes]
    trees.model_table(spark, {}).write.mode("overwrite").parquet(path)
    with ThreadPoolExecutor(max_workers=threads) as pool:
        for at in range(0, len(keys), STORED_MODELS):
            some = keys[at : at + STORED_MODELS]
            trees.model_table(spark, dict(zip(some, pool.map(fit, some)))).coalesce(1).write.mode("append").parquet(path)
    return spark.read.schema(trees.SCHEMA).parquet(path)


def predict_per_key(models: DataFrame, df: DataFrame, fallback: DataFrame | None = None) -> DataFrame:
    """Each key by its own model of the table, in one plan; other keys by ``fallback`` (``ds, key, hour, pred``), else 0."""
    scored = trees.score_by_key(df, models)
    own = F.when(F.col("prediction").isNotNull(), F.expm1(clip(F.col("prediction"))))
    if fallback is None:
        return scored.select(*df.columns, F.coalesce(own, F.lit(0.0)).alias("pred"))
    side = fallback.groupBy("ds", "key", "hour").agg(F.min("pred").alias("_other"))
    joined = scored.join(side, ["ds", "key", "hour"], "left")
    return joined.select(*df.columns, F.coalesce(own, "_other", F.lit(0.0)).alias("pred"))


def fit_ridge_per_key(train: DataFrame, features: Sequence[str], alpha: float = 1.0, held: int = 256) -> DataFrame:
    """``key, weights, medians``: closed-form ridge on log1p for every key, however many.

    As :func:`fit_ridge` on the key's rows: missing values are the key's medians and columns are scaled. Each task
    sums one matrix of moments for each key that it meets, and hands them on when it holds more than ``held``;
    no row leaves its task. A matrix has the sums of products of the values, of marks where they are missing, and
    of the target, so that medians and scales can be put in afterwards.
    """
    d = len(features)
    size = 2 * d + 2  # one, values, marks, target
    upper = np.triu_indices(size)
    rows = train.select("key", "y", *[F.col(c).cast("double").alias(c) for c in features]).na.drop(subset=["key", "y"])

    def moments(batches):
        import pyarrow as pa

        sums: dict[str, np.ndarray] = {}

        def out():
            return pa.RecordBatch.from_pydict({"key": list(sums), "m": [m[upper] for m in sums.values()]})

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0).dictionary_encode()
            columns = [batch.column(2 + i).to_numpy(zero_copy_only=False) for i in range(d)]
            x = np.column_stack(columns) if d else np.empty((batch.num_rows, 0))
            missing = np.isnan(x)
            full = np.column_stack([np.ones(len(x)), np.where(missing, 0.0, x), missing, np.log1p(batch.column(1).to_numpy(zero_copy_only=False))])
            place = keys.indices.to_numpy(zero_copy_only=False)
            for i, key in enumerate(keys.dictionary.to_pylist()):
                own = full[place == i]
                sums[key] = sums.get(key, 0) + own.T @ own
            if len(sums) > held:
                yield out()
                sums.clear()
        if sums:
            yield out()

    summed = (
        rows.mapInArrow(moments, "key string, m array<double>")
        .select("key", F.posexplode("m").alias("at", "v"))
        .groupBy("key", "at")
        .agg(F.sum("v").alias("v"))
        .groupBy("key")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "v"))), lambda e: e["v"]).alias("m"))
    )
    middle = rows.groupBy("key").agg(F.array(*[F.percentile_approx(c, 0.5, 10_000) for c in features]).alias("medians"))

    def solve(batches):
        for batch in batches:
            found = [_ridge_of(flat, medians, d, alpha) for flat, medians in zip(batch["m"], batch["medians"])]
            yield pd.DataFrame({"key": batch["key"], "weights": [w for w, _ in found], "medians": [c for _, c in found]})

    return summed.join(middle, "key").mapInPandas(solve, "key string, weights array<double>, medians array<double>")


def _ridge_of(flat: Sequence[float], medians: Sequence[float | None], d: int, alpha: float) -> tuple[list[float], list[float]]:
    """Intercept and slopes in the columns' own units, and what stands for missing values. A column without a
    value, or with one value only, has slope 0."""
    size = 2 * d + 2
    m = np.zeros((size, size))
    m[np.triu_indices(size)] = flat
    m = m + np.triu(m, 1).T
    fill = np.array([np.nan if c is None else c for c in medians], dtype=float)
    fill = np.where(np.isnan(fill), 0.0, fill)
    put = np.zeros((d + 2, size))  # one, filled values, target
    put[0, 0] = put[-1, -1] = 1
    put[1 : d + 1, 1 : d + 1] = np.eye(d)
    put[1 : d + 1, d + 1 : 2 * d + 1] = np.diag(fill)
    m = put @ m @ put.T
    n, mean = m[0, 0], m[0, 1:] / m[0, 0]
    centred = m[1:, 1:] - n * np.outer(mean, mean)
    spread = np.sqrt(np.maximum(np.diag(centred)[:-1], 0) / n)
    flat_column = spread <= 1e-9 * np.maximum(np.abs(mean[:-1]), 1)
    scale = np.where(flat_column, 1.0, spread)
    inner = centred[:-1, :-1] / np.outer(scale, scale)
    inner[flat_column] = inner[:, flat_column] = 0
    right = np.where(flat_column, 0.0, centred[:-1, -1] / scale)
    slope = np.linalg.solve(inner + alpha * np.eye(d), right) / scale
    return [float(mean[-1] - slope @ mean[:-1]), *slope.tolist()], fill.tolist()


def predict_ridge_per_key(df: DataFrame, weights: DataFrame, features: Sequence[str], fallback: DataFrame | None = None) -> DataFrame:
    """Keys without weights by ``fallback`` (``ds, key, hour, pred``), else 0."""
    joined = df.join(weights, "key", "left")
    linear = F.col("weights")[0]
    for i, feature in enumerate(features):
        linear = linear + F.col("weights")[i + 1] * F.coalesce(F.col(feature).cast("double"), F.col("medians")[i])
    own = F.when(F.col("weights").isNotNull(), F.coalesce(F.expm1(clip(linear)), F.lit(0.0)))
    if fallback is None:
        return joined.withColumn("pred", F.coalesce(own, F.lit(0.0))).drop("weights", "medians")
    side = fallback.groupBy("ds", "key", "hour").agg(F.min("pred").alias("_other"))
    both = joined.withColumn("pred", own).join(side, ["ds", "key", "hour"], "left")
    return both.select(*df.columns, F.coalesce("pred", "_other", F.lit(0.0)).alias("pred"))


# ------------------------------------------------------------------ ablation


def together(*jobs: Callable[[], Any]) -> list[Any]:
    """What independent fits return, run side by side: a round of small jobs leaves most of a cluster idle."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        return [done.result() for done in [pool.submit(job) for job in jobs]]


def ablation(
    split: DataFrame, features: Sequence[str], settings: Boosting, without: str, full: Callable[[], TreeModel] | None = None
) -> DataFrame:
    """Metrics with and without one feature, and the change of the MAE. Both models are fitted side by side;
    ``full`` gives the one with the feature, if it is stored or to be shared."""
    marked = learned_from(split).withColumn("is_val", F.col("split") == "val")
    test = split.where("split = 'test'")
    fewer = [f for f in features if f != without]
    models = together(full or (lambda: fit_boosted(marked, list(features), settings)), lambda: fit_boosted(marked, fewer, settings))
    frames = [prediction_rows(predict(model, test), name) for model, name in zip(models, ("full", "reduced"))]
    metrics = metrics_by(frames[0].unionByName(frames[1]))
    whole = metrics.where("model = 'full'").select("mae").scalar()
    return metrics.withColumn("mae_change", F.col("mae") - whole)


# ------------------------------------------------------------------ walk-forward


def walk_forward(
    df: DataFrame,
    folds: Sequence[Fold],
    features: Sequence[str],
    settings: Boosting,
    name: str = "LightGBM",
    least_train: int = 500,
    least_test: int = 100,
) -> DataFrame:
    """``fold, model, mae`` of the seasonal mean and of a booster with its own tail
    of each fold as validation. Folds that are too small are left out."""
    kept = {r["fold"] for r in fold_sizes(df, folds, least_train, least_test).where("kept").collect()}  # per fold
    used = [f for f in folds if f[0] in kept]
    base = fold_forecasts(df, used).select("fold", F.lit(BASELINE).alias("model"), "y", "pred")
    train, test = settle(tail_split(df, used)), settle(fold_rows(df, used, "test"))
    parts = [base]
    for fold in used:
        model = fit_boosted(train.where(F.col("fold") == fold[0]), features, settings)
        scored = predict(model, test.where(F.col("fold") == fold[0]))
        parts.append(scored.select("fold", F.lit(name).alias("model"), "y", "pred"))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy("fold", "model").agg(F.avg(F.abs(F.col("y") - F.col("pred"))).alias("mae"))


# ------------------------------------------------------------------ search


@dataclass(frozen=True)
class SearchSpace:
    """Ranges of a seeded random search; ``step`` is drawn on a log scale.

    Fixed values: the ranges below.
    """

    depth: tuple[int, int] = (3, 10)
    step: tuple[float, float] = (0.01, 0.3)
    rounds: tuple[int, int] = (100, 500)
    row_share: tuple[float, float] = (0.5, 1.0)
    column_share: tuple[float, float] = (0.5, 1.0)
    least_leaf: tuple[int, int] = (10, 10)
    base: Boosting = field(default_factory=lambda: XGBOOST_DEFAULT)
    patience: int = SEARCH_PATIENCE

    def draw(self, source: random.Random) -> Boosting:
        low, high = (math.log(v) for v in self.step)
        return replace(
            self.base,
            depth=source.randint(*self.depth),
            step=math.exp(source.uniform(low, high)),
            rounds=source.randint(*self.rounds),
            row_share=source.uniform(*self.row_share),
            column_share=f"{source.uniform(*self.column_share):.4f}",
            least_leaf=source.randint(*self.least_leaf),
            patience=self.patience,
        )


# The ranges of the second learner. Its 20 to 150 leaves are depths of 5 to 8 here.
LIGHTGBM_SPACE = SearchSpace(
    depth=(5, 8), column_share=(0.8, 0.8), least_leaf=(10, 100), base=replace(LIGHTGBM, rounds=500)
)


def search(
    df: DataFrame,
    folds: Sequence[Fold],
    features: Sequence[str],
    space: SearchSpace,
    trials: int = 50,
    seed: int = 42,
    threads: int = 2,
    progress: Callable[[int, float], None] | None = None,
    least_train: int = 200,
    least_test: int = 50,
) -> tuple[DataFrame, Boosting]:
    """``trial, fold, mae`` with the settings tried, and the best settings.

    The folds are laid out once in written tables; every trial is a few Spark fits.
    """
    kept = {r["fold"] for r in fold_sizes(df, folds, least_train, least_test).where("kept").collect()}
    used = [f for f in folds if f[0] in kept]
    if not used:
        raise ValueError("no fold is large enough")
    train = settle(tail_split(df, used))
    test = settle(fold_rows(df, used, "test"))
    source = random.Random(seed)
    drawn = [space.draw(source) for _ in range(trials)]

    def run(job: tuple[int, str]) -> tuple:
        trial, fold = job
        model = fit_boosted(train.where(F.col("fold") == fold), features, drawn[trial])
        scored = predict(model, test.where(F.col("fold") == fold))
        mae = scored.agg(F.avg(F.abs(F.col("y") - F.col("pred"))).alias("mae")).first()["mae"]
        if progress:
            progress(trial, mae)
        s = drawn[trial]
        return (trial, fold, float(mae), s.depth, s.step, s.rounds, s.row_share, s.column_share, s.least_leaf)

    jobs = [(t, f[0]) for t in range(trials) for f in used]
    with ThreadPoolExecutor(max_workers=threads) as pool:
        rows = list(pool.map(run, jobs))
    table = literal_table(
        df.sparkSession,
        rows,
        "trial int, fold string, mae double, depth int, step double, rounds int, row_share double, "
        "column_share string, least_leaf int",
    )
    means = table.groupBy("trial").agg(F.avg("mae").alias("mae"))
    best = means.agg(F.min_by("trial", F.struct("mae", "trial")).alias("t")).first()["t"]
    return table, drawn[best]


def verdict(split: DataFrame, holidays: DataFrame, features: Sequence[str], default: Boosting, tuned: Boosting) -> DataFrame:
    """Default against tuned settings on the test period, overall and on holidays.

    ``yes`` over 5 % gain, ``marginal`` over 0, else ``no``.
    """
    marked = learned_from(split).withColumn("is_val", F.col("split") == "val")
    test = split.where("split = 'test'")
    frames = [
        prediction_rows(predict(fit_boosted(marked, features, s), test), name)
        for name, s in ((BASELINE, default), ("tuned", tuned))
    ]
    preds = frames[0].unionByName(frames[1])
    overall = improvements(metrics_by(preds)).select("model", "mae", "mae_gain_pct")
    festive = (
        preds.join(F.broadcast(holidays.select("ds")), "ds", "left_semi")  # years x rules rows
        .groupBy("model")
        .agg(F.avg("abs_err").alias("holiday_mae"))
    )
    gain = F.col("mae_gain_pct")
    answer = F.when(gain > 5, "yes").when(gain > 0, "marginal").otherwise("no")
    return (
        overall.join(festive, "model", "left")
        .withColumn("verdict", F.when(F.col("model") == "tuned", answer))
        .withColumn("model", F.when(F.col("model") == BASELINE, "default").otherwise(F.col("model")))
    )
