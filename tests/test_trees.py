"""Boosting against Spark's own, nominal columns, and models as a table."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from seasonflow.operators import trees
from seasonflow.plans import forecasters as f
from seasonflow.sources import sinks

NAMES = ["a", "b", "c"]
SMALL = replace(f.LIGHTGBM, rounds=7, depth=4, step=0.3, least_leaf=2, patience=100, l1=0.0, l2=0.0)


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(500):
        a, b, c = (float(round(v, 3)) for v in rng.normal(size=3))
        rows.append((i, a, b, c, float(np.exp(1 + 0.5 * a + abs(b)) + rng.random()), i % 5 == 0))
    return spark.createDataFrame(rows, "id int, a double, b double, c double, y double, is_val boolean").persist()


# leaves of some size: splits of very few rows tie, and rounding decides
@pytest.mark.parametrize("settings", [replace(SMALL, least_leaf=20), replace(SMALL, least_leaf=20, row_share=0.7, column_share="0.6")])
def test_trees_are_those_of_the_library(frame, settings):
    booster = GBTRegressor(
        featuresCol="features", labelCol="target", maxIter=settings.rounds, stepSize=settings.step, maxDepth=settings.depth, maxBins=settings.bins,
        minInstancesPerNode=settings.least_leaf, subsamplingRate=settings.row_share, featureSubsetStrategy=settings.column_share, seed=settings.seed,
    )
    rows = f.settle(f.with_target(frame).coalesce(1))
    alike = f.in_order(rows.withColumn("_order", F.xxhash64(*trees.Inputs(tuple(NAMES)).numbers(), "target")), 1)
    ready = VectorAssembler(inputCols=NAMES, outputCol="features").transform(alike).persist()
    whole = booster.fit(ready)
    own = f.fit_boosted(rows, NAMES, settings, is_val=None)
    want = [trees.tree_of(t.toDebugString) for t in whole.trees]
    assert [t.weight for t in own.trees] == list(whole.treeWeights)
    for have, tree in zip(own.trees, want, strict=True):
        assert (have.feature, have.threshold, have.left_child, have.right_child) == (tree.feature, tree.threshold, tree.left_child, tree.right_child)
        np.testing.assert_allclose(have.value, tree.value, rtol=1e-9)
    got = own.transform(rows).orderBy("id").toPandas()["prediction"]
    np.testing.assert_allclose(got, whole.transform(ready).orderBy("id").toPandas()["prediction"], rtol=1e-9)


def test_rounds_are_fitted_once_and_go_on(frame, monkeypatch):
    fits = []
    original = f.RandomForestRegressor.fit
    monkeypatch.setattr(f.RandomForestRegressor, "fit", lambda self, *a: fits.append(self.getSeed()) or original(self, *a))
    whole = f.fit_boosted(frame, NAMES, replace(SMALL, rounds=12))
    assert fits == [42 + i for i in range(12)]  # a stored table in between, and no second fit
    first = f.fit_boosted(frame, NAMES, replace(SMALL, rounds=5))
    more = f.fit_boosted(frame, NAMES, replace(SMALL, rounds=12), start=first)
    assert [t.feature for t in more.trees] == [t.feature for t in whole.trees]
    np.testing.assert_allclose(more.errors, whole.errors)
    left, right = (m.transform(frame).orderBy("id").toPandas()["prediction"] for m in (whole, more))
    np.testing.assert_allclose(left, right)
    # the errors are those of the trees so far
    for i in (0, 4, 11):
        part = trees.TreeModel(whole.inputs, whole.trees[: i + 1]).transform(f.with_target(frame)).where("is_val")
        assert part.agg(F.avg((F.col("target") - F.col("prediction")) ** 2)).first()[0] == pytest.approx(whole.errors[i])


def test_patience_ends_the_fit(frame):
    noise = frame.withColumn("y", F.when(F.col("is_val"), F.abs(F.hash("id")) % 1000).otherwise(F.col("y")).cast("double"))
    model = f.fit_boosted(noise, NAMES, replace(SMALL, rounds=60, patience=4))
    best, over = f.best_round(model.errors, 4)
    assert over and len(model.trees) == best and len(model.errors) == best + 4 < 60


def test_penalties_shrink_the_leaves(frame):
    plain = replace(SMALL, rounds=4, l1=0.0, l2=0.0)
    settings = replace(plain, l1=0.7, l2=3.0)
    rows = f.settle(f.with_target(frame).coalesce(1))
    own, free = f.fit_boosted(rows, NAMES, settings), f.fit_boosted(rows, NAMES, plain)
    assert own.trees[0] == free.trees[0] and own.trees[1].feature == free.trees[1].feature  # the level, and splits before any shrinking
    table = rows.where("NOT is_val").toPandas()
    so_far = np.zeros(len(table))
    for i, tree in enumerate(own.trees):
        alone = trees.TreeModel(own.inputs, [replace(tree, weight=1.0)])
        # the place of each row's leaf, in place of its value
        numbered = trees.TreeModel(own.inputs, [replace(tree, weight=1.0, value=[float(k) for k in range(len(tree.value))])])
        leaf = trees.Packed(numbered.inputs, numbered.trees).predict(table[NAMES].to_numpy()).astype(int)
        left = table["target"].to_numpy() - so_far
        for k in set(leaf.tolist()) if i else ():
            total, n = left[leaf == k].sum(), (leaf == k).sum()
            want = 2 * np.sign(total) * max(abs(total) - 0.7, 0) / (n + 3.0)
            assert tree.value[k] == pytest.approx(want, abs=1e-9)
        so_far += tree.weight * trees.Packed(alone.inputs, alone.trees).predict(table[NAMES].to_numpy())
    # the errors, read off the leaves' sums, are those of the trees so far
    for i in range(len(own.trees)):
        part = trees.TreeModel(own.inputs, own.trees[: i + 1]).transform(rows).where("is_val")
        assert part.agg(F.avg((F.col("target") - F.col("prediction")) ** 2)).first()[0] == pytest.approx(own.errors[i])


def test_a_penalised_leaf():
    assert replace(SMALL, l1=0.0, l2=0.0).leaf(6.0, 3) == 2.0
    heavy = replace(SMALL, l1=2.0, l2=1.0)
    assert heavy.leaf(6.0, 3) == 1.0 and heavy.leaf(-6.0, 3) == -1.0 and heavy.leaf(1.5, 3) == 0.0 and replace(SMALL, l1=0.0, l2=0.0).leaf(0.0, 0) == 0.0


def unordered(spark, count=400):
    """Only the set {1, 4, 6} of a code tells rows apart: a number needs several splits."""
    rows = [(i, float(i % 8), 5.0 if i % 8 in (1, 4, 6) else 1.0, False) for i in range(count)]
    return spark.createDataFrame(rows, "id int, key_code double, y double, is_val boolean")


def test_unordered_values_need_one_split(spark):
    df = unordered(spark)
    stump = replace(SMALL, rounds=1, depth=1, column_share="all")
    model = f.fit_boosted(df, ["key_code"], stump)
    assert sorted(model.trees[0].left_categories[0]) in ([1, 4, 6], [0, 2, 3, 5, 7, 8], [0, 2, 3, 5, 7])
    scored = f.predict(model, df)
    assert scored.where(F.abs(F.col("pred") - F.col("y")) > 1e-9).count() == 0
    plain = f.predict(f.fit_boosted(df, ["key_code"], replace(stump, nominal=())), df)
    assert plain.where(F.abs(F.col("pred") - F.col("y")) > 0.1).count() > 0
    # values never seen, and missing ones, are a category of their own
    odd = spark.createDataFrame([(99.0,), (None,), (1.0,)], "key_code double")
    other = [r["pred"] for r in f.predict(model, odd).collect()]
    assert other[0] == other[1] and other[2] == pytest.approx(5.0)


def test_very_many_values_are_a_number(spark):
    df = unordered(spark)
    assert set(trees.Inputs.of(df, ["key_code"], ["key_code"], most=8).values) == {"key_code"}
    few = trees.Inputs.of(df, ["key_code"], ["key_code"], most=7)
    assert few.values == {} and few.most_categories == 0
    wide = spark.range(900).selectExpr("CAST(id % 300 AS DOUBLE) AS key_code", "CAST(id % 3 AS DOUBLE) AS y", "false AS is_val")
    model = f.fit_boosted(wide, ["key_code"], replace(SMALL, rounds=1, column_share="all"))  # bins are as many as the values
    assert f.predict(model, wide).where(F.abs(F.col("pred") - F.col("y")) > 1e-6).count() == 0


def test_models_as_a_table(spark, frame, folder):
    two = frame.withColumn("key", F.when(F.col("id") % 3 == 0, "p").otherwise("q")).withColumn("key_code", F.col("id") % 4)
    names = [*NAMES, "key_code"]
    models = {k: f.fit_boosted(two.where(F.col("key") == k), names, replace(SMALL, rounds=3)) for k in "pq"}
    sinks.save_models(trees.model_table(spark, models), f"{folder}/models")
    table = sinks.load_models(spark, f"{folder}/models")
    rows = two.unionByName(two.limit(5).withColumn("key", F.lit("none"))).withColumn("b", F.when(F.col("id") % 9 != 0, F.col("b")))
    for part_rows in (1_000_000, 40):  # whole keys, and keys in parts
        scored = trees.score_by_key(rows, table, spread=["id"], part_rows=part_rows)
        assert scored.columns == [*rows.columns, "prediction"]
        got = {(r["key"], r["id"]): r["prediction"] for r in scored.collect()}
        assert len(got) == 505 and all(v is None for (k, _), v in got.items() if k == "none")
        for k, model in models.items():
            for r in model.transform(rows.where(F.col("key") == k)).collect():
                assert got[k, r["id"]] == pytest.approx(r["prediction"])
    assert trees.score_by_key(rows, table.limit(0), spread=["id"]).where("prediction IS NULL").count() == 505
    sinks.save_model(models["p"], f"{folder}/one")
    back = sinks.load_trees(spark, f"{folder}/one")
    assert back.inputs == models["p"].inputs and [t.feature for t in back.trees] == [t.feature for t in models["p"].trees]
    with pytest.raises(KeyError):
        trees.model_of(table, "none")


def test_split_counts_equal_a_count_by_hand(spark):
    inner = trees.Tree(1.0, [1, 0, -1, -1, 1, -1, -1], [0.0] * 7, [1, 2, -1, -1, 5, -1, -1], [4, 3, -1, -1, 6, -1, -1], [0.0] * 7, [[]] * 7, [0.5, 0.5, 0.0])
    leaf = trees.Tree(0.1, [-1], [0.0], [-1], [-1], [2.0], [[]], [0.0, 0.0, 0.0])
    model = trees.TreeModel(trees.Inputs(("a", "b", "c")), [inner, leaf, inner])
    found = [tuple(r) for r in f.feature_importance(model, NAMES).collect()]
    assert found == [("b", 4.0), ("a", 2.0), ("c", 0.0)]
    assert dict(tuple(r) for r in f.feature_importance(model, NAMES, by="gain").collect()) == {"a": pytest.approx(1 / 3), "b": pytest.approx(1 / 3), "c": 0}
