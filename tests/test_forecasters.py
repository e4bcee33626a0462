import threading
from dataclasses import replace
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from seasonflow.operators import evaluate, split, trees
from seasonflow.plans import forecasters as f

NAMES = ["key_code", "kind_code", "a", "b"]
SMALL = replace(f.LIGHTGBM, rounds=8, depth=3, step=0.3, least_leaf=2)


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(7)
    out = []
    for i in range(900):
        key = "xyz"[i % 3]
        a, b = float(rng.normal()), float(rng.normal())
        y = float(np.expm1(np.clip(2 + 0.8 * a - 0.3 * b + {"x": 0, "y": 1, "z": 2}[key] + rng.normal(0, 0.05), 0, None)))
        day = date(2024, 1, 1) + timedelta(days=i // 3)
        part = "train" if i < 600 else "val" if i < 720 else "test"
        out.append((day, key, 4, "xyz".index(key), 0 if key == "x" else 1, a, None if i % 50 == 0 else b, y, part))
    schema = "ds date, key string, hour int, key_code int, kind_code int, a double, b double, y double, split string"
    return spark.createDataFrame(out, schema).persist()


def train(rows):
    return rows.where("split <> 'test'")


def marked(rows):
    return train(rows).withColumn("is_val", F.col("split") == "val")


def test_ridge_equals_the_closed_form(rows):
    alpha = 5.0
    model = f.fit_ridge(train(rows), NAMES, alpha)
    pdf = train(rows).toPandas()
    x = pdf[["a", "b"]].to_numpy()
    median = np.nanmedian(x[:, 1])
    x[np.isnan(x[:, 1]), 1] = median
    scale = x.std(axis=0)
    numbers = (x - x.mean(axis=0)) / scale
    hot = np.column_stack([pdf["key_code"] == c for c in range(3)] + [pdf["kind_code"] == c for c in range(2)]).astype(float)
    design = np.column_stack([numbers, hot])
    target = np.log1p(pdf["y"].to_numpy())
    centred, mean = design - design.mean(axis=0), target.mean()
    weights = np.linalg.solve(centred.T @ centred + alpha * np.eye(design.shape[1]), centred.T @ (target - mean))
    fitted = model.stages[-1]
    have = fitted.coefficients.toArray()
    np.testing.assert_allclose(have[:2], weights[:2], rtol=2e-3)
    want = mean + centred @ weights
    got = model.transform(train(rows)).orderBy("ds", "key").select("prediction").toPandas()["prediction"].to_numpy()
    np.testing.assert_allclose(np.sort(got), np.sort(want), atol=5e-3)


def test_unknown_category_still_predicts(rows):
    model = f.fit_ridge(train(rows), NAMES)
    odd = rows.limit(1).withColumn("key_code", F.lit(99)).withColumn("kind_code", F.lit(None).cast("int"))
    assert f.predict(model, odd).first()["pred"] >= 0


def test_boosting_beats_the_mean_and_repeats_itself(rows):
    test = rows.where("split = 'test'")
    first = f.predict(f.fit_boosted(marked(rows), NAMES, SMALL), test)
    again = f.predict(f.fit_boosted(marked(rows), NAMES, SMALL), test)
    assert first.where(F.col("pred").isNull() | F.isnan("pred") | (F.col("pred") < 0)).count() == 0
    left, right = (x.orderBy("ds", "key").toPandas()["pred"].to_numpy() for x in (first, again))
    np.testing.assert_allclose(left, right)
    mean = train(rows).agg(F.avg("y")).first()[0]
    mae = evaluate.metrics_by(evaluate.prediction_rows(first, "m")).first()["mae"]
    flat = test.agg(F.avg(F.abs(F.col("y") - mean))).first()[0]
    assert mae < 0.7 * flat


def test_best_round_waits_for_patience():
    dips = [5.0, 4.0, 4.2, 4.1, 4.3, 3.0, 3.0, 3.5]
    assert f.best_round(dips, 5) == (6, False)
    assert f.best_round(dips, 3) == (2, True)
    assert f.best_round([1.0, 1.0, 1.0], 2) == (1, True)
    assert f.best_round([], 3) == (0, False)


def test_patience_outlasts_flat_rounds(rows):
    """Stumps with small steps gain less than 0.1 % a round, and still sum up."""
    slow = replace(SMALL, rounds=30, step=0.0005, depth=1, patience=10)
    test, mae = rows.where("split = 'test'"), {}
    for name, settings in (("slow", slow), ("hasty", replace(slow, rounds=1))):
        model = f.fit_boosted(marked(rows), NAMES, settings)
        assert len(model.trees) == settings.rounds
        mae[name] = f.predict(model, test).agg(F.avg(F.abs(F.col("y") - F.col("pred")))).first()[0]
    assert mae["slow"] < mae["hasty"]


def test_trees_after_the_best_round_are_dropped(rows):
    """Validation rows that contradict the others: every round after the first does harm."""
    opposite = F.expm1(F.greatest(6 - F.log1p("y"), F.lit(0.0)))
    odd = marked(rows).withColumn("y", F.when(F.col("is_val"), opposite).otherwise(F.col("y")))
    model = f.fit_boosted(odd, NAMES, replace(SMALL, rounds=12, patience=4))
    assert len(model.trees) == 1 and len(model.errors) == 5
    plain = f.fit_boosted(odd.where("NOT is_val"), NAMES, replace(SMALL, rounds=1))
    test = rows.where("split = 'test'")
    left, right = (f.predict(m, test).orderBy("ds", "key").toPandas()["pred"].to_numpy() for m in (model, plain))
    np.testing.assert_allclose(left, right, rtol=1e-6)


def test_forest_and_importance(rows):
    model = f.fit_forest(train(rows), NAMES, trees=5, depth=5)
    importance = f.feature_importance(model, NAMES, by="gain").collect()
    assert {r["feature"] for r in importance} == set(NAMES)
    assert sum(r["importance"] for r in importance) == pytest.approx(1.0)
    assert importance[0]["importance"] == max(r["importance"] for r in importance)


def test_one_model_per_key(rows):
    few = rows.where("key <> 'z' or split = 'test'")
    models = f.fit_per_key(few, NAMES, replace(SMALL, rounds=2))
    assert {r["key"] for r in models.collect()} == {"x", "y"}
    test = rows.where("split = 'test'")
    scored = f.predict_per_key(models, test)
    assert scored.count() == test.count()
    assert scored.where("key = 'z' and pred <> 0").count() == 0
    fallback = test.select("ds", "key", "hour", F.lit(3.0).alias("pred"))
    assert scored.columns == f.predict_per_key(models, test, fallback).columns
    assert f.predict_per_key(models, test, fallback).where("key = 'z' and pred <> 3").count() == 0


def test_ridge_for_any_number_of_keys(rows):
    names, alpha = ["a", "b", "flat", "void"], 2.0
    table = train(rows).withColumn("flat", F.lit(3.0)).withColumn("void", F.lit(None).cast("double"))
    found = {r["key"]: r for r in f.fit_ridge_per_key(table, names, alpha, held=2).collect()}
    pdf = train(rows).toPandas()
    for key, part in pdf.groupby("key"):
        x, y = part[["a", "b"]].to_numpy(), np.log1p(part["y"].to_numpy())
        median = found[key]["medians"]
        assert abs((x[:, 1] < median[1]).sum() - (x[:, 1] > median[1]).sum()) <= 1
        x = np.where(np.isnan(x), median[:2], x)
        scale = x.std(axis=0)
        centred = (x - x.mean(axis=0)) / scale
        slope = np.linalg.solve(centred.T @ centred + alpha * np.eye(2), centred.T @ (y - y.mean())) / scale
        np.testing.assert_allclose(found[key]["weights"][1:3], slope, rtol=1e-8)
        assert found[key]["weights"][3:] == [0, 0] and median[2:] == [3, 0]
        assert found[key]["weights"][0] == pytest.approx(y.mean() - slope @ x.mean(axis=0))


def test_ridge_per_key_equals_ridge_on_one_key(rows):
    one = train(rows).where("key = 'y'")
    test = rows.where("split = 'test' and key = 'y'")
    whole = f.predict(f.fit_ridge(one, ["a", "b"], 2.0), test).orderBy("ds").toPandas()["pred"]
    weights = f.fit_ridge_per_key(one, ["a", "b"], 2.0)
    own = f.predict_ridge_per_key(test, weights, ["a", "b"]).orderBy("ds").toPandas()["pred"]
    np.testing.assert_allclose(own, whole, rtol=1e-5)
    plan = weights._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "FlatMapGroupsInPandas" not in plan


def test_ridge_per_key_fallback(rows):
    weights = f.fit_ridge_per_key(train(rows).where("key <> 'z'"), ["a", "b"])
    test = rows.where("split = 'test'")
    other = test.select("ds", "key", "hour", F.lit(3.0).alias("pred"))
    got = f.predict_ridge_per_key(test, weights, ["a", "b"], other)
    assert got.count() == test.count() and got.where("key = 'z' and pred <> 3").count() == 0
    assert f.predict_ridge_per_key(test, weights, ["a", "b"]).where("key = 'z' and pred <> 0").count() == 0


def test_walk_forward_and_search(rows):
    folds = [
        ("f1", "2024-01-01", "2024-04-30", "2024-05-01", "2024-06-30"),
        ("f2", "2024-01-01", "2024-06-30", "2024-07-01", "2024-08-31"),
        ("tiny", "2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"),
    ]
    df = rows.withColumn("weekday", F.weekday("ds"))
    found = f.walk_forward(df, folds, NAMES, replace(SMALL, rounds=2), least_train=50, least_test=20)
    got = {(r["fold"], r["model"]): r["mae"] for r in found.collect()}
    assert set(got) == {(x, m) for x in ("f1", "f2") for m in ("Baseline", "LightGBM")}
    space = f.SearchSpace(depth=(2, 3), rounds=(2, 3), least_leaf=(1, 5))
    table, best = f.search(df, folds, NAMES, space, trials=2, least_train=50, least_test=20)
    trials = table.collect()
    assert len(trials) == 4
    means = {t: np.mean([r["mae"] for r in trials if r["trial"] == t]) for t in (0, 1)}
    winner = next(r for r in trials if r["trial"] == min(means, key=means.get))
    assert best.depth == winner["depth"] and best.step == winner["step"]
    again, _ = f.search(df, folds, NAMES, space, trials=2, least_train=50, least_test=20)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, trials))
    with pytest.raises(ValueError):
        f.search(df, folds[2:], NAMES, space, trials=1)


def test_ablation_reports_the_change(rows):
    found = {r["model"]: r for r in f.ablation(rows, NAMES, SMALL, "a").collect()}
    assert found["full"]["mae_change"] == 0 and found["reduced"]["mae_change"] > 0
    assert split.key_sizes(rows).count() == 3


def test_models_of_an_ablation_are_fitted_side_by_side(rows, monkeypatch):
    both = threading.Barrier(2, timeout=60)
    leaf = trees.TreeModel(trees.Inputs(("b",)), [trees.Tree(1.0, [-1], [0.0], [-1], [-1], [2.0], [[]], [])])
    monkeypatch.setattr(f, "fit_boosted", lambda rows, names, settings: both.wait() and leaf or leaf)
    assert {r["model"] for r in f.ablation(rows, NAMES, SMALL, "a").collect()} == {"full", "reduced"}
    shared = lambda: both.wait() and leaf or leaf
    assert f.ablation(rows, NAMES, SMALL, "a", shared).count() == 2


def test_independent_fits_run_side_by_side():
    three = threading.Barrier(3, timeout=60)
    assert f.together(*[lambda i=i: (three.wait(), i)[1] for i in range(3)]) == [0, 1, 2]
    with pytest.raises(ZeroDivisionError):
        f.together(lambda: 1, lambda: 1 // 0)


def test_a_table_of_some_size_is_dealt_to_several_tasks(spark, monkeypatch):
    dealt = []
    original = f.in_order
    monkeypatch.setattr(f, "in_order", lambda df, parts, *a: dealt.append(parts) or original(df, parts, *a))
    wide = spark.range(48_000).selectExpr("CAST(id % 97 AS DOUBLE) AS a", "CAST(id % 5 AS DOUBLE) AS y", "false AS is_val")
    f.fit_boosted(wide, ["a"], replace(SMALL, rounds=1))
    assert dealt == [3]


def test_more_keys_than_any_pool(spark, monkeypatch):
    """A thousand models, scored in one plan."""
    rows = spark.range(1000 * 8).select(
        F.concat(F.lit("k"), F.col("id") % 1000).alias("key"), F.lit("train").alias("split"), F.lit(1.0).alias("y"),
        F.lit("2024-01-01").cast("date").alias("ds"), (F.col("id") % 7).cast("int").alias("hour"),
    )
    monkeypatch.setattr(f, "key_sizes", lambda split: split.groupBy("key").count().withColumn("kept", F.lit(True)))
    leaf = lambda v: trees.Tree(1.0, [0, -1, -1], [3.0, 0.0, 0.0], [1, -1, -1], [2, -1, -1], [0.0, v, v + 1], [[], [], []], [])
    monkeypatch.setattr(f, "fit_boosted", lambda rows, names, settings: trees.TreeModel(trees.Inputs(("hour",)), [leaf(1.0), leaf(0.5)]))
    monkeypatch.setattr(f, "STORED_MODELS", 250)
    models = f.fit_per_key(rows, ["hour"], None)
    assert models.select("key").distinct().count() == 1000 and models.count() == 2000
    scored = f.predict_per_key(models, rows)
    expected = {h: np.expm1(1.5 if h <= 3 else 3.5) for h in range(7)}
    got = scored.collect()
    assert len(got) == 8000 and all(r["pred"] == pytest.approx(expected[r["hour"]]) for r in got)
