"""Rounds grown from binned rows: draws and candidates of Spark's learner, chunks against one table, jobs of a round."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from seasonflow.operators import growing
from seasonflow.plans import forecasters as f

NAMES = ["a", "b", "c", "weekday"]
SMALL = replace(f.LIGHTGBM, rounds=5, depth=4, step=0.3, least_leaf=20)


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(900):
        a, b, c = (float(round(v, 3)) for v in rng.normal(size=3))
        day = int(rng.integers(7))
        rows.append((i, a, b, None if i % 11 == 0 else c, day, float(np.exp(1 + 0.5 * a + abs(b) + (day in (1, 4))) + rng.random()), i % 6 == 0))
    return spark.createDataFrame(rows, "id int, a double, b double, c double, weekday int, y double, is_val boolean").persist()


def test_a_round_is_one_job(spark, frame):
    """Before, a round was a fit of its own: a dozen jobs and more."""
    jobs, context = [], spark.sparkContext
    for rounds in (4, 14):
        context.setJobGroup(f"rounds-{rounds}", "")
        f.fit_boosted(frame, NAMES, replace(SMALL, rounds=rounds))
        jobs.append(len(context.statusTracker().getJobIdsForGroup(f"rounds-{rounds}")))
    context.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[1] - jobs[0] <= 10


def test_draws_are_those_of_the_library(spark):
    for seed in (0, 43, -7_000_000_001):
        theirs = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed)
        np.testing.assert_array_equal(growing.uniforms(seed, 700), [theirs.nextDouble() for _ in range(700)])
    assert growing.uniforms(3, 0).tolist() == []
    assert growing.Draws(1, 4, 4).of_a_node() == [0, 1, 2, 3]
    draws = growing.Draws(1, 9, 3)
    many = [draws.of_a_node() for _ in range(300)]
    assert all(len(set(d)) == 3 for d in many) and set(sum(many, [])) == set(range(9))
    assert [growing.columns_kept(s, 10) for s in ("all", "auto", "sqrt", "onethird", "0.71", "1.0", "3", "30")] == [10, 10, 4, 4, 8, 10, 3, 10]
    with pytest.raises(ValueError):
        growing.columns_kept("1.5", 10)


def test_candidates_are_nearest_to_equal_counts():
    rng = np.random.default_rng(2)
    for splits, size in ((1, 5), (7, 40), (7, 8), (15, 400)):
        for most in (2, 30):
            values, counts = np.arange(size) / 4, rng.integers(1, most, size)
            found, target = [], counts.sum() / (splits + 1)
            so_far = counts[0]
            for i in range(1, size):
                before, so_far = so_far, so_far + counts[i]
                if abs(before - target) < abs(so_far - target):
                    found.append((values[i - 1] + values[i]) / 2)
                    target += counts.sum() / (splits + 1)
            want = found if size - 1 > splits else (values[:-1] + values[1:]) / 2
            np.testing.assert_array_equal(growing.candidates(values, counts, splits), want)


def test_thinned_values_stand_for_all():
    values, counts = np.arange(10_000) / 3, np.full(10_000, 2)
    few, n = growing.thinned(values, counts, 500)
    assert len(few) == 500 and n.sum() == 20_000 and n.max() == 40 and few[-1] == values[-1]
    heavy, n = growing.thinned(np.arange(6.0), np.array([1, 1, 1000, 1, 1, 1]), 3)
    assert n.sum() == 1005 and 2.0 in heavy


@pytest.mark.parametrize("settings", [SMALL, replace(SMALL, l1=0.0, l2=0.0, column_share="0.5")])
def test_chunks_give_the_trees_of_one_table(frame, settings, monkeypatch):
    monkeypatch.setattr(f, "TASK_ROWS", 120)
    monkeypatch.setattr(growing, "STORED_EVERY", 2)
    whole = f.fit_boosted(frame, NAMES, settings)
    monkeypatch.setattr(growing, "CHUNK_ROWS", 240)
    parted = f.fit_boosted(frame, NAMES, settings)
    again = f.fit_boosted(frame, NAMES, settings)
    assert again.trees == parted.trees and again.errors == parted.errors
    for have, tree in zip(parted.trees, whole.trees, strict=True):
        assert (have.feature, have.threshold, have.left_categories) == (tree.feature, tree.threshold, tree.left_categories)
        np.testing.assert_allclose(have.value, tree.value, rtol=1e-9, atol=1e-12)
        np.testing.assert_allclose(have.gain, tree.gain, rtol=1e-6, atol=1e-12)
    np.testing.assert_allclose(parted.errors, whole.errors)
    # the errors are those of the trees
    scored = whole.transform(f.with_target(frame)).where("is_val")
    assert scored.agg(F.avg((F.col("target") - F.col("prediction")) ** 2)).first()[0] == pytest.approx(min(whole.errors))


def test_rows_dealt_to_chunks_of_their_own_draws(frame, monkeypatch):
    monkeypatch.setattr(f, "TASK_ROWS", 120)
    monkeypatch.setattr(growing, "CHUNK_ROWS", 240)
    model = f.fit_boosted(frame, NAMES, replace(SMALL, row_share=0.7))
    assert len(model.errors) == 5 and model.errors[-1] < model.errors[0]


def test_odd_rows(spark, frame):
    with pytest.raises(ValueError):
        f.fit_boosted(frame.withColumn("is_val", F.lit(True)), NAMES, SMALL)
    with pytest.raises(Exception, match="not finite"):
        f.fit_boosted(frame.withColumn("y", F.lit(None).cast("double")), NAMES, SMALL)
    # a nominal column without a value, one value only, and a constant target
    flat = frame.withColumn("weekday", F.lit(None).cast("int")).withColumn("a", F.lit(1.0)).withColumn("y", F.lit(3.0))
    model = f.fit_boosted(flat, ["weekday", "a"], replace(SMALL, rounds=2))
    assert [t.feature for t in model.trees] == [[-1]] * len(model.trees)
    assert f.predict(model, flat).where(F.abs(F.col("pred") - 3) > 1e-9).count() == 0
    unknown = frame.withColumn("y", F.when(~F.col("is_val") | (F.col("id") % 12 == 0), F.col("y")))
    assert len(f.fit_boosted(unknown, NAMES, SMALL).errors) == 5
