from datetime import date, timedelta

import numpy as np
import pytest

from seasonflow.operators import evaluate
from seasonflow.operators.baseline import SeasonalMean, fold_forecasts
from seasonflow.plans import reports
from seasonflow.functions.holidays import holiday_table

# Published errors per line of the seasonal mean and of the per-line booster.
BASELINE = [842.47, 172.69, 5360.26, 754.99, 47.46, 85.98, 123.35, 102.7, 77.53, 231.47, 150.3, 484.63]


def preds(spark, rows):
    return spark.createDataFrame(
        rows, "ds date, key string, kind string, hour int, is_holiday int, real double, pred double, model string"
    )


def random_preds(spark, n=400):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(n):
        day = date(2025, 1, 1) + timedelta(days=int(rng.integers(0, 40)))
        key = "abc"[int(rng.integers(0, 3))]
        real = float(rng.integers(0, 1000))
        for model in ("Baseline", "X"):
            rows.append((day, key, {"a": "t", "b": "t"}.get(key), int(rng.integers(4, 8)), int(i % 7 == 0), real, real + float(rng.normal(0, 50)), model))
    return preds(spark, rows)


def test_metrics_against_numpy_and_slices_sum_up(spark):
    df = random_preds(spark)
    pdf = df.toPandas()
    slices = evaluate.metric_slices(df).collect()
    for r in slices:
        part = pdf[pdf["model"] == r["model"]]
        if r["slice_type"] != "global":
            part = part[part[r["slice_type"]].astype(str) == r["slice_value"]]
        e = part["real"] - part["pred"]
        assert r["n"] == len(part)
        assert r["mae"] == pytest.approx(e.abs().mean(), abs=0.006)
        assert r["rmse"] == pytest.approx(np.sqrt((e**2).mean()), abs=0.006)
        assert r["r2"] == pytest.approx(1 - (e**2).sum() / ((part["real"] - part["real"].mean()) ** 2).sum(), abs=1e-4)
    keys = [r for r in slices if r["slice_type"] == "key" and r["model"] == "X"]
    whole = next(r for r in slices if r["slice_type"] == "global" and r["model"] == "X")
    assert sum(r["n"] for r in keys) == whole["n"]
    assert sum(r["n"] * r["mae"] for r in keys) / whole["n"] == pytest.approx(whole["mae"], abs=0.01)
    assert not any(r["slice_value"] is None for r in slices)


def test_constant_and_single_rows(spark):
    day = date(2025, 1, 2)
    rows = [(day, "a", "t", 4, 0, 5.0, 5.0, "exact")] * 2 + [(day, "a", "t", 4, 0, 5.0, 6.0, "off")] * 2
    rows += [(day, "a", "t", 4, 0, 5.0, 6.0, "one")]
    got = {r["model"]: r["r2"] for r in evaluate.metrics_by(preds(spark, rows)).collect()}
    assert got == {"exact": 1.0, "off": 0.0, "one": None}


def test_published_equal_weight_error(spark):
    by_key = spark.createDataFrame([("Baseline", f"l{i}", m) for i, m in enumerate(BASELINE)], "model string, key string, mae double")
    assert round(evaluate.equal_weight_mae(by_key).first()["equal_weight_mae"], 1) == 702.8


def test_published_gains_and_best_model(spark):
    metrics = spark.createDataFrame(
        [("Baseline", 774.83, 3309.41, 0.8982), ("LightGBM", 890.25, 3616.57, 0.8784), ("XGBoost", 839.28, 3416.01, 0.8915)],
        "model string, mae double, rmse double, r2 double",
    )
    assert evaluate.best_model(metrics).first()["model"] == "XGBoost"
    gains = {r["model"]: r["mae_gain_pct"] for r in evaluate.improvements(metrics).collect()}
    assert gains == {"Baseline": 0.0, "LightGBM": -14.9, "XGBoost": -8.32}
    kpis = {r["metric"]: r for r in evaluate.kpi_table(metrics).collect()}
    assert kpis["mae"]["best"] == 839.28 and kpis["r2"]["gain_pct"] is None
    assert [r["model"] for r in evaluate.comparison_table(metrics).where("is_best").collect()] == ["Baseline"]


def test_published_walk_forward_summary(spark):
    base, light = [446.2, 640.6, 420.2, 557.9], [500.5, 454.2, 362.1, 371.1]
    rows = [(f"f{i}", "Baseline", m) for i, m in enumerate(base)] + [(f"f{i}", "LightGBM", m) for i, m in enumerate(light)]
    got = {r["model"]: r for r in evaluate.cv_summary(spark.createDataFrame(rows, "fold string, model string, mae double")).collect()}
    assert round(got["LightGBM"]["cv_pct"], 1) == 13.7 and round(got["Baseline"]["cv_pct"], 1) == 17.1
    assert got["LightGBM"]["wins"] == 3 and got["LightGBM"]["stable"] and not got["Baseline"]["stable"]


def test_stored_metrics_equal_direct_ones(spark):
    df = random_preds(spark)
    flags = df.groupBy("ds", "key", "hour").agg({"is_holiday": "max"}).withColumnsRenamed({"max(is_holiday)": "is_holiday", "hour": "hour_of_day"})
    document = evaluate.metrics_document(df.drop("is_holiday", "kind"), flags)
    direct = {r["model"]: (r["mae"], r["rmse"], r["r2"], r["n"]) for r in evaluate.metrics_by(df).collect()}
    stored = {r["model"]: (r["mae"], r["rmse"], r["r2"], r["n"]) for r in document.where("slice_type = 'global'").collect()}
    assert stored == direct
    assert evaluate.metric_summary(document, ["X"]).count() == 1


def test_holiday_classes(spark):
    rows = []
    for day, level in ((date(2025, 1, 1), 20.0), (date(2025, 1, 6), 90.0), (date(2025, 1, 7), 100.0)):
        rows += [(day, "a", "t", h, 0, level, level + 3, m) for h in range(4, 12) for m in ("Baseline", "X")]
    df = preds(spark, rows)
    holidays = holiday_table(spark, [2025])
    days = evaluate.holiday_day_metrics(df, holidays)
    assert {(r["ds"].day, r["day_class"], r["demand_pct"]) for r in days.collect()} == {(1, "quiet", 20.0), (6, "active", 90.0)}
    assert {(r["day_class"], r["mae_mean"], r["days"]) for r in evaluate.holiday_class_metrics(days).where("model = 'X'").collect()} == {
        ("quiet", 3.0, 1),
        ("active", 3.0, 1),
    }
    split = {(r["model"], r["day_type"]): (r["n"], r["days"]) for r in evaluate.holiday_split_metrics(df, holidays).collect()}
    assert split["X", "holiday"] == (16, 2) and split["X", "normal"] == (8, 1)


def test_seasonal_mean_and_its_fallback(spark):
    rows = [("a", 4, 0, 10.0), ("a", 4, 0, 30.0), ("b", 4, 0, 2.0), ("b", 4, 0, None), ("b", 4, 1, -9.0)]
    train = spark.createDataFrame(rows, "key string, hour int, weekday int, y double")
    model = SeasonalMean().fit(train)
    asked = spark.createDataFrame([("a", 4, 0), ("z", 4, 0), ("b", 4, 1)], "key string, hour int, weekday int")
    got = {(r["key"], r["weekday"]): r["pred"] for r in model.transform(asked).collect()}
    assert got == {("a", 0): 20.0, ("z", 0): pytest.approx((20 + 2 - 9) / 3), ("b", 1): 0.0}


def test_fold_forecasts_equal_separate_fits(spark):
    rng = np.random.default_rng(2)
    rows = [
        (date(2024, 1, 1) + timedelta(days=d), k, 4, (date(2024, 1, 1) + timedelta(days=d)).weekday(), float(rng.integers(0, 99)))
        for d in range(120)
        for k in "ab"
    ]
    df = spark.createDataFrame(rows, "ds date, key string, hour int, weekday int, y double")
    folds = [
        ("f1", "2024-01-01", "2024-01-31", "2024-02-01", "2024-02-20"),
        ("f2", "2024-01-10", "2024-02-15", "2024-02-10", "2024-03-20"),
    ]
    got = fold_forecasts(df, folds)
    for name, a, b, c, d in folds:
        model = SeasonalMean().fit(df.where(f"ds between '{a}' and '{b}'"))
        want = model.transform(df.where(f"ds between '{c}' and '{d}'")).select("ds", "key", "pred")
        have = got.where(f"fold = '{name}'").select("ds", "key", "pred")
        joined = want.join(have.withColumnRenamed("pred", "p"), ["ds", "key"])
        assert joined.count() == want.count() == have.count()
        assert joined.where("abs(pred - p) > 1e-9").count() == 0


def test_reports_on_ties_and_absent_cells(spark):
    rows = [(date(2024, 1, 1), "b", 4, 0, 5.0), (date(2024, 1, 2), "a", 4, 1, 5.0), (date(2024, 1, 2), "a", 5, 1, None)]
    df = spark.createDataFrame(rows, "ds date, key string, hour_of_day int, weekday int, y double")
    assert [r["key"] for r in reports.top_keys(df, 1).collect()] == ["a"]
    grid = reports.heatmap(df, range(4, 7)).collect()
    assert len(grid) == 2 * 3 and sum(r["dow_0"] for r in grid) == 5.0 and sum(r["dow_3"] for r in grid) == 0.0
    single = spark.createDataFrame([("2024-01", 3.0)], "month string, total double")
    assert reports.linear_trend(single).first()["trend"] is None
    two = spark.createDataFrame([("2024-01", 3.0), ("2024-02", 5.0)], "month string, total double")
    assert [r["trend"] for r in reports.linear_trend(two).orderBy("month").collect()] == [3.0, 5.0]
