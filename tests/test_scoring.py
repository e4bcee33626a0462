from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from seasonflow.functions.holidays import holiday_table
from seasonflow.operators import asof, features
from seasonflow.plans import scoring
from seasonflow.spec import SeriesSpec

REQUEST = "request_id long, line string, date string, hour string, model string"


def history(spark, seed=4):
    """Gaps, nulls, a short series, and the same key in two hours."""
    rng = np.random.default_rng(seed)
    rows = []
    for key, hour, days in (("Line A", 5, 80), ("Line A", 6, 80), ("Line B", 5, 2)):
        for d in range(days):
            if rng.random() < 0.7:
                y = None if rng.random() < 0.2 else float(rng.integers(0, 500))
                rows.append((date(2024, 1, 1) + timedelta(days=d), key, "rail", hour, y))
    return spark.createDataFrame(rows, "ds date, key string, kind string, hour int, y double"), rows


def direct(rows, key, hour, day):
    """The statistics of one request, by plain arithmetic."""
    past = sorted((r[0], r[4]) for r in rows if r[1] == key and r[3] == hour and r[0] < day and r[4] is not None)
    values = [y for _, y in past]
    whole = float(np.mean(values)) if values else 0.0
    lags = []
    for k in (1, 7, 14):
        hit = [r for r in rows if r[1] == key and r[3] == hour and r[0] == day - timedelta(days=k)]
        same = [r[4] for r in rows if r[1] == key and r[3] == hour and r[0].weekday() == day.weekday() and r[4] is not None]
        lags.append(hit[0][4] if hit else (float(np.mean(same)) if same else 0.0))
    return (
        *lags,
        float(np.mean(values[-7:])) if len(values) >= 3 else whole,
        float(np.mean(values[-28:])) if len(values) >= 14 else whole,
        float(np.std(values[-7:])) if len(values) >= 3 else 0.0,
    )


def state(spark, long, bounded):
    return scoring.ServingState(
        history=long,
        stats=asof.history_stats(long, order=[] if bounded else ["hour"], bounded=bounded),
        means=asof.weekday_means(long),
        lines=long.select("key", "kind").distinct(),
        keys=features.label_codes(long, "key"),
        kinds=features.label_codes(long, "kind"),
        holidays=holiday_table(spark, [2023, 2024]),
        rail_kind="rail",
        trend_base=2023,
    )


@pytest.mark.parametrize("bounded", [True, False])
def test_request_features_equal_direct_arithmetic(spark, bounded):
    long, rows = history(spark)
    days = [date(2023, 12, 30), *[date(2024, 1, 1) + timedelta(days=d) for d in range(0, 100, 3)]]
    asked = [(i, f" {k.lower()} ", d.isoformat(), str(h), None) for i, (k, h, d) in enumerate((k, h, d) for k, h in (("Line A", 5), ("Line A", 6), ("Line B", 5)) for d in days)]
    served = state(spark, long, bounded)
    valid = scoring.accepted(scoring.validate(spark.createDataFrame(asked, REQUEST), served.keys))
    got = scoring.request_features(valid, served).collect()
    assert len(got) == len(asked)
    for r in got:
        want = direct(rows, r["key"], r["hour"], r["ds"])
        have = (r["lag_1d"], r["lag_7d"], r["lag_14d"], r["rolling_7d"], r["rolling_28d"], r["rolling_7d_std"])
        assert have == pytest.approx(want, nan_ok=True) if None not in want else [
            h == w or (h is not None and h == pytest.approx(w)) for h, w in zip(have, want)
        ].count(False) == 0
        present = all(any(x[1] == r["key"] and x[3] == r["hour"] and x[0] == r["ds"] - timedelta(days=k) for x in rows) for k in (1, 7, 14))
        assert r["lags_available"] == present
    past = {f"lag_{k}d" for k in features.LAGS} | {name for name, *_ in features.ROLLING}
    dated = {"hour_of_day", "weekday", "month", "year", "year_trend", "day_of_year", "is_weekend", "iso_week", "is_holiday", "is_bridge"}
    waves = {f"{part}_{side}" for part in ("hour", "weekday", "month") for side in ("sin", "cos")}
    names = past | dated | waves | {"key_code", "kind_code", "is_rail", "hour_x_weekday", "is_morning_peak", "is_evening_peak"}
    assert names <= set(got[0].asDict())


@pytest.mark.parametrize("days", [range(0, 100, 3), [40]])
def test_dated_state_equals_the_plain_one(spark, folder, days):
    from dataclasses import replace

    long, rows = history(spark)
    plain = state(spark, long, True)
    laid = replace(plain, dated=asof.lay_out(long, plain.stats, f"{folder}/dated"))
    dates = [date(2023, 12, 30), date(2024, 8, 1), *[date(2024, 1, 1) + timedelta(days=d) for d in days]]
    asked = [(i, k, d.isoformat(), str(h), None) for i, (k, h, d) in enumerate((k, h, d) for k, h in (("line a", 5), ("line a", 6), ("line b", 5)) for d in dates)]
    valid = scoring.accepted(scoring.validate(spark.createDataFrame(asked, REQUEST), plain.keys))
    left, right = (sorted(map(tuple, scoring.request_features(valid, s).collect()), key=lambda r: r[0]) for s in (plain, laid))
    assert len(left) == len(asked)
    for a, b in zip(left, right):
        assert a == pytest.approx(b, nan_ok=True) if None not in a else [x == y or x == pytest.approx(y) for x, y in zip(a, b)].count(False) == 0


def pruned_scans(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_dated_state_opens_only_the_asked_folders(spark, folder):
    long, _ = history(spark)
    dated = asof.lay_out(long, asof.history_stats(long, bounded=True), f"{folder}/dated")
    asked = spark.createDataFrame([("Line A", date(2024, 2, 20), 5), ("Line A", date(2024, 2, 25), 5)], "key string, ds date, hour int")
    for found in (asof.dated_lookup(asked, dated), asof.dated_stats(asked, dated)):
        plan = pruned_scans(found)
        assert "dynamicpruning" in plan.lower() and "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        joined = plan[plan.index("BroadcastHashJoin") :].split("Union")[0]
        scan = joined[: joined.index("FileScan")] if "FileScan" in joined else joined
        assert "hashpartitioning" not in scan  # the stored rows meet the request where they are


def test_repeated_history_rows_all_count(spark):
    rows = [(date(2024, 1, d), "A", "k", 5, float(10 * d + i), i) for d in (1, 2, 3) for i in range(4)]
    long = spark.createDataFrame(rows, "ds date, key string, kind string, hour int, y double, i int")
    asked = spark.createDataFrame([(date(2024, 1, 3), "A", 5), (date(2024, 1, 9), "A", 5)], "ds date, key string, hour int")
    stats = asof.history_stats(long, order=["i"])
    got = {r["ds"].day: r for r in asof.asof_stats(asked, stats).collect()}
    values = [10.0 * d + i for d in (1, 2, 3) for i in range(4)]
    assert got[3]["n_before"] == 8 and got[3]["rolling_7d"] == pytest.approx(np.mean(values[1:8]))
    assert got[9]["n_before"] == 12 and got[9]["rolling_7d_std"] == pytest.approx(np.std(values[-7:]))


def test_validation_kinds(spark):
    long, _ = history(spark)
    keys = features.label_codes(long, "key")
    asked = [
        (1, "LINE A", "2024-01-05", "5", None),
        (2, "nowhere", "2024-01-05", "5", None),
        (3, "line a", "2024-13-05", "5", None),
        (4, "line a", "2024-01-05", "24", None),
        (5, "line a", "2024-01-05", "x", None),
    ]
    checked = scoring.validate(spark.createDataFrame(asked, REQUEST), keys)
    assert {r["request_id"]: r["error"] for r in checked.collect()} == {1: None, 2: "unknown_key", 3: "bad_date", 4: "bad_hour", 5: "bad_hour"}
    assert scoring.accepted(checked).first()["key"] == "Line A"
    assert scoring.rejected(checked).count() == 4


def test_lookup_of_stored_predictions(spark):
    day = date(2025, 3, 15)
    preds = spark.createDataFrame(
        [(day, "LÍNEA A", 17, 10.0, 12.345, 2.345, "XGBoost"), (day, "LÍNEA A", 17, 10.0, 11.0, 1.0, "Baseline")],
        "ds date, key string, hour int, real double, pred double, abs_err double, model string",
    )
    asked = [
        (1, " línea a", "2025-03-15", "17", "XGBoost "),
        (2, "LÍNEA A", "2025-03-15", "17", None),
        (3, "LÍNEA A", "2025-03-15", "17", "Ridge"),
        (4, "LÍNEA A", "15/03/2025", "17", None),
        (5, "LÍNEA A", "2025-03-15", "30", None),
        (6, "LÍNEA A", "2025-03-15", "17", ""),
    ]
    got = {r["request_id"]: r for r in scoring.lookup(spark.createDataFrame(asked, REQUEST), preds, ["Baseline", "XGBoost"]).collect()}
    assert got[1]["pred"] == 12.34 and got[1]["line"] == "LÍNEA A" and got[1]["status"] == "ok"
    assert got[2]["model"] == got[6]["model"] == "Baseline"
    assert [got[i]["status"] for i in (3, 4, 5)] == ["not_found", "bad_date", "bad_hour"]


def test_repeated_predictions_are_one(spark):
    day = date(2025, 3, 15)
    preds = spark.createDataFrame([(day, "A", 7, 1.0, float(v), 0.5, "m") for v in (3, 2, 2, 9)], "ds date, key string, hour int, real double, pred double, abs_err double, model string")
    asked = spark.createDataFrame([(1, "a", "2025-03-15", "7", None)], REQUEST)
    assert scoring.lookup(asked, preds, ["m"]).first()["pred"] == 2.0


def test_line_listing(spark):
    long, _ = history(spark)
    rows = scoring.lines(long).collect()
    assert [r["key"] for r in rows] == ["Line A", "Line B"] and rows[0]["total"] == 2


def test_present_nulls_may_be_filled(spark):
    rows = [(date(2024, 1, d), "A", "k", 5, None if d == 9 else 4.0) for d in range(1, 11)]
    long = spark.createDataFrame(rows, "ds date, key string, kind string, hour int, y double")
    served = state(spark, long, True)
    asked = spark.createDataFrame([(1, "A", date(2024, 1, 10), 5)], "request_id long, key string, ds date, hour int").withColumn("line", F.col("key"))
    kept = scoring.request_features(asked, served).first()
    filled = scoring.request_features(asked, served, fill_present_nulls=True).first()
    assert kept["lag_1d"] is None and filled["lag_1d"] == 4.0
    assert SeriesSpec().row_id == ["ds", "key", "hour"]


def test_requests_of_one_cell_are_scored_once(spark):
    """Popular cells: the model sees each cell once, and the answers are those of a row for each request."""
    long, _ = history(spark)
    served = state(spark, long, True)
    cells = [("Line A", 5, date(2024, 2, 20)), ("Line B", 5, date(2024, 2, 21)), ("Line A", 6, date(2030, 1, 1))]
    asked = [(i, f" {k.lower()} ", d.isoformat(), str(h), None) for i, (k, h, d) in enumerate(cells * 40)]
    valid = scoring.accepted(scoring.validate(spark.createDataFrame(asked, REQUEST), served.keys))
    seen = []

    class Model:
        def transform(self, df):
            seen.append(df.count())
            return df.withColumn("prediction", F.log1p(F.coalesce(F.col("lag_1d"), F.lit(0.0)) + F.col("rolling_7d") + F.col("key_code")))

    got = sorted(map(tuple, scoring.score_requests(valid, served, Model()).collect()))
    assert seen == [3] and len(got) == 120
    assert got == sorted(map(tuple, scoring.live_scores(scoring.request_features(valid, served), Model()).collect()))
