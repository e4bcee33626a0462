from datetime import date, timedelta

import pandas as pd
from pyspark.sql import functions as F

from seasonflow.functions.holidays import holiday_table
from seasonflow.operators import features, split
from seasonflow.spec import SeriesSpec

SPEC = SeriesSpec()


def series(spark, days, values, key="A", hour=5):
    start = date(2024, 1, 1)
    rows = [(start + timedelta(days=d), key, "k", hour, v) for d, v in zip(days, values)]
    return spark.createDataFrame(rows, "ds date, key string, kind string, hour int, y double")


def test_row_lag_is_not_a_calendar_lag(spark):
    df = series(spark, [0, 1, 3, 6, 7], [1.0, 2.0, None, 4.0, 5.0])
    df = features.add_calendar_lags(features.add_history(df, bounded=True))
    rows = df.orderBy("ds").collect()
    assert [r["lag_1d"] for r in rows] == [None, 1.0, 2.0, None, 4.0]
    assert [r["calendar_lag_1d"] for r in rows] == [None, 1.0, None, None, 4.0]
    assert rows[-1]["calendar_lag_7d"] == 1.0 and rows[-1]["lag_7d"] is None


def test_rolling_matches_pandas(spark):
    values = [float((i * 37) % 101) if i % 5 else None for i in range(60)]
    got = features.add_history(series(spark, range(60), values), bounded=True).orderBy("ds").toPandas()
    shifted = pd.Series(values, dtype=float).shift(1)
    expected = {
        "rolling_7d": shifted.rolling(7, min_periods=3).mean(),
        "rolling_28d": shifted.rolling(28, min_periods=14).mean(),
        "rolling_7d_std": shifted.rolling(7, min_periods=3).std(),
    }
    for name, column in expected.items():
        pd.testing.assert_series_equal(got[name], column, check_names=False)


def test_no_feature_sees_the_future(spark):
    values = [float(i) for i in range(50)]
    changed = values[:30] + [v * 9 for v in values[30:]]
    parts = [features.add_history(series(spark, range(50), v), block_rows=32).where("ds <= '2024-01-30'") for v in (values, changed)]
    assert parts[0].exceptAll(parts[1]).count() == 0


def test_zero_fill_only_where_never_operating(spark):
    df = series(spark, [0, 1], [None, 3.0], hour=5).union(series(spark, [0, 1], [None, None], hour=6))
    got = {(r["hour"], r["ds"].day): r["y"] for r in features.zero_fill(df).collect()}
    assert got == {(5, 1): None, (5, 2): 3.0, (6, 1): 0.0, (6, 2): 0.0}


def test_encoding_by_sorted_order(spark):
    df = spark.createDataFrame([("b", "y"), ("a", None), ("c", "x")], "key string, kind string")
    coded, keys, kinds = features.add_encoding(df, "x")
    got = {r["key"]: (r["key_code"], r["kind_code"], r["is_rail"]) for r in coded.collect()}
    assert got == {"a": (0, None, 0), "b": (1, 1, 0), "c": (2, 0, 1)}
    assert features.encoder_table(keys, kinds).count() == 5


def test_all_features_present(spark):
    df, _, _ = features.build_features(
        series(spark, range(20), [float(v) for v in range(20)]), holiday_table(spark, [2024]), "k", 2023
    )
    names = features.feature_columns(df)
    assert len(names) == 28 and features.NOT_REPORTED in names
    first = df.orderBy("ds").first()
    assert first["is_holiday"] == 1 and first["is_bridge"] == 1  # 1 January 2024 is a Monday
    assert first["weekday"] == 0 and first["iso_week"] == 1 and first["year_trend"] == 1
    ranked = features.correlations(df).collect()
    assert abs(ranked[0]["r"]) > 0.99 and "is_rail" not in {r["feature"] for r in ranked}  # constant
    counted = features.null_history(df).first()
    assert counted["rows"] == 20 and counted["rows_with_null"] == 14


def test_split_is_disjoint_and_whole(spark):
    df = features.add_history(series(spark, range(500), [float(v) for v in range(500)]), bounded=True)
    rows = split.temporal_split(df, "2025-01-01", "2025-12-31", "2024-11-01")
    report = {r["split"]: r for r in split.split_report(rows).collect()}
    assert sum(r["rows"] for r in report.values()) == split.usable(df).count()
    assert report["train"]["last"] == date(2024, 10, 31) and report["val"]["first"] == date(2024, 11, 1)
    assert report["test"]["first"] == date(2025, 1, 1)


def test_rows_after_the_test_period_can_be_kept_from_fits(spark):
    df = features.add_history(series(spark, range(500), [float(v) for v in range(500)]), bounded=True)
    last = split.usable(df).agg({"ds": "max"}).first()[0]
    until = str(last - timedelta(days=20))
    plain = split.temporal_split(df, str(last - timedelta(days=60)), until, str(last - timedelta(days=90)))
    apart = split.temporal_split(df, str(last - timedelta(days=60)), until, str(last - timedelta(days=90)), later="later")
    rows = {r["split"]: r for r in split.split_report(apart).collect()}
    assert rows["later"]["rows"] == 20 and rows["later"]["first"] == last - timedelta(days=19)
    assert split.learned_from(apart).where("ds > '%s'" % until).isEmpty()
    assert split.learned_from(plain).count() == rows["train"]["rows"] + rows["val"]["rows"] + 20


def test_positional_tail_may_cut_inside_a_day(spark):
    rows = [(date(2024, 1, 1) + timedelta(days=d), k, h) for d in range(11) for k in "abc" for h in (4, 5)]
    df = spark.createDataFrame(rows, "ds date, key string, hour int")
    folds = [("f1", "2024-01-01", "2024-01-09", "2024-01-10", "2024-01-11"), ("f2", "2024-01-02", "2024-01-11", "2024-01-12", "2024-01-13")]
    got = split.tail_split(df, folds)
    for name, first, last, _, _ in folds:
        inside = sorted(r for r in rows if first <= r[0].isoformat() <= last)
        cut = int(len(inside) * 0.8)
        val = {(r["ds"], r["key"], r["hour"]) for r in got.where(F.col("fold") == name).where("is_val").collect()}
        assert val == set(inside[cut:])


def test_small_folds_and_keys_are_marked(spark):
    df = series(spark, range(40), [1.0] * 40)
    folds = [("f1", "2024-01-01", "2024-01-20", "2024-01-21", "2024-01-25"), ("f2", "2030-01-01", "2030-02-01", "2030-02-02", "2030-02-03")]
    sizes = {r["fold"]: r for r in split.fold_sizes(df, folds, 20, 5).collect()}
    assert sizes["f1"]["kept"] and (sizes["f1"]["train_rows"], sizes["f1"]["test_rows"]) == (20, 5)
    assert not sizes["f2"]["kept"] and sizes["f2"]["train_rows"] == 0
    marked = df.withColumn("split", F.when(F.col("ds") > "2024-02-01", "val").otherwise("train"))
    assert not split.key_sizes(marked).first()["kept"]
