"""Forecasts of the seasonal mean and the errors of several forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from seasonflow.catalog.base import METRICS, PREDICTIONS, SPLIT, history, holidays, predictions, query, rounded, scored_rows
from seasonflow.catalog.features import FOLD_CTE
from seasonflow.operators import baseline, evaluate, features, split
from seasonflow.sources import tables
from seasonflow.sources.tables import RETAIL

P = f"WITH {PREDICTIONS}"


# ------------------------------------------------------------------ seasonal mean


@query(P + " SELECT ds, key, hour, y, round(base, 7) AS pred FROM scored")
def baseline_forecast(spark, folder):
    return rounded(scored_rows(spark, folder).select("ds", "key", "hour", "y", "pred"), 7, "pred")


@query(
    f"""WITH {SPLIT} SELECT key, hour, CAST(weekday AS INTEGER) AS weekday, round(avg(y), 7) AS cell_mean
FROM usable WHERE split <> 'test' GROUP BY 1, 2, 3"""
)
def seasonal_means(spark, folder):
    rows = split.temporal_split(history(spark, folder), RETAIL.test_from, RETAIL.test_until, RETAIL.val_from)
    return rounded(baseline.seasonal_means(rows.where("split <> 'test'")), 7, "cell_mean")


@query(P + " SELECT round(avg(m), 7) AS level FROM means")
def fallback_level(spark, folder):
    rows = split.temporal_split(history(spark, folder), RETAIL.test_from, RETAIL.test_until, RETAIL.val_from)
    return rounded(baseline.SeasonalMean().fit(rows.where("split <> 'test'")).level(), 7, "level")


@query(P + f" SELECT key, {METRICS} FROM preds WHERE model = 'Baseline' GROUP BY key")
def baseline_metrics_by_key(spark, folder):
    preds = evaluate.prediction_rows(scored_rows(spark, folder), "Baseline")
    return evaluate.metrics_by(preds, ["key"])


@query(P + " SELECT ds, key, hour, model, round(abs_err, 7) AS abs_err, round(greatest(real - pred, 0), 7) AS shortfall FROM preds")
def absolute_errors(spark, folder):
    preds = predictions(spark, folder).withColumn("shortfall", baseline.clip(F.col("real") - F.col("pred")))
    return rounded(preds.select("ds", "key", "hour", "model", "abs_err", "shortfall"), 7, "abs_err", "shortfall")


@query(P + " SELECT model, count(*) AS rows, min(ds) AS first, max(ds) AS last FROM preds GROUP BY model")
def stacked_predictions(spark, folder):
    scored = scored_rows(spark, folder)
    frames = [
        evaluate.prediction_rows(scored, "Baseline"),
        evaluate.prediction_rows(scored.withColumn("pred", F.col("lag_7d")), "Lag7"),
        evaluate.prediction_rows(scored.withColumn("pred", F.col("rolling_7d")), "Roll7"),
    ]
    return evaluate.stack(frames).groupBy("model").agg(
        F.count(F.lit(1)).alias("rows"), F.min("ds").alias("first"), F.max("ds").alias("last")
    )


# ------------------------------------------------------------------ slices


@query(P + f" SELECT model, {METRICS} FROM preds GROUP BY model")
def metrics_by_model(spark, folder):
    return evaluate.metrics_by(predictions(spark, folder))


@query(
    P
    + " "
    + " UNION ALL ".join(
        f"SELECT model, '{t}' AS slice_type, {v} AS slice_value, {METRICS} FROM preds {w} GROUP BY model{g}"
        for t, v, w, g in (
            ("global", "'all'", "", ""),
            ("key", "key", "", ", key"),
            ("kind", "kind", "WHERE kind IS NOT NULL", ", kind"),
            ("hour", "CAST(hour AS VARCHAR)", "", ", hour"),
            ("is_holiday", "CAST(is_holiday AS VARCHAR)", "", ", is_holiday"),
        )
    )
)
def metrics_by_slice(spark, folder):
    return evaluate.metric_slices(predictions(spark, folder))


_EXACT = f"""{P}, g AS (SELECT model, avg(abs_err) AS mae, sqrt(avg((real - pred) * (real - pred))) AS rmse FROM preds GROUP BY model),
base AS (SELECT mae AS bm, rmse AS br FROM g WHERE model = 'Baseline'),
gains AS (SELECT model, round_even((bm - mae) / bm * 100, 2) AS mae_gain_pct, round_even((br - rmse) / br * 100, 2) AS rmse_gain_pct FROM g, base),
m AS (SELECT model, is_holiday, key, real, pred FROM preds)"""


@query(
    f"""{_EXACT}
SELECT x.model, 'global' AS slice_type, 'all' AS slice_value, mae, rmse, r2, n, mae_gain_pct, rmse_gain_pct
FROM (SELECT model, {METRICS} FROM m GROUP BY model) x JOIN gains USING (model)
UNION ALL SELECT model, 'key', key, mae, rmse, NULL, NULL, NULL, NULL FROM (SELECT model, key, {METRICS} FROM m GROUP BY model, key)
UNION ALL SELECT model, 'holiday', CASE is_holiday WHEN 1 THEN 'holiday' ELSE 'normal' END, mae, rmse, NULL, n, NULL, NULL
FROM (SELECT model, is_holiday, {METRICS} FROM m GROUP BY model, is_holiday) WHERE n >= 5"""
)
def metrics_document(spark, folder):
    flagged = features.add_holidays(
        features.add_calendar(tables.line_long(spark, folder), trend_base=RETAIL.trend_base), holidays(spark)
    )
    preds = predictions(spark, folder).drop("is_holiday", "kind")
    return evaluate.metrics_document(preds, flagged)


@query(
    P
    + f""" SELECT model, CASE is_holiday WHEN 1 THEN 'holiday' ELSE 'normal' END AS day_type, {METRICS},
  count(DISTINCT ds) AS days FROM preds GROUP BY model, is_holiday HAVING count(*) >= 5"""
)
def holiday_split_metrics(spark, folder):
    return evaluate.holiday_split_metrics(predictions(spark, folder), holidays(spark))


_DAY = f"""{P}, normal AS (SELECT model, avg(real) AS nm FROM preds WHERE is_holiday = 0 GROUP BY model),
per AS (SELECT model, ds, holiday, avg(real) AS am, {METRICS} FROM preds WHERE is_holiday = 1 GROUP BY model, ds, holiday),
per_day AS (SELECT model, ds, holiday, mae, rmse, r2, round_even(am / nm * 100, 1) AS demand_pct,
  CASE WHEN am / nm * 100 >= 60 THEN 'active' ELSE 'quiet' END AS day_class FROM per JOIN normal USING (model))"""


@query(_DAY + " SELECT * FROM per_day")
def holiday_day_metrics(spark, folder):
    return evaluate.holiday_day_metrics(predictions(spark, folder), holidays(spark))


@query(_DAY + " SELECT model, day_class, round_even(avg(mae), 2) AS mae_mean, count(*) AS days FROM per_day GROUP BY model, day_class")
def holiday_class_metrics(spark, folder):
    return evaluate.holiday_class_metrics(evaluate.holiday_day_metrics(predictions(spark, folder), holidays(spark)))


# ------------------------------------------------------------------ comparisons

_MODEL = f"{P}, m AS (SELECT model, {METRICS} FROM preds GROUP BY model), b AS (SELECT mae AS bm, rmse AS br FROM m WHERE model = 'Baseline')"
_BY_KEY = f"{P}, k AS (SELECT model, key, {METRICS} FROM preds GROUP BY model, key)"


@query(
    _MODEL
    + """ SELECT model, mae, rmse, r2, n, round_even((bm - mae) / bm * 100, 2) AS mae_gain_pct,
  round_even((br - rmse) / br * 100, 2) AS rmse_gain_pct FROM m, b"""
)
def improvements(spark, folder):
    return evaluate.improvements(evaluate.metrics_by(predictions(spark, folder)))


@query(_BY_KEY + " SELECT model, round(avg(mae), 7) AS equal_weight_mae FROM k GROUP BY model")
def equal_weight_mae(spark, folder):
    found = evaluate.equal_weight_mae(evaluate.metrics_by(predictions(spark, folder), ["model", "key"]))
    return rounded(found, 7, "equal_weight_mae")


@query(
    _BY_KEY
    + """ SELECT a.key, a.mae AS baseline_mae, o.mae AS model_mae, round((a.mae - coalesce(o.mae, a.mae)) / a.mae * 100, 7) AS gain_pct
FROM k a LEFT JOIN k o ON o.key = a.key AND o.model = 'Roll7' WHERE a.model = 'Baseline'"""
)
def gain_by_key(spark, folder):
    by_key = evaluate.metrics_by(predictions(spark, folder), ["model", "key"])
    return rounded(evaluate.gain_by_key(by_key, "Roll7"), 7, "gain_pct")


@query(
    _MODEL
    + """, w AS (SELECT * FROM m WHERE model <> 'Baseline' ORDER BY mae, model LIMIT 1), bb AS (SELECT * FROM m WHERE model = 'Baseline')
SELECT 'mae' AS metric, w.model AS best_model, bb.mae AS baseline, w.mae AS best, round_even((bb.mae - w.mae) / bb.mae * 100, 2) AS gain_pct FROM w, bb
UNION ALL SELECT 'rmse', w.model, bb.rmse, w.rmse, round_even((bb.rmse - w.rmse) / bb.rmse * 100, 2) FROM w, bb
UNION ALL SELECT 'r2', w.model, bb.r2, w.r2, NULL FROM w, bb"""
)
def kpi_table(spark, folder):
    return evaluate.kpi_table(evaluate.metrics_by(predictions(spark, folder)))


@query(
    _MODEL
    + """ SELECT model, mae, rmse, r2, round_even((bm - mae) / bm * 100, 1) AS gain_pct, mae = (SELECT min(mae) FROM m) AS is_best FROM m, b"""
)
def comparison_table(spark, folder):
    return evaluate.comparison_table(evaluate.metrics_by(predictions(spark, folder)))


@query(
    f"""{_EXACT} SELECT x.model, mae, rmse, r2, n, mae_gain_pct, rmse_gain_pct
FROM (SELECT model, {METRICS} FROM m WHERE model IN ('Baseline', 'Roll7') GROUP BY model) x JOIN gains USING (model)"""
)
def metric_summary(spark, folder):
    flagged = features.add_holidays(
        features.add_calendar(tables.line_long(spark, folder), trend_base=RETAIL.trend_base), holidays(spark)
    )
    document = evaluate.metrics_document(predictions(spark, folder).drop("is_holiday", "kind"), flagged)
    return evaluate.metric_summary(document, ["Baseline", "Roll7"])


# ------------------------------------------------------------------ walk-forward

_FOLD = f"""WITH {SPLIT}, {FOLD_CTE},
fm AS (SELECT fold, key, hour, weekday, avg(y) AS m FROM usable JOIN folds ON ds BETWEEN train_first AND train_last GROUP BY 1, 2, 3, 4),
fl AS (SELECT fold, avg(m) AS level FROM fm GROUP BY fold),
ft AS (SELECT fold, ds, key, hour, weekday, y, rolling_7d FROM usable JOIN folds ON ds BETWEEN test_first AND test_last),
fp AS (SELECT ft.*, greatest(coalesce(fm.m, fl.level), 0) AS pred FROM ft LEFT JOIN fm USING (fold, key, hour, weekday) JOIN fl USING (fold))"""


def _folds(spark, folder):
    return baseline.fold_forecasts(split.usable(history(spark, folder)), RETAIL.folds)


@query(_FOLD + " SELECT fold, ds, key, hour, y, round(pred, 7) AS pred FROM fp")
def walk_forward_forecasts(spark, folder):
    return rounded(_folds(spark, folder).select("fold", "ds", "key", "hour", "y", "pred"), 7, "pred")


_FOLD_MAE = (
    _FOLD
    + """, fmae AS (SELECT fold, 'Baseline' AS model, avg(abs(y - pred)) AS mae FROM fp GROUP BY fold
UNION ALL SELECT fold, 'Roll7', avg(abs(y - rolling_7d)) FROM fp GROUP BY fold)"""
)


def _fold_mae(spark, folder):
    each = F.array(
        F.struct(F.lit("Baseline").alias("model"), F.col("pred").alias("p")),
        F.struct(F.lit("Roll7").alias("model"), F.col("rolling_7d").alias("p")),
    )
    rows = _folds(spark, folder).select("fold", "y", F.inline(each))
    return rows.groupBy("fold", "model").agg(F.avg(F.abs(F.col("y") - F.col("p"))).alias("mae"))


@query(_FOLD_MAE + " SELECT fold, model, round(mae, 7) AS mae FROM fmae")
def walk_forward_mae(spark, folder):
    return rounded(_fold_mae(spark, folder), 7, "mae")


@query(
    _FOLD_MAE
    + """ SELECT f.model, count(*) AS folds, round(avg(f.mae), 7) AS mae_mean, round(stddev_pop(f.mae), 7) AS mae_std,
  round(stddev_pop(f.mae) / avg(f.mae) * 100, 7) AS cv_pct, count(*) FILTER (WHERE f.mae < b.mae) AS wins,
  stddev_pop(f.mae) / avg(f.mae) * 100 < 15 AS stable
FROM fmae f JOIN fmae b ON b.fold = f.fold AND b.model = 'Baseline' GROUP BY f.model"""
)
def walk_forward_summary(spark, folder):
    return rounded(evaluate.cv_summary(_fold_mae(spark, folder)), 7, "mae_mean", "mae_std", "cv_pct")
