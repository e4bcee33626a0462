"""Fitted forecasters, their evaluation and live scoring.

Queries here fit on every usable row before the test period, with the settings of the library. The featured
rows, and the models that several queries read, are stored once for each session and folder. Walk-forward,
search and verdict fit many boosters: they ask for fewer rounds, as the README says.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonflow.catalog.base import SPLIT, holidays, query
from seasonflow.catalog.features import featured
from seasonflow.catalog.serving import serving_state
from seasonflow.operators import evaluate, features, split, trees
from seasonflow.operators.baseline import SeasonalMean
from seasonflow.plans import forecasters as f
from seasonflow.plans import reports, scoring
from seasonflow.session import scratch_path, settle
from seasonflow.sources import readers, sinks, tables
from seasonflow.sources.tables import RETAIL
from seasonflow.streaming.scoring import score_stream

LIGHT, XGB, PER_KEY = f.LIGHTGBM, f.XGBOOST, f.LIGHTGBM_PER_KEY
#: For queries that fit many boosters.
SHORT = {"rounds": 8, "depth": 5, "step": 0.2}

_stored: dict[tuple[str, str, str], Any] = {}


def _once(spark, folder: str, name: str, make: Callable[[], Any]) -> Any:
    """What is read by several queries is made once for each session and folder."""
    place = (spark.sparkContext.applicationId, folder, name)
    if place not in _stored:
        _stored[place] = make()
    return _stored[place]


def _rows(spark, folder) -> tuple[DataFrame, list[str]]:
    """Featured rows with their split, stored once, and the feature list."""

    def make():
        rows = split.temporal_split(featured(spark, folder), RETAIL.test_from, RETAIL.test_until, RETAIL.val_from)
        return settle(rows), [c for c in features.feature_columns(rows) if c != "split"]

    return _once(spark, folder, "rows", make)


def _boosted(spark, folder, name: str, settings: f.Boosting) -> trees.TreeModel:
    rows, names = _rows(spark, folder)
    return _once(spark, folder, name, lambda: f.fit_boosted(_marked(rows), names, settings))


def _per_key(spark, folder) -> DataFrame:
    rows, names = _rows(spark, folder)
    return _once(spark, folder, "per-key", lambda: f.fit_per_key(rows, names, PER_KEY, threads=8))


def _mean(rows: DataFrame) -> DataFrame:
    return SeasonalMean().fit(_train(rows)).transform(_test(rows))


def _train(rows: DataFrame) -> DataFrame:
    return rows.where("split <> 'test'")


def _marked(rows: DataFrame) -> DataFrame:
    return _train(rows).withColumn("is_val", F.col("split") == "val")


def _test(rows: DataFrame) -> DataFrame:
    return rows.where("split = 'test'")


@query()
def ridge_forecast(spark, folder):
    rows, names = _rows(spark, folder)
    return evaluate.prediction_rows(f.predict(f.fit_ridge(_train(rows), names), _test(rows)), "RidgeBaseline")


@query()
def forest_forecast(spark, folder):
    rows, names = _rows(spark, folder)
    model = f.fit_forest(_train(rows), names)
    return evaluate.prediction_rows(f.predict(model, _test(rows)), "RandomForest")


@query()
def boosted_forecast(spark, folder):
    rows, _ = _rows(spark, folder)
    return evaluate.prediction_rows(f.predict(_boosted(spark, folder, "light", LIGHT), _test(rows)), "LightGBM")


@query()
def boosted_tuned_forecast(spark, folder):
    rows, _ = _rows(spark, folder)
    return evaluate.prediction_rows(f.predict(_boosted(spark, folder, "tuned", XGB), _test(rows)), "XGBoost")


@query()
def per_key_forecast(spark, folder):
    rows, _ = _rows(spark, folder)
    return evaluate.prediction_rows(f.predict_per_key(_per_key(spark, folder), _test(rows), _mean(rows)), "LGB_PerLinea")


@query()
def per_key_ridge_forecast(spark, folder):
    rows, names = _rows(spark, folder)
    weights = settle(f.fit_ridge_per_key(_train(rows), names))
    return evaluate.prediction_rows(f.predict_ridge_per_key(_test(rows), weights, names, _mean(rows)), "RidgePerKey")


@query()
def model_comparison(spark, folder):
    """Metrics of the learners side by side, with their gain over the seasonal mean."""
    rows, names = _rows(spark, folder)
    test = _test(rows)
    frames = [
        evaluate.prediction_rows(_mean(rows), "Baseline"),
        evaluate.prediction_rows(f.predict(f.fit_ridge(_train(rows), names), test), "RidgeBaseline"),
        evaluate.prediction_rows(f.predict(_boosted(spark, folder, "light", LIGHT), test), "LightGBM"),
    ]
    return evaluate.improvements(settle(evaluate.metrics_by(evaluate.stack(frames))))


@query()
def feature_importance(spark, folder):
    """Splits of the stored trees, counted by feature, and written as CSV."""
    _, names = _rows(spark, folder)
    found = f.feature_importance(_boosted(spark, folder, "light", LIGHT), names)
    path = scratch_path(spark, "importance")
    sinks.write_csv(found, path)
    back = spark.read.option("header", True).schema(found.schema).csv(path)
    return reports.top_features(back)


@query()
def feature_ablation(spark, folder):
    rows, names = _rows(spark, folder)
    return f.ablation(rows, names, LIGHT, "day_of_year", lambda: _boosted(spark, folder, "light", LIGHT))


@query()
def walk_forward_boosted(spark, folder):
    rows, names = _rows(spark, folder)
    found = settle(f.walk_forward(rows.drop("split"), RETAIL.folds, names, replace(LIGHT, **SHORT)))
    return evaluate.cv_summary(found)


@query()
def hyperparameter_search(spark, folder):
    rows, names = _rows(spark, folder)
    space = f.SearchSpace(depth=(3, 5), rounds=(2, 4))
    return f.search(rows.drop("split"), RETAIL.folds[2:], names, space, trials=3)[0]


@query()
def tuning_verdict(spark, folder):
    rows, names = _rows(spark, folder)
    slow = replace(f.XGBOOST_DEFAULT, rounds=8, depth=5)
    return f.verdict(rows, holidays(spark), names, slow, replace(XGB, **SHORT))


@query()
def saved_model_scores(spark, folder):
    """A model, and one model per key, that were saved and loaded again."""
    rows, names = _rows(spark, folder)
    root = scratch_path(spark, "models")
    sinks.save_model(f.fit_ridge(_train(rows), names), f"{root}/ridge")
    whole = f.predict(sinks.load_model(f"{root}/ridge"), _test(rows))
    sinks.save_models(_per_key(spark, folder), f"{root}/per-key")
    per_key = f.predict_per_key(sinks.load_models(spark, f"{root}/per-key"), _test(rows), _mean(rows))
    return evaluate.metrics_by(
        evaluate.stack([evaluate.prediction_rows(whole, "Ridge"), evaluate.prediction_rows(per_key, "PerKey")])
    )


def _live_model(spark, folder):
    return _boosted(spark, folder, "light", LIGHT)


@query()
def live_scores(spark, folder):
    """Every valid request scored from features built for its date."""
    state = serving_state(spark, folder, laid_out=True)
    valid = scoring.accepted(scoring.validate(tables.order_requests(spark, folder), state.keys))
    return scoring.score_requests(valid, state, _live_model(spark, folder))


@query()
def streamed_scores(spark, folder):
    """The same scores, with the requests read as a stream of files."""
    asked, answers = scratch_path(spark, "requests"), scratch_path(spark, "answers")
    tables.order_requests(spark, folder).write.parquet(asked)
    stream = spark.readStream.schema(readers.REQUESTS).parquet(asked)
    running = score_stream(
        stream, serving_state(spark, folder, laid_out=True), _live_model(spark, folder), answers, scratch_path(spark, "offsets")
    )
    running.awaitTermination()
    return spark.read.parquet(f"{answers}/scored").drop("batch")


@query(
    f"WITH {SPLIT} SELECT ds, key, hour, y AS real, CAST(5 AS BIGINT) AS learners, true AS sound FROM usable WHERE split = 'test'"
)
def forecasts_of_all_learners(spark, folder):
    """What SQL can say of every learner's forecasts: its rows and values, errors that are the distance of
    forecast and value, and no forecast missing or below 0."""
    rows, names = _rows(spark, folder)
    test = _test(rows)
    per_key, light, tuned = f.together(
        lambda: _per_key(spark, folder), lambda: _boosted(spark, folder, "light", LIGHT), lambda: _boosted(spark, folder, "tuned", XGB)
    )
    frames = {
        "ridge": f.predict(f.fit_ridge(_train(rows), names), test),
        "light": f.predict(light, test),
        "tuned": f.predict(tuned, test),
        "per_key": f.predict_per_key(per_key, test, _mean(rows)),
        "ridge_per_key": f.predict_ridge_per_key(test, f.fit_ridge_per_key(_train(rows), names), names, _mean(rows)),
    }
    each = evaluate.stack([evaluate.prediction_rows(df, name) for name, df in frames.items()])
    sound = (F.col("pred") >= 0) & (F.abs(F.abs(F.col("real") - F.col("pred")) - F.col("abs_err")) < 1e-6)
    return each.groupBy("ds", "key", "hour", "real").agg(F.countDistinct("model").alias("learners"), F.bool_and(F.coalesce(sound, F.lit(False))).alias("sound"))
