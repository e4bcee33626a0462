"""Answering requests: validation, look-up of stored predictions, live features."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonflow.functions import calendar, cleaning
from seasonflow.operators import asof
from seasonflow.operators.baseline import clip
from seasonflow.operators.trees import TreeModel
from seasonflow.session import settle
from seasonflow.spec import SeriesSpec

SPEC = SeriesSpec()


def lines(trusted: DataFrame) -> DataFrame:
    """Distinct (key, kind) with the number of pairs."""
    pairs = trusted.select("key", "kind").distinct()
    return pairs.withColumn("total", pairs.agg(F.count(F.lit(1))).scalar()).orderBy("key", "kind")


def validate(requests: DataFrame, keys: DataFrame) -> DataFrame:
    """Adds ``key, ds, hour, error`` to requests of ``line, date, hour`` text.

    ``keys`` is ``value, code``; ``error`` is null for a valid request.
    """
    known = keys.select(F.col("value").alias("key"), cleaning.match_key(F.col("value")).alias("_match"))
    known = known.groupBy("_match").agg(F.min("key").alias("key"))
    checked = requests.withColumnsRenamed({"hour": "_hour"}).withColumns(
        {
            "_match": cleaning.match_key(F.col("line")),
            "ds": F.try_to_date(F.trim("date"), "yyyy-MM-dd"),
            "hour": F.col("_hour").try_cast("int"),
        }
    )
    error = (
        F.when(F.col("hour").isNull() | ~F.col("hour").between(0, 23), "bad_hour")
        .when(F.col("ds").isNull(), "bad_date")
        .when(F.col("key").isNull(), "unknown_key")
    )
    return checked.join(known, "_match", "left").withColumn("error", error).drop("_match", "_hour")


def accepted(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("error").isNull()).drop("error")


def rejected(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("error").isNotNull())


def lookup(requests: DataFrame, preds: DataFrame, model_order: Sequence[str]) -> DataFrame:
    """Stored predictions for ``request_id, line, date, hour, model`` requests.

    A null or empty model takes the first one in ``model_order``. Unmatched requests
    stay, with ``status`` telling why. Predictions meet once per (key, ds, hour), as
    a short array with one entry per model: of repeated ones the first by its values.
    """
    rank = F.coalesce(F.array_position(F.array(*[F.lit(m) for m in model_order]), F.trim("model")), F.lit(0))
    rank = F.when(rank == 0, len(model_order) + 1).otherwise(rank)
    entry = F.struct(
        rank.alias("rank"), F.trim("model").alias("model"), "pred", "real", "abs_err", F.col("key").alias("line")
    )
    stored = (
        preds.withColumn("_match", cleaning.match_key(F.col("key")))
        .groupBy("_match", F.col("ds").alias("_ds"), F.col("hour").alias("_h"), F.trim("model").alias("_m"))
        .agg(F.min(entry).alias("_one"))
        .groupBy("_match", "_ds", "_h")
        .agg(F.array_sort(F.collect_list("_one")).alias("_all"))
    )
    asked = requests.select(
        "request_id",
        "line",
        cleaning.match_key(F.col("line")).alias("_match"),
        F.try_to_date(F.trim("date"), "yyyy-MM-dd").alias("_ds"),
        F.col("hour").try_cast("int").alias("_h"),
        F.nullif(F.trim("model"), F.lit("")).alias("_model"),
    )
    fits = F.filter("_all", lambda e: F.col("_model").isNull() | (e["model"] == F.col("_model")))
    hit = asked.join(stored, ["_match", "_ds", "_h"], "left").withColumn("_hit", F.get(fits, F.lit(0)))
    status = (
        F.when(F.col("_h").isNull() | ~F.col("_h").between(0, 23), "bad_hour")
        .when(F.col("_ds").isNull(), "bad_date")
        .when(F.col("_hit").isNull(), "not_found")
        .otherwise("ok")
    )
    return hit.select(
        "request_id",
        F.coalesce(F.col("_hit.line"), F.col("line")).alias("line"),
        F.col("_ds").alias("ds"),
        F.col("_h").alias("hour"),
        cleaning.half_even(F.col("_hit.pred"), 2).alias("pred"),
        cleaning.half_even(F.col("_hit.real"), 2).alias("real"),
        cleaning.half_even(F.col("_hit.abs_err"), 2).alias("abs_err"),
        F.col("_hit.model").alias("model"),
        status.alias("status"),
    )


@dataclass(frozen=True)
class ServingState:
    """Tables that serving reads; each is worth writing once and reloading.

    ``history`` ds, key, hour, y · ``stats`` from :func:`asof.history_stats` ·
    ``means`` from :func:`asof.weekday_means` · ``lines`` key, kind ·
    ``keys`` and ``kinds`` label codes · ``holidays`` · ``dated`` history and stats laid out by
    date (:func:`asof.lay_out`), which are read instead of the first two where they are given.
    """

    history: DataFrame
    stats: DataFrame
    means: DataFrame
    lines: DataFrame
    keys: DataFrame
    kinds: DataFrame
    holidays: DataFrame
    rail_kind: str
    trend_base: int
    dated: asof.Dated | None = None


def request_features(
    requests: DataFrame, state: ServingState, fill_present_nulls: bool = False
) -> DataFrame:
    """All features of validated requests (``key, ds, hour`` present), one row each."""
    return requests.join(cell_features(requests, state, fill_present_nulls), SPEC.row_id, "left")


def cell_features(requests: DataFrame, state: ServingState, fill_present_nulls: bool = False) -> DataFrame:
    """The features of each distinct (ds, key, hour) that validated requests ask for.

    A lag whose row is absent takes the weekday mean of its series, or 0. A row that
    is present but null stays null unless ``fill_present_nulls``.
    """
    if state.dated is None:
        lags, rolling = asof.calendar_lookup(requests, state.history), asof.asof_stats(requests, state.stats)
    else:
        lags, rolling = asof.dated_lookup(requests, state.dated), asof.dated_stats(requests, state.dated)
    weekday = F.weekday("ds")
    cells = (
        lags.join(rolling, SPEC.row_id)
        .withColumn("weekday", weekday)
        .join(state.means, [*SPEC.series, "weekday"], "left")
    )
    fallback = F.coalesce("weekday_mean", F.lit(0.0))
    filled = {}
    for k in asof.DAYS:
        absent = ~F.col(f"has_{k}d") | (F.lit(fill_present_nulls) & F.col(f"lag_{k}d").isNull())
        filled[f"lag_{k}d"] = F.when(absent, fallback).otherwise(F.col(f"lag_{k}d"))
    present = F.lit(True)
    for k in asof.DAYS:
        present = present & F.col(f"has_{k}d")
    cells = cells.withColumns({**filled, "lags_available": present}).drop(
        "weekday_mean", *[f"has_{k}d" for k in asof.DAYS]
    )
    named = state.lines.groupBy("key").agg(F.min("kind").alias("kind"))
    flags = state.holidays.select("ds", F.lit(1).alias("_is"), "is_bridge")
    dated = (
        cells.drop("weekday")
        .withColumns({"hour_of_day": F.col("hour").cast("int"), **calendar.date_parts(F.col("ds"), state.trend_base)})
        .join(F.broadcast(flags), "ds", "left")  # years x rules rows
        .withColumn("is_holiday", F.coalesce("_is", F.lit(0)))
        .withColumn("is_bridge", F.coalesce("is_bridge", F.lit(0)))
        .drop("_is")
        .join(named, "key", "left")
    )
    keys = state.keys.select(F.col("value").alias("key"), F.col("code").alias("key_code"))
    kinds = state.kinds.select(F.col("value").alias("kind"), F.col("code").alias("kind_code"))
    coded = (
        dated.join(keys, "key", "left")
        .join(kinds, "kind", "left")
        .withColumn("kind_code", F.coalesce("kind_code", F.lit(0)))
        .withColumn("is_rail", F.coalesce((F.col("kind") == state.rail_kind).cast("int"), F.lit(0)))
    )
    hour, day, month = F.col("hour_of_day"), F.col("weekday"), F.col("month")
    return coded.withColumns({**calendar.cyclic(hour, day, month), **calendar.interactions(hour, day)})


def score_requests(requests: DataFrame, state: ServingState, model: PipelineModel | TreeModel, name: str = "LightGBM") -> DataFrame:
    """:func:`live_scores` of validated requests. Requests of one cell have one answer, so the model walks each
    distinct cell once, however many requests ask for it."""
    cells = settle(model.transform(cell_features(requests, state)).select(*SPEC.row_id, "lags_available", "prediction"))
    return _answers(requests.join(cells, SPEC.row_id, "left"), name)


def live_scores(features: DataFrame, model: PipelineModel | TreeModel, name: str = "LightGBM") -> DataFrame:
    """Predictions in the original scale for a model trained on log1p."""
    return _answers(model.transform(features), name)


def _answers(scored: DataFrame, name: str) -> DataFrame:
    return scored.select(
        "request_id",
        cleaning.match_key(F.col("line")).alias("line"),
        "ds",
        "hour",
        cleaning.half_even(clip(F.expm1("prediction")), 1).alias("pred"),
        F.lit(name).alias("model"),
        F.lit("live").alias("source"),
        "lags_available",
    )
