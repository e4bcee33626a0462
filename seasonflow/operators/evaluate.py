"""Forecast errors over slices, from a long table of predictions.

A prediction row is ``ds, key, hour, real, pred, abs_err, model`` (and, where a
slice needs them, ``kind`` and ``is_holiday``). Rows are reduced once to mergeable
sums per cell; every slice is then a roll-up of cells.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seasonflow.functions.cleaning import half_even, per_cent
from seasonflow.session import settle

BASELINE = "Baseline"
LEAST_ROWS = 5
ACTIVE_FROM = 60.0


def prediction_rows(scored: DataFrame, model: str, keep: Sequence[str] = ()) -> DataFrame:
    """Scored rows in the long layout shared by all models."""
    return scored.select(
        "ds",
        "key",
        "hour",
        *keep,
        F.col("y").alias("real"),
        "pred",
        F.abs(F.col("y") - F.col("pred")).alias("abs_err"),
        F.lit(model).alias("model"),
    )


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame)
    return stacked


# ------------------------------------------------------------------ mergeable sums


def partial_sums() -> list[Column]:
    error = F.col("real") - F.col("pred")
    n = F.count(F.lit(1))
    return [
        n.alias("n"),
        F.sum(F.abs(error)).alias("sae"),
        F.sum(error * error).alias("sse"),
        F.sum("real").alias("sy"),
        (F.var_pop("real") * n).alias("m2"),
        F.min("real").alias("lo"),
        F.max("real").alias("hi"),
    ]


def merged_sums() -> list[Column]:
    between = F.sum(F.col("sy") * F.col("sy") / F.col("n")) - F.sum("sy") * F.sum("sy") / F.sum("n")
    return [
        F.sum("n").alias("n"),
        F.sum("sae").alias("sae"),
        F.sum("sse").alias("sse"),
        F.sum("sy").alias("sy"),
        (F.sum("m2") + between).alias("m2"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
    ]


def metric_columns(rounded: bool = True) -> dict[str, Column]:
    mae = F.col("sae") / F.col("n")
    rmse = F.sqrt(F.col("sse") / F.col("n"))
    constant = F.when(F.col("sse") == 0, 1.0).otherwise(0.0)
    r2 = F.when(F.col("n") < 2, F.lit(None)).when(F.col("lo") == F.col("hi"), constant).otherwise(1 - F.col("sse") / F.col("m2"))
    if rounded:
        return {"mae": half_even(mae, 2), "rmse": half_even(rmse, 2), "r2": half_even(r2, 4)}
    return {"mae": mae, "rmse": rmse, "r2": r2}


def scored_only(preds: DataFrame) -> DataFrame:
    return preds.na.drop(subset=["real", "pred"])


def cells(preds: DataFrame, by: Sequence[str]) -> DataFrame:
    return scored_only(preds).groupBy(*by).agg(*partial_sums())


# ------------------------------------------------------------------ slices


def metrics_by(preds: DataFrame, by: Sequence[str] = ("model",), rounded: bool = True) -> DataFrame:
    return cells(preds, by).withColumns(metric_columns(rounded)).select(*by, "mae", "rmse", "r2", "n")


def metric_slices(preds: DataFrame, slices: Sequence[str] = ("key", "kind", "hour", "is_holiday")) -> DataFrame:
    """All metrics of all models, overall and per value of every slice column.

    ``model, slice_type, slice_value, mae, rmse, r2, n``; one scan, and the
    grouping sets expand cells rather than rows.
    """
    sets = [["model"], *[["model", s] for s in slices]]
    rolled = (
        cells(preds, ["model", *slices])
        .groupingSets([[F.col(c) for c in s] for s in sets], "model", *slices)
        .agg(*merged_sums(), *[F.grouping(s).alias(f"_all_{s}") for s in slices])
    )
    kind, value = F.lit("global"), F.lit("all")
    present = F.lit(True)
    for s in slices:
        here = F.col(f"_all_{s}") == 0
        kind = F.when(here, s).otherwise(kind)
        value = F.when(here, F.col(s).cast("string")).otherwise(value)
        present = present & ~(here & F.col(s).isNull())
    return (
        rolled.where(present)
        .withColumns({"slice_type": kind, "slice_value": value})
        .withColumns(metric_columns())
        .select("model", "slice_type", "slice_value", "mae", "rmse", "r2", "n")
    )


def of_model(column: str, model: str) -> Column:
    """A model's value beside every row of a table of metrics, which has one row per model."""
    return F.max(F.when(F.col("model") == model, F.col(column))).over(Window.partitionBy())


def improvements(metrics: DataFrame, places: int = 2, baseline: str = BASELINE) -> DataFrame:
    """Per cent by which each model's MAE and RMSE improve on the baseline's."""
    base_mae, base_rmse = of_model("mae", baseline), of_model("rmse", baseline)
    return metrics.withColumn(
        "mae_gain_pct", half_even(per_cent(base_mae - F.col("mae"), base_mae), places)
    ).withColumn("rmse_gain_pct", half_even(per_cent(base_rmse - F.col("rmse"), base_rmse), places))


def metrics_document(preds: DataFrame, featured: DataFrame) -> DataFrame:
    """The stored metrics, rebuilt from stored predictions.

    Tidy rows: ``global`` (mae, rmse, r2, n, both gains), ``key`` (mae, rmse) and
    ``holiday`` (mae, rmse, n; at least five rows).
    """
    flags = featured.select("ds", "key", F.col("hour_of_day").alias("hour"), "is_holiday")
    flagged = preds.join(flags, ["ds", "key", "hour"], "left")
    rolled = (
        cells(flagged, ["model", "key", "is_holiday"])
        .groupingSets([[F.col("model")], [F.col("model"), F.col("key")], [F.col("model"), F.col("is_holiday")]], "model", "key", "is_holiday")
        .agg(*merged_sums(), F.grouping("key").alias("_k"), F.grouping("is_holiday").alias("_h"))
    )
    whole = (F.col("_k") == 1) & (F.col("_h") == 1)
    by_key = F.col("_k") == 0
    exact = rolled.withColumns(
        {
            "slice_type": F.when(whole, "global").when(by_key, "key").otherwise("holiday"),
            "slice_value": F.when(whole, "all")
            .when(by_key, F.col("key"))
            .otherwise(F.when(F.col("is_holiday") == 1, "holiday").when(F.col("is_holiday") == 0, "normal")),
            **metric_columns(rounded=False),
        }
    ).where(
        F.col("slice_value").isNotNull() & ((F.col("slice_type") != "holiday") | (F.col("n") >= LEAST_ROWS))
    )
    # some rows per model and key: stored, so that the gains do not run the predictions again
    exact = settle(exact.select("model", "slice_type", "slice_value", "mae", "rmse", "r2", "n"))
    top = exact.where("slice_type = 'global'").select("model", "mae", "rmse")
    gains = improvements(top).select("model", F.lit("global").alias("slice_type"), "mae_gain_pct", "rmse_gain_pct")
    glob = F.col("slice_type") == "global"
    return exact.join(gains, ["model", "slice_type"], "left").select(
        "model",
        "slice_type",
        "slice_value",
        half_even(F.col("mae"), 2).alias("mae"),
        half_even(F.col("rmse"), 2).alias("rmse"),
        F.when(glob, half_even(F.col("r2"), 4)).alias("r2"),
        F.when(F.col("slice_type") != "key", F.col("n")).alias("n"),
        "mae_gain_pct",
        "rmse_gain_pct",
    )


# ------------------------------------------------------------------ holidays


def by_date_with_holiday(preds: DataFrame, holidays: DataFrame) -> DataFrame:
    """Mergeable sums per (model, date), with the holiday name where there is one."""
    names = holidays.select("ds", "holiday")
    return cells(preds, ["model", "ds"]).join(F.broadcast(names), "ds", "left")  # years x rules rows


def holiday_split_metrics(preds: DataFrame, holidays: DataFrame) -> DataFrame:
    """Metrics of holiday and normal days; slices under five rows are left out."""
    rolled = (
        by_date_with_holiday(preds, holidays)
        .groupBy("model", F.when(F.col("holiday").isNotNull(), "holiday").otherwise("normal").alias("day_type"))
        .agg(*merged_sums(), F.count(F.lit(1)).alias("days"))
        .where(F.col("n") >= LEAST_ROWS)
    )
    return rolled.withColumns(metric_columns()).select("model", "day_type", "mae", "rmse", "r2", "n", "days")


def holiday_day_metrics(preds: DataFrame, holidays: DataFrame) -> DataFrame:
    """Metrics of every holiday and its demand against the mean normal hour."""
    dated = by_date_with_holiday(preds, holidays)
    normal = (
        dated.where(F.col("holiday").isNull())
        .groupBy("model")
        .agg((F.sum("sy") / F.sum("n")).alias("normal_mean"))
    )
    share = per_cent(F.col("sy") / F.col("n"), F.col("normal_mean"))
    return (
        dated.where(F.col("holiday").isNotNull())
        .join(normal, "model", "left")
        .withColumns(metric_columns())
        .withColumn("demand_pct", half_even(share, 1))
        .withColumn("day_class", F.when(share >= ACTIVE_FROM, "active").otherwise("quiet"))
        .select("model", "ds", "holiday", "mae", "rmse", "r2", "demand_pct", "day_class")
    )


def holiday_class_metrics(day_metrics: DataFrame) -> DataFrame:
    """Mean of the rounded per-day MAEs of quiet and of active holidays."""
    return day_metrics.groupBy("model", "day_class").agg(
        half_even(F.avg("mae"), 2).alias("mae_mean"), F.count(F.lit(1)).alias("days")
    )


# ------------------------------------------------------------------ comparisons


def equal_weight_mae(by_key: DataFrame) -> DataFrame:
    """Every key one vote: the mean over keys of the per-key MAE."""
    return by_key.groupBy("model").agg(F.avg("mae").alias("equal_weight_mae"))


def gain_by_key(by_key: DataFrame, model: str, baseline: str = BASELINE) -> DataFrame:
    """Per cent gain per key; a key without the model counts as 0 %."""
    base = by_key.where(F.col("model") == baseline).select("key", F.col("mae").alias("baseline_mae"))
    other = by_key.where(F.col("model") == model).select("key", F.col("mae").alias("model_mae"))
    gain = per_cent(F.col("baseline_mae") - F.coalesce("model_mae", "baseline_mae"), F.col("baseline_mae"))
    return base.join(other, "key", "left").withColumn("gain_pct", gain)


def best_model(metrics: DataFrame, baseline: str = BASELINE) -> DataFrame:
    """The non-baseline model with the least MAE; ties go to the first name."""
    return metrics.where(F.col("model") != baseline).agg(
        F.min_by("model", F.struct("mae", "model")).alias("model")
    )


def kpi_table(metrics: DataFrame, baseline: str = BASELINE) -> DataFrame:
    """``metric, baseline, best, gain_pct`` for MAE, RMSE and R2 of the best model."""
    rank = F.when(F.col("model") != baseline, F.struct("mae", "model"))
    winner = F.min(rank).over(Window.partitionBy())["model"]  # as best_model: one row per model
    gains = improvements(metrics).withColumn("_winner", winner)
    both = gains.where((F.col("model") == baseline) | (F.col("model") == F.col("_winner"))).withColumn(
        "side", F.when(F.col("model") == baseline, "baseline").otherwise("best")
    )
    tidy = both.select(
        "side",
        "model",
        F.inline(
            F.array(
                F.struct(F.lit("mae").alias("metric"), F.col("mae").alias("value"), F.col("mae_gain_pct").alias("gain")),
                F.struct(F.lit("rmse").alias("metric"), F.col("rmse").alias("value"), F.col("rmse_gain_pct").alias("gain")),
                F.struct(F.lit("r2").alias("metric"), F.col("r2").alias("value"), F.lit(None).cast("double").alias("gain")),
            )
        ),
    )
    best = F.col("side") == "best"
    return tidy.groupBy("metric").agg(
        F.max(F.when(best, F.col("model"))).alias("best_model"),
        F.max(F.when(~best, F.col("value"))).alias("baseline"),
        F.max(F.when(best, F.col("value"))).alias("best"),
        F.max(F.when(best, F.col("gain"))).alias("gain_pct"),
    )


def comparison_table(metrics: DataFrame, baseline: str = BASELINE) -> DataFrame:
    """Metrics of all models, gain to one place, and the least MAE marked."""
    base, least = of_model("mae", baseline), F.min("mae").over(Window.partitionBy())  # one row per model
    return metrics.select(
        "model",
        "mae",
        "rmse",
        "r2",
        half_even(per_cent(base - F.col("mae"), base), 1).alias("gain_pct"),
        (F.col("mae") == least).alias("is_best"),
    )


def metric_summary(document: DataFrame, models: Sequence[str]) -> DataFrame:
    """Global metrics of the named models."""
    return document.where((F.col("slice_type") == "global") & F.col("model").isin(*models)).select(
        "model", "mae", "rmse", "r2", "n", "mae_gain_pct", "rmse_gain_pct"
    )


def cv_summary(fold_mae: DataFrame, limit: float = 15.0) -> DataFrame:
    """Mean, population deviation and variation of the fold MAEs, and folds won.

    ``fold_mae`` is ``fold, model, mae``, one row per fold and model.
    """
    base = fold_mae.where(F.col("model") == BASELINE).select("fold", F.col("mae").alias("_base"))
    spread = per_cent(F.stddev_pop("mae"), F.avg("mae"))
    return (
        fold_mae.join(base, "fold", "left")
        .groupBy("model")
        .agg(
            F.count(F.lit(1)).alias("folds"),
            F.avg("mae").alias("mae_mean"),
            F.stddev_pop("mae").alias("mae_std"),
            spread.alias("cv_pct"),
            F.count_if(F.col("mae") < F.col("_base")).alias("wins"),
            (spread < limit).alias("stable"),
        )
    )


