"""Seasonal-mean forecaster: the mean of each (series, weekday) cell."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonflow.functions.cleaning import mean
from seasonflow.operators.split import Fold, fold_rows
from seasonflow.session import settle
from seasonflow.spec import SeriesSpec


def clip(value: Column) -> Column:
    return F.greatest(value, F.lit(0.0))


def seasonal_means(df: DataFrame, spec: SeriesSpec = SeriesSpec()) -> DataFrame:
    """Mean per (series, weekday); partial sums are combined before the shuffle."""
    return (
        df.na.drop(subset=spec.series)
        .groupBy(*spec.series, "weekday")
        .agg(mean(spec.y).alias("cell_mean"))
    )


@dataclass(frozen=True)
class SeasonalMeanModel:
    table: DataFrame
    spec: SeriesSpec

    def level(self) -> DataFrame:
        """Fallback for unseen cells: the unweighted mean of the cell means."""
        return self.table.agg(F.avg("cell_mean").alias("level"))

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``pred``, never negative.

        The table is stored, so its size is known: under the session's threshold it
        is broadcast, beyond it the join shuffles and large cells are split.
        """
        joined = df.join(self.table, [*self.spec.series, "weekday"], "left")
        pred = F.coalesce(F.col("cell_mean"), self.level().scalar())
        return joined.withColumn("pred", clip(pred)).drop("cell_mean")


@dataclass(frozen=True)
class SeasonalMean:
    spec: SeriesSpec = SeriesSpec()

    def fit(self, train: DataFrame) -> SeasonalMeanModel:
        return SeasonalMeanModel(settle(seasonal_means(train, self.spec)), self.spec)


def fold_means(df: DataFrame, folds: Sequence[Fold], spec: SeriesSpec = SeriesSpec()) -> DataFrame:
    """Seasonal means of every fold in one pass over the rows.

    Fold ends cut time into segments; rows are summed per (cell, segment) first,
    and only these sums are copied to the folds that contain the segment.
    """
    ends = sorted({end for f in folds for end in f[1:3]})
    segment = sum(
        (
            (F.col(spec.ds) >= F.lit(e).cast("date")).cast("int")
            + (F.col(spec.ds) > F.lit(e).cast("date")).cast("int")
            for e in ends
        ),
        F.lit(0),
    )
    sums = (
        df.groupBy(*spec.series, "weekday", segment.alias("_segment"))
        .agg(F.sum(spec.y).alias("_sum"), F.count(spec.y).alias("_n"), F.min(spec.ds).alias(spec.ds))
    )
    return (
        fold_rows(sums, folds, "train", spec.ds)
        .groupBy("fold", *spec.series, "weekday")
        .agg(F.try_divide(F.sum("_sum").cast("double"), F.sum("_n")).alias("cell_mean"))
    )


def fold_forecasts(df: DataFrame, folds: Sequence[Fold], spec: SeriesSpec = SeriesSpec()) -> DataFrame:
    """Test rows of every fold with the prediction of the fold's own means.

    The means are fitted, and stored, before the test rows meet them.
    """
    means = settle(fold_means(df, folds, spec))
    level = means.groupBy("fold").agg(F.avg("cell_mean").alias("_level"))
    return (
        fold_rows(df, folds, "test", spec.ds)
        .join(means, ["fold", *spec.series, "weekday"], "left")
        .join(F.broadcast(level), "fold", "left")  # one row per fold
        .withColumn("pred", clip(F.coalesce("cell_mean", "_level")))
        .drop("cell_mean", "_level")
    )
