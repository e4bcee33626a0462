"""Look-ups of a series' past from the view of a request date."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seasonflow.functions.cleaning import mean
from seasonflow.operators.ordering import over_series
from seasonflow.session import settle
from seasonflow.spec import SeriesSpec

DAYS = (1, 7, 14)


def wanted_cells(requests: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Distinct (ds, series) asked for, so that a popular one is looked up once."""
    return requests.select(*spec.row_id).na.drop().distinct()


def _near(history: DataFrame, wanted: DataFrame, on: Sequence[str]) -> DataFrame:
    """Drops the history that no request can touch. The wanted cells are stored, so Spark knows their
    size in bytes and sends them to the history while they are small."""
    return history.join(settle(wanted.select(*on).distinct()), list(on), "left_semi")


def calendar_lookup(
    requests: DataFrame,
    history: DataFrame,
    days: Sequence[int] = DAYS,
    spec: SeriesSpec = SeriesSpec(),
) -> DataFrame:
    """Per distinct request cell: ``lag_<k>d`` on the exact date and ``has_<k>d``.

    A row that exists with a null value counts as present.
    """
    offsets = F.array(*[F.lit(k) for k in days])
    looked = wanted_cells(requests, spec).withColumn("_k", F.explode(offsets))
    looked = looked.withColumn("_at", F.date_sub(spec.ds, F.col("_k")))
    dates = looked.select(F.col("_at").alias(spec.ds), *spec.series)
    past = (
        _near(history.na.drop(subset=spec.row_id), dates, spec.row_id)
        .groupBy(F.col(spec.ds).alias("_at"), *spec.series)
        .agg(F.min(spec.y).alias("_y"), F.lit(True).alias("_has"))
    )
    found = looked.join(past, ["_at", *spec.series], "left")
    return found.groupBy(*spec.row_id).agg(
        *[F.max(F.when(F.col("_k") == k, F.col("_y"))).alias(f"lag_{k}d") for k in days],
        *[F.coalesce(F.bool_or((F.col("_k") == k) & F.col("_has")), F.lit(False)).alias(f"has_{k}d") for k in days],
    )


def history_stats(
    history: DataFrame, spec: SeriesSpec = SeriesSpec(), order: Sequence[str] = (), bounded: bool = False
) -> DataFrame:
    """State of every series at the end of every date that has a value.

    Counts and means of all values so far, and means and population deviation of
    the last 7 and 28 values. A table worth keeping: serving reads only this.
    """
    known = history.where(F.col(spec.y).isNotNull()).na.drop(subset=spec.row_id)

    def build(window: Window) -> dict[str, Column]:
        last7, last28 = window.rowsBetween(-6, 0), window.rowsBetween(-27, 0)
        return {
            "_m7": F.avg(spec.y).over(last7),
            "_m28": F.avg(spec.y).over(last28),
            "_s7": F.stddev_pop(spec.y).over(last7),
        }

    rows = over_series(known, spec.series, spec.ds, order, 27, build, bounded, position="_at")
    last = F.max_by(F.struct("_m7", "_m28", "_s7"), "_at")
    ends = rows.groupBy(*spec.row_id).agg(
        last.alias("_last"), F.count(F.lit(1)).alias("_rows"), F.sum(spec.y).alias("_sum")
    )
    upto = Window.partitionBy(*spec.series).orderBy(spec.ds).rowsBetween(Window.unboundedPreceding, 0)
    return ends.select(
        *spec.row_id,
        F.sum("_rows").over(upto).alias("n"),
        (F.sum("_sum").over(upto) / F.sum("_rows").over(upto)).alias("mean_all"),
        F.col("_last._m7").alias("mean_7"),
        F.col("_last._m28").alias("mean_28"),
        F.col("_last._s7").alias("std_7"),
    )


def asof_stats(
    requests: DataFrame, stats: DataFrame, spec: SeriesSpec = SeriesSpec()
) -> DataFrame:
    """Per distinct request cell, statistics of the values strictly before its date.

    Fewer than 3 (14) values: the mean of all; none: 0; deviation under 3 values: 0.
    Both sides hold at most one row per date, so a series stays as short as the calendar.
    """
    wanted = wanted_cells(requests, spec)
    near = _near(stats, wanted, spec.series)
    state = F.struct("n", "mean_all", "mean_7", "mean_28", "std_7")
    both = near.select(*spec.row_id, state.alias("_state"), F.lit(1).alias("_side")).unionByName(
        wanted.select(*spec.row_id, F.lit(0).alias("_side")), allowMissingColumns=True
    )
    before = (
        Window.partitionBy(*spec.series)
        .orderBy(spec.ds, "_side")  # a request comes before the history of its own date
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    seen = both.withColumn("_seen", F.last("_state", ignorenulls=True).over(before)).where("_side = 0")
    return _as_features(seen, spec)


def weekday_means(history: DataFrame, spec: SeriesSpec = SeriesSpec()) -> DataFrame:
    """Historical mean per (series, weekday); cells without a value are absent."""
    return (
        history.na.drop(subset=[*spec.row_id, spec.y])
        .groupBy(*spec.series, F.weekday(spec.ds).alias("weekday"))
        .agg(mean(spec.y).alias("weekday_mean"))
    )


# ------------------------------------------------------------------ a stored state, laid out by date


@dataclass(frozen=True)
class Dated:
    """What serving reads, a folder a month: ``history`` has one row for each cell; ``stats`` has the state of a
    series at the end of its dates, and in every month the state that the series brought into it.
    ``last_month`` is the month after the last one with a value."""

    history: DataFrame
    stats: DataFrame
    last_month: int


def _month(ds: Column) -> Column:
    return (F.year(ds) * 12 + F.month(ds) - 1).cast("int")


def lay_out(history: DataFrame, stats: DataFrame, path: str, spec: SeriesSpec = SeriesSpec()) -> Dated:
    """Writes history and the stats of :func:`history_stats` for look-ups that open only the folders of the months they ask for."""
    spark = history.sparkSession
    cells = history.na.drop(subset=spec.row_id).groupBy(*spec.row_id).agg(F.min(spec.y).alias(spec.y))
    cells = cells.select(*spec.row_id, spec.y, _month(F.col(spec.ds)).alias("month"))
    cells.repartitionByRange(*spec.row_id).sortWithinPartitions(*spec.row_id).write.mode("overwrite").partitionBy("month").parquet(f"{path}/history")
    state = F.struct("n", "mean_all", "mean_7", "mean_28", "std_7").alias("state")
    own = stats.select(*spec.series, spec.ds, state, F.lit(False).alias("carried"), _month(F.col(spec.ds)).alias("month"))
    last = own.agg(F.max("month")).first()[0]
    after = 0 if last is None else last + 1
    ends = own.groupBy(*spec.series, "month").agg(F.max_by("state", spec.ds).alias("state"))
    following = F.lead("month").over(Window.partitionBy(*spec.series).orderBy("month"))  # one row a month
    upto = ends.withColumn("upto", F.coalesce(following, F.lit(after)))
    months = F.explode(F.sequence(F.col("month") + 1, F.col("upto")))
    brought = upto.select(*spec.series, F.lit(None).cast("date").alias(spec.ds), "state", F.lit(True).alias("carried"), months.alias("month"))
    both = own.unionByName(brought)
    both.repartitionByRange("month", *spec.series).sortWithinPartitions("month", *spec.series).write.mode("overwrite").partitionBy("month").parquet(f"{path}/stats")
    read = lambda df, name: spark.read.schema(df.schema).parquet(f"{path}/{name}")
    return Dated(read(cells, "history"), read(both, "stats"), after)


def dated_lookup(requests: DataFrame, dated: Dated, days: Sequence[int] = DAYS, spec: SeriesSpec = SeriesSpec()) -> DataFrame:
    """:func:`calendar_lookup` on a laid-out history.

    The wanted cells are stored; while they are small they go to the history, whose scan opens only the folders of
    their months, and no row of it is shuffled but those that were asked for.
    """
    wanted = wanted_cells(requests, spec).select(*spec.row_id)
    looked = wanted.withColumn("_k", F.explode(F.array(*[F.lit(k) for k in days])))
    past = F.date_sub(spec.ds, F.col("_k"))
    asked = settle(looked.select(F.col(spec.ds).alias("_ds"), past.alias(spec.ds), *spec.series, "_k", _month(past).alias("month")))
    # a condition on the asked side tells Spark that it is worth pruning by
    hits = dated.history.join(asked.where(F.col("_k") >= min(days)), ["month", *spec.row_id])
    found = hits.select(F.col("_ds").alias(spec.ds), *spec.series, "_k", F.col(spec.y).alias("_y"), F.lit(True).alias("_has"))
    every = asked.where(F.col("_k") == days[0]).select(F.col("_ds").alias(spec.ds), *spec.series)
    both = found.unionByName(every, allowMissingColumns=True)
    return both.groupBy(*spec.row_id).agg(
        *[F.max(F.when(F.col("_k") == k, F.col("_y"))).alias(f"lag_{k}d") for k in days],
        *[F.coalesce(F.bool_or((F.col("_k") == k) & F.col("_has")), F.lit(False)).alias(f"has_{k}d") for k in days],
    )


def dated_stats(requests: DataFrame, dated: Dated, spec: SeriesSpec = SeriesSpec()) -> DataFrame:
    """:func:`asof_stats` on a laid-out state: a request meets its series' rows of one month, and what it brought into it."""
    wanted = wanted_cells(requests, spec).select(*spec.row_id)
    month = F.least(_month(F.col(spec.ds)), F.lit(dated.last_month))
    asked = settle(wanted.select(F.col(spec.ds).alias("_ds"), *spec.series, month.alias("month")))
    hits = dated.stats.join(asked.where(F.col("month") >= 0), ["month", *spec.series]).where(F.col("carried") | (F.col(spec.ds) < F.col("_ds")))
    order = F.struct(~F.col("carried"), F.col(spec.ds))
    found = hits.select(F.col("_ds").alias("_at"), *spec.series, "state", order.alias("order"))
    both = found.unionByName(asked.select(F.col("_ds").alias("_at"), *spec.series), allowMissingColumns=True)
    seen = both.groupBy("_at", *spec.series).agg(F.max_by("state", "order").alias("_seen")).withColumnRenamed("_at", spec.ds)
    return _as_features(seen, spec)


def _as_features(seen: DataFrame, spec: SeriesSpec) -> DataFrame:
    n = F.coalesce(F.col("_seen.n"), F.lit(0))
    whole = F.coalesce(F.col("_seen.mean_all"), F.lit(0.0))
    return seen.select(
        *spec.row_id,
        n.alias("n_before"),
        F.when(n >= 3, F.col("_seen.mean_7")).otherwise(whole).alias("rolling_7d"),
        F.when(n >= 14, F.col("_seen.mean_28")).otherwise(whole).alias("rolling_28d"),
        F.when(n >= 3, F.col("_seen.std_7")).otherwise(F.lit(0.0)).alias("rolling_7d_std"),
    )
