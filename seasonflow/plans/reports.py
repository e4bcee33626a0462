"""Report tables: demand, errors, holidays and trend."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seasonflow.functions.cleaning import half_even, per_cent
from seasonflow.operators.evaluate import ACTIVE_FROM, BASELINE, LEAST_ROWS
from seasonflow.operators.split import dates_between
from seasonflow.session import settle
from seasonflow.spec import SeriesSpec

SPEC = SeriesSpec()


def total(y: str):
    """Sum in which an all-missing group counts 0."""
    return F.coalesce(F.sum(y), F.lit(0.0))


# ------------------------------------------------------------------ demand


def heatmap(df: DataFrame, hours: Sequence[int], spec: SeriesSpec = SPEC) -> DataFrame:
    """Mean demand per (key, hour) with one column per weekday, absent cells 0.

    The full grid of hours comes from exploding a written list per key.
    """
    means = df.groupBy(spec.key, "hour_of_day").pivot("weekday", list(range(7))).agg(F.avg(spec.y))
    grid = df.select(spec.key).distinct().withColumn(
        "hour_of_day", F.explode(F.array(*[F.lit(int(h)) for h in hours]))
    )
    days = {f"dow_{d}": F.coalesce(F.col(f"`{d}`"), F.lit(0.0)) for d in range(7)}
    joined = grid.join(means, [spec.key, "hour_of_day"], "left")
    return joined.select(spec.key, "hour_of_day", *[c.alias(n) for n, c in days.items()])


def totals_by_key(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("key").agg((total("y") / 1e6).alias("millions")).orderBy("millions", "key")
    )


def top_keys(df: DataFrame, k: int = 3) -> DataFrame:
    """The keys of largest total demand; at most ``k`` rows."""
    return df.groupBy("key").agg(total("y").alias("total")).orderBy(F.desc("total"), "key").limit(k)


def daily_total(df: DataFrame) -> DataFrame:
    """System total per date and its trailing mean of seven dates.

    The window runs over one row per date, not over the demand rows.
    """
    trailing = Window.orderBy("ds").rowsBetween(-6, 0)
    days = df.where(F.col("ds").isNotNull()).groupBy("ds").agg(total("y").alias("total"))
    return days.withColumn("ma7", F.avg("total").over(trailing))


def annual_totals(df: DataFrame, months: tuple[int, int] = (1, 9)) -> DataFrame:
    """Totals of the months that all years have, with the change on the year before."""
    years = (
        df.where(F.month("ds").between(*months))
        .groupBy(F.year("ds").alias("year"))
        .agg((total("y") / 1e6).alias("millions"))
    )
    before = F.lag("millions").over(Window.orderBy("year"))  # one row per year
    return years.withColumn("change_pct", per_cent(F.col("millions") - before, before))


def monthly_totals(df: DataFrame, first: str | None = None, last: str | None = None, y: str = "real") -> DataFrame:
    """Totals of every month, or of those between two dates."""
    kept = df if first is None or last is None else df.where(dates_between(df, first, last))
    months = kept.where(F.col("ds").isNotNull()).groupBy(F.date_format("ds", "yyyy-MM").alias("month"))
    return months.agg(half_even(total(y), 0).alias("total"))


def linear_trend(monthly: DataFrame) -> DataFrame:
    """Least-squares line over the month index; null for a single month."""
    numbered = monthly.withColumn("x", F.row_number().over(Window.orderBy("month")) - 1)  # one row per month
    every = Window.partitionBy()
    slope, intercept = F.regr_slope("total", "x").over(every), F.regr_intercept("total", "x").over(every)
    trend = F.when(F.count(F.lit(1)).over(every) > 1, intercept + slope * F.col("x"))
    return numbered.select("month", "total", trend.alias("trend"))


# ------------------------------------------------------------------ predictions


def daily_sums(preds: DataFrame) -> DataFrame:
    return preds.groupBy("ds", "key").agg(total("real").alias("real"), total("pred").alias("pred"))


def daily_means(preds: DataFrame) -> DataFrame:
    return preds.groupBy("ds", "key").agg(F.avg("real").alias("real"), F.avg("pred").alias("pred"))


def real_against_predicted(preds: DataFrame, demand: DataFrame, model: str, k: int = 3) -> DataFrame:
    """Daily sums of one model for the ``k`` keys of largest demand."""
    busiest = F.broadcast(top_keys(demand, k).select("key"))  # k rows
    return daily_sums(preds.where(F.col("model") == model)).join(busiest, "key", "left_semi")


def error_histogram(preds: DataFrame, kinds: DataFrame, model: str, bins: int = 50) -> DataFrame:
    """Counts of absolute errors in equal bins from 0 to the largest error, per kind."""
    # the forecasts are computed once: two narrow columns are stored, for the largest error and for the bins
    chosen = settle(preds.where((F.col("model") == model) & F.col("abs_err").isNotNull()).select("key", "abs_err"))
    top = chosen.agg(F.max("abs_err")).scalar()
    place = F.least(F.floor(F.col("abs_err") / top * bins), F.lit(bins - 1))
    binned = chosen.withColumn("bin", F.when(top > 0, place).otherwise(F.lit(0)).cast("int"))
    # reduced to key x bin before the kind is looked up
    counted = binned.groupBy("key", "bin").agg(F.count(F.lit(1)).alias("n"))
    named = kinds.groupBy("key").agg(F.min("kind").alias("kind"))
    return (
        counted.join(named, "key")
        .where(F.col("kind").isNotNull())
        .groupBy("kind", "bin")
        .agg(F.sum("n").alias("n"))
    )


def key_performance(preds: DataFrame) -> DataFrame:
    """MAE, total, hour of highest mean and key of highest sum; ties take the first."""
    cells = settle(
        preds.groupBy("key", "hour").agg(
            F.sum("abs_err").alias("sae"), F.count("abs_err").alias("n"), F.sum("real").alias("s"), F.count("real").alias("c")
        )
    )  # keys x hours rows, read three times
    hours = cells.groupBy("hour").agg(F.try_divide(F.sum("s"), F.sum("c")).alias("mean"))
    keys = cells.groupBy("key").agg(F.coalesce(F.sum("s"), F.lit(0.0)).alias("sum"))
    peak_hour = hours.where(F.col("mean").isNotNull()).orderBy(F.desc("mean"), "hour").limit(1).select("hour").scalar()
    busiest = keys.orderBy(F.desc("sum"), "key").limit(1).select("key").scalar()
    return cells.agg(
        F.try_divide(F.sum("sae"), F.sum("n")).alias("mae"), F.coalesce(F.sum("s"), F.lit(0.0)).alias("total")
    ).select("mae", "total", peak_hour.alias("peak_hour"), busiest.alias("busiest_key"))


# ------------------------------------------------------------------ holidays


def holiday_mae(preds: DataFrame, holidays: DataFrame) -> DataFrame:
    """MAE and total demand per (date, holiday, model)."""
    return (
        preds.join(F.broadcast(holidays.select("ds", "holiday")), "ds")  # years x rules rows
        .groupBy("ds", "holiday", "model")
        .agg(F.avg("abs_err").alias("mae"), total("real").alias("total"))
    )


def holiday_comparison(by_holiday: DataFrame, model: str, baseline: str = BASELINE) -> DataFrame:
    """Two models side by side on the holidays that both cover."""
    base = F.max(F.when(F.col("model") == baseline, F.col("mae")))
    other = F.max(F.when(F.col("model") == model, F.col("mae")))
    both = by_holiday.groupBy("ds", "holiday").agg(base.alias("b"), other.alias("m")).na.drop(subset=["b", "m"])
    return both.select(
        F.date_format("ds", "dd/MM/yyyy").alias("date"),
        "holiday",
        half_even(F.col("b"), 0).cast("int").alias("baseline_mae"),
        half_even(F.col("m"), 0).cast("int").alias("model_mae"),
        half_even(per_cent(F.col("b") - F.col("m"), F.col("b")), 1).alias("gain_pct"),
    )


def normal_and_holiday_mae(preds: DataFrame, holidays: DataFrame, models: Sequence[str]) -> DataFrame:
    marked = (
        preds.where(F.col("model").isin(*models))
        .groupBy("model", "ds")
        .agg(F.sum("abs_err").alias("sae"), F.count("abs_err").alias("n"))
        .join(F.broadcast(holidays.select("ds", F.lit(True).alias("is"))), "ds", "left")
    )

    def mae(inside: bool):
        here = F.col("is").isNotNull() if inside else F.col("is").isNull()
        return F.try_divide(F.sum(F.when(here, F.col("sae"))), F.sum(F.when(here, F.col("n"))))

    return marked.groupBy("model").agg(mae(False).alias("normal_mae"), mae(True).alias("holiday_mae"))


def holiday_day_table(preds: DataFrame, holidays: DataFrame, model: str, baseline: str = BASELINE) -> DataFrame:
    """MAE per holiday of baseline and model, for holidays with five baseline rows.

    The normal level is the mean over all models' rows of normal days.
    """
    dated = settle(
        preds.groupBy("model", "ds")
        .agg(
            F.avg("abs_err").alias("mae"),
            F.avg("real").alias("mean"),
            F.sum("real").alias("s"),
            F.count("real").alias("c"),
            F.count(F.lit(1)).alias("n"),
        )
        .join(F.broadcast(holidays.select("ds", "holiday")), "ds", "left")
    )
    normal = dated.where(F.col("holiday").isNull()).agg(F.try_divide(F.sum("s"), F.sum("c"))).scalar()
    is_base = F.col("model") == baseline
    days = (
        dated.where(F.col("holiday").isNotNull())
        .groupBy("ds", "holiday")
        .agg(
            F.max(F.when(is_base, F.col("n"))).alias("n"),
            F.max(F.when(is_base, F.col("mean"))).alias("mean"),
            F.max(F.when(is_base, F.col("mae"))).alias("baseline_mae"),
            F.max(F.when(F.col("model") == model, F.col("mae"))).alias("model_mae"),
        )
        .where(F.col("n") >= LEAST_ROWS)
    )
    share = per_cent(F.col("mean"), normal)
    return days.select(
        F.concat(F.date_format("ds", "dd/MM"), F.lit(" "), F.substring("holiday", 1, 25)).alias("day"),
        "baseline_mae",
        "model_mae",
        F.when(share >= ACTIVE_FROM, "active").otherwise("quiet").alias("day_class"),
    ).orderBy("baseline_mae", "day")


# ------------------------------------------------------------------ importance


def top_features(importance: DataFrame, k: int = 15) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(k)
