"""Quality audit and summaries of a long demand table, as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonflow.functions.cleaning import per_cent
from seasonflow.operators.quantiles import exact_quantile
from seasonflow.session import literal_table
from seasonflow.spec import SeriesSpec

SPEC = SeriesSpec()


def dates_by_year(long: DataFrame, years: Sequence[int]) -> DataFrame:
    """First and last date and distinct dates of every expected year."""
    found = (
        long.where(F.year("ds").isin(*years))
        .groupBy(F.year("ds").alias("year"))
        .agg(F.min("ds").alias("first"), F.max("ds").alias("last"), F.countDistinct("ds").alias("days"))
    )
    expected = literal_table(long.sparkSession, [(int(y),) for y in years], "year int")
    return expected.join(found, "year", "left").select(
        "year", "first", "last", F.coalesce("days", F.lit(0)).alias("days"), F.col("days").isNull().alias("no_data")
    )


def value_outliers(long: DataFrame, y: str = "y", q: float = 0.999) -> DataFrame:
    """Negative values, the exact quantile, and what lies above it."""
    limit = exact_quantile(long, y, q, name="limit").scalar()
    seen = long.where(F.col(y).isNotNull()).select(y, limit.alias("limit"))
    return seen.groupBy("limit").agg(
        F.count_if(F.col(y) < 0).alias("negative"),
        F.count_if(F.col(y) > F.col("limit")).alias("above"),
        per_cent(F.count_if(F.col(y) > F.col("limit")), F.count(F.lit(1))).alias("above_pct"),
    )


def top_outliers(long: DataFrame, k: int = 5, q: float = 0.999, spec: SeriesSpec = SPEC) -> DataFrame:
    limit = exact_quantile(long, spec.y, q, name="limit").scalar()
    return (
        long.where(F.col(spec.y) > limit)
        .select(*spec.row_id, spec.y)
        .orderBy(F.col(spec.y).desc(), *spec.row_id)
        .limit(k)
    )


def missing_by_key(long: DataFrame, limit: float = 0.2, spec: SeriesSpec = SPEC) -> DataFrame:
    share = F.avg(F.col(spec.y).isNull().cast("double"))
    return long.groupBy(spec.key).agg((share * 100).alias("missing_pct"), (share > limit).alias("flagged"))


def compare_totals(long: DataFrame, wide: DataFrame, tolerance: float = 10.0) -> DataFrame:
    """Sum of the hours against the stated total, per (ds, key), where both exist."""
    summed = long.groupBy("ds", "key").agg(F.sum("y").alias("computed"))
    stated = wide.select("ds", "key", "total")
    return (
        summed.join(stated, ["ds", "key"], "left")
        .na.drop(subset=["computed", "total"])
        .withColumn("diff", F.abs(F.col("computed") - F.col("total")))
        .withColumn("differs", F.col("diff") > tolerance)
    )


def total_mismatches(compared: DataFrame) -> DataFrame:
    return compared.agg(
        F.count(F.lit(1)).alias("compared"),
        F.count_if("differs").alias("mismatches"),
        F.max("diff").alias("max_diff"),
    )


def mismatch_sample(compared: DataFrame, k: int = 3) -> DataFrame:
    return compared.where("differs").orderBy("ds", "key", "total").limit(k).drop("differs")


def years_by_key(long: DataFrame) -> DataFrame:
    return long.groupBy("key").agg(F.array_sort(F.collect_set(F.year("ds"))).alias("years"))


def zeros_and_missing(long: DataFrame, y: str = "y") -> DataFrame:
    rows, zero, missing = F.count(F.lit(1)), F.count_if(F.col(y) == 0), F.count_if(F.col(y).isNull())
    return long.agg(
        zero.alias("zeros"),
        per_cent(zero, rows).alias("zeros_pct"),
        missing.alias("missing"),
        per_cent(missing, rows).alias("missing_pct"),
    )


def top_missing_hours(long: DataFrame, k: int = 5) -> DataFrame:
    return (
        long.where(F.col("y").isNull())
        .groupBy("hour")
        .agg(F.count(F.lit(1)).alias("missing"))
        .orderBy(F.desc("missing"), "hour")
        .limit(k)
    )


def summary_by_kind(long: DataFrame, by: str = "kind", y: str = "y") -> DataFrame:
    """Mean, exact median, maximum and sum per kind."""
    typed = long.where(F.col(by).isNotNull())
    middle = exact_quantile(typed, y, 0.5, [by], name="median")
    sums = typed.groupBy(by).agg(
        F.avg(y).alias("mean"), F.max(y).alias("max"), F.coalesce(F.sum(y), F.lit(0.0)).alias("sum")
    )
    return sums.join(middle, by, "left").select(by, "mean", "median", "max", "sum")


def summary_by_key(long: DataFrame, by: str = "key", y: str = "y") -> DataFrame:
    return (
        long.where(F.col(by).isNotNull())
        .groupBy(by)
        .agg(F.count(y).alias("rows"), F.avg(y).alias("mean"), F.max(y).alias("max"))
        .orderBy(F.col("mean").desc_nulls_last(), by)
    )


def overview(long: DataFrame) -> DataFrame:
    return long.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("ds").alias("first"),
        F.max("ds").alias("last"),
        F.countDistinct("key").alias("keys"),
        F.array_sort(F.collect_set("hour")).alias("hours"),
    )
