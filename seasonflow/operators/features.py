"""Leakage-safe features of a long demand table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import fields
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seasonflow.functions import calendar
from seasonflow.functions.cleaning import per_cent
from seasonflow.operators.ordering import BLOCK_ROWS, over_series, with_global_position
from seasonflow.session import settle
from seasonflow.spec import SeriesSpec

LAGS = (1, 7, 14)
# name, rows back, least number of non-null values, statistic
ROLLING = (
    ("rolling_7d", 7, 3, F.avg),
    ("rolling_28d", 28, 14, F.avg),
    ("rolling_7d_std", 7, 3, F.stddev_samp),
)
# history that a row may lack: every lag, and the rolling means
NULLABLE = (*(f"lag_{k}d" for k in LAGS), *(name for name, _, _, how in ROLLING if how is F.avg))
# the roles of a long table, and its untouched date text, describe a row and are no features
NOT_FEATURES = frozenset((*(f.default for f in fields(SeriesSpec)), "raw_date", "year_part"))
# a feature for models that the correlation report leaves out
NOT_REPORTED = "iso_week"


# ------------------------------------------------------------------ calendar


def add_calendar(df: DataFrame, spec: SeriesSpec = SeriesSpec(), trend_base: int = 2023) -> DataFrame:
    columns = calendar.date_parts(F.col(spec.ds), trend_base)
    if spec.hour:
        columns = {"hour_of_day": F.col(spec.hour).cast("int"), **columns}
    return df.withColumns(columns)


def add_holidays(df: DataFrame, holidays: DataFrame, spec: SeriesSpec = SeriesSpec()) -> DataFrame:
    """Flags from a rule-made calendar (years x rules rows, so broadcast).

    A bridge is a holiday that falls on a Monday.
    """
    flags = holidays.select(F.col("ds").alias("_hd"), F.lit(1).alias("_is"), F.col("is_bridge").alias("_bridge"))
    return (
        df.join(F.broadcast(flags), F.col(spec.ds) == F.col("_hd"), "left")
        .withColumn("is_holiday", F.coalesce("_is", F.lit(0)))
        .withColumn("is_bridge", F.coalesce("_bridge", F.lit(0)))
        .drop("_hd", "_is", "_bridge")
    )


def add_cyclic(df: DataFrame) -> DataFrame:
    return df.withColumns(calendar.cyclic(F.col("hour_of_day"), F.col("weekday"), F.col("month")))


def add_interactions(df: DataFrame) -> DataFrame:
    return df.withColumns(calendar.interactions(F.col("hour_of_day"), F.col("weekday")))


# ------------------------------------------------------------------ history


def lag_columns(y: str, window: Window, lags: Iterable[int] = LAGS) -> dict[str, Column]:
    """Values ``k`` rows back: positions, not calendar days; a null row counts."""
    return {f"lag_{k}d": F.lag(y, k).over(window) for k in lags}


def rolling_columns(y: str, window: Window) -> dict[str, Column]:
    """Statistics of the rows before the current one; null where too few values."""
    columns = {}
    for name, back, least, statistic in ROLLING:
        frame = window.rowsBetween(-back, -1)
        columns[name] = F.when(F.count(y).over(frame) >= least, statistic(y).over(frame))
    return columns


def add_history(
    df: DataFrame,
    spec: SeriesSpec = SeriesSpec(),
    order: Sequence[str] = (),
    bounded: bool = False,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Row lags and rolling statistics of every series, all over one window.

    Call before :func:`zero_fill`: filled zeros must not reach a lag. ``order``
    names further columns that make the order inside a date total. See
    :func:`seasonflow.operators.ordering.over_series` for ``bounded``.
    """
    reach = max(*LAGS, *(back for _, back, _, _ in ROLLING))

    def build(window: Window) -> dict[str, Column]:
        return {**lag_columns(spec.y, window), **rolling_columns(spec.y, window)}

    keyed = df.na.drop(subset=spec.series)
    return over_series(keyed, spec.series, spec.ds, order, reach, build, bounded, block_rows)


def add_calendar_lags(
    df: DataFrame, spec: SeriesSpec = SeriesSpec(), days: Sequence[int] = LAGS, unique: bool = False
) -> DataFrame:
    """Values exactly ``k`` days earlier, whatever rows are missing between.

    Each value is sent forward to the dates that look back at it, so that the join
    meets on (series, date) and no series gathers in one task. Where (series, date) is
    ``unique`` by construction a series is as short as the calendar, and one window with a
    frame of days does: one shuffle, and no row is copied. Rows without a series or a date have no lag.
    """
    if unique:
        along = Window.partitionBy(*spec.series).orderBy(F.unix_date(spec.ds))
        whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in spec.row_id])
        frames = {k: F.min(spec.y).over(along.rangeBetween(-k, -k)) for k in days}
        return df.withColumns({f"calendar_lag_{k}d": F.when(whole, frame) for k, frame in frames.items()})
    sent = (
        df.na.drop(subset=spec.row_id)
        .groupBy(*spec.row_id)
        .agg(F.min(spec.y).alias("_y"))
        .withColumn("_k", F.explode(F.array(*[F.lit(k) for k in days])))
        .withColumn(spec.ds, F.date_add(spec.ds, F.col("_k")))
        .groupBy(*spec.row_id)
        .agg(*[F.min(F.when(F.col("_k") == k, F.col("_y"))).alias(f"calendar_lag_{k}d") for k in days])
    )
    return df.join(sent, spec.row_id, "left")


def operating_cells(df: DataFrame, spec: SeriesSpec = SeriesSpec()) -> DataFrame:
    """Series with at least one value ever."""
    return df.where(F.col(spec.y).isNotNull()).groupBy(*spec.series).agg(F.count(F.lit(1)).alias("n"))


def series_directory(df: DataFrame, spec: SeriesSpec = SeriesSpec()) -> DataFrame:
    """``key, hour, kind, n``: every series and how many values it has, stored.

    One pass over the rows serves the zero-fill and both label maps, and as a stored
    table its size is known: it is broadcast only where it is small.
    """
    return settle(df.groupBy(*spec.series, spec.kind).agg(F.count(spec.y).alias("n")))


def zero_fill(df: DataFrame, spec: SeriesSpec = SeriesSpec(), directory: DataFrame | None = None) -> DataFrame:
    """Zero only where the series never has a value; other gaps stay null."""
    if directory is None:
        directory = settle(operating_cells(df, spec))
    cells = directory.where(F.col("n") > 0).select(*spec.series, F.lit(True).alias("_operates")).distinct()
    missing = F.col(spec.y).isNull() & F.col("_operates").isNull()
    return (
        df.join(cells, spec.series, "left")
        .withColumn(spec.y, F.when(missing, F.lit(0.0)).otherwise(F.col(spec.y)))
        .drop("_operates")
    )


# ------------------------------------------------------------------ encoding


def label_codes(df: DataFrame, column: str) -> DataFrame:
    """``value, code``: codes by sorted order of the distinct values, from 0.

    Fitted once and kept; a null value gets no code.
    """
    values = settle(df.select(F.col(column).alias("value")).where(F.col("value").isNotNull()).distinct())
    return with_global_position(values, ["value"], "code").select("value", F.col("code").cast("int"))


def add_code(df: DataFrame, column: str, codes: DataFrame, name: str) -> DataFrame:
    side = codes.select(F.col("value").alias("_value"), F.col("code").alias(name))
    return df.join(side, F.col(column) == F.col("_value"), "left").drop("_value")


def add_encoding(
    df: DataFrame, rail_kind: str, spec: SeriesSpec = SeriesSpec(), codes: tuple[DataFrame, DataFrame] | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    keys, kinds = codes or (label_codes(df, spec.key), label_codes(df, spec.kind))
    coded = add_code(add_code(df, spec.key, keys, "key_code"), spec.kind, kinds, "kind_code")
    is_rail = F.coalesce((F.col(spec.kind) == rail_kind).cast("int"), F.lit(0))
    return coded.withColumn("is_rail", is_rail), keys, kinds


def encoder_table(keys: DataFrame, kinds: DataFrame) -> DataFrame:
    """Both label maps in one tidy table; either direction is a filter."""
    return keys.withColumn("encoder", F.lit("key")).unionByName(kinds.withColumn("encoder", F.lit("kind")))


# ------------------------------------------------------------------ all together


def build_features(
    trusted: DataFrame,
    holidays: DataFrame,
    rail_kind: str,
    trend_base: int,
    spec: SeriesSpec = SeriesSpec(),
    bounded: bool = False,
    codes: tuple[DataFrame, DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The featured table and the two label maps. History comes before zero-fill."""
    df = add_calendar(trusted, spec, trend_base)
    df = add_history(df, spec, bounded=bounded)
    directory = series_directory(trusted, spec)
    df = zero_fill(df, spec, directory)
    df = add_holidays(df, holidays, spec)
    df = add_cyclic(df)
    codes = codes or (label_codes(directory, spec.key), label_codes(directory, spec.kind))
    df, keys, kinds = add_encoding(df, rail_kind, spec, codes)
    return add_interactions(df), keys, kinds


def feature_columns(df: DataFrame, excluded: Iterable[str] = NOT_FEATURES) -> list[str]:
    """Every column that is not excluded, in table order (schema only)."""
    dropped = set(excluded)
    return [c for c in df.columns if c not in dropped]


# ------------------------------------------------------------------ report


def correlations(df: DataFrame, y: str = "y", features: Sequence[str] | None = None, top: int = 15) -> DataFrame:
    """``feature, r``: the features most correlated with the target, sign kept.

    One pass with mergeable sums; each pair uses the rows where both are present.
    """
    names = [f for f in features or feature_columns(df) if f in df.columns and (features or f != NOT_REPORTED)]
    valid = df.where(F.col(y).isNotNull())
    target = F.col(y).cast("double")

    def r(name: str) -> Column:
        # F.corr divides by zero on a constant column; here that gives null
        x = F.col(name).cast("double")
        spread = F.sqrt(F.var_pop(x)) * F.sqrt(F.var_pop(F.when(x.isNotNull(), target)))
        return F.try_divide(F.covar_pop(x, target), spread)

    one = valid.agg(*[r(f).alias(f) for f in names])
    tidy = one.select(
        F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("r")) for f in names]))
    ).where(F.col("r").isNotNull() & ~F.isnan("r"))
    return tidy.orderBy(F.abs("r").desc(), "feature").limit(top)


def null_history(df: DataFrame) -> DataFrame:
    """Rows in all, rows with any null lag or rolling mean, and their share."""
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in NULLABLE])
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(any_null).alias("rows_with_null"),
        per_cent(F.count_if(any_null), F.count(F.lit(1))).alias("null_pct"),
    )


