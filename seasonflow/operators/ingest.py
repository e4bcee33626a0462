"""Wide text table to clean long table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonflow.functions import cleaning
from seasonflow.operators.split import dates_between
from seasonflow.session import literal_table
from seasonflow.spec import Profile, SeriesSpec


def parse_dates(wide: DataFrame, profile: Profile, policy: str = "by_rule") -> DataFrame:
    """Adds ``ds``; the raw text stays as ``raw_date``."""
    text = F.col(profile.raw_date)
    if policy == "by_rule":
        parsed = cleaning.date_by_rule(text, profile.date_rules)
    elif policy == "two_pass":
        parsed = cleaning.two_pass_date(text)
    else:
        raise ValueError(f"unknown date policy: {policy}")
    return wide.withColumn("ds", parsed).withColumn("raw_date", text)


def clean_numbers(wide: DataFrame, columns: Sequence[str]) -> DataFrame:
    present = [c for c in columns if c in wide.columns]
    return wide.withColumns({c: cleaning.number(F.col(f"`{c}`")) for c in present})


def to_long(wide: DataFrame, profile: Profile) -> DataFrame:
    """One row per hour cell, the missing ones included."""
    ids = ["ds", "raw_date", profile.raw_key, profile.raw_total]
    return (
        wide.unpivot(ids, [f"`{c}`" for c in profile.hour_columns()], "_hour", "y")
        .withColumn("hour", F.replace(F.col("_hour"), F.lit(":00"), F.lit("")).cast("int"))
        .withColumnsRenamed({profile.raw_key: "key", profile.raw_total: "total"})
        .drop("_hour")
    )


def type_table(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return literal_table(df.sparkSession, list(types.items()), "key string, kind string")


def add_type(long: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Left lookup in the profile's own map, written in the program text."""
    return long.join(F.broadcast(type_table(long, types)), "key", "left")


def unmapped_keys(long: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return long.select("key").join(F.broadcast(type_table(long, types)), "key", "left_anti").distinct()


def trusted_table(wide: DataFrame, profile: Profile, policy: str = "by_rule") -> DataFrame:
    """Dates, numbers, unpivot, type; the columns of the clean long table."""
    dated = parse_dates(wide, profile, policy)
    clean = clean_numbers(dated, [*profile.hour_columns(), profile.raw_total])
    return add_type(to_long(clean, profile), profile.types).select(
        "ds", "raw_date", "key", "kind", "hour", "y", "total"
    )


def date_audit(wide: DataFrame, profile: Profile) -> DataFrame:
    """Rows that each pass and the rule leave unparsed, ambiguous and exchanged rows."""
    text = F.col(profile.raw_date)
    first = F.try_to_date(F.trim(text), cleaning.DAY_FIRST)
    both = cleaning.two_pass_date(text)
    ruled = cleaning.date_by_rule(text, profile.date_rules)
    return wide.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(first.isNull()).alias("null_after_first"),
        F.count_if(both.isNull()).alias("null_after_second"),
        F.count_if(ruled.isNull()).alias("null_by_rule"),
        F.count_if(cleaning.is_ambiguous_date(text)).alias("ambiguous"),
        F.count_if(F.coalesce(both != ruled, F.lit(False))).alias("exchanged"),
    )


def unparsed_dates(wide: DataFrame, profile: Profile) -> DataFrame:
    """The distinct texts that neither pass can read."""
    text = F.col(profile.raw_date)
    return wide.where(cleaning.two_pass_date(text).isNull()).select(text.alias("raw_date")).distinct()


def in_any(column: Column, values: Sequence) -> Column:
    return column.isin(*values)


def explore(
    df: DataFrame,
    keys: Sequence[str],
    first: str,
    last: str,
    hours: tuple[int, int],
    model: str | None = None,
    spec: SeriesSpec = SeriesSpec(),
) -> DataFrame:
    """Conjunctive filter on key, date range, hour range and model; pushed to the scan."""
    kept = df.where(
        F.col(spec.key).isin(*keys)
        & dates_between(df, first, last, spec.ds)
        & F.col(spec.hour).between(*hours)
    )
    return kept if model is None else kept.where(F.col("model") == model)
