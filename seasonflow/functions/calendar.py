"""Calendar and hour features as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_parts(ds: Column, trend_base: int) -> dict[str, Column]:
    weekday = F.weekday(ds)
    return {
        "weekday": weekday,  # 0 = Monday
        "month": F.month(ds),
        "year": F.year(ds),
        "day_of_year": F.dayofyear(ds),
        "is_weekend": (weekday >= 5).cast("int"),
        "iso_week": F.weekofyear(ds),
        "year_trend": F.year(ds) - F.lit(trend_base),
    }


def wave(name: str, value: Column, period: int) -> dict[str, Column]:
    angle = value * F.lit(2 * math.pi) / F.lit(period)
    return {f"{name}_sin": F.sin(angle), f"{name}_cos": F.cos(angle)}


def cyclic(hour: Column, weekday: Column, month: Column) -> dict[str, Column]:
    return {**wave("hour", hour, 24), **wave("weekday", weekday, 7), **wave("month", month, 12)}


def interactions(hour: Column, weekday: Column) -> dict[str, Column]:
    return {
        "hour_x_weekday": hour * weekday,
        "is_morning_peak": hour.between(6, 9).cast("int"),
        "is_evening_peak": hour.between(17, 19).cast("int"),
    }
