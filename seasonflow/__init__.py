"""Keyed, seasonal demand time series on Spark."""

from seasonflow.spec import SeriesSpec

__all__ = ["SeriesSpec"]
