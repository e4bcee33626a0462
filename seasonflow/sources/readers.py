"""Reading tables. A path may be local or on any store Spark has a connector for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonflow.spec import Profile

BOM = "﻿"
PREDICTIONS = "ds date, key string, hour int, real double, pred double, abs_err double, model string"
REQUESTS = "request_id long, line string, date string, hour string, model string"


def read_wide_csv(spark: SparkSession, path: str, profile: Profile) -> DataFrame:
    """The raw wide table, every column as text; a byte order mark is ignored.

    Columns are taken by the names in the header, which may be in any order, but in the same
    one in all files of a folder: Spark checks each header and fails where one differs.
    """
    header = spark.read.option("header", False).csv(path).limit(1).first()
    names = [(c or "").lstrip(BOM).strip() for c in header]
    missing = [c for c in (profile.raw_date, profile.raw_key) if c not in names]
    if missing:
        raise ValueError(f"columns missing from {path}: {missing}")
    schema = T.StructType([T.StructField(c or "", T.StringType()) for c in header])
    wide = spark.read.option("header", True).option("enforceSchema", False).schema(schema).csv(path).toDF(*names)
    absent = [c for c in profile.raw_columns() if c not in names]
    return wide.withColumns({c: F.lit(None).cast("string") for c in absent}).select(
        *[F.col(f"`{c}`") for c in profile.raw_columns()]
    )


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Only the asked columns leave the files."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_predictions_csv(spark: SparkSession, path: str) -> DataFrame:
    """Stored predictions, names trimmed, with the month as text."""
    df = spark.read.option("header", True).option("dateFormat", "yyyy-MM-dd").schema(PREDICTIONS).csv(path)
    return df.withColumns(
        {"key": F.trim("key"), "model": F.trim("model"), "month": F.date_format("ds", "yyyy-MM")}
    )


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)
