"""Filters on dates open only the folders of their years."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from seasonflow.operators import features, ingest, split
from seasonflow.sources import readers, sinks

FOLDS = [("f", "2022-01-01", "2022-06-30", "2022-07-01", "2022-09-30")]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("years") / "table")
    rows = [(date(2021, 1, 1) + timedelta(days=i), "a", 5, float(i)) for i in range(1200)]
    df = spark.createDataFrame(rows, "ds date, key string, hour int, y double").withColumns({"lag_1d": F.col("y"), "lag_7d": F.col("y"), "rolling_7d": F.col("y")})
    sinks.write_by_year(df, path)
    return readers.read_parquet(spark, path)


def read_years(df):
    """Years whose rows the scan gives, and the partition filters of the plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    return {r[0] for r in df.select(F.year("ds")).distinct().collect()}, filters


def test_explorer_and_folds(stored):
    found = ingest.explore(stored, ["a"], "2022-02-01", "2022-03-01", (0, 23))
    years, filters = read_years(found)
    assert years == {2022} and "year_part" in filters and "2022" in filters
    for part, rows in (("train", 181), ("test", 92)):
        df = split.fold_rows(stored, FOLDS, part)
        assert df.count() == rows and "year_part" in read_years(df)[1]


def test_no_folds(stored):
    assert split.fold_rows(stored, [], "train").count() == 0 and split.tail_split(stored, []).count() == 0


def test_temporal_split(stored):
    rows = split.temporal_split(stored, "2023-01-01", "2023-12-31", "2022-11-01")
    plain = split.temporal_split(stored.drop("year_part"), "2023-01-01", "2023-12-31", "2022-11-01")
    assert sorted(map(tuple, rows.groupBy("split").count().collect())) == sorted(map(tuple, plain.groupBy("split").count().collect()))
    for part, days, filters in (("test", 365, ">= 2023"), ("val", 61 + 105, ">= 2022"), ("train", 669, "")):
        own = split.part_rows(rows, part, "2023-01-01", "2023-12-31", "2022-11-01")
        assert own.count() == rows.where(F.col("split") == part).count() == days
        assert filters in read_years(own)[1]
    assert "year_part" not in features.feature_columns(rows)
