import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from seasonflow.operators import features
from seasonflow.operators.ordering import over_series, with_global_position
from seasonflow.operators.quantiles import exact_quantile
from seasonflow.spec import SeriesSpec


def hot_rows(spark, n=3000, seed=5):
    """One series holds most rows, with many rows on one date, gaps and nulls."""
    source = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if source.random() < 0.8 else source.choice(["a", "b", "c"])
        day = date(2024, 1, 1) + timedelta(days=min(source.randint(0, 200), 90))
        rows.append((i, key, 1, day, None if source.random() < 0.2 else float(source.randint(0, 999))))
    rows.append((n, "a", 1, None, 5.0))
    return spark.createDataFrame(rows, "id int, key string, hour int, ds date, y double")


def test_blocks_equal_one_plain_window(spark):
    df = hot_rows(spark)
    spec = SeriesSpec()
    plain = features.add_history(df, spec, order=["id"], bounded=True)
    blocks = features.add_history(df, spec, order=["id"], block_rows=64)
    assert blocks.columns == plain.columns
    left, right = plain.orderBy("id").toPandas(), blocks.orderBy("id").toPandas()
    assert len(left) == len(right) == 3001
    for column in left.columns:
        if left[column].dtype == float:
            np.testing.assert_allclose(left[column], right[column], rtol=1e-9, equal_nan=True)
        else:
            assert left[column].tolist() == right[column].tolist()


def test_block_must_be_longer_than_the_reach(spark):
    with pytest.raises(ValueError):
        over_series(hot_rows(spark, 10), ["key"], "ds", ["id"], 28, lambda w: {}, block_rows=28)


def test_global_position_equals_row_number(spark):
    df = hot_rows(spark)
    placed = with_global_position(df, ["ds", "key", "id"])
    exact = F.row_number().over(Window.orderBy(F.col("ds").asc_nulls_last(), "key", "id")) - 1
    assert placed.withColumn("exact", exact).where("position <> exact").count() == 0
    assert placed.count() == df.count()


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.9, 0.999, 1.0])
def test_exact_quantile_with_a_coarse_sketch(spark, q):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(0, 100, 20_000), np.repeat(7.0, 5_000), rng.integers(0, 5, 5_000)])
    keys = np.where(rng.random(len(values)) < 0.7, "hot", rng.choice(["a", "b"], len(values)))
    df = spark.createDataFrame([(k, float(v)) for k, v in zip(keys.tolist(), values.tolist())], "k string, v double")
    whole = exact_quantile(df, "v", q, accuracy=200).first()["quantile"]
    assert whole == pytest.approx(np.quantile(values, q), abs=1e-9)
    grouped = {r["k"]: r["quantile"] for r in exact_quantile(df, "v", q, ["k"], accuracy=200).collect()}
    for k in ("hot", "a", "b"):
        assert grouped[k] == pytest.approx(np.quantile(values[keys == k], q), abs=1e-9)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 7, 10, 100])
def test_exact_quantile_of_few_values(spark, n):
    values = [float(v * v) for v in range(n)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    for q in (0.25, 0.5, 0.9, 0.999):
        assert exact_quantile(df, "v", q).first()["quantile"] == pytest.approx(np.quantile(values, q))
