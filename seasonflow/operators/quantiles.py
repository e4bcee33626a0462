"""Exact quantiles with linear interpolation, per group, without holding a group.

Spark's exact ``percentile`` keeps every distinct value of a group in one buffer.
Here a sketch first brackets the wanted rank, one pass counts the rows below the
bracket and the distinct values inside it, by ranges of equal width. Running sums over these few ranges
tell which hold the rank, and only their values are ordered, so nothing that grows with the rows is in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seasonflow.session import settle

#: Ranges of a bracket.
RANGES = 4096


def exact_quantile(
    df: DataFrame, value: str, q: float, by: Sequence[str] = (), accuracy: int = 100_000, name: str = "quantile", slack: float | None = None
) -> DataFrame:
    """One row per group: the group columns and the exact ``q`` quantile of the non-null values."""
    slack = slack or 2.0 / accuracy  # twice the rank error that the sketch allows
    low_q, high_q = max(q - slack, 0.0), min(q + slack, 1.0)
    groups = [f"_g{i}" for i in range(len(by))]
    rows = df.where(F.col(value).isNotNull()).select(
        *[F.col(c).alias(g) for c, g in zip(by, groups)], F.col(value).cast("double").alias("_v")
    )
    bracket = rows.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("_n"),
        F.percentile_approx("_v", [low_q, high_q], accuracy).alias("_range"),
    )
    rank = (F.col("_n") - 1) * F.lit(q)
    bracket = bracket.select(
        *groups,
        F.floor(rank).alias("_k"),
        (rank - F.floor(rank)).alias("_part"),
        "_n",
        F.col("_range")[0].alias("_low"),
        F.col("_range")[1].alias("_high"),
    )
    if groups:
        same = [F.col(f"{g}").eqNullSafe(F.col(f"_b{g}")) for g in groups]
        # stored, so that its size is known and the rows are not shuffled to meet it
        side = settle(bracket.select(*[F.col(g).alias(f"_b{g}") for g in groups], "_k", "_part", "_n", "_low", "_high"))
        placed = rows.join(side, same).drop(*[f"_b{g}" for g in groups])
    else:
        one = bracket.select(F.struct("_k", "_part", "_n", "_low", "_high")).scalar()
        placed = rows.withColumn("_one", one).select("_v", "_one.*")
    tier = F.when(F.col("_v") < F.col("_low"), 0).when(F.col("_v") <= F.col("_high"), 1).otherwise(2)
    keep = ["_k", "_part", "_n"]
    width = F.col("_high") - F.col("_low")
    inside = F.when(width > 0, F.least(F.floor((F.col("_v") - F.col("_low")) / width * RANGES), F.lit(RANGES - 1))).otherwise(0)
    place = F.when(F.col("_tier") == 0, -1).when(F.col("_tier") == 2, RANGES).otherwise(inside).cast("int")
    # Below the bracket only the largest value can be wanted, above it only the smallest.
    counted = settle(
        placed.withColumn("_tier", tier)
        .withColumn("_cell", F.when(F.col("_tier") == 1, F.col("_v")))
        .withColumn("_place", place)
        .groupBy(*groups, *keep, "_tier", "_place", "_cell")
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            F.when(F.col("_tier") == 0, F.max("_v")).otherwise(F.min("_v")).alias("_at"),
        )
    )
    ranges = counted.groupBy(*groups, *keep, "_place").agg(F.sum("_rows").alias("_in"))  # at most RANGES and two a group
    over = Window.partitionBy(*groups).orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    nxt = F.least(F.col("_k") + 1, F.col("_n") - 1)
    summed = ranges.withColumn("_before", F.sum("_in").over(over) - F.col("_in"))
    holds = lambda index: (F.col("_before") <= index) & (index < F.col("_before") + F.col("_in"))
    wanted = settle(summed.where(holds(F.col("_k")) | holds(nxt)).select(*groups, F.col("_place").alias("_here"), "_before"))
    match = [F.col("_place") == F.col("_here"), *[F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}")) for g in groups]]
    few = counted.alias("a").join(wanted.alias("b"), match).select("a.*", "b._before")  # two ranges of a group at most
    along = Window.partitionBy(*groups, "_place").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    running = few.withColumn("_upto", F.col("_before") + F.sum("_rows").over(along))
    first = F.min(F.when(F.col("_upto") > F.col("_k"), F.struct("_upto", "_tier", "_at", "_rows")))
    second = F.min(F.when(F.col("_upto") > nxt, F.struct("_upto", "_tier", "_at", "_rows")))
    picked = running.groupBy(*groups, *keep).agg(first.alias("_first"), second.alias("_second"))

    def held(side: str, index):
        cell = F.col(side)
        exact = (
            (cell["_tier"] == 1)
            | ((cell["_tier"] == 0) & (index == cell["_upto"] - 1))
            | ((cell["_tier"] == 2) & (index == cell["_upto"] - cell["_rows"]))
        )
        return F.when(exact, cell["_at"])

    low = held("_first", F.col("_k"))
    high = F.when(F.col("_part") == 0, low).otherwise(held("_second", nxt))
    result = picked.select(
        *[F.col(g).alias(c) for c, g in zip(by, groups)],
        (low + (high - low) * F.col("_part")).alias(name),
    )
    result = settle(result)
    if result.where(F.col(name).isNull()).isEmpty():
        return result
    # the sketch missed a rank: look again in a wider bracket, which ends with the whole range
    return exact_quantile(df, value, q, by, accuracy, name, slack * 16)
