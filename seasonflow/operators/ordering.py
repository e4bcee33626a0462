"""Exact positions and windows that never put a whole series into one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seasonflow.session import settle

BLOCK_ROWS = 65_536
_LOW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def last_nulls(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def with_global_position(df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """Row number (from 0) in the order of ``order``, by a distributed sort.

    The sorted rows are written once, because a second run of a range shuffle may
    cut its ranges elsewhere. Only one count per partition meets in one place.
    """
    ordered = settle(
        df.repartitionByRange(*last_nulls(order))
        .sortWithinPartitions(*last_nulls(order))
        .withColumn("_row", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_row", _LOW_BITS))
    )
    sizes = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    inside = F.col("_row") - F.shiftleft("_part", _LOW_BITS)
    return (
        ordered.join(F.broadcast(starts), "_part")  # one row per partition
        .withColumn(name, F.col("_start") + inside)
        .drop("_row", "_part", "_start")
    )


def over_series(
    df: DataFrame,
    series: Sequence[str],
    bucket: str,
    order: Sequence[str],
    reach: int,
    build: Callable[[Window], dict[str, Column]],
    bounded: bool = False,
    block_rows: int = BLOCK_ROWS,
    position: str | None = None,
) -> DataFrame:
    """Add window columns that look at most ``reach`` rows back in a series.

    ``bounded=True`` states that (series, bucket) is unique, so that a series is no
    longer than the calendar: one plain window, one shuffle. Otherwise a series, or
    one date of it, may hold any share of the rows: the rows are put in order by a
    distributed sort and cut into blocks of ``block_rows``, each with the ``reach``
    rows before it, and blocks are spread over the tasks.

    ``position`` names a column that tells rows of one (series, bucket) in order.
    """
    if bounded:
        window = Window.partitionBy(*series).orderBy(*last_nulls([bucket, *order]))
        added = df.withColumns(build(window))
        return added.withColumn(position, F.lit(0).cast("long")) if position else added
    if reach >= block_rows:
        raise ValueError("a block must be longer than the reach of the window")
    placed = with_global_position(df, [*series, bucket, *order], "_position")
    near_end = F.col("_position") % block_rows >= block_rows - reach
    copies = placed.withColumn("_home", F.floor(F.col("_position") / block_rows)).withColumn(
        "_block",
        F.explode(F.when(near_end, F.array("_home", F.col("_home") + 1)).otherwise(F.array("_home"))),
    )
    window = Window.partitionBy(*series, "_block").orderBy("_position")
    own = copies.withColumns(build(window)).where(F.col("_block") == F.col("_home"))
    if position:
        own = own.withColumn(position, F.col("_position"))
    return own.drop("_position", "_home", "_block")
