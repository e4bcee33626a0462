"""Demand tables derived from order, line item and event tables.

Every function aggregates the whole source table; nothing is sampled. Money is
summed in whole cents, so that sums do not depend on the order of the rows; the
cents stay 64-bit integers, which is far cheaper per row than a decimal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonflow.spec import Profile

SLOTS = tuple(range(1, 8))

RETAIL = Profile(
    hours=SLOTS,
    raw_date="DAY",
    raw_key="LINE",
    raw_total="TOTAL",
    date_rules=((None, 1999, "d/M/yyyy"), (2000, None, "M/d/yyyy")),
    types={"AF": "accepted", "AO": "accepted", "RF": "returned", "RO": "returned", "NF": "new"},
    rail_kind="accepted",
    years=(1995, 1996, 1997, 1998, 1999, 2000, 2001),
    trend_base=1995,
    test_from="2001-01-01",
    test_until="2001-12-31",
    val_from="2000-11-01",
    folds=(
        ("Fold 1", "1995-01-01", "1997-06-30", "1997-07-01", "1997-12-31"),
        ("Fold 2", "1995-01-01", "1998-06-30", "1998-07-01", "1998-12-31"),
        ("Fold 3", "1995-01-01", "1999-06-30", "1999-07-01", "1999-12-31"),
        ("Fold 4", "1995-01-01", "2000-06-30", "2000-07-01", "2000-12-31"),
    ),
    main_models=("Baseline", "Lag7", "Roll7"),
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cents(column: str):
    return F.rint(F.col(column) * 100).cast("long")


def exact_sum(column: str):
    return F.sum(cents(column)) / 100.0


def line_key():
    return F.concat("l_returnflag", "l_linestatus")


def line_cells(spark: SparkSession, folder: str) -> DataFrame:
    """``ds, key, hour, y``: price per ship date, line and slot; absent cells absent."""
    return (
        table(spark, folder, "lineitem")
        .groupBy(
            F.col("l_shipdate").cast("date").alias("ds"),
            line_key().alias("key"),
            F.col("l_linenumber").alias("hour"),
        )
        .agg(exact_sum("l_extendedprice").alias("y"))
    )


def wide_raw(spark: SparkSession, folder: str) -> DataFrame:
    """The text table a network would deliver: one row per day and line.

    Dates are day first up to 1999 and month first after; numbers carry thousands
    separators and blanks; the stated total is 50 too high on the first of a month.
    """
    items = table(spark, folder, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("ds"),
        line_key().alias("LINE"),
        "l_linenumber",
        cents("l_extendedprice").alias("v"),
    )
    days = items.groupBy("ds", "LINE").agg(
        *[F.sum(F.when(F.col("l_linenumber") == h, F.col("v"))).alias(f"{h}:00") for h in SLOTS],
        F.sum("v").alias("TOTAL"),
    )
    text = F.when(F.year("ds") < 2000, F.date_format("ds", "d/M/yyyy")).otherwise(F.date_format("ds", "M/d/yyyy "))
    stated = F.col("TOTAL") + F.when(F.dayofmonth("ds") == 1, 5000).otherwise(0)

    def spelled(column):
        return F.coalesce(F.format_number(column / 100.0, 2), F.lit(" "))

    return days.select(
        text.alias("DAY"),
        "LINE",
        *[spelled(F.col(f"`{h}:00`")).alias(f"{h}:00") for h in SLOTS],
        spelled(stated).alias("TOTAL"),
    )


def line_long(spark: SparkSession, folder: str) -> DataFrame:
    """``ds, key, hour, y, kind``: every slot of every day a line has, gaps null.

    Grouped by (ds, key) and unpivoted, so (ds, key, hour) is unique.
    """
    items = table(spark, folder, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("ds"),
        line_key().alias("key"),
        "l_linenumber",
        cents("l_extendedprice").alias("v"),
    )
    days = items.groupBy("ds", "key").agg(
        *[(F.sum(F.when(F.col("l_linenumber") == h, F.col("v"))) / 100.0).alias(str(h)) for h in SLOTS]
    )
    long = days.unpivot(["ds", "key"], [f"`{h}`" for h in SLOTS], "hour", "y").withColumn("hour", F.col("hour").cast("int"))
    kinds = F.create_map(*[F.lit(v) for pair in RETAIL.types.items() for v in pair])
    return long.withColumn("kind", F.try_element_at(kinds, F.col("key")))


def orders_daily(spark: SparkSession, folder: str) -> DataFrame:
    """``ds, key, y, n``: order value and count per date and priority; dates may be absent."""
    return (
        table(spark, folder, "orders")
        .groupBy(F.col("o_orderdate").cast("date").alias("ds"), F.col("o_orderpriority").alias("key"))
        .agg(exact_sum("o_totalprice").alias("y"), F.count(F.lit(1)).alias("n"))
    )


def events_hourly(spark: SparkSession, folder: str) -> DataFrame:
    """``ds, key, hour, y``: event value per date, type and hour; absent cells absent."""
    return (
        table(spark, folder, "events")
        .groupBy(
            F.col("ts").cast("date").alias("ds"), F.col("event_type").alias("key"), F.hour("ts").alias("hour")
        )
        .agg(exact_sum("value").alias("y"))
    )


def events_long(spark: SparkSession, folder: str) -> DataFrame:
    """``ds, key, hour, y``: all 24 hours of every day on which a type occurs, hours without events null."""
    cells = table(spark, folder, "events").select(
        F.col("ts").cast("date").alias("ds"), F.col("event_type").alias("key"), F.hour("ts").alias("hour"), cents("value").alias("v")
    )
    days = cells.groupBy("ds", "key").agg(*[(F.sum(F.when(F.col("hour") == h, F.col("v"))) / 100.0).alias(str(h)) for h in range(24)])
    return days.unpivot(["ds", "key"], [f"`{h}`" for h in range(24)], "hour", "y").withColumn("hour", F.col("hour").cast("int"))


def order_requests(spark: SparkSession, folder: str) -> DataFrame:
    """One request per order: untidy line text, date text, hour text, model.

    Lines that end in ``P`` do not exist, the 29th of a month is written as month
    13, and priority 5 asks for hour 50.
    """
    digit = F.substring("o_orderpriority", 1, 1)
    model = F.when(F.col("o_orderstatus") == "O", F.lit(None)).when(digit == "1", "Lag7 ").otherwise("Baseline")
    day = F.when(F.dayofmonth("o_orderdate") == 29, F.date_format("o_orderdate", "yyyy-'13'-dd")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("request_id"),
        F.concat(F.lit(" r"), F.lower("o_orderstatus"), F.lit(" ")).alias("line"),
        day.alias("date"),
        F.when(digit == "5", "50").otherwise(digit).alias("hour"),
        model.alias("model"),
    )
