"""Temporal splits and expanding-window folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seasonflow.operators.ordering import with_global_position
from seasonflow.session import literal_table
from seasonflow.spec import SeriesSpec

NEEDED = ("y", "lag_1d", "lag_7d", "rolling_7d")
#: The column that stored tables are laid out by.
YEAR_PART = "year_part"
Fold = tuple[str, str, str, str, str]


def usable(df: DataFrame, needed: Sequence[str] = NEEDED) -> DataFrame:
    return df.na.drop(subset=list(needed))


def dates_between(df: DataFrame, first: str, last: str | None, ds: str = "ds") -> Column:
    """Whether a date lies between two others, both included, or from the first on. Where the table is laid out by
    year the years are bounded too, so that a scan opens only the folders of these years."""
    day = F.col(ds)
    inside = day >= F.lit(first).cast("date")
    if last is not None:
        inside = inside & (day <= F.lit(last).cast("date"))
    if YEAR_PART in df.columns:
        inside = inside & (F.col(YEAR_PART) >= int(first[:4]))
        if last is not None:
            inside = inside & (F.col(YEAR_PART) <= int(last[:4]))
    return inside


def temporal_split(df: DataFrame, test_from: str, test_until: str, val_from: str, ds: str = "ds", later: str | None = None) -> DataFrame:
    """Adds ``split``: test inside the test period, else val from ``val_from``, else train.

    Rows after the test period are validation rows too, unless ``later`` names a part of their own: then no fit
    sees what comes after the test. :func:`learned_from` gives the rows to fit on, :func:`part_rows` one part.
    """
    in_test, in_val = dates_between(df, test_from, test_until, ds), dates_between(df, val_from, None, ds)
    label = F.when(in_test, "test")
    if later is not None:
        label = label.when(F.col(ds) > F.lit(test_until).cast("date"), later)
    return usable(df).withColumn("split", label.when(in_val, "val").otherwise("train"))


def learned_from(split: DataFrame) -> DataFrame:
    """Training and validation rows."""
    return split.where(F.col("split").isin("train", "val"))


def part_rows(split: DataFrame, part: str, test_from: str, test_until: str, val_from: str, ds: str = "ds") -> DataFrame:
    """The rows of one part, with the dates that it lies between told to the scan."""
    first, last = {"test": (test_from, test_until), "val": (val_from, None)}.get(part, (None, None))
    rows = split.where(F.col("split") == part)
    return rows if first is None else rows.where(dates_between(split, first, last, ds))


def split_report(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.min("ds").alias("first"), F.max("ds").alias("last")
    )


def fold_table(df: DataFrame, folds: Sequence[Fold]) -> DataFrame:
    raw = literal_table(
        df.sparkSession, list(folds), "fold string, train_first string, train_last string, test_first string, test_last string"
    )
    return raw.select("fold", *[F.to_date(c).alias(c) for c in raw.columns[1:]])


def fold_rows(df: DataFrame, folds: Sequence[Fold], part: str, ds: str = "ds") -> DataFrame:
    """Rows of every fold's ``train`` or ``test`` period, both ends included.

    The folds are an array written in the program text, so a row is copied only to
    the folds that hold its date and nothing is shuffled.
    """
    first, last = (1, 2) if part == "train" else (3, 4)
    if not folds:
        return df.where(F.lit(False)).withColumn("fold", F.lit(None).cast("string"))
    df = df.where(dates_between(df, min(f[first] for f in folds), max(f[last] for f in folds), ds))
    listed = F.array(
        *[
            F.struct(
                F.lit(f[0]).alias("fold"),
                F.lit(f[first]).cast("date").alias("a"),
                F.lit(f[last]).cast("date").alias("b"),
            )
            for f in folds
        ]
    )
    held = F.filter(listed, lambda f: F.col(ds).between(f["a"], f["b"]))
    return df.withColumn("fold", F.explode(F.transform(held, lambda f: f["fold"])))


def fold_sizes(df: DataFrame, folds: Sequence[Fold], least_train: int = 500, least_test: int = 100) -> DataFrame:
    """Rows of each fold and whether it is large enough; counted per date first."""
    by_date = df.groupBy("ds").agg(F.count(F.lit(1)).alias("n"))
    table = F.broadcast(fold_table(df, folds))
    train = F.col("ds").between(F.col("train_first"), F.col("train_last"))
    test = F.col("ds").between(F.col("test_first"), F.col("test_last"))
    sizes = table.join(by_date, train | test, "left").groupBy("fold").agg(
        F.coalesce(F.sum(F.when(train, F.col("n"))), F.lit(0)).alias("train_rows"),
        F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0)).alias("test_rows"),
    )
    large = (F.col("train_rows") >= least_train) & (F.col("test_rows") >= least_test)
    return sizes.withColumn("kept", large)


def key_sizes(split: DataFrame, least_train: int = 100, least_val: int = 10) -> DataFrame:
    """Rows per key and whether the key is large enough for a model of its own."""
    sizes = split.groupBy("key").agg(
        F.count_if(F.col("split") == "train").alias("train_rows"),
        F.count_if(F.col("split") == "val").alias("val_rows"),
    )
    large = (F.col("train_rows") >= least_train) & (F.col("val_rows") >= least_val)
    return sizes.withColumn("kept", large)


def tail_cuts(df: DataFrame, folds: Sequence[Fold], fraction: float = 0.2, spec: SeriesSpec = SeriesSpec()) -> DataFrame:
    """The first validation row of every fold: ``fold, cut_ds, cut_<series...>``.

    The last ``fraction`` of a fold's training rows, by position in (ds, series)
    order, may begin inside a day. Counts per date find the day; only the rows of
    these few days are sorted, over all tasks, to find the row.
    """
    by_date = df.groupBy(spec.ds).agg(F.count(F.lit(1)).alias("n"))
    along = Window.partitionBy("fold").orderBy(spec.ds)  # one row per date
    upto = fold_rows(by_date, folds, "train", spec.ds).select(
        "fold",
        spec.ds,
        F.sum("n").over(along).alias("upto"),
        "n",
        F.sum("n").over(Window.partitionBy("fold")).alias("all"),
    )
    cut = F.floor(F.col("all") * F.lit(1 - fraction))
    days = upto.where((F.col("upto") > cut) & (F.col("upto") - F.col("n") <= cut)).select(
        "fold", F.col(spec.ds).alias("cut_ds"), (cut - (F.col("upto") - F.col("n"))).alias("inside")
    )
    days = F.broadcast(days)  # one row per fold
    wanted = F.broadcast(days.select("cut_ds").distinct())
    on_days = df.select(*spec.row_id).join(wanted, F.col(spec.ds) == F.col("cut_ds"), "left_semi")
    placed = with_global_position(on_days, spec.row_id, "_at")
    starts = placed.groupBy(spec.ds).agg(F.min("_at").alias("_first"))
    return (
        placed.join(F.broadcast(starts), spec.ds)  # one row per cut day
        .join(days, (F.col(spec.ds) == F.col("cut_ds")) & (F.col("_at") - F.col("_first") == F.col("inside")))
        .select("fold", "cut_ds", *[F.col(c).alias(f"cut_{c}") for c in spec.series])
    )


def tail_split(df: DataFrame, folds: Sequence[Fold], fraction: float = 0.2, spec: SeriesSpec = SeriesSpec()) -> DataFrame:
    """Training rows of every fold with ``is_val`` on the positional tail."""
    cuts = tail_cuts(df, folds, fraction, spec)
    here = F.struct(F.col(spec.ds).alias("a0"), *[F.col(c).alias(f"a{i + 1}") for i, c in enumerate(spec.series)])
    there = F.struct(F.col("cut_ds").alias("a0"), *[F.col(f"cut_{c}").alias(f"a{i + 1}") for i, c in enumerate(spec.series)])
    return (
        fold_rows(df, folds, "train", spec.ds)
        .join(F.broadcast(cuts), "fold")  # one row per fold
        .withColumn("is_val", here >= there)
        .drop(*[c for c in cuts.columns if c != "fold"])
    )
