"""Writing tables and models, and publishing a set of artefacts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from seasonflow.operators import trees
from seasonflow.operators.trees import TreeModel
from seasonflow.session import literal_table
from seasonflow.spec import SeriesSpec


def write_by_year(df: DataFrame, path: str, spec: SeriesSpec = SeriesSpec()) -> None:
    """Parquet by year, sorted by (ds, series) over range partitions.

    Ranges follow the full row id, so neither a long year nor a large key makes one
    large task; files of one year hold narrow date ranges that scans can skip.
    """
    (
        df.withColumn("year_part", F.year(spec.ds))
        .repartitionByRange(*spec.row_id)
        .sortWithinPartitions(*spec.row_id)
        .write.mode("overwrite")
        .partitionBy("year_part")
        .parquet(path)
    )


def write_predictions(preds: DataFrame, path: str) -> None:
    preds.write.mode("overwrite").partitionBy("model").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> DataFrame:
    """Writes JSON lines, reads them back and checks that every row is there."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").json(path)
    back = df.sparkSession.read.schema(df.schema).json(path)
    wrote, read = seen.get["rows"], back.count()
    if wrote != read:
        raise IOError(f"{path}: wrote {wrote} rows, read back {read}")
    return back


def save_model(model: PipelineModel | TreeModel, path: str) -> None:
    """A pipeline in Spark's own format, boosted trees as a table of them."""
    if isinstance(model, TreeModel):
        trees.model_table(SparkSession.active(), {"": model}).coalesce(1).write.mode("overwrite").parquet(path)
    else:
        model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_trees(spark: SparkSession, path: str) -> TreeModel:
    """The one model of boosted trees that :func:`save_model` stored."""
    return trees.model_of(spark.read.schema(trees.SCHEMA).parquet(path))


def save_models(models: DataFrame, path: str) -> None:
    """The table of the models of many keys, however many: one write."""
    models.write.mode("overwrite").parquet(path)


def load_models(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(trees.SCHEMA).parquet(path)


@dataclass(frozen=True)
class Artefact:
    """A table to publish: ``table`` is None where it was not produced."""

    name: str
    table: DataFrame | None
    place: str
    layout: str = "parquet"
    partition: Sequence[str] = ()


def publish(spark: SparkSession, artefacts: Sequence[Artefact], root: str) -> DataFrame:
    """Writes each artefact under its own prefix; a missing or failing one does not
    stop the others. Returns ``name, path, rows, status``."""
    report = []
    for a in artefacts:
        path = f"{root.rstrip('/')}/{a.place}"
        if a.table is None:
            report.append((a.name, path, None, "skip"))
            continue
        try:
            writer = a.table.write.mode("overwrite").option("header", True)
            if a.partition:
                writer = writer.partitionBy(*a.partition)
            writer.format(a.layout).save(path)
            rows = spark.read.format(a.layout).option("header", True).load(path).count()
            report.append((a.name, path, rows, "ok"))
        except Exception as problem:  # reported per item, as the caller decides
            report.append((a.name, path, None, f"error: {type(problem).__name__}"))
    return literal_table(spark, report, "name string, path string, rows long, status string")
