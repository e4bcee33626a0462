"""Session helpers: settings, reliable checkpoints, literal tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benches; on a cluster the submitter sets these."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("seasonflow")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder: the session's own, or a temporary one when local."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        configured = tempfile.mkdtemp(prefix="seasonflow-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def delete_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder on whatever store Spark reads it from."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


#: Folders of the open scopes, the innermost last; threads of one job share them.
_scopes: list[str] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """Scratch tables made inside go into one folder, which is deleted at the end.

    What is to outlive the scope must have been written elsewhere by then: a DataFrame
    that still reads a settled table fails after it.
    """
    folder = scratch_path(spark, "scope")
    _scopes.append(folder)
    try:
        yield folder
    finally:
        _scopes.remove(folder)
        delete_path(spark, folder)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table: in the innermost open scope, else beside the checkpoints."""
    return f"{_scopes[-1] if _scopes else shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Computes ``df`` once into a table in the shared folder and reads it back.

    The lineage ends here, so a lost executor costs no earlier work, and later reads
    are columnar. A checkpoint would compute the last stage twice.
    """
    path = scratch_path(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table written out in the program: its size is that of the source text,
    so it may be broadcast whatever the size of the data."""
    return spark.createDataFrame(rows, schema)
