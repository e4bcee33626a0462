"""The corpus pipeline: stages of the text operators, one after the other, over ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seasonflow.llm.bpe import token_stage
from seasonflow.llm.common import table
from seasonflow.llm.decontaminate import decontamination_stage
from seasonflow.llm.pii import mask_stage
from seasonflow.llm.quality import quality_stage
from seasonflow.llm.simhash import near_duplicate_stage
from seasonflow.session import delete_path, scratch_path, scratch_scope

STAGES = [
    ("quality_rules", quality_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("pii_masking", mask_stage),
    ("byte_bpe", token_stage),
]
#: Estimates, fingerprints and merges have no SQL: tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each stage is written and read again by the next one.

    A stage's own scratch tables, and what the stage before it wrote, are deleted once its result is written.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before is not None:
            delete_path(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
