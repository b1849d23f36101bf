"""The corpus pipeline: stages of `riskweave.llm` operators over documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which `run`
writes to the shared folder and reads again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskweave.llm import stages
from riskweave.llm.common import stored, table

STAGES = stages.STAGES

#: SQL can express neither the trained classifiers nor the fingerprints' components.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
