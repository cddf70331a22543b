"""The corpus pipeline: five stages from raw documents to a source mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents. A stage's result is written before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm.common import Stages, table
from contrail.llm.decontaminate import decontaminate
from contrail.llm.mixing import op10_query
from contrail.llm.quality import quality_filter
from contrail.llm.secrets import redacted
from contrail.llm.simhash import keep_one


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or whose host fails, go."""
    return quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least doc_id stays."""
    return keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are replaced by their kind; all documents stay."""
    out = redacted(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes from each document."""
    return op10_query(spark, docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("source_mix", source_mix),
]

#: Fingerprints and token counts have no SQL; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stages, docs, before = Stages(spark), table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = stages.keep(stage(spark, docs, sf_dir), name)
        if before:
            stages.drop(before)
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
