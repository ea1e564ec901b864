"""The corpus pipeline: quality rules, near duplicates, secrets, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the next one's
docs. All stages but the last return the columns of documents. Rows a stage keeps are whole rows; the quality
stage drops what its rules reject, the near-duplicate stage keeps one document of each group of Jaccard similarity 0.8 or more, the secrets stage
replaces found spans inside texts, the mixing stage repeats or drops documents to meet source targets, and the
packing stage returns the placement of every token piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rulelode.llm import _util as ut
from rulelode.llm import mixing, neardup, packing, quality, secrets


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.quality_filter(docs, quality.fit(docs, ut.table(spark, sf_dir, "labels")))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.deduplicate(docs, neardup.STAGE_PERCENT)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.draw(docs)


def packing_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules), ("MinHash near-dedup", minhash_near_dedup), ("secret scans", secret_scans),
    ("mixing sources to target weights", mixing_sources), ("packing", packing_windows),
]

#: The method-specific verdicts of the stages are no SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir; each stage's rows are written below the shared folder in between."""
    docs = ut.table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = ut.materialize(docs, "stage")
    return docs
