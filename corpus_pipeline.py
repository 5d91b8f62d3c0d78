"""The corpus pipeline: documents through toxicity, near duplicates, decontamination, personal data and mixing.

Each stage takes (spark, docs, sf_dir), works on all that the one before kept, and
gives documents; ``run`` writes them to the shared folder and reads them back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwork.llm import decontamination, mixing, personal_data, simhash, toxicity
from quillwork.llm.common import table
from quillwork.session import materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the cut; null and blank texts are judged like any other."""
    model = toxicity.learned(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.toxic_score(F.col("text"), model) < toxicity.CUT)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints (three words, 2 of 64 bits); blank texts are one component."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind, n_chars as the new text has them."""
    return personal_data.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for; ``copy`` numbers the copies."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("personal_data", redact),
    ("mixing", mix_sources),
]
# Two stages rest on trained models and one on 64-bit hashes, which SQL cannot express; tests/llm/test_pipeline.py
# holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
