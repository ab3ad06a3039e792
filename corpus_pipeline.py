"""The corpus pipeline: documents through five operators of ``scrimtally.llm``.

Each stage reads what its predecessor kept, as written Parquet. All but the last
return the columns of ``documents``: toxic documents go, one document of each
group of near duplicates stays, documents with a benchmark passage go, personal
data is masked, and the last stage encodes what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scrimtally.llm import decontamination, near_duplicates, pii, sentencepiece, toxicity
from scrimtally.llm.base import stored, table
from scrimtally.llm.queries import model_path


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component."""
    return near_duplicates.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked and ``n_chars`` counted anew."""
    return pii.mask_documents(docs)


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: number of ids, digests of the ids and of the decoded text."""
    return sentencepiece.token_digests(docs, model_path())


STAGES = [
    ("toxicity", toxicity_stage),
    ("near duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("sentencepiece", sentencepiece_stage),
]
# models and hashes can't be expressed in SQL; the tests hold each stage against a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
