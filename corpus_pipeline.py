"""A training corpus from raw documents, stage by stage.

Every stage takes (spark, docs, sf_dir), works on all that the one before kept, and returns the
columns of ``docs``; the last returns packed pieces. Nulls, empty tables, repeated rows and further
columns are handled as the operators' own descriptions say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from logspark.llm.common import saved, table
from logspark.llm.decontaminate import without_contaminated
from logspark.llm.packing import packed_documents
from logspark.llm.pii import replaced
from logspark.llm.quality import judge_quality
from logspark.llm.simhash import without_near_duplicates

#: Stands in for a secret that a real run gets from outside.
PII_KEY = "surrogates of the pipeline"
#: Fingerprints and learned ratios have no counterpart in SQL; tests compare the stages with plain Python.
ORACLE_SQL = None


def _with_rest(docs: DataFrame) -> DataFrame:
    """doc_id and text by fixed types, and all columns but the text as one, so that no name can clash."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.struct(*[F.col(c) for c in docs.columns if c != "text"]).alias("rest"),
    )


def _columns(docs: DataFrame, **new) -> list:
    return [new[c].alias(c) if c in new else F.col("text" if c == "text" else f"rest.{c}") for c in docs.columns]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or score too low go."""
    judged = judge_quality(_with_rest(docs), table(spark, sf_dir, "labels"))
    return judged.where("kept").select(*_columns(docs))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that links of at most three fingerprint bits make (three-word shingles), one document stays."""
    return without_near_duplicates(docs, shingle=3, distance=3)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item, or a whole shorter one, go."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become surrogates; ``n_chars`` follows the text."""
    return replaced(_with_rest(docs), PII_KEY).select(
        *_columns(docs, n_chars=F.length("text").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None)
    )


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of the documents in sequences of 2048, as op6 returns them."""
    return packed_documents(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    )


STAGES = [
    ("quality", quality_stage),
    ("near-duplicates", near_duplicate_stage),
    ("benchmark", benchmark_stage),
    ("personal-data", personal_data_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each reads what the one before wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
