"""A corpus pipeline of five operators; each stage takes and returns a table of documents, and the
last one returns where the tokens of what is left are packed.

Every stage works on all rows its predecessor kept.  Null and empty texts pass the filters, unless
they are copies of each other; repeated rows are copies.  Extra columns are carried along.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimweave.llm.common import materialize, read
from dimweave.llm.decontamination import remove_contaminated
from dimweave.llm.near_copies import keep_one
from dimweave.llm.packing import pack
from dimweave.llm.secrets import redact
from dimweave.llm.toxicity import fit, remove_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model scores 0.5 or more go."""
    return remove_toxic(docs, fit(docs, read(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (similarity of five-word shingles 0.8 or more) the document with
    the smallest id stays."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return remove_contaminated(docs, read(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked, with `n_chars` to match; all documents stay."""
    clean = redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    kind = docs.schema["n_chars"].dataType
    size = F.coalesce(F.length("text").cast(kind), F.col("n_chars"))
    return clean.withColumn("n_chars", size).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each piece of each document in windows of 2048 tokens."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]

# Most stages cannot be put in SQL; tests/llm/test_pipeline.py holds them against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
