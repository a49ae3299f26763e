"""The registered queries of the subpackage: each takes (spark, folder of tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from dimweave.llm import oracles
from dimweave.llm.common import read
from dimweave.llm.decontamination import contaminated, contamination
from dimweave.llm.html_extraction import extract
from dimweave.llm.hyperminhash import near_duplicates as near_duplicate_sets
from dimweave.llm.importance import resample
from dimweave.llm.neighbours import nearest
from dimweave.llm.packing import pack
from dimweave.llm.secrets import scan
from dimweave.llm.simhash import near_duplicates
from dimweave.llm.suffixes import repeated_passages
from dimweave.llm.token_counts import token_counts
from dimweave.llm.toxicity import fit, held_out, toxicity
from dimweave.llm.warc import read_back, write
from dimweave.llm.whitening import whiten
from dimweave.session import fresh_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = oracles.ORACLES


def query(build):
    QUERIES[build.__name__] = build
    return build


@query
def op1_html_extraction(spark, sf_dir):
    found = extract(read(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


@query
def op2_secret_scans(spark, sf_dir):
    return scan(read(spark, sf_dir, "documents"))


@query
def op3_simhash(spark, sf_dir):
    found = near_duplicates(read(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


@query
def op4_packing(spark, sf_dir):
    return pack(read(spark, sf_dir, "documents"))


@query
def op5_token_counts(spark, sf_dir):
    return token_counts(read(spark, sf_dir, "documents"))


@query
def op6_warc(spark, sf_dir):
    pages, folder = read(spark, sf_dir, "pages"), fresh_folder(spark, "warc")
    records = read_back(write(pages, folder), folder, payload=False)
    kind = pages.schema["page_id"].dataType
    return records.select(
        F.col("page").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers").cast(kind).alias("refers_to"),
    )


@query
def op7_suffix_array(spark, sf_dir):
    return repeated_passages(read(spark, sf_dir, "documents"))


@query
def op8_decontamination(spark, sf_dir):
    found = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
        "longest",
    )


@query
def op9_toxicity(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    scored = toxicity(docs, fit(docs, read(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "passages"
    )


@query
def op10_nearest_neighbours(spark, sf_dir):
    return nearest(read(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


@query
def op11_importance_resampling(spark, sf_dir):
    return resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op12_hyperminhash(spark, sf_dir):
    return near_duplicate_sets(read(spark, sf_dir, "documents"))


@query
def op13_embedding_whitening(spark, sf_dir):
    return whiten(read(spark, sf_dir, "embeddings"))


@query
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)
