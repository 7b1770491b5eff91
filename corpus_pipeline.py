"""Corpus pipeline: quality filter, near- and exact-repeat removal, decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; every stage
works on what the stage before kept. All but the last return the columns of
``documents`` (``n_chars`` follows the text).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import discard, settle, table
from tessera.llm.op05_packing import pack_documents
from tessera.llm.op06_quality import fit_quality, quality_filter
from tessera.llm.op07_simhash import simhash_rows, text_hash
from tessera.llm.op09_suffix import suffix_dedup
from tessera.llm.op10_tiling import decontaminate
from tessera.llm.tokens import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the line CRF scores under 0.3. The labelled training texts come from ``docs``. A null text is
    scored as an empty one; null ids are scored like others."""
    return quality_filter(docs, fit_quality(docs, table(spark, sf_dir, "labels")), least=0.3).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of smallest id (then text hash) of every SimHash component, once; different texts under one
    id are documents of their own; rows without an id are in no group and stay."""
    rows = docs.withColumn("text_hash", text_hash())
    copies = simhash_rows(docs).where("doc_id <> component_id or text_hash <> component_text").select("doc_id", "text_hash")
    # Repeated rows go first, map-side: the one shuffle of the texts then serves the join with the slim keys too.
    named = rows.where("doc_id is not null").dropDuplicates(["doc_id", "text_hash"])
    named = named.join(copies.distinct(), ["doc_id", "text_hash"], "left_anti")
    return named.select(*COLUMNS).union(docs.where("doc_id is null").select(*COLUMNS))


def repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut bytes under repeated 200-byte strings; what a cut leaves of a character goes too. Emptied documents and null
    texts stay, empty."""
    found = suffix_dedup(docs, carry=("lang", "source"))
    text = F.col("kept").cast("string")
    whole = F.when(F.is_valid_utf8(text), text).otherwise(F.replace(F.make_valid_utf8(text), F.lit("\ufffd"), F.lit("")))
    return (found.select("doc_id", whole.alias("text"), "carry.lang", "carry.source")
            .withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that cover 0.8 or more of a benchmark item's words (a null or empty text covers nothing)."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of 2048 tokens (a null or empty text is its closing id alone)."""
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("quality classifier", quality), ("SimHash near-dedup", near_duplicates),
          ("suffix-array dedup", repeated_spans), ("benchmark decontamination", benchmark_passages),
          ("best-fit packing", packing)]

ORACLE_SQL = None  # tokens, line CRF and tiling have no SQL form; tests/llm checks the stages by brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read back."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        done = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return done
        done = settle(done)
        if k:
            discard(spark, docs)
        docs = done
