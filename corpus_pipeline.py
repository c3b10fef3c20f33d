"""A training corpus from documents: five stages, each an operator of ``cadence.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's documents. All but the last return the
columns of documents; the last has one row per emitted copy, with the number ``copy``.
The stages' decisions take effect on whole documents: the language and quality filters
and the decontamination drop documents, near-duplicates keep the document with the
smallest id of each group, and the mix repeats or leaves out documents.

Nulls, empty and long texts, repeated rows, empty tables and extra columns behave as the
operators' docstrings say; extra columns are handed through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.llm import decontam, langid, mixing, quality, simhash
from cadence.llm.common import id_hash, prepare, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the corpus's languages; texts without a letter and texts
    unlike every language go. Learns as query op4 does."""
    model = langid.learn(docs, id_hash(F.col("doc_id")) % 3 != 1)
    return langid.keep(docs, model)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least the threshold. Learns as op9 does."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.learn(docs, labels, id_hash(F.col("doc_id")) % 5 != 0, meta=["n_chars"])
    return quality.keep(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: 3-word shingles, 3 bits."""
    return simhash.keep_one(docs, size=3, max_bits=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an occurrence of a benchmark window."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every document once per copy."""
    return mixing.emit(docs)


STAGES = [
    ("language_id", language_id),
    ("quality_filter", quality_filter),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
]

#: XXH64 fingerprints and fitted classifiers have no SQL form; tests/llm compares the
#: first two stages with scores of each text alone, near_dedup with brute force and the
#: last two with OP8_SQL and OP7_SQL over their own input.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies ``STAGES`` to the documents of ``sf_dir``."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
