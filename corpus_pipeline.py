"""The corpus pipeline: documents to packed training sequences, stage by stage.

Each stage works on what its predecessor kept and, but for the last, returns the columns of
documents. Rows of any content are handled: a null text has no words and goes at the first
stage; repeated rows are copies of each other, of which near-dedup keeps one; columns
beyond those of documents are carried along untouched, whatever they are called; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import decontamination, language_id, packing, quality_rules, simhash
from shelfcast.llm.queries import vocabulary
from shelfcast.session import stage


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a quality rule go."""
    return quality_rules.keep_quality(docs)


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of no learned language go; the models learn from the labelled rows here.

    The bound on the score is low: texts of two languages are not clean of one, but clean.
    Foreign texts and gibberish get high scores too, and go by their evidence.
    """
    labelled = docs.filter(language_id.training_rows(F.col("doc_id")))
    model, evidence = language_id.fit(labelled), language_id.fit_evidence(labelled)
    return language_id.keep_languages(docs, model, least=0.3, evidence=evidence)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that of the smallest doc_id: a group is linked by
    SimHash fingerprints of three-word shingles that differ in at most two bits."""
    return simhash.keep_one(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; shorter passages are cut out of the others."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.decontaminate(docs, items)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents with their place in a training sequence."""
    return packing.pack_documents(docs, vocabulary())


STAGES = [
    ("quality rules", rules),
    ("language ID", languages),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_passages),
    ("best-fit packing", sequences),
]

ORACLE_SQL = None  # SQL can express neither the trained model nor the fingerprints


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn over the whole table; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
