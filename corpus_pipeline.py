"""The corpus pipeline: quality rules, quality classifier, line dedup,
SimHash near-dedup, packing. Every stage reads what its predecessor wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chirp.llm.common import stored, table
from chirp.llm.line_dedup import line_dedup
from chirp.llm.packing import pack
from chirp.llm.quality_classifier import classify, fit
from chirp.llm.quality_rules import quality_rules
from chirp.llm.simhash import keep_one


def stage_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-supervision verdict keeps."""
    return quality_rules(docs).filter("kept").select(*docs.columns)


def stage_quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts. It learns from the labelled
    rows of the whole corpus, as the stage before has taken bad ones out."""
    model = fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return classify(docs, model).filter("predicted = 1").select(*docs.columns)


def stage_line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the runs of lines that occur earlier."""
    return line_dedup(docs, whole=True).select(*docs.columns)


def stage_simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return keep_one(docs, words=3, max_bits=2)


def stage_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in the sequences."""
    return pack(docs, capacity=4096, end_id=2)


STAGES = [
    ("quality_rules", stage_quality_rules),
    ("quality_classifier", stage_quality_classifier),
    ("line_dedup", stage_line_dedup),
    ("simhash_dedup", stage_simhash),
    ("packing", stage_packing),
]

# EM, the trained classifier and the heaps are beyond SQL; the tests hold
# the pipeline against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
