"""The corpus pipeline: quality, near duplicates, benchmark leaks, mix, shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabloom.llm import classifier, decontaminate, mixing, near_dup, queries, resharding
from tabloom.llm.grams import stored
from tabloom.session import load, scratch_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier rejects go."""
    return classifier.keep_good(docs, classifier.fit(docs, queries.train_labels(spark, sf_dir)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return near_dup.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go."""
    return decontaminate.drop_leaks(docs, load(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it."""
    return mixing.mix_sources(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, from the rewritten shards, with its new shard and its slot there; the columns of the documents stay."""
    plan = resharding.reshard(resharding.sized(docs, queries.OLD_SHARDS), queries.OLD_SHARDS, queries.NEW_SHARDS)
    return resharding.resharded(spark, docs, plan, scratch_dir(spark, "resharded"))


STAGES = [
    ("quality classifier", quality),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("source mix", mix),
    ("shards", shards),
]

# Trained weights, signatures and rounding have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet and reread as the next one's input."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
