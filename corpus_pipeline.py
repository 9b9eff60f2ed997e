"""A training corpus from documents: toxic texts and near duplicates go, repeated passages are cut, sources are mixed, sequences packed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluvion.llm import mixing, near_duplicates, packing, passages, toxicity
from fluvion.llm.common import stored, table


#: Columns of documents. Others go through the stages under names of their own, so that no operator's columns meet them.
OWN = ("doc_id", "text", "lang", "source", "n_chars")


def carried(docs: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """stage(docs) with all columns of docs."""
    names = {c: f"extra_column_{k}" for k, c in enumerate(docs.columns) if c not in OWN}
    out = stage(docs.withColumnsRenamed(names))
    return out.select(*(F.col(names.get(c, c)).alias(c) for c in docs.columns))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain rejects go.

    Null and empty texts stay, as do all without labels. Equal rows go or stay together; other columns pass through.
    """
    labels = table(spark, sf_dir, "labels")
    return carried(docs, lambda d: toxicity.score(d, labels).where(~F.col("rejected")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: that of the least id, null ids last.

    Rows equal in id and text are one group. Null, empty and blank texts have no words and stay. Other columns pass through.
    """
    return carried(docs, near_duplicates.keep_one)


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut out; texts without any stay as they are, null ones included. n_chars follows a text that was cut.

    Rows stay as many as they are; equal ones are each other's repeats. Other columns pass through.
    """
    cut = F.col("n_removed") > 0

    def remove(d: DataFrame) -> DataFrame:
        done = passages.remove_passages(d).withColumn("text", F.when(cut, F.col("kept")).otherwise(F.col("text")))
        return done.withColumn("n_chars", F.when(cut, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))

    return carried(docs, remove)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, with all its columns. Null texts have no words and are taken by their source's rate like others."""
    return carried(docs, lambda d: mixing.emit(mixing.mix(d)))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces and their places in sequences. A null text is an empty one and gives a piece of its end sign alone; an empty table gives an empty one."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("near duplicates", near_duplicate_stage),
    ("passages", passage_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Trained models, signatures and token ids have no SQL; tests/llm/test_pipeline.py holds every stage's rows against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written as Parquet and read again as the next stage's docs."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
