"""The corpus pipeline: filters, cleans and packs the documents table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, packing, secrets, simhash, toxicity
from tessera.llm.common import fresh, prepare, table
from tessera.llm.queries import tokenizer_path
from tessera.session import materialize, release, tables_written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity reaches the rejection mark go."""
    rated, name = toxicity.rate(docs, table(spark, sf_dir, "labels"))
    return rated.where(~toxicity.toxic(name)).drop(name)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too much of the benchmark go."""
    name = fresh(docs, "contamination")
    marked = decontaminate.mark(docs, table(spark, sf_dir, "benchmark"), name)
    return marked.where(~decontaminate.contaminated(name)).drop(name)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in its text are replaced."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("simhash_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack),
]

# Regression, fingerprints and packing have no SQL form; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written and reread by the next; what a stage has read goes once it is written."""
    docs = table(prepare(spark), sf_dir, "documents")
    before = tables_written(spark)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
        release(spark, before, newest=1)
    return STAGES[-1][1](spark, docs, sf_dir)
