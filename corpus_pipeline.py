"""From raw documents to a training mix, in stages that each work on what the one before kept."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from rillstone.llm import decontam, jaccard, line_dedup, mixing, quality
from rillstone.llm.common import CLEANUP, discard
from rillstone.session import written

#: no SQL: line matching and the mix's schedule are not expressible in it
ORACLE_SQL = None


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def stage(fn: Stage) -> Stage:
    """A stage begins when the one before has been written: what that one wrote for itself goes, and from here on the
    session removes the shuffle files of a result as soon as it is written."""

    @wraps(fn)
    def begin(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        discard(spark)
        spark.conf.set(CLEANUP, "true")
        return fn(spark, docs, sf_dir)

    return begin


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or a certified cutoff rejects go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@stage
def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of lines that repeat an earlier one go, and documents of which no word is left."""
    return line_dedup.drop_repeated_lines(docs, emptied=False)


@stage
def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    return jaccard.keep_one(docs)


@stage
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a word window of a test item go."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@stage
def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document that it takes words of, and how many (repeats counted)."""
    return mixing.mix_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_deduplication),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", mixing_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, run_stage in STAGES:
        docs = run_stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs, name.replace(" ", "-"))
    return docs
