"""From raw documents to a training mix: the stages of the corpus pipeline.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is written and
read again before the next one.  All but the last return the columns of documents; the last one
gives its sample with each row's topic and inclusion probability.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loanscope.llm.common import land
from loanscope.llm.decontam import without_benchmark
from loanscope.llm.exact_dedup import keep_owners
from loanscope.llm.langid import identified
from loanscope.llm.mixing import sampled_mix
from loanscope.llm.simhash import RADIUS, SHINGLE_WORDS, keep_components
from loanscope.sources.tables import read_table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be determined go."""
    return identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id stays."""
    return keep_owners(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return keep_components(docs, SHINGLE_WORDS, RADIUS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without_benchmark(docs, read_table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sample whose expected tokens have the target source, language and topic marginals."""
    return sampled_mix(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
]

# Classifiers, tries, XXH64 and raking are not SQL: run() is tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = land(docs, f"pipeline-{name}")
    return docs
