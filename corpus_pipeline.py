"""The corpus pipeline over `documents`: each stage works on all rows its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kontor.llm import decontamination, langid, mixing, simhash, tokenfiles
from kontor.llm.frames import learn_rows
from kontor.llm.queries import tokenizer_path
from kontor.operators.sizing import written
from kontor.session import tune

# Documents count as near-duplicates by three-word shingles at this many bits or fewer.
SHINGLE, RADIUS = 3, 3


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those without letters or with a doubtful language go."""
    tune(spark)
    return langid.accepted(docs, langid.train(docs.filter(learn_rows(F.col("doc_id")))))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id."""
    tune(spark)
    return simhash.one_of_each(docs, size=SHINGLE, radius=RADIUS)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    tune(spark)
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    tune(spark)
    return mixing.mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the token files, read back."""
    tune(spark)
    files = tokenfiles.write_tokens(docs, tokenizer_path())
    return tokenfiles.read_back(spark, files).withColumnRenamed("key", "doc_id")


STAGES = [
    ("language ID", known_language),
    ("SimHash near-dedup", without_copies),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources to target weights", mixed),
    ("token-ID output", token_ids),
]

# SQL cannot express the language model or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each one's result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
