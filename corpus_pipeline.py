"""The training-corpus pipeline: five stages over `documents`, each one operator of tidegauge.llm.

Every stage gets what the one before it kept and returns the columns of documents; the last
returns one row for each document of the token files. `run` writes each stage's result to the
shared folder and hands the written table on, so a lost executor costs at most one stage's
tasks. Stages keep clean documents: each removes only what its operator decides against.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.decontaminate import contaminated, find_items
from tidegauge.llm.mixing import mix, repeated
from tidegauge.llm.quality import score_quality
from tidegauge.llm.queries import quality_rules, tokenizer_path
from tidegauge.llm.simhash import keep_one
from tidegauge.llm.token_files import read_token_files, write_token_files
from tidegauge.session import scratch_path, ship_package, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble predicts to be of quality 1."""
    ship_package(spark)
    scored = score_quality(docs, quality_rules(spark, docs.select("doc_id", "text"), sf_dir))
    return scored.filter(F.col("predicted") == 1).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of smallest id, of each group of near-duplicates."""
    ship_package(spark)
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words is benchmark text."""
    ship_package(spark)
    found = find_items(docs, table(spark, sf_dir, "benchmark"))
    return found.filter(~contaminated(F.col("n_words"), F.col("n_hit"))).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's share asks for; repeats are equal rows."""
    return repeated(mix(docs), docs.columns)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32, read back from the written token files."""
    ship_package(spark)
    path = scratch_path(spark, "token-files")
    write_token_files(docs, path, tokenizer_path())
    return read_token_files(spark, path)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_files", token_files),
]

#: Trained rules, XXH64 fingerprints and tokens are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
