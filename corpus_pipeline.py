"""The corpus pipeline. Each stage reads what its predecessor wrote and does its work on all of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.mixing import mixed_documents
from quayside.llm.queries import tokenizer_path
from quayside.llm.sentencepiece_fst import encode_documents, read_model
from quayside.llm.simhash import drop_near_duplicates
from quayside.llm.substrings import dedup_substrings
from quayside.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier rejects go; it learns from the labels of those given."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return drop_near_duplicates(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that also stand earlier are cut out of the texts."""
    return dedup_substrings(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts become what the mix takes of them; documents it takes nothing of go."""
    return mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids and the number of fallback bytes of every text."""
    model = read_model(tokenizer_path("piece_bpe_32k.model"))
    coded = encode_documents(docs.select("doc_id", "source", "text"), model)
    return coded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "n_fallback")


STAGES = [
    ("toxicity", toxicity),
    ("simhash_near_dedup", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("source_mixing", source_mix),
    ("sentencepiece", token_ids),
]
# A classifier's fit and the mix's draws are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn. What a stage returns is written to the shared folder and read again."""
    from uuid import uuid4

    from quayside.session import shared_folder

    folder = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{number}-{name}")
            docs = spark.read.parquet(f"{folder}/{number}-{name}")
    return docs
