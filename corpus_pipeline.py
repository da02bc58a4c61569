"""From documents to token ids: quality rules, near copies, secrets, source weights, pieces."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayloom.llm import mixing, pieces, quality, secrets, setjoin
from dayloom.llm.common import keep, table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep."""
    return quality.filter_documents(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of similar ones."""
    return setjoin.one_of_each(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked; ``n_chars`` follows the text."""
    return secrets.redact(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("bigint"), F.col("n_chars")))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of the sources takes it."""
    return mixing.mix_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the digest of the text they decode to."""
    return pieces.encode_documents(docs).drop("text")


STAGES = [
    ("quality rules", good_documents),
    ("n-gram Jaccard join", one_of_each),
    ("secret scans", without_secrets),
    ("mixing sources to target weights", mixed),
    ("SentencePiece encoding and decoding", encoded),
]
ORACLE_SQL = None  # learned rules, subset sums and pieces are beyond SQL; tests/llm/test_pipeline.py has plain Python for every stage


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
