"""A training corpus from raw documents: what is toxic goes, one of each group of near copies stays, test passages
go, sources are mixed to their weights, and the rest becomes token files in the order of training.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but the last
return the columns of the documents. A document may occur several times after mixing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listloom.llm import decontaminate, jaccard, mixing, tokens, toxicity
from listloom.llm.queries import vocabulary
from listloom.session import shared_folder


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the model, trained on the labelled ones among them, does not call toxic."""
    return toxicity.clean_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the documents that are linked by their shingles, the one with the smallest id."""
    return jaccard.one_per_component(docs)


def without_test_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of which less than a twentieth stands in a benchmark's windows."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them, in order of training."""
    return mixing.mix_documents(docs)


# Pieces that a worker of the last stage keeps, and bytes of texts that it encodes at once: fewer than alone, as its
# executor's heap has grown in the stages before.
KEPT, AT_ONCE = 50_000, 1 << 20


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the order of training, and a row for each document in them.

    The mix wrote its rows in that order: by the number of the part, and in it from the first row on.
    """
    place = "_metadata.file_name", "_metadata.row_index"
    rows = docs.select("doc_id", "text", *[F.col(c).alias(n) for c, n in zip(place, ("file", "row"), strict=True)])
    rows = rows.withColumn("part", F.regexp_extract("file", r"part-(\d+)", 1).try_cast("long"))
    return tokens.token_report(rows, vocabulary(), order=["part", "file", "row"], kept=KEPT, at_once=AT_ONCE)


STAGES = [
    ("toxicity", reject_toxic),
    ("jaccard", one_of_each_group),
    ("decontamination", without_test_passages),
    ("mixing", mixed),
    ("tokens", as_tokens),
]

# Scores of a trained model and ids of a tokenizer are beyond SQL; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written to the shared folder and read by the next stage."""
    folder = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
