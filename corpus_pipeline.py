"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and
read again as the next one's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vialflow.llm.common import documents, stored, table
from vialflow.llm.exact_dedup import drop_copies
from vialflow.llm.jaccard_join import drop_near_copies
from vialflow.llm.packing import pack
from vialflow.llm.queries import tokenizer_path
from vialflow.llm.surrogates import with_surrogates
from vialflow.llm.toxicity import drop_toxic
from vialflow.session import ship_package


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    ship_package(spark)
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row of the smallest doc_id stays."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts linked by a Jaccard similarity of 0.8 or more on five-word
    shingles, the document of the smallest doc_id stays."""
    ship_package(spark)
    return drop_near_copies(docs, k=5, similarity="0.8")


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts become surrogates; n_chars follows the text."""
    return with_surrogates(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents placed in sequences of at most 2048 tokens."""
    ship_package(spark)
    return pack(docs, tokenizer_path("byte_bpe_50k.json"), cap=2048, end_id=0)


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("private_data", private_data), ("packing", packing)]

# a fitted classifier and a tokenizer cannot be written in SQL; tests/llm/test_pipeline.py
# compares every stage with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
