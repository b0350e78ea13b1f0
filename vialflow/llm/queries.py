"""Queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from . import sql
from .common import documents, table
from .exact_dedup import content_sort
from .jaccard_join import jaccard_components
from .lexical_search import search
from .main_text import extract
from .merkle import audited
from .packing import pack
from .quotations import link
from .sentence_pieces import encode
from .surrogates import with_surrogates
from .syncmers import fingerprints
from .url_filter import judge as judge_urls
from .toxicity import held_out, judge
from .training_order import materialise


def op1_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"), "training order").drop("folder")


def op2_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return link(table(spark, sf_dir, "conversations"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir), k=3, similarity="0.9").drop("node")


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_surrogates(documents(spark, sf_dir), counts="n_entities")


def op5_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, _, _ = judge(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), "threshold", "flagged")


def tokenizer_path(name: str) -> str:
    """A file of the installed public tokenizers."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op6_linear_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"), cap=2048, end_id=0)


def op7_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort(documents(spark, sf_dir))


def op8_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(documents(spark, sf_dir))


def op9_markov_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return judge_urls(table(spark, sf_dir, "pages"))


def op10_agenda(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"), digests=True)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audited(documents(spark, sf_dir))


def op12_term_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op13_cut_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return extract(table(spark, sf_dir, "pages"))


QUERIES = {
    "op1_training_order": op1_training_order,
    "op2_quotation_links": op2_quotation_links,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_surrogates": op4_surrogates,
    "op5_toxicity_cnn": op5_toxicity_cnn,
    "op6_linear_grouping": op6_linear_grouping,
    "op7_content_sort": op7_content_sort,
    "op8_closed_syncmers": op8_closed_syncmers,
    "op9_markov_urls": op9_markov_urls,
    "op10_agenda": op10_agenda,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_term_pipeline": op12_term_pipeline,
    "op13_cut_extraction": op13_cut_extraction,
}

SQL = {
    "op7_content_sort": sql.CONTENT_SORT,
    "op11_merkle_manifest": sql.MERKLE_MANIFEST,
    "op12_term_pipeline": sql.LEXICAL_SEARCH,
}
