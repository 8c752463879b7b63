"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import embedding_whitening, exact_topk, jaccard_join, language_id, mixing, quality_rules, quality_votes, secrets, sentence_pieces, spelling_variants, token_files, toxicity, url_filters
from ledgerlens.llm.common import table
from ledgerlens.session import work_folder

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents"))


def op2_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return sentence_pieces.digest(table(spark, sf_dir, "documents"), path)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mixed(docs).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = table(spark, sf_dir, "documents")
    return token_files.digest(docs, path, 2, work_folder(spark, "token-files"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = jaccard_join.joined(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_shingles", "component_id")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.digest(table(spark, sf_dir, "documents"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(url_filters.RULES, "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filters.judged(pages, rules).drop("url")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.digest(table(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_whitening.digest(table(spark, sf_dir, "embeddings"))


def op13_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_votes.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_sentence_pieces, op3_secrets, op4_toxicity, op5_exact_topk, op6_mixing, op7_token_files,
        op8_jaccard_join, op9_language_id, op10_url_filters, op11_spelling_variants, op12_embedding_whitening, op13_quality_votes,
    )
}
SQL: dict[str, str] = {
    "op1_quality_rules": quality_rules.JUDGED_SQL,
    "op5_exact_topk": exact_topk.SQL,
    "op8_jaccard_join": jaccard_join.SQL,
    "op10_url_filters": url_filters.SQL,
    "op11_spelling_variants": spelling_variants.SQL,
}
