"""The registered queries: each operator over its whole table, with the columns of its contract; and their SQL."""

from __future__ import annotations

import string
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from clicklake.llm import bpe, chat, html, language, lexical, licenses, merkle, mixing, neighbours, packing, simhash, topk, toxicity
from clicklake.llm.common import remainder, ship, table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def llm_queries() -> dict[str, Query]:
    """All of them but the pipeline, which ``corpus_pipeline.py`` at the repository's top holds."""
    return dict(_QUERIES)


@_query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = remainder(F.col("doc_id"), 5) == 0
    model = toxicity.fit(docs, labels.where(~held_out))
    scored = toxicity.scored(docs, model)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@_query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@_query
def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan(table(spark, sf_dir, "documents")))


@_query
def op4_vector_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return neighbours.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))[0]


@_query
def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@_query
def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    draws, documents = mixing.mix(table(spark, sf_dir, "documents"))
    return mixing.taken(draws, documents)


@_query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@_query
def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    found = html.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@_query
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    network = language.fit(docs.where(~held_out))
    return language.identify(docs, network).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def _chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations, and one more whose texts look like control strings."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    own = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    return turns.unionByName(own).select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("parts"))


@_query
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digest(chat.read_back(chat.format_chats(_chats(spark, sf_dir))))


@_query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    return merkle.manifest(table(spark, sf_dir, "documents"), remainder(F.col("doc_id"), 5) == 0, lowered)


@_query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query
def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(bpe.VOCABULARY))
