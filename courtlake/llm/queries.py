"""The registered queries of this subpackage: (spark, sf_dir) to a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtlake.llm import (
    bagminhash, conversations, cover_tree, hidden_markov, kneser_ney, manifest, mixing, packing,
    personal_data, sharding, toxicity, vector_file, warc,
)
from courtlake.llm.common import table


def op1_vector_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_file.top_k(table(spark, sf_dir, "embeddings"))


def op2_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hidden_markov.score(table(spark, sf_dir, "documents"))


def op3_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many tokens as there are; sources within 97 % of the highest entropy, twice at most."""
    documents = table(spark, sf_dir, "documents")
    tokens = documents.agg(F.sum(mixing.token_count(F.col("text")))).first()[0] or 0
    mixed = mixing.mix(documents, target_entropy=0.97, max_repeats=2.0, budget_tokens=tokens)
    return mixed.select(
        "doc_id", "source", "n_tokens", "source_weight", "epoch", "block_order", "document_order")


def op5_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op7_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return toxicity.score(documents, toxicity.fit(documents, table(spark, sf_dir, "labels")))


def op9_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.similar_vectors(table(spark, sf_dir, "embeddings"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.find(table(spark, sf_dir, "documents"))


def op11_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_digest(table(spark, sf_dir, "documents"))


def op12_persistent_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.audit_repairs(table(spark, sf_dir, "conversations"))


def op13_butterfly_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.tamper_check(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_vector_file": op1_vector_file,
    "op2_hidden_markov": op2_hidden_markov,
    "op3_bagminhash": op3_bagminhash,
    "op4_temperature_mixing": op4_temperature_mixing,
    "op5_best_two_fit": op5_best_two_fit,
    "op6_warc": op6_warc,
    "op7_kneser_ney": op7_kneser_ney,
    "op8_toxicity": op8_toxicity,
    "op9_cover_tree": op9_cover_tree,
    "op10_personal_data": op10_personal_data,
    "op11_feistel_sharding": op11_feistel_sharding,
    "op12_persistent_audit": op12_persistent_audit,
    "op13_butterfly_manifest": op13_butterfly_manifest,
}
