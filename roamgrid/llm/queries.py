"""The registered queries of this subpackage: thin digests of the operators, by their contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roamgrid.llm import (embedding_forest, knn_join, minhash_dedup, mixing, packing, pii_crf, quality_gam, prefix_trie,
                          repair_dawg, secret_entropy, sharding, toxicity_cnn, url_rules)
from roamgrid.llm.oracles import ORACLES  # noqa: F401
from roamgrid.llm.shared import table

QUERIES = {}



def query(build):
    QUERIES[build.__name__] = build
    return build


@query
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii_crf.spans(docs, pii_crf.train(docs))


@query
def op2_embedding_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_forest.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_rules.judge(pages, url_rules.page_labels(pages, table(spark, sf_dir, "labels")))


@query
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(table(spark, sf_dir, "documents"))


@query
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


@query
def op7_knn_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn_join.search(table(spark, sf_dir, "embeddings"))


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_gam.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_cnn.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


@query
def op12_repair_dawg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_dawg.damage_and_repair(table(spark, sf_dir, "conversations"))


@query
def op13_secret_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_entropy.scan(table(spark, sf_dir, "documents"))
