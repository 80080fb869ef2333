"""The corpus pipeline: quality, near-duplicates, personal data, mixture, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the columns of ``docs``. ``run``
writes each result as Parquet in the shared folder and gives it to the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roamgrid.llm import minhash_dedup, mixing, packing, pii_crf, quality_gam
from roamgrid.llm.shared import table
from roamgrid.session import materialize

MIN_QUALITY = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least ``MIN_QUALITY``, from a model fitted to the labels outside fold 0.

    Null and empty texts are scored like texts without words, and repeated rows alike. The fit reads the documents of this stage.
    """
    model = quality_gam.train(docs, table(spark, sf_dir, "labels"))
    scored = quality_gam.score(docs, model, "__quality")
    return scored.filter(F.col("__quality") >= MIN_QUALITY).drop("__quality")


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, 0.8 or more): the one with the smallest id.

    Documents without words and rows without an id are kept. Of rows with equal id and equal words one is kept. Different texts of one id
    are judged each by its own group, so a text stays unless a copy or near copy of it stays.
    """
    kept = minhash_dedup.judged(docs, width=5).filter("kept").groupBy("doc_id", "high", "low").agg(F.min("print").alias("__print"))
    kept = kept.select(F.col("doc_id").alias("__kept"), "__print").distinct()
    named = docs.withColumn("__text", minhash_dedup.text_print(F.col("text")))
    one = named.join(kept, (F.col("doc_id") == F.col("__kept")) & (F.col("__text") == F.col("__print")), "left_semi")
    one = one.dropDuplicates(["doc_id", "__text"]).drop("__text")
    return one.unionByName(docs.filter("doc_id is null"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind and ``n_chars`` counted again where there is such a column."""
    masked = pii_crf.mask(docs, pii_crf.train(docs))
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the curriculum takes, one row per copy, in the order of their positions."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their bins, as ``packing.pack`` returns them."""
    return packing.pack(docs)


STAGES = [("quality", quality), ("near_duplicates", dedup), ("personal_data", personal_data), ("mixture", mixture),
          ("packing", pack)]

# No SQL states the classifier and the random field; tests compare the other stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
