"""A training-data pipeline over ``documents``, built of five of the operators.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``; all but the last
return the columns of ``documents``.  Each row is judged by its own text, whether
its doc_id is null, repeated or unique; empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabline.llm import decontam, hamming, quality, queries, surrogates
from cabline.llm._common import TEXT_COMPRESSION, cut, release, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the likelihood ratio go."""
    judged = quality.quality_rules(docs, table(spark, sf_dir, "labels"), carry="row")
    return judged.where("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, of similarity 0.8 or more, stays: the one
    with the smallest id, a row without an id only if all are.  Rows without words are in
    no group and stay."""
    # numbered in a table of their own: no later reading can number them otherwise
    rows = cut(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered-rows",
               TEXT_COMPRESSION)
    linked = hamming.near_duplicates(rows, id_col="__row").select(
        F.col("doc_id").alias("__row"), "component_id")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "__row")
    # as many groups as documents: one plan at every size
    first = (rows.select("__row", "doc_id").join(linked.hint("merge"), "__row")
             .groupBy("component_id").agg(F.min_by("__row", order).alias("__row")))
    # the shuffles so far can go before the texts are shuffled
    first = cut(first.select("__row"), "kept-rows")
    release(spark)
    return (rows.join(first.hint("merge"), "__row", "left_semi")
            .select(*docs.columns))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold enough of benchmark items go."""
    found = decontam.find_contamination(docs, table(spark, sf_dir, "benchmark"), carry="row")
    return found.where("not contaminated").select("row.*")


def replace_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets are replaced; n_chars follows the text."""
    out = surrogates.replace_pii(docs, queries.PII_KEY)
    kind = docs.schema["n_chars"].dataType
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                          .otherwise(F.length("text")).cast(kind))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return queries.packed(docs)


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates),
          ("decontaminate", decontaminate), ("replace_pii", replace_pii), ("pack", pack)]

#: models, hash digests of token ids and keyed surrogates are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
