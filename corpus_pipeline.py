"""The corpus pipeline: toxicity, SimHash near-dedup, substring dedup, secret scans, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's ``docs``. All but the last return the
columns of ``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convaudit.llm.common import scratch, stored, table
from convaudit.llm.lines import dedup_units
from convaudit.llm.packing import pack
from convaudit.llm.queries import TOXIC, toxicity_model
from convaudit.llm.secret_scan import masked, scan_versions, with_spans
from convaudit.llm.simhash import near_duplicates
from convaudit.llm.toxicity import with_scores

#: SQL can't express the classifier, the fingerprints or the tokenizer; tests hold the rows against a plain version.
ORACLE_SQL = None


def with_length(docs: DataFrame, columns: list[str]) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast("long")).select(*columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    scored = with_scores(docs, toxicity_model(spark, sf_dir))
    return scored.where(F.col("score") < TOXIC).drop("score")


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays: the smallest id's, of several texts that of the smallest hash.

    A null id comes after all others, so of a group of null ids alone one row stays
    too. Of rows equal in id and text any one stays.
    """
    own = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", F.xxhash64("text").alias("of"))
    kept = near_duplicates(docs.select(own.alias("own"), "text"), key="own").where("own <=> component_id")
    kept = stored(kept.groupBy("own").agg((F.count(F.lit(1)) > 1).alias("__many")).select(
        F.col("own.doc_id").alias("__id"), F.col("own.of").alias("__of"), "__many"), "representatives")
    rows = docs.join(kept, docs.doc_id.eqNullSafe(kept["__id"]) & (F.xxhash64(docs.text) == kept["__of"]))
    # texts are shuffled only where rows repeat
    once = rows.where("not __many").unionByName(rows.where("__many").dropDuplicates(["__id", "__of"]))
    return once.select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; a document that loses all its text goes with them."""
    left = dedup_units(docs).where(~((F.col("n_removed") > 0) & F.coalesce(F.trim("text") == "", F.lit(False))))
    return with_length(left, docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked."""
    found = with_spans(docs, scan_versions(docs, scratch(spark, "secret-ledger")))
    return with_length(found.withColumn("text", masked("text", "spans")), docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their token ids."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", toxicity), ("simhash", simhash_dedup), ("lines", line_dedup), ("secrets", secret_scan), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
