"""Registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convaudit.llm.align import cross_align
from convaudit.llm.bpe import encode_decode
from convaudit.llm.common import scratch, table
from convaudit.llm.embeddings import near_vectors
from convaudit.llm.html_text import extract_pages
from convaudit.llm.lines import dedup_units
from convaudit.llm.oracle import SQL as ORACLE_SQL  # noqa: F401  the entry point reads it here
from convaudit.llm.packing import pack
from convaudit.llm.quality import apply_rules
from convaudit.llm.secret_scan import BASE, scan_versions, spans_text, with_spans
from convaudit.llm.simhash import near_duplicates
from convaudit.llm.spelling import spelling_groups
from convaudit.llm.toxicity import fit, sample_labels, with_scores
from convaudit.llm.warc import read_archives, write_archives
from convaudit.llm.wordpiece import token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def held_out(key: str = "doc_id"):
    """Rows that no label is learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


def toxicity_model(spark: SparkSession, sf_dir: str):
    """A model learned from labelled documents that aren't held out."""
    labels = sample_labels(table(spark, sf_dir, "labels").where(~held_out()), "toxic")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fit(docs.join(F.broadcast(labels), "doc_id"), "toxic")  # at most 30,000 rows of two numbers


#: A text at or above this score is predicted toxic.
TOXIC = 0.3


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = with_scores(table(spark, sf_dir, "documents").select("doc_id", "text"), toxicity_model(spark, sf_dir))
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = apply_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = with_spans(docs, scan_versions(docs, scratch(spark, "secret-ledger")))
    count = lambda rule: F.size(F.filter("spans", lambda s: s.rule == rule)).cast("long").alias(f"n_{rule}")
    base = F.filter("spans", lambda s: s.rule.isin(*BASE))
    return out.select("doc_id", *[count(r) for r in BASE], F.sha2(spans_text(base), 256).alias("base_sha256"),
                      spans_text(F.col("spans")).alias("spans"))


@query
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "archives")
    write_archives(table(spark, sf_dir, "pages"), path)
    out = read_archives(spark, path, payloads=False)
    # a record that can't be read back must not vanish
    gap = F.raise_error(F.concat_ws(" ", F.lit("gap in the archive:"), "file", "offset", "size", "error"))
    return out.select(F.when(F.col("error").isNull(), F.col("key").cast("long")).otherwise(gap).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                      F.col("refers_to").cast("long").alias("refers_to"))


@query
def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_units(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.array_join(F.transform("removed", lambda s: F.concat_ws(":", s.start, s.end)), ",")
    return out.select("doc_id", "text", "n_units", "n_removed", spans.alias("removed"))


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op11_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract_pages(table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


@query
def op13_cross_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = cross_align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                      public_tokenizers.path("piece_bpe_32k.model"), groups=lambda g: F.sha2(g, 256))
    return out.withColumnRenamed("groups", "groups_sha256")
