"""One query per operator of this package, over the whole table, and the pipeline that joins five of them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline

from . import byte_bpe, conversations, embeddings, fingerprints, hard_negatives, licenses, ngram_join, packing, page_text, pii, substrings, toxicity, warc
from .common import table
from .oracles import ORACLE_SQL


def op4_embedding_near_dedup(spark, sf_dir):
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_byte_bpe(spark, sf_dir):
    return byte_bpe.round_trip_digests(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op1_warc(spark, sf_dir):
    index, folder = warc.archive_pages(table(spark, sf_dir, "pages"))
    return warc.read_records(index, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_license_notices(spark, sf_dir):
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op3_fingerprints(spark, sf_dir):
    return fingerprints.compare_edited(table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_substring_dedup(spark, sf_dir):
    return substrings.removal_digests(table(spark, sf_dir, "documents"))


def op8_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return pii.find_pii(docs, pii.fit_trees(docs))


def op9_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_model(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op10_ngram_join(spark, sf_dir):
    return ngram_join.join_documents(table(spark, sf_dir, "documents"))


def op11_page_text(spark, sf_dir):
    return page_text.extract_pages(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op12_hard_negatives(spark, sf_dir):
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op13_conversation_repair(spark, sf_dir):
    return conversations.repair_digests(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_warc": op1_warc,
    "op2_license_notices": op2_license_notices,
    "op4_embedding_near_dedup": op4_embedding_near_dedup,
    "op5_byte_bpe": op5_byte_bpe,
    "op3_fingerprints": op3_fingerprints,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_pii": op8_pii,
    "op9_toxicity": op9_toxicity,
    "op10_ngram_join": op10_ngram_join,
    "op11_page_text": op11_page_text,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_conversation_repair": op13_conversation_repair,
    "pipeline": corpus_pipeline.run,
}

if corpus_pipeline.ORACLE_SQL:
    ORACLE_SQL = {**ORACLE_SQL, "pipeline": corpus_pipeline.ORACLE_SQL}
