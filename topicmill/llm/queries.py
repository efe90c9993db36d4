"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from topicmill.llm import alignment, decontamination, embedding_dedup, line_dedup, merkle, mixing, pii, quality
from topicmill.llm import set_join, substring_dedup, token_counts, url_filter, warc
from topicmill.llm.common import table


def op1_token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.with_token_counts(docs).select("doc_id", "n_tokens")


def op2_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("item_ids", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def op3_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return url_filter.judge(pages).select("page_id", "host", "path", "rule", "verdict")


def op4_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).drop("text", "lang", "source")


def op5_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_pii(docs)
    counts = [f"n_{k}" for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op6_ngram_join(spark, sf_dir):
    return set_join.link_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_embedding_dedup(spark, sf_dir):
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op8_substring_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = substring_dedup.remove_repeats(docs)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_warc(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "valid"]
    return warc.archive_round_trip(pages).select(*columns)


def op10_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "whole")


def op11_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    leaves = docs.select("doc_id", "source", merkle.leaf_digest().alias("leaf"), merkle.tampered_leaf().alias("claimed"))
    found = merkle.verify(merkle.manifest(leaves))
    proof = merkle.proof_digest(F.col("path")).alias("proof_sha256")
    return found.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", "verified")


def op12_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = line_dedup.dedup_lines(docs)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op13_tokenizer_alignment(spark, sf_dir):
    return alignment.align_tokenizers(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_decontamination": op2_decontamination,
    "op3_url_filter": op3_url_filter,
    "op4_quality": op4_quality,
    "op5_pii": op5_pii,
    "op6_ngram_join": op6_ngram_join,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_warc": op9_warc,
    "op10_mixing": op10_mixing,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_line_dedup": op12_line_dedup,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}
