"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerflow.llm import (ann, audit, chat, decontaminate, htmltext, langid, licenses, linededup, manifest, neardup,
                            packing, pii, substring)
from ledgerflow.llm.common import read_table


def op1_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


def op2_language_id(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return langid.identify_language(docs).select(
        "doc_id", langid.held_out_column().alias("held_out"), "lang_pred", "score")


def op3_personal_data(spark, sf_dir):
    return pii.span_digest(pii.find_personal_data(read_table(spark, sf_dir, "documents")))


def op4_substring_dedup(spark, sf_dir):
    return substring.removal_digest(read_table(spark, sf_dir, "documents"))


def op5_nearest_neighbours(spark, sf_dir):
    rows = read_table(spark, sf_dir, "embeddings")
    return ann.nearest_neighbours(rows, rows.filter(F.col("vec_id") % 50 == 0))


def op6_license_scan(spark, sf_dir):
    return licenses.scan_licenses(licenses.document_paths(read_table(spark, sf_dir, "documents")))


def op7_decontamination(spark, sf_dir):
    return decontaminate.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op8_minhash_near_dedup(spark, sf_dir):
    return neardup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op9_line_dedup(spark, sf_dir):
    return linededup.remove_common_lines(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "text", "n_lines", "n_removed")


def op10_html_text(spark, sf_dir):
    return htmltext.extract_text(read_table(spark, sf_dir, "pages"))


def op11_merkle_manifest(spark, sf_dir):
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    found = manifest.tamper_audit(read_table(spark, sf_dir, "documents"), tampered)
    return found.select("doc_id", "leaf", "subroot", "root", manifest.proof_digest(F.col("proof")).alias("proof_sha256"),
                        "folded_root", "verified")


def op12_filter_audit(spark, sf_dir):
    return audit.interaction_audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op13_chat_formatting(spark, sf_dir):
    turns = chat.control_conversation(read_table(spark, sf_dir, "conversations"))
    return chat.read_back(chat.format_conversations(turns))


QUERIES = {f.__name__: f for f in (
    op1_best_fit_packing, op2_language_id, op3_personal_data, op4_substring_dedup, op5_nearest_neighbours,
    op6_license_scan, op7_decontamination, op8_minhash_near_dedup, op9_line_dedup, op10_html_text,
    op11_merkle_manifest, op12_filter_audit, op13_chat_formatting)}
