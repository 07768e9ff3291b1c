"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import bpe, decontaminate, exact_dedup, html_extract, language_id, license_scan, lm_score, near_dedup, secret_scan, toxicity
from .common import table


def op1_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_site_style_tree(spark, sf_dir):
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def op3_secret_scan(spark, sf_dir):
    return secret_scan.secret_summary(table(spark, sf_dir, "documents"))


def op4_license_scan(spark, sf_dir):
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


def op5_decontaminate(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_near_dedup(spark, sf_dir):
    return near_dedup.near_dedup(table(spark, sf_dir, "documents"))


def op7_byte_bpe(spark, sf_dir):
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op8_lm_score(spark, sf_dir):
    return lm_score.lm_score(table(spark, sf_dir, "documents"))


def op9_language_id(spark, sf_dir):
    return language_id.language_id(table(spark, sf_dir, "documents"))


def op10_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (op1_exact_dedup, op2_site_style_tree, op3_secret_scan, op4_license_scan, op5_decontaminate, op6_near_dedup, op7_byte_bpe, op8_lm_score, op9_language_id, op10_toxicity)}
ORACLES = {"op1_exact_dedup": exact_dedup.ORACLE}
