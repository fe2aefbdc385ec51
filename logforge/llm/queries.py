"""The queries opN_<name>: each operator over its whole table, with its production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import held_out, score_toxicity

    scored = score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "matches")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_rules import apply_rules

    judged = apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix_sources

    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import repeated_lines

    found = repeated_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), "removed")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .license_scan import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard_join import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", F.col("n_links").alias("found_links"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import filter_urls

    return filter_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm_score import score_texts

    return score_texts(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontam import find_leaks

    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import repeated_bytes

    found = repeated_bytes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op11_ball_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ball_codes import codebooks_sha256, compress, label_errors

    coded, books = compress(table(spark, sf_dir, "embeddings"))
    return label_errors(coded).select("vec_id", "code", "error", "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256"))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .importance import resample

    drawn = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_circulant(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .circulant import near_copies

    return near_copies(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_quality_rules, op3_mix_sources, op4_line_dedup, op5_license_scan, op6_jaccard_join, op7_url_filter, op8_lm_score,
        op9_decontamination, op10_suffix_dedup, op11_ball_codes, op12_importance, op13_circulant,
    )
}
