"""The corpus pipeline: documents through five stages, each written and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logforge.scale import work_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.3; the labels teach, as far as they are not held out."""
    from logforge.llm.common import ship
    from logforge.llm.toxicity import score_toxicity

    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = score_toxicity(docs, labels, keep=COLUMNS, carry_text=True)
    return scored.where(F.col("predicted") == 0).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier one repeats; n_chars follows the text."""
    from logforge.llm.line_dedup import drop_repeated_lines

    return drop_repeated_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates; rows without id or words stay.

    Of rows that share an id one stays, the first by its columns.
    """
    from logforge.llm.common import checked, land
    from logforge.llm.jaccard_join import near_duplicates

    base = work_dir(spark, "near-duplicates")
    groups = near_duplicates(docs)
    gone = land(groups.where(F.col("component_id") != F.col("doc_id")).select("doc_id").distinct(), f"{base}/gone")
    again = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select("doc_id")
    again = land(again, f"{base}/again")
    kept = docs.join(checked(gone), "doc_id", "left_anti").select(*COLUMNS)
    one = kept.join(checked(again), "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*COLUMNS)).alias("row")).select("row.*")
    return kept.join(checked(again), "doc_id", "left_anti").union(one)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item was found; rows without an id cannot be named by a find and stay."""
    from logforge.llm.common import checked, land
    from logforge.llm.decontam import find_leaks

    leaks = find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    gone = land(leaks.select("doc_id").distinct(), f"{work_dir(spark, 'leaking')}/gone")
    return docs.join(checked(gone), "doc_id", "left_anti").select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: how many words of each document it takes; documents of which it takes none are not in it."""
    from logforge.llm.mixing import mix_sources

    mixed = mix_sources(docs)
    return mixed.where(F.col("taken") > 0).select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicate),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
]

# Learned scores, similarity joins and seeded blocks are not SQL; a brute-force version stands in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written below the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = work_dir(spark, "pipeline")
    for n, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{n}")
        docs = spark.read.parquet(f"{base}/{n}")
    return docs


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)
