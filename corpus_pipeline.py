"""The corpus pipeline: each stage reads what its predecessor kept, written as Parquet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import decontaminate, language, line_dedup, mixing, near_dup
from tillroll.scratch import Scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# A document goes if it has no letters, or if no language holds this share of its words.
MIN_LANGUAGE_SHARE = 0.35


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language; ``lang`` stays as it was. Without any labelled
    document to learn from, all that have letters stay."""
    model = language.fit(docs)
    judged = language.identify_language(docs, model)
    if not model.languages:
        return docs.filter(F.coalesce(F.col("text"), F.lit("")).rlike(r"\p{L}"))
    kept = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SHARE)
    return judged.filter(kept).select(*docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go; a document of which nothing is left goes too."""
    kept = line_dedup.dedup_lines(docs, Scratch(spark))
    emptied = (F.col("n_removed") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return kept.filter(F.col("text").isNull() | ~emptied).select(*docs.columns)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dup.drop_near_duplicates(docs, Scratch(spark))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of test items."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.cleaned(docs, benchmark, Scratch(spark))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often as it takes them, numbered by ``copy``."""
    mixed = mixing.mix(docs, Scratch(spark)).filter("copies > 0")
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("near_dup", near_dup_stage),
    ("decontamination", decontamination),
    ("mixing", mixing_stage),
]

# Trained models and hash thresholds are outside of SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark)
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = scratch.cut(docs, name)
    return docs
