"""The corpus pipeline: language ID, line dedup, near-dedup, benchmark decontamination, mixing to target weights.

Each stage takes what its predecessor kept and returns documents with their columns; the last one adds what the mix takes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlog.llm import decontam, langid, lines, mixing, neardup
from adlog.llm.common import free_name, stage

#: Least posterior probability of a document's language; texts without letters have none.
LEAST_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised: NULL and empty texts, texts without a letter and those without a likely language go.

    Rows are judged one by one, so repeated rows stay or go together; of equally likely languages the first counts.
    """
    (name,) = free_name(docs, "id_text")
    model = langid.learn(docs.select("doc_id", "text", "lang"))
    judged = langid.judged(docs, model, into=name)
    return judged.where((F.col(f"{name}.lang_pred") != langid.UNKNOWN) & (F.col(f"{name}.score") >= LEAST_SCORE)).drop(name)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One occurrence of each group of similar lines stays, that of the smallest id; documents left without a line with a word go.

    NULL and empty texts, and texts without a word, stay as they are. Of rows equal in id and text one stays.
    """
    return _counted(lines.clean(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that of the smallest id (NULL last), then of the smallest key.

    NULL texts all stay; empty ones are copies of one another. Of rows equal in id and text one stays.
    """
    return neardup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain an item of the benchmark go, all rows of them; NULL and empty texts contain none and stay."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with ``size, source_size, target`` and the words taken; the budget is all words.

    NULL and empty texts have no words to take and go. Rows equal in id and text are taken together; NULL is a source.
    """
    return mixing.mix(docs).where("taken > 0")


def _counted(docs: DataFrame) -> DataFrame:
    """The column of text lengths, if there is one, after texts have changed."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mix", mix),
]

#: SQL has neither the language model nor the sampling: tests hold the stages against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
