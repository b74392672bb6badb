"""One query for each operator, over whole tables, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlog.llm import clusters, decontam, divergence, langid, lines, maintext, mixing, neardup, pii, quality, search, toolcalls, urls


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = langid.learn(docs.where(~langid.held_out()).select("doc_id", "text", "lang"))
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op2_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality.fit(quality.ratings(docs, table(spark, folder, "labels")))
    found = quality.grade(docs.select("doc_id", "text"), model, at_least=2)
    return found.select("doc_id", "score", "expected_grade", F.col("tail").alias("tail_probability"), (F.col("tail") >= 0.5).alias("keep"))


def op3_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    calls, results = toolcalls.calls_of(table(spark, folder, "conversations"))
    found = toolcalls.link(calls, results, toolcalls.tools(spark))
    return found.withColumn("errors", F.array_join("errors", ","))


def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digest(table(spark, folder, "documents"))


#: The rules of the URL query.
URL_RULES = [
    urls.Rule("com", "/", "allow"),
    urls.Rule("example.com", "/en/", "block"),
    urls.Rule("www.example.com", "/en/", "allow"),
    urls.Rule("net", "/es/", "block"),
    urls.Rule("net", "/fr/", "block"),
]


def op9_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    ruled = urls.apply_rules(table(spark, folder, "pages").select("page_id", "url"), URL_RULES)
    found = urls.fit(ruled, F.col("page_id"))
    return urls.judge(ruled, found).select("page_id", "host", "path", "rule", "verdict", "difference")


def op5_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return search.top(docs, docs.where("doc_id % 100 = 0"), k=10)


def op6_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.classes(table(spark, folder, "documents"))


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = lines.removed(table(spark, folder, "documents"))
    return found.select("doc_id", "lines", F.size("removed").alias("n_removed"), "removed")


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.amounts(table(spark, folder, "documents"))


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontam.matches(docs, table(spark, folder, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select(
        "doc_id", F.col("leak.item").alias("item_id"), "leak.first_word", "leak.words", "leak.bits", "leak.similarity"
    )


def op11_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    return clusters.clustered(table(spark, folder, "embeddings"))


def op12_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    found = maintext.extracted(table(spark, folder, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_language_id, op2_quality_classifier, op3_chat_formatting, op4_pii, op5_topk_search, op6_minhash_near_dedup, op7_line_dedup, op8_mixing, op9_url_filters, op10_decontamination, op11_centroid_clustering, op12_html_extraction, op13_source_divergence)
}
ORACLE: dict[str, str] = {"op5_topk_search": search.ORACLE, "op8_mixing": mixing.ORACLE, "op11_centroid_clustering": clusters.ORACLE, "op13_source_divergence": divergence.ORACLE}
