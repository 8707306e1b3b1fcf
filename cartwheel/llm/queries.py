"""The operators as registered queries over the whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import codes, decontaminate, exact_dedup, html_text, jaccard_join, langid, licenses, lm, mixing, runs, secrets, simhash, toxicity
from cartwheel.llm.common import remainder, table


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs.select("doc_id", "text"), langid.train(docs))
    return found.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.refine(table(spark, sf_dir, "documents"), digest_all=True)
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    families = F.array_sort(F.array_distinct(F.transform("licenses", lambda x: x["family"])))
    return found.select(
        "doc_id", "n_paragraphs", F.size("licenses").cast("long").alias("n_statements"), F.array_join(families, ",").alias("families"),
        F.coalesce(F.array_max(F.transform("licenses", lambda x: x["probability"])), F.lit(0.0)).alias("score"),
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.classes(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = toxicity.score(docs.select("doc_id", "text"), toxicity.train(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "places")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = runs.repeat_tail(table(spark, sf_dir, "documents"), "doc_id", "text")
    return runs.digest(runs.scan(docs, digest=True))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, books = codes.compress(table(spark, sf_dir, "embeddings"))
    return found.withColumn("codebooks_sha256", F.lit(codes.digest(books)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_lm_scoring, op2_language_id, op3_exact_dedup, op4_license_scan, op5_decontamination,
        op6_jaccard_join, op7_secret_scan, op8_html_extraction, op9_toxicity, op10_mixing,
        op11_periodic_runs, op12_simhash, op13_vector_codes,
    )
}
