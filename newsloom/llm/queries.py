"""One query per operator of this subpackage, over the given tables, and the SQL of those that have one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import audit, ctw, decontaminate, exact, jaccard, language, licenses, mixing, pages, repeats, search, toxicity, urls
from newsloom.llm.common import held_out
from newsloom.session import ship_package

#: Shares of the mixed corpus by source, in blocks per period; every other source has one.
TARGETS = {"src0": 4, "src1": 3, "src2": 3, "src3": 2}
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf, "documents")).drop("bucket", "points")


def op2_mix(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents"), TARGETS).select("doc_id", "source", "mix_block", "mix_slot", "mix_position")


def op3_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.jaccard_groups(table(spark, sf, "documents"), n=4, percent=85)


def op4_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = toxicity.train(docs, labels.where(~held_out(F.col("doc_id"), 4)))
    return toxicity.scores(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), 4).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(table(spark, sf, "documents"))


def op5_license_places(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.places(table(spark, sf, "documents"))


def op6_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.passages(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select("doc_id", "item_id", "edits", "end_word")


def op7_context_tree(spark: SparkSession, sf: str) -> DataFrame:
    rated = ctw.score_texts(table(spark, sf, "documents"), ~held_out(F.col("id"), 7))
    return rated.select("doc_id", held_out(F.col("doc_id"), 7).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_suffix_array(spark: SparkSession, sf: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf, "documents"))


def op9_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return urls.filter_urls(table(spark, sf, "pages"), URL_RULES).drop("url_score")


def op10_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = language.train(docs.where(~held_out(F.col("doc_id"), 4)))
    return language.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id"), 4).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), F.array_join("langs", " ").alias("langs"))


def op11_main_text(spark: SparkSession, sf: str) -> DataFrame:
    return pages.main_text(table(spark, sf, "pages")).select("page_id", "url", "text", "n_chars")


def op12_ranked_search(spark: SparkSession, sf: str) -> DataFrame:
    return search.ranked(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op13_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    return audit.interactions(audit.masks(table(spark, sf, "documents"), table(spark, sf, "labels")))


QUERIES = {f.__name__: f for f in (
    op1_exact_dedup, op2_mix, op3_jaccard_join, op4_toxicity, op5_license_scan, op5_license_places, op6_decontaminate, op7_context_tree, op8_suffix_array, op9_url_filter, op10_language_id,
    op11_main_text, op12_ranked_search, op13_filter_audit)}

_OP1 = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM documents),
     k AS (SELECT doc_id, body, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY body) AS group_size
           FROM d WINDOW w AS (PARTITION BY body ORDER BY points DESC, doc_id))
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM k
"""


def oracle() -> dict[str, str]:
    return {"op1_exact_dedup": _OP1, "op5_license_scan": licenses.scan_sql(), "op5_license_places": licenses.places_sql(),
            "op12_ranked_search": search.SQL, "op13_filter_audit": audit.SQL}
