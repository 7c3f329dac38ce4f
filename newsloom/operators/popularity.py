"""Click counts per article and the popularity ranker."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import split_ids, strip_click_suffix
from newsloom.operators.ranking import rank_by_popularity, ranks_to_list
from newsloom.operators.skew import skew_join


def popularity(impressions: DataFrame) -> DataFrame:
    """(article_id, clicks) over the clicked lists."""
    return impressions.select(F.explode("clicked_articles").alias("article_id")).groupBy("article_id").agg(
        F.count(F.lit(1)).alias("clicks"))


def clicked_items(behaviors: DataFrame) -> DataFrame:
    """Items of raw impression strings that carry the click suffix."""
    items = behaviors.select(F.explode(split_ids(F.col("impressions"))).alias("item"))
    return items.where(F.col("item").endswith("-1"))


def popularity_from_behaviors(behaviors: DataFrame) -> DataFrame:
    """(article_id, clicks) straight from raw impression strings."""
    ids = clicked_items(behaviors).select(strip_click_suffix(F.col("item")).alias("article_id"))
    return ids.groupBy("article_id").agg(F.count(F.lit(1)).alias("clicks"))


def popularity_summary(pop: DataFrame) -> DataFrame:
    return pop.agg(F.max("clicks").alias("max_clicks"), F.count(F.lit(1)).alias("n_articles"))


def attach_popularity(cands: DataFrame, pop: DataFrame) -> DataFrame:
    """Candidates with their click count, 0 if never clicked. Popular articles are hot keys of this join."""
    joined = skew_join(cands, pop, ["article_id"], "left")
    return joined.withColumn("clicks", F.coalesce("clicks", F.lit(0)))


def popularity_predictions(test: DataFrame, pop: DataFrame) -> DataFrame:
    """(row_id, impression_id, ranks) for unlabeled impressions; no candidates give an empty list."""
    cands = test.select("row_id", "impression_id", F.posexplode_outer("candidates").alias("pos", "article_id"))
    ranked = rank_by_popularity(attach_popularity(cands, pop))
    return ranks_to_list(ranked, ("row_id", "impression_id"))
