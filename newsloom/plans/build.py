"""From raw folders to a feature store of Parquet tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators.features import article_features, history_clicks, recency_features
from newsloom.operators.lexical import LexicalIndex, build_bm25_index
from newsloom.operators.semantic import hash_encoder_vectors
from newsloom.operators.splits import assert_split_order, temporal_split, union_all
from newsloom.operators.unify import (
    distinct_users, first_history, latest_users, settle_repeats, unify_articles, unify_impressions_parquet, unify_impressions_tsv)
from newsloom.sources.readers import (
    read_articles_parquet, read_behaviors_parquet, read_behaviors_tsv, read_history_parquet, read_news_tsv)
from newsloom.sources.writers import missing_embeddings, path_exists, write_index, write_splits, write_table


def build_feature_store(articles: DataFrame, user_frames: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Articles as they are, and one history per user: that of the last frame that has the user."""
    ranked = [u.select("user_id", "history").withColumn("source_rank", F.lit(i)) for i, u in enumerate(user_frames)]
    return articles, latest_users(union_all(ranked))


def embed_unique(articles: DataFrame) -> DataFrame:
    """`hash_encoder_vectors` of a table with one row per id."""
    return hash_encoder_vectors(articles, unique=True)


def build_store(spark: SparkSession, root: str, dataset: str, articles: DataFrame, user_frames: list[DataFrame],
                impressions: DataFrame, embed: Callable[[DataFrame], DataFrame] = embed_unique,
                test_days: float = 1, val_days: float = 1, features: dict[str, DataFrame] | None = None) -> None:
    """Write all store tables of one dataset, and those of `features` beside them.

    Articles that have a stored vector are not embedded again. Stored articles have one row per id, so their texts are
    not shuffled again.
    """
    articles, users = build_feature_store(settle_repeats(articles), user_frames)
    write_table(articles, root, "articles", dataset)
    write_table(users, root, "users", dataset)
    write_splits(temporal_split(impressions, test_days, val_days), root, dataset)
    mine = F.col("dataset") == dataset
    assert_split_order(spark.read.parquet(f"{root}/impressions").where(mine))
    stored = spark.read.parquet(f"{root}/articles").where(mine).drop("dataset")
    write_index(build_bm25_index(stored, unique=True, clustered=True), root, dataset)
    write_embeddings_once(spark, root, dataset, stored, embed)
    for name, df in (features or {}).items():
        write_table(df, root, name, dataset)


def write_embeddings_once(spark: SparkSession, root: str, dataset: str, articles: DataFrame,
                          embed: Callable[[DataFrame], DataFrame]) -> None:
    """Embed and append only the articles without a stored vector."""
    if path_exists(spark, f"{root}/vectors"):
        stored = spark.read.parquet(f"{root}/vectors").where(F.col("dataset") == dataset)
        articles = missing_embeddings(articles, stored)
    write_table(embed(articles), root, "vectors", dataset, mode="append")


def build_from_tsv(spark: SparkSession, raw_dir: str, root: str, dataset: str, **options) -> None:
    """Store of a news.tsv and behaviors.tsv folder, with the categories and entities of the articles as `article_features`."""
    behaviors, news = read_behaviors_tsv(spark, f"{raw_dir}/behaviors.tsv"), read_news_tsv(spark, f"{raw_dir}/news.tsv")
    build_store(spark, root, dataset, unify_articles(news, "tsv"), [first_history(behaviors)], unify_impressions_tsv(behaviors),
                features={"article_features": article_features(news)}, **options)


def build_from_parquet(spark: SparkSession, raw_dir: str, root: str, dataset: str,
                       parts: tuple[str, ...] = ("train", "validation"), tau_seconds: float = 86400.0 * 7, test_days: float = 1, val_days: float = 1,
                       **options) -> None:
    """Store of an articles.parquet with one folder of behaviors and history per part; later parts win for users.

    `user_recency` has each user's clicks up to the end of the training part, so that it holds nothing of what is predicted.
    """
    articles = unify_articles(read_articles_parquet(spark, f"{raw_dir}/articles.parquet"), "parquet")
    users = [distinct_users(read_history_parquet(spark, f"{raw_dir}/{p}/history.parquet")) for p in parts]
    impressions = union_all([unify_impressions_parquet(
        read_behaviors_parquet(spark, f"{raw_dir}/{p}/behaviors.parquet")) for p in parts])
    clicks = union_all([history_clicks(spark.read.parquet(f"{raw_dir}/{p}/history.parquet")) for p in parts])
    end = impressions.agg((F.max("time") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit((test_days + val_days) * 86400.0))).alias("end")).scalar()
    build_store(spark, root, dataset, articles, users, impressions, test_days=test_days, val_days=val_days,
                features={"user_recency": recency_features(clicks, end, tau_seconds)}, **options)


def index_from_store(tables: dict[str, DataFrame]) -> LexicalIndex:
    """Stored index tables as an index."""
    return LexicalIndex(tables["stats"], tables["docs"], tables["postings"])
