"""Ranked prediction lists for unlabeled impressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.operators.ranking import rank_candidates, ranks_to_list
from newsloom.operators.semantic import semantic_score, user_vectors
from newsloom.session import stage


def generate_predictions(test: DataFrame, vectors: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """(row_id, impression_id, ranks): semantic ranks 1..N in candidate order, empty without candidates.

    Without `users` each row's own history is its reader profile; else histories come from `users`.
    Candidates without a vector rank last, unless the reader has no known history: then all tie.
    """
    reader = F.col("row_id").cast("string") if users is None else F.col("user_id")
    rows = test.select("row_id", "impression_id", reader.alias("user_id"),
                       F.posexplode_outer("candidates").alias("pos", "article_id"))
    if users is None:
        users = test.select(reader.alias("user_id"), "history")
    pairs = rows.where(F.col("article_id").isNotNull()).select("user_id", "article_id").distinct()
    pairs = stage(pairs, "pairs")
    scores = semantic_score(pairs, user_vectors(users, vectors), vectors, "last")
    scored = rows.join(scores, ["user_id", "article_id"], "left")
    return ranks_to_list(rank_candidates(scored), ("row_id", "impression_id"))
