"""Ranks inside an impression and their list form.

A partition of these windows is one input row's candidate list, so its size is bounded by a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def by_score(key: list[str], score: str = "score") -> Window:
    """Order of candidates: score descending, then position."""
    return Window.partitionBy(*key).orderBy(F.desc(score), "pos")


def rank_candidates(scored: DataFrame, score: str = "score", key: tuple[str, ...] = ("row_id",)) -> DataFrame:
    """`rank` 1..N per row key, ties in position order."""
    return scored.withColumn("rank", F.row_number().over(by_score(list(key), score)))


def rank_by_popularity(cands: DataFrame) -> DataFrame:
    """Ordinal popularity rank, ties in position order."""
    return rank_candidates(cands, "clicks")


def top_k(ranked: DataFrame, k: int) -> DataFrame:
    """First k candidates per row key."""
    return ranked.where(F.col("rank") <= k)


def tie_groups(scored: DataFrame, score: str = "score", key: tuple[str, ...] = ("row_id",)) -> DataFrame:
    """Per candidate the descending rank of its tie group, the group's size, and its mean ascending rank."""
    peers = Window.partitionBy(*key).orderBy(F.desc(score))
    whole = Window.partitionBy(*key)
    same = peers.rangeBetween(Window.currentRow, Window.currentRow)
    out = scored.withColumn("tie_rank", F.rank().over(peers)).withColumn("tie_size", F.count(F.lit(1)).over(same))
    size = F.count(F.lit(1)).over(whole)
    return out.withColumn("avg_rank", size - F.col("tie_rank") + 1 - (F.col("tie_size") - 1) / F.lit(2.0))


def ranks_to_list(ranked: DataFrame, key: tuple[str, ...] = ("row_id",)) -> DataFrame:
    """Ranks as one list per row key in position order; rows without a position give an empty list."""
    item = F.when(F.col("pos").isNotNull(), F.struct("pos", "rank"))
    return ranked.groupBy(*key).agg(
        F.transform(F.array_sort(F.collect_list(item)), lambda x: x["rank"]).alias("ranks"))


def hits(ranked: DataFrame, k: int, key: tuple[str, ...] = ("row_id",)) -> DataFrame:
    """Clicked candidates among the first k, and clicked candidates in all, per row key."""
    return ranked.groupBy(*key).agg(
        F.sum(F.when(F.col("rank") <= k, F.col("label")).otherwise(0)).alias("n_hits"),
        F.sum("label").alias("n_clicked"))
