"""Ranking quality per impression and its means by slice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsloom.operators.ranking import by_score
from newsloom.operators.skew import skew_join
from newsloom.operators.unify import one_per_id

RECALL_CUTS = (50, 100, 200)  # Fixed values: default recall cut-offs.
METRICS = ("auc", "mrr", "ndcg_5", "ndcg_10", "category_diversity_5")


def attach_category(rows: DataFrame, articles: DataFrame) -> DataFrame:
    """Rows with the category of their article, the last one where ids repeat, "unknown" outside the catalog."""
    joined = skew_join(rows, one_per_id(articles, "category"), ["article_id"], "left")
    return joined.withColumn("category", F.coalesce("category", F.lit("unknown")))


def recall_at(ranked: DataFrame, ks: tuple[int, ...] = RECALL_CUTS, key: tuple[str, ...] = ("row_id",)) -> DataFrame:
    """recall_k per row key over distinct candidates; rows without a click are left out."""
    clicked = F.sum("label")
    found = [F.sum(F.when(F.col("rank") <= k, F.col("label")).otherwise(0)).alias(f"hits_{k}") for k in ks]
    sums = ranked.groupBy(*key).agg(clicked.alias("n_clicked"), *found).where(F.col("n_clicked") > 0)
    return sums.select(*key, *[(F.col(f"hits_{k}") / F.col("n_clicked")).alias(f"recall_{k}") for k in ks])


def retrieval_recall(top: DataFrame, clicks: DataFrame, ks: tuple[int, ...] = RECALL_CUTS, key: tuple[str, ...] = ("user_id",)) -> DataFrame:
    """recall_k per key: the share of the distinct clicked articles that are among the first k retrieved.

    `top` has (user_id, article_id, rank), `clicks` has `key` (user_id included) and article_id. Users with a click
    but without a retrieved list have recall 0.
    """
    wanted = clicks.select(*key, "article_id").distinct()
    met = wanted.join(top.select("user_id", "article_id", "rank"), ["user_id", "article_id"], "left")
    n = F.count(F.lit(1))
    return met.groupBy(*key).agg(*[(F.count_if(F.col("rank") <= k) / n).alias(f"recall_{k}") for k in ks])


def _tied_window(key: list[str], score: str):
    return Window.partitionBy(*key).orderBy(F.desc(score))


def _discount(rn, k: int):
    return F.when(rn <= k, 1 / F.log2(rn + 1)).otherwise(F.lit(0.0))


def with_rank_columns(scored: DataFrame, key: list[str], score: str, ks: tuple[int, ...]) -> DataFrame:
    """Rank, tie and discount columns. Every window shares one partitioning and one sort order."""
    order = by_score(key, score)
    peers = _tied_window(key, score)
    same = peers.rangeBetween(Window.currentRow, Window.currentRow)
    whole = Window.partitionBy(*key)
    out = (
        scored.withColumn("rn", F.row_number().over(order))
        .withColumn("tie_rank", F.rank().over(peers))
        .withColumn("tie_size", F.count(F.lit(1)).over(same))
        .withColumn("n", F.count(F.lit(1)).over(whole))
        .withColumn("n_pos", F.sum("label").over(whole))
    )
    for k in ks:
        out = out.withColumn(f"disc_{k}", _discount(F.col("rn"), k))
    for k in ks:
        out = out.withColumn(f"tied_{k}", F.avg(f"disc_{k}").over(same))
    return out


def auc_expr():
    """Mann-Whitney form with mean ranks, so a tied pair counts one half; null without both classes."""
    avg_rank = F.col("n") - F.col("tie_rank") + 1 - (F.col("tie_size") - 1) / F.lit(2.0)
    pos, n = F.max("n_pos"), F.max("n")
    total = F.sum(F.when(F.col("label") == 1, avg_rank))
    return F.when((pos > 0) & (n > pos), (total - pos * (pos + 1) / 2) / (pos * (n - pos)))


def mrr_expr():
    """Reciprocal rank of the first click, 0 without one."""
    return F.max(F.when(F.col("label") == 1, 1 / F.col("rn")).otherwise(F.lit(0.0)))


def ndcg_expr(k: int):
    """Binary gain, log2 discount, gain averaged over tied scores; 0 without a click."""
    ideal = F.sum(F.when(F.col("rn") <= F.col("n_pos"), F.col(f"disc_{k}")).otherwise(0.0))
    return F.when(ideal > 0, F.sum(F.col("label") * F.col(f"tied_{k}")) / ideal).otherwise(F.lit(0.0))


def diversity_expr(k: int):
    """Distinct categories over list length in the first k; the set holds at most k values."""
    top = F.col("rn") <= k
    return F.size(F.collect_set(F.when(top, F.col("category")))) / F.sum(F.when(top, 1).otherwise(0))


def ranking_metrics(scored: DataFrame, key: tuple[str, ...] = ("row_id",), score: str = "score",
                    ks: tuple[int, ...] = (5, 10), diversity_k: int | None = 5) -> DataFrame:
    """auc, mrr, ndcg_k and category_diversity_k per row key, from one shuffle on the key.

    Input rows need pos, label, the score and, for diversity, category.
    """
    names = list(key)
    aggs = [auc_expr().alias("auc"), mrr_expr().alias("mrr"), *[ndcg_expr(k).alias(f"ndcg_{k}") for k in ks]]
    if diversity_k:
        aggs.append(diversity_expr(diversity_k).alias(f"category_diversity_{diversity_k}"))
    return with_rank_columns(scored, names, score, ks).groupBy(*names).agg(*aggs)


def auc(scored: DataFrame, key: tuple[str, ...] = ("row_id",)) -> DataFrame:
    return ranking_metrics(scored, key, diversity_k=None).select(*key, "auc")


def mrr(scored: DataFrame, key: tuple[str, ...] = ("row_id",)) -> DataFrame:
    return ranking_metrics(scored, key, diversity_k=None).select(*key, "mrr")


def ndcg_at(scored: DataFrame, ks: tuple[int, ...] = (5, 10), key: tuple[str, ...] = ("row_id",)) -> DataFrame:
    return ranking_metrics(scored, key, ks=ks, diversity_k=None).select(*key, *[f"ndcg_{k}" for k in ks])


def category_diversity(ranked: DataFrame, articles: DataFrame, k: int = 5, key: tuple[str, ...] = ("row_id",)) -> DataFrame:
    """Distinct categories over list length among the first k ranked candidates."""
    top = attach_category(ranked.where(F.col("rank") <= k), articles)
    return top.groupBy(*key).agg(
        (F.size(F.collect_set("category")) / F.count(F.lit(1))).alias(f"category_diversity_{k}"))


def mean_by_slice(metrics: DataFrame, names: tuple[str, ...] = METRICS, cut: int = 5) -> DataFrame:
    """(model, slice, metric, value) means for global, cold and warm; an empty slice gives 0.0.

    One conditional aggregation per model: slices are columns of it, so empty ones keep their row.
    """
    slices = {"global": F.lit(True), "cold": F.col("hist_len") < cut, "warm": F.col("hist_len") >= cut}
    aggs = [F.coalesce(F.avg(F.when(cond, F.col(m))), F.lit(0.0)).alias(f"{s}__{m}")
            for s, cond in slices.items() for m in names]
    wide = metrics.groupBy("model").agg(*aggs)
    cells = F.array(*[F.struct(F.lit(s).alias("slice"), F.lit(m).alias("metric"), F.col(f"{s}__{m}").alias("value"))
                      for s in slices for m in names])
    return wide.select("model", F.explode(cells).alias("cell")).select("model", "cell.*")


slice_report = mean_by_slice


def compare_models(report: DataFrame, models: tuple[str, ...] = ("lexical", "semantic")) -> DataFrame:
    """One row per slice and metric, one value column per model."""
    return report.groupBy("slice", "metric").pivot("model", list(models)).agg(F.first("value"))


def recall_by_slice(recalls: DataFrame, names: tuple[str, ...], cut: int = 5) -> DataFrame:
    """Mean recall per model and history slice; input rows need model, hist_len and the recall columns."""
    return mean_by_slice(recalls, names, cut)
