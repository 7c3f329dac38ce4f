"""A linear ranker fitted by distributed normal equations, with and without the columns that are missing when serving."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.lists import empty_ids
from newsloom.operators.beyond import compare_with_ci
from newsloom.operators.metrics import ranking_metrics
from newsloom.operators.popularity import attach_popularity
from newsloom.operators.skew import skew_join
from newsloom.operators.unify import labeled_candidates
from newsloom.session import stage

FEATURES = ("one", "popularity", "seen", "logged_read")
#: Features made from columns that the log has and a request lacks.
ABSENT = ("logged_read",)


def candidate_features(impressions: DataFrame, log: DataFrame, users: DataFrame, pop: DataFrame) -> DataFrame:
    """Candidates of split impressions with FEATURES: popularity in training, whether the user has read the article, and the read
    time that the log has for it (`log`: impression_id, article_id, read_time), which is known only after the click."""
    key = "row_id" if "row_id" in impressions.columns else "impression_id"
    listed = F.concat(F.coalesce("clicked_articles", empty_ids()), F.coalesce("unclicked_articles", empty_ids()))
    before = users.groupBy("user_id").agg(F.flatten(F.collect_list(F.coalesce("history", empty_ids()))).alias("before"))
    after = log.where(F.col("article_id").isNotNull()).groupBy(F.col("impression_id").cast("string").alias(key)).agg(
        F.collect_list(F.struct(F.col("article_id").cast("string").alias("article_id"), "read_time")).alias("after"))
    # History and read times meet the impression, which is a tenth of its candidates' rows; its candidates become rows afterwards.
    rows = skew_join(impressions, before, ["user_id"], "left").withColumn("before", F.array_intersect(listed, "before"))
    cands = labeled_candidates(rows.join(after, key, "left"), keep=("split", "hist_len", "before", "after"))
    read = F.array_max(F.transform(F.filter("after", lambda x: x["article_id"] == F.col("article_id")), lambda x: x["read_time"]))
    cands = cands.select("row_id", "user_id", "split", "hist_len", "pos", "article_id", "label", read.cast("double").alias("logged_read"),
                         F.array_contains("before", F.col("article_id")).cast("double").alias("seen"))
    return attach_popularity(cands, pop).select(
        "row_id", "user_id", "split", "hist_len", "pos", "label", F.lit(1.0).alias("one"), F.log1p(F.col("clicks").cast("double")).alias("popularity"),
        F.coalesce("seen", F.lit(0.0)).alias("seen"), F.coalesce("logged_read", F.lit(0.0)).alias("logged_read"))


def normal_equations(rows: DataFrame, features: tuple[str, ...], label: str = "label") -> tuple[np.ndarray, np.ndarray]:
    """(sums of products of features, sums of features times label): one aggregation, features² numbers for the driver."""
    products = [F.sum(F.col(a) * F.col(b)) for i, a in enumerate(features) for b in features[i:]]
    found = rows.agg(*products, *[F.sum(F.col(a) * F.col(label)) for a in features]).first()
    values = np.array([x or 0.0 for x in found], float)
    n = len(features)
    matrix = np.zeros((n, n))
    matrix[np.triu_indices(n)] = values[:-n]
    return matrix + np.triu(matrix, 1).T, values[-n:]


def weights(sums: tuple[np.ndarray, np.ndarray], features: tuple[str, ...], used: tuple[str, ...], ridge: float = 1e-3) -> dict[str, float]:
    """Least-squares weights of the `used` features; `ridge` is added to the diagonal, so constant features do no harm."""
    at = [features.index(f) for f in used]
    solved = np.linalg.solve(sums[0][np.ix_(at, at)] + ridge * np.eye(len(at)), sums[1][at])
    return dict(zip(used, solved.tolist()))


def serving_time_ablation(rows: DataFrame, features: tuple[str, ...] = FEATURES, absent: tuple[str, ...] = ABSENT,
                          names: tuple[str, ...] = ("auc", "mrr", "ndcg_5", "ndcg_10"), b: int = 1000) -> DataFrame:
    """(slice, metric, all, serving, difference, low, high): ranking quality of the test part with all features and without `absent`.

    One pass over the training part gives the sums of both fits. Both rankers see the same impressions, those with a clicked
    and another candidate; the interval is that of the paired difference.
    """
    rows = stage(rows, "features")
    sums = normal_equations(rows.where("split = 'train'"), features)
    test = rows.where("split = 'test'")
    scored = None
    for model, used in (("all", features), ("serving", tuple(f for f in features if f not in absent))):
        score = sum((F.col(f) * F.lit(w) for f, w in weights(sums, features, used).items()), F.lit(0.0))
        part = test.select(F.lit(model).alias("model"), "row_id", "hist_len", "pos", "label", F.round(score, 9).alias("score"))
        scored = part if scored is None else scored.unionByName(part)
    measured = ranking_metrics(scored, ("model", "row_id", "hist_len"), diversity_k=None).where(F.col("auc").isNotNull())
    return compare_with_ci(stage(measured, "ablation"), names, ("all", "serving"), b=b)
