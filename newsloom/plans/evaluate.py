"""Scoring and evaluation of impressions, from candidates to metric reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsloom.operators.lexical import LexicalIndex, bm25_score, history_query
from newsloom.operators.metrics import METRICS, attach_category, ranking_metrics, recall_at
from newsloom.operators.ranking import rank_candidates
from newsloom.operators.semantic import semantic_score, user_vectors
from newsloom.operators.skew import skew_join
from newsloom.operators.splits import only_labeled
from newsloom.operators.unify import labeled_candidates
from newsloom.session import stage


def attach_history(impressions: DataFrame, users: DataFrame) -> DataFrame:
    """Impressions with the user's history, empty for unknown users."""
    joined = skew_join(impressions, users.select("user_id", "history"), ["user_id"], "left")
    return joined.withColumn("history", F.coalesce("history", F.array().cast("array<string>")))


def attach_hist_len(impressions: DataFrame, users: DataFrame) -> DataFrame:
    """Impressions with the length of the user's history, 0 for unknown users."""
    lengths = users.select("user_id", F.size("history").cast("bigint").alias("hist_len"))
    joined = skew_join(impressions, lengths, ["user_id"], "left")
    return joined.withColumn("hist_len", F.coalesce("hist_len", F.lit(0)))


def wanted_users(users: DataFrame, rows: DataFrame) -> DataFrame:
    """Only the users that occur in `rows`; the others need no query and no vector."""
    return users.join(rows.select("user_id").distinct(), "user_id", "left_semi")


def distinct_pairs(cands: DataFrame) -> DataFrame:
    """Scores depend on user and article alone, so each pair is scored once."""
    return cands.select("user_id", "article_id").distinct()


@dataclass(frozen=True)
class Candidates:
    """Candidate rows and their distinct pairs, both written out: several joins read each of them."""

    rows: DataFrame
    pairs: DataFrame

    def attach(self, scores: DataFrame, how: str = "left") -> DataFrame:
        """Pair scores back on the candidate rows, in the partitioning by pair that the scores come in."""
        return self.rows.join(scores, ["user_id", "article_id"], how)


def prepare(cands: DataFrame, staged: bool = True) -> Candidates:
    """Pairs are always written out; candidates that are cheap to read again need not be (`staged` False)."""
    rows = stage(cands, "candidates") if staged else cands
    return Candidates(rows, stage(distinct_pairs(rows), "pairs"))


def pair_lexical(c: Candidates, users: DataFrame, index: LexicalIndex, recent: int | None = None,
                 name: str = "score") -> DataFrame:
    query = history_query(wanted_users(users, c.pairs), index.postings, recent, by_article=True)
    return bm25_score(c.pairs, query, index.postings, name)


def pair_semantic(c: Candidates, users: DataFrame, vectors: DataFrame, unknown: str = "null", name: str = "score",
                  pairs: DataFrame | None = None) -> DataFrame:
    """Semantic scores of the pairs, or of `pairs` that extend them by more columns."""
    vecs = user_vectors(wanted_users(users, c.pairs), vectors)
    return semantic_score(c.pairs if pairs is None else pairs, vecs, vectors, unknown, name)


def score_lexical(cands: DataFrame, users: DataFrame, index: LexicalIndex, recent: int | None = None,
                  name: str = "score", staged: bool = True) -> DataFrame:
    """Candidates with their BM25 score; unknown candidates and users score 0.0."""
    c = prepare(cands, staged)
    return c.attach(pair_lexical(c, users, index, recent, name))


def score_semantic(cands: DataFrame, users: DataFrame, vectors: DataFrame, unknown: str = "null",
                   name: str = "score", staged: bool = True) -> DataFrame:
    """Candidates with their cosine score; `unknown` is the policy for candidates without a vector."""
    c = prepare(cands, staged)
    return c.attach(pair_semantic(c, users, vectors, unknown, name), "inner" if unknown == "drop" else "left")


def all_candidates_known(scored: DataFrame, known: str = "semantic", key: tuple[str, ...] = ("row_id",)) -> DataFrame:
    """Rows of impressions in which every candidate has a value in `known`."""
    whole = Window.partitionBy(*key)
    counted = scored.withColumn("_missing", F.count_if(F.col(known).isNull()).over(whole))
    return counted.where(F.col("_missing") == 0).drop("_missing")


def score_both(impressions: DataFrame, users: DataFrame, articles: DataFrame, vectors: DataFrame,
               index: LexicalIndex) -> DataFrame:
    """Candidates of comparable impressions with lexical and semantic score, category and history length.

    Comparable means: a click, a non-click, a non-empty history, and a vector for every candidate.
    Both models see the same rows.
    """
    labeled = attach_hist_len(only_labeled(impressions, need_unclicked=True), users).where(F.col("hist_len") > 0)
    c = prepare(labeled_candidates(labeled, keep=("hist_len",)))
    # Category and article vector follow each other, as both joins need the pairs partitioned by article.
    lexical = attach_category(pair_lexical(c, users, index, name="lexical"), articles)
    return all_candidates_known(c.attach(pair_semantic(c, users, vectors, "null", "semantic", pairs=lexical)))


def by_model(scored: DataFrame, models: tuple[str, ...] = ("lexical", "semantic")) -> DataFrame:
    """One row per candidate and model with a common score column."""
    cells = F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("score")) for m in models])
    rest = [c for c in scored.columns if c not in models]
    return scored.select(*rest, F.explode(cells).alias("cell")).select(*rest, "cell.*")


def evaluate_impressions(impressions: DataFrame, users: DataFrame, articles: DataFrame, vectors: DataFrame,
                         index: LexicalIndex) -> DataFrame:
    """(model, row_id, hist_len, auc, mrr, ndcg_5, ndcg_10, category_diversity_5) per comparable impression."""
    scored = by_model(score_both(impressions, users, articles, vectors, index))
    return ranking_metrics(scored, ("model", "row_id", "hist_len")).select("model", "row_id", "hist_len", *METRICS)


def lexical_recall(impressions: DataFrame, users: DataFrame, index: LexicalIndex, ks: tuple[int, ...]) -> DataFrame:
    """Recall at k per clicked impression; unknown candidates stay in the list with score 0.0."""
    cands = labeled_candidates(only_labeled(impressions), distinct=True)
    return recall_at(rank_candidates(score_lexical(cands, users, index)), ks)


def semantic_recall(impressions: DataFrame, users: DataFrame, vectors: DataFrame, ks: tuple[int, ...]) -> DataFrame:
    """Recall at k per clicked impression; unknown candidates are not ranked but count as missed clicks.

    An impression in which no candidate is known is left out.
    """
    cands = labeled_candidates(only_labeled(impressions), distinct=True)
    scored = score_semantic(cands, users, vectors, "null")
    ranked = rank_candidates(scored).withColumn(
        "rank", F.when(F.col("score").isNotNull(), F.col("rank")))
    known = F.count("score").alias("n_known")
    sums = ranked.groupBy("row_id").agg(
        known, F.sum("label").alias("n_clicked"),
        *[F.sum(F.when(F.col("rank") <= k, F.col("label")).otherwise(0)).alias(f"hits_{k}") for k in ks])
    return sums.where(F.col("n_known") > 0).select(
        "row_id", *[(F.col(f"hits_{k}") / F.col("n_clicked")).alias(f"recall_{k}") for k in ks])


def mean_recall(recalls: DataFrame, ks: tuple[int, ...]) -> DataFrame:
    """Mean recall per cut-off, 0.0 without impressions."""
    return recalls.agg(*[F.coalesce(F.avg(f"recall_{k}"), F.lit(0.0)).alias(f"recall_{k}") for k in ks])
