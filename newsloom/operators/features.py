"""Article and user features, leakage checks, and the serving-time view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import ENTITY_SCHEMA, parse_entities
from newsloom.functions.times import epoch_seconds
from newsloom.operators.semantic import mean_vectors
from newsloom.operators.skew import skew_join
from newsloom.operators.unify import labeled_candidates, one_per_id


def history_clicks(history: DataFrame) -> DataFrame:
    """Parallel history lists as rows (user_id, article_id, click_time, read_time, scroll)."""
    zipped = F.arrays_zip(
        F.col("article_id_fixed").alias("article_id"), F.col("impression_time_fixed").alias("click_time"),
        F.col("read_time_fixed").alias("read_time"), F.col("scroll_percentage_fixed").alias("scroll"))
    rows = history.select(F.col("user_id").cast("string").alias("user_id"), F.explode(zipped).alias("z"))
    return rows.select("user_id", F.col("z.article_id").cast("string").alias("article_id"), "z.click_time",
                       "z.read_time", "z.scroll")


def decay(age_seconds, tau_seconds: float):
    return F.exp(-age_seconds / F.lit(float(tau_seconds)))


def recency_features(clicks: DataFrame, at, tau_seconds: float = 86400.0) -> DataFrame:
    """Per user: clicks up to `at`, age of the last one, and the sum of exponential decay weights."""
    age = epoch_seconds(at) - epoch_seconds(F.col("click_time"))
    past = clicks.select("user_id", age.alias("age")).where(F.col("age") >= 0)
    return past.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_clicks"), F.min("age").alias("last_click_age"),
        F.sum(decay(F.col("age"), tau_seconds)).alias("decay_sum"))


def recency_vectors(clicks: DataFrame, vectors: DataFrame, at, tau_seconds: float = 86400.0) -> DataFrame:
    """Per user the decay-weighted mean of clicked article vectors."""
    age = epoch_seconds(at) - epoch_seconds(F.col("click_time"))
    past = clicks.select("user_id", "article_id", age.alias("age")).where(F.col("age") >= 0)
    weights = past.groupBy("user_id", "article_id").agg(F.sum(decay(F.col("age"), tau_seconds)).alias("weight"))
    rows = skew_join(weights, one_per_id(vectors, "embedding"), ["article_id"])
    return mean_vectors(rows, "user_id", "embedding", "weight")


def article_features(news: DataFrame, entity_cols: tuple[str, ...] = ("title_entities", "abstract_entities"),
                     schema: str = ENTITY_SCHEMA, min_confidence: float = 0.0) -> DataFrame:
    """Category, subcategory and the sorted distinct entity ids of each article, without a shuffle."""
    entities = F.concat(*[F.coalesce(parse_entities(F.col(c), schema), F.array().cast(schema)) for c in entity_cols])
    kept = F.filter(entities, lambda e: e["WikidataId"].isNotNull()
                    & (F.coalesce(e["Confidence"], F.lit(1.0)) >= min_confidence))
    ids = F.array_sort(F.array_distinct(F.transform(kept, lambda e: e["WikidataId"])))
    return news.select("article_id", "category", "subcategory", ids.alias("entities"),
                       F.size(ids).cast("bigint").alias("n_entities"))


def entity_vectors(features: DataFrame, vectors: DataFrame) -> DataFrame:
    """(article_id, n_known, embedding): the mean vector of each article's entities that have one.

    `features` is as of `article_features`, `vectors` as of `read_vec`. Articles without a known entity have no row. An
    entity of very many articles is a hot key on the side of the articles, where it is spread.
    """
    named = features.select("article_id", F.explode("entities").alias("entity_id"))
    rows = skew_join(named, one_per_id(vectors, "embedding", key="entity_id"), ["entity_id"])
    known = rows.groupBy("article_id").agg(F.count(F.lit(1)).alias("n_known"))
    return mean_vectors(rows, "article_id").join(known, "article_id").select("article_id", "n_known", "embedding")


def history_leaks(impressions: DataFrame, clicks: DataFrame) -> DataFrame:
    """Impressions whose user has a history click at or after them.

    The user's last click decides, so one row per user meets the impressions and no click is paired
    with an impression.
    """
    last = clicks.groupBy("user_id").agg(F.max("click_time").alias("last_click"))
    joined = skew_join(impressions.select("impression_id", "user_id", "time", "split"), last, ["user_id"], "left")
    return joined.withColumn("leak", F.coalesce(F.col("last_click") >= F.col("time"), F.lit(False)))


def future_candidates(impressions: DataFrame, articles: DataFrame) -> DataFrame:
    """Candidates with `leak` where the article was published after the impression."""
    cands = labeled_candidates(impressions, keep=("time", "split"))
    published = one_per_id(articles, "published_time")
    joined = skew_join(cands, published, ["article_id"], "left")
    return joined.withColumn("leak", F.coalesce(F.col("published_time") > F.col("time"), F.lit(False)))


def leakage_report(impressions: DataFrame, clicks: DataFrame, articles: DataFrame) -> DataFrame:
    """(check, split, n_rows, n_leaks) for both leak kinds."""
    def count(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("leak").alias("n_leaks")).select(
            F.lit(name).alias("check"), "split", "n_rows", "n_leaks")

    return count(history_leaks(impressions, clicks), "history_at_or_after_impression").unionByName(
        count(future_candidates(impressions, articles), "candidate_published_later"))


def serving_time_view(train: DataFrame, test: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Training rows without the columns that the test data lacks, `keep` (such as labels) aside."""
    have = set(test.columns) | set(keep)
    return train.drop(*[c for c in train.columns if c not in have])


def column_presence(frames: dict[str, DataFrame]) -> DataFrame:
    """Per column: presence in each named frame and its count of non-null values there, from one aggregation."""
    names = list(frames)
    columns = sorted({c for df in frames.values() for c in df.columns})
    counted = None
    for name, df in frames.items():
        flags = [F.col(c).isNotNull().cast("int").alias(c) for c in df.columns]
        part = df.select(F.lit(name).alias("frame_name"), *flags)
        counted = part if counted is None else counted.unionByName(part, allowMissingColumns=True)
    sums = counted.groupBy("frame_name").agg(*[F.sum(c).cast("bigint").alias(c) for c in columns])
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n")) for c in columns]))
    wide = sums.select("frame_name", cells.alias("cell")).groupBy("cell.column_name").pivot("frame_name", names).agg(F.first("cell.n"))
    out = wide.select("column_name", *[F.coalesce(F.col(n), F.lit(0)).alias(f"n_{n}") for n in names])
    for name, df in frames.items():
        out = out.withColumn(f"in_{name}", F.col("column_name").isin(df.columns))
    return out
