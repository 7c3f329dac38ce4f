"""Raw inputs to the unified articles, users and impressions tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.lists import empty_ids, ids_to_string, unclicked, unnest
from newsloom.functions.text import parse_history, parse_labeled_impressions
from newsloom.functions.times import parse_time
from newsloom.session import stage


def _text(name: str):
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def unify_articles(df: DataFrame, kind: str) -> DataFrame:
    """Articles of either source as (article_id, title, abstract, body, category), text never null.

    `kind` is tsv (abstract given, no body) or parquet (subtitle, body, category_str else category).
    """
    if kind == "tsv":
        abstract, body, category = _text("abstract"), F.lit(""), _text("category")
    elif kind == "parquet":
        have = set(df.columns)
        abstract = _text("subtitle") if "subtitle" in have else F.lit("")
        body = _text("body") if "body" in have else F.lit("")
        names = [c for c in ("category_str", "category") if c in have]
        category = _text(names[0]) if names else F.lit("")
    else:
        raise ValueError(f"unknown kind: {kind}")
    return df.select(F.col("article_id").cast("string"), _text("title").alias("title"), abstract.alias("abstract"),
                     body.alias("body"), category.alias("category"))


SOURCE_ORDER = ("source_rank", "row_position")


def one_per_id(df: DataFrame, *cols: str, key: str = "article_id") -> DataFrame:
    """One row per id with `cols` (default: all others): the last one read.

    Last is the greatest source rank, then row position, as far as `df` has these columns; rows that agree in them
    are ordered by their values, so the choice never varies. Grouping by the id is the partitioning that a join on
    it needs anyway.
    """
    order = [c for c in SOURCE_ORDER if c in df.columns]
    cols = cols or tuple(c for c in df.columns if c != key and c not in order)
    best = df.groupBy(key).agg(F.max(F.struct(*order, *cols)).alias("row"))
    return best.select(key, *[F.col("row").getField(c).alias(c) for c in cols])


def settle_repeats(df: DataFrame, key: str = "article_id") -> DataFrame:
    """One row per id as of `one_per_id`, for tables in which few ids repeat: ids alone are counted, and only the rows of
    repeated ones are grouped. All others stay where they are, so the rows do not come grouped by id.

    Repeated ids are staged: Spark then knows before the join that they are few enough to be sent out, or shuffles both sides.
    """
    cols = [c for c in df.columns if c not in SOURCE_ORDER]
    repeated = df.groupBy(F.col(key).alias("_repeated")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_repeated")
    repeated = stage(repeated, "repeated")
    same = F.col(key).eqNullSafe(F.col("_repeated"))
    once = df.join(repeated, same, "left_anti").select(cols)
    return once.unionByName(one_per_id(df.join(repeated, same, "left_semi"), key=key))


def first_history(behaviors: DataFrame) -> DataFrame:
    """Per user the history string of the earliest behaviors row, parsed; null and blank give an empty list."""
    raw = F.coalesce("history", F.lit(""))
    time = parse_time(F.col("time")) if dict(behaviors.dtypes)["time"] == "string" else F.col("time")
    order = F.struct(time.isNull(), time, "impression_id")
    first = behaviors.groupBy(F.col("user_id").cast("string").alias("user_id")).agg(
        F.min_by(raw, order).alias("history"))
    return first.select("user_id", parse_history(F.col("history")).alias("history"))


def distinct_users(df: DataFrame) -> DataFrame:
    """One row per user. Of several lists the greatest is kept, so the choice never varies between runs."""
    return df.groupBy("user_id").agg(F.max("history").alias("history"))


def latest_users(df: DataFrame, rank: str = "source_rank") -> DataFrame:
    """One row per user, from the source with the highest rank."""
    return df.groupBy("user_id").agg(F.max_by("history", rank).alias("history"))


def unify_impressions_tsv(behaviors: DataFrame) -> DataFrame:
    """Raw behaviors strings to the unified impressions."""
    parsed = behaviors.select(
        F.col("impression_id").cast("string"), F.col("user_id").cast("string"), parse_time(F.col("time")).alias("time"),
        parse_labeled_impressions(F.col("impressions")).alias("parsed"))
    return unnest(parsed, "parsed").withColumnsRenamed(
        {"clicked": "clicked_articles", "unclicked": "unclicked_articles"})


def unify_impressions_parquet(behaviors: DataFrame) -> DataFrame:
    """In-view and clicked lists to the unified impressions."""
    return behaviors.select(
        "impression_id", "user_id", "time", ids_to_string(F.col("clicked")).alias("clicked_articles"),
        unclicked(F.col("inview"), F.col("clicked")).alias("unclicked_articles"))


def history_rows(users: DataFrame) -> DataFrame:
    """(user_id, pos, article_id), one row per history entry."""
    return users.select("user_id", F.posexplode(F.coalesce("history", empty_ids())).alias("pos", "article_id"))


def candidate_set(impressions: DataFrame) -> DataFrame:
    """Clicked and unclicked ids as one distinct list per impression."""
    return impressions.withColumn(
        "candidates", F.array_union(F.coalesce("clicked_articles", empty_ids()),
                                    F.coalesce("unclicked_articles", empty_ids())))


def labeled_candidates(impressions: DataFrame, distinct: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per candidate: clicked first with label 1, then unclicked with label 0.

    Duplicates stay unless `distinct`, which gives the set form that recall is computed on. The row
    key is `row_id` where the frame has it, else the impression id.
    """
    clicked = F.coalesce("clicked_articles", empty_ids())
    others = F.coalesce("unclicked_articles", empty_ids())
    if distinct:
        clicked = F.array_distinct(clicked)
        others = F.array_except(others, clicked)
    items = F.concat(
        F.transform(clicked, lambda x: F.struct(x.alias("article_id"), F.lit(1).alias("label"))),
        F.transform(others, lambda x: F.struct(x.alias("article_id"), F.lit(0).alias("label"))))
    key = F.col("row_id") if "row_id" in impressions.columns else F.col("impression_id")
    return impressions.select(
        key.alias("row_id"), "user_id", *keep, F.posexplode(items).alias("pos", "item")).select(
        "row_id", "user_id", *keep, "pos", "item.article_id", "item.label")
