"""One query per operator over the driver's tables: name -> function of (session, table folder).

Lists are returned as joined text and floats rounded to six digits, so that results compare by value.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.catalog import tables as t
from newsloom.functions import lists, text, times
from newsloom.functions.vectors import l2_norm
from newsloom.operators import (
    beyond, features, growing, lexical, metrics, popularity, profile, ranking, retrieval, semantic, skew, splits, timeline, unify)
from newsloom.plans import ablation, build, evaluate, predict
from newsloom.session import stage, staging_path
from newsloom.sources import readers, writers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
KS = (1, 3, 5)
TOP = 10


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# Helpers ---------------------------------------------------------------------------------------

def r6(col: Column | str) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.round(col.cast("double"), 6)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: r6(n) for n in names})


def joined(name: str) -> Column:
    return F.array_join(F.col(name).cast("array<string>"), " ").alias(name)


def stamp(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


def split_impressions(spark, sf, split: str) -> DataFrame:
    return splits.one_split(t.impressions(spark, sf), split)


def test_impressions(spark, sf) -> DataFrame:
    return split_impressions(spark, sf, "test")


def train_popularity(spark, sf) -> DataFrame:
    return popularity.popularity(split_impressions(spark, sf, "train"))


_STORED: dict[tuple[str, str, str], object] = {}


def stored(spark, sf: str, name: str, make: Callable[[], object]):
    """A store table that many queries read, written by the first of them in a session."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _STORED:
        _STORED[key] = make()
    return _STORED[key]


def users(spark, sf) -> DataFrame:
    return stored(spark, sf, "users", lambda: stage(t.users(spark, sf), "users"))


def index(spark, sf) -> lexical.LexicalIndex:
    return stored(spark, sf, "index", lambda: lexical.build_bm25_index(t.articles(spark, sf)))


def forward(spark, sf) -> DataFrame:
    return stored(spark, sf, "forward", lambda: retrieval.forward_index(index(spark, sf).postings))


def balls(spark, sf) -> tuple[DataFrame, DataFrame]:
    return stored(spark, sf, "balls", lambda: retrieval.exact_vector_index(t.vectors(spark, sf)))


def test_candidates(spark, sf) -> DataFrame:
    return unify.labeled_candidates(test_impressions(spark, sf))


def all_candidates(spark, sf) -> DataFrame:
    return unify.labeled_candidates(t.impressions(spark, sf))


def all_pairs(spark, sf) -> DataFrame:
    return evaluate.distinct_pairs(all_candidates(spark, sf))


def unlabeled_test(spark, sf) -> DataFrame:
    """Test impressions without labels: in-view order, the row number taken from the event."""
    rows = splits.one_split(t.inview_log(spark, sf).withColumnRenamed("impression_time", "time"), "test")
    return rows.select(
        F.col("impression_id").alias("row_id"), F.col("impression_id").cast("string").alias("impression_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("article_ids_inview").cast("array<string>").alias("candidates"))


def late_histories(spark, sf) -> DataFrame:
    """Histories logged with the events of the test day; many users have none."""
    log = t.history_log(spark, sf).withColumn("time", F.col("impression_time"))
    return splits.one_split(log, "test").select(
        F.col("user_id").cast("string").alias("user_id"), F.col("article_id_fixed").cast("array<string>").alias("history"),
        F.col("event_id").alias("source_rank"))


def lexical_scored(spark, sf) -> DataFrame:
    """All candidates with their BM25 score, read twice and not written out."""
    return evaluate.score_lexical(all_candidates(spark, sf), users(spark, sf), index(spark, sf), staged=False)


def semantic_ranked(spark, sf) -> DataFrame:
    """All candidates ranked by cosine. Candidates come from within a row of the events, so they are read twice and not written
    out, and neither are the ranks, which every query reads once."""
    cands = evaluate.score_semantic(all_candidates(spark, sf), users(spark, sf), t.vectors(spark, sf), "drop", staged=False)
    return ranking.rank_candidates(cands)


def scored_test(spark, sf) -> DataFrame:
    """Comparable test candidates with both scores."""
    return evaluate.score_both(test_impressions(spark, sf), users(spark, sf), t.articles(spark, sf),
                               t.vectors(spark, sf), index(spark, sf))


def test_metrics(spark, sf) -> DataFrame:
    return evaluate.evaluate_impressions(test_impressions(spark, sf), users(spark, sf), t.articles(spark, sf),
                                         t.vectors(spark, sf), index(spark, sf))


def write_tsv(df: DataFrame, path: str) -> str:
    """Files of bounded rows, as a compressed text is read by one task."""
    cols = [F.coalesce(F.col(c), F.lit("")) for c in df.columns]
    df.select(F.concat_ws("\t", *cols).alias("value")).write.option("compression", "gzip").option("maxRecordsPerFile", 1 << 16).text(path)
    return path


def store_digest(store: dict[str, DataFrame]) -> DataFrame:
    """(name, n_rows, digest) of the seven store tables: the sum over rows of 32 bits of the md5 of a row's values as text.

    Fractions count by their value in millionths, lists by their items; rows may come in any order.
    """
    def listed(c: str) -> Column:
        return F.array_join(F.col(c).cast("array<string>"), " ")

    def millionths(c: str) -> Column:
        return F.round(F.col(c) * 1000000).cast("bigint")

    texts = {
        "articles": ["article_id", "title", "abstract", "body", "category"], "users": ["user_id", listed("history")],
        "impressions": ["impression_id", "user_id", stamp("time"), listed("clicked_articles"), listed("unclicked_articles"), "split"],
        "vectors": ["article_id", F.array_join(F.transform("embedding", lambda x: F.round(x * 1000).cast("bigint").cast("string")), " ")],
        "postings": ["term", "article_id", "tf", "dl", "df", millionths("idf"), millionths("weight")], "docs": ["article_id", "dl"],
        "stats": ["n", millionths("avgdl"), millionths("k1"), millionths("b")]}
    out = []
    for name, cols in texts.items():
        row = F.md5(F.concat_ws("|", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]).cast("binary"))
        code = F.conv(F.substring(row, 1, 8), 16, 10).cast("bigint")
        out.append(store[name].agg(F.count(F.lit(1)).alias("n_rows"), F.sum(code).alias("digest")).select(F.lit(name).alias("name"), "n_rows", "digest"))
    return splits.union_all(out)


# Sources ---------------------------------------------------------------------------------------

@query
def read_news_tsv(spark, sf):
    path = write_tsv(t.news(spark, sf), staging_path(spark, "news"))
    return readers.read_news_tsv(spark, path).drop("abstract_entities")


@query
def read_behaviors_tsv(spark, sf):
    path = write_tsv(t.behaviors(spark, sf), staging_path(spark, "behaviors"))
    return readers.read_behaviors_tsv(spark, path)


@query
def read_vec(spark, sf):
    path = staging_path(spark, "vec")
    line = F.concat_ws("\t", "article_id", F.array_join(F.col("embedding").cast("array<string>"), "\t"))
    t.vectors(spark, sf).select(line.alias("value")).write.text(path)
    return readers.read_vec(spark, path, 64).select(
        "entity_id", F.size("embedding").cast("bigint").alias("dims"), r6(l2_norm(F.col("embedding"))).alias("norm"))


@query
def read_articles_parquet(spark, sf):
    raw = readers.read_articles_parquet(spark, f"{sf}/documents.parquet",
                                        {"doc_id": "article_id", "text": "title", "lang": "category_str"})
    return raw.select("article_id", "title", "subtitle", "body", "category_str")


@query
def read_history_parquet(spark, sf):
    path = staging_path(spark, "history")
    t.history_log(spark, sf).write.parquet(path)
    return readers.read_history_parquet(spark, path).select("user_id", joined("history"))


@query
def read_behaviors_parquet(spark, sf):
    path = staging_path(spark, "inview")
    t.inview_log(spark, sf).write.parquet(path)
    return readers.read_behaviors_parquet(spark, path).select(
        "impression_id", "user_id", stamp("time"), joined("inview"), joined("clicked"))


@query
def load_store(spark, sf):
    root = staging_path(spark, "store")
    idx, rows = index(spark, sf), splits.temporal_split(t.impressions(spark, sf))
    for name, df in (("articles", t.articles(spark, sf)), ("users", users(spark, sf)), ("vectors", t.vectors(spark, sf))):
        writers.write_table(df, root, name, "one")
        writers.write_table(df.limit(1), root, name, "other")
    writers.write_splits(rows, root, "one")
    writers.write_index(idx, root, "one")
    return store_digest(readers.load_store(spark, root, "one"))


@query
def scan_many(spark, sf):
    both = readers.scan_many(spark, [f"{sf}/events.parquet", f"{sf}/events.parquet"])
    return both.groupBy("source_rank", "event_type").agg(F.count(F.lit(1)).alias("n_rows"), F.max("event_id").alias("last_id"))


@query
def read_all_datasets(spark, sf):
    root = staging_path(spark, "datasets")
    rows = splits.temporal_split(t.impressions(spark, sf)).select("impression_id", "split")
    behaviors = t.behaviors(spark, sf).join(rows, "impression_id")
    for name in splits.SPLITS:
        part = behaviors.where(F.col("split") == name).drop("split")
        write_tsv(part.select("impression_id", "user_id", "time", "history", "impressions"), f"{root}/logs_{name}/behaviors.tsv")
    return readers.read_all_datasets(spark, f"{root}/*/behaviors.tsv", "behaviors", "part-*", level=2).select(
        "dataset", "impression_id", "user_id", "impressions")


@query
def read_test_impressions(spark, sf):
    tsv, inview = staging_path(spark, "test-tsv"), staging_path(spark, "test-parquet")
    bare = F.regexp_replace("impressions", "-[01]", "")
    write_tsv(t.behaviors(spark, sf).withColumn("impressions", bare), tsv)
    t.inview_log(spark, sf).drop("article_ids_clicked", "article_id").write.parquet(inview)
    rows = readers.read_test_impressions(spark, tsv, inview)
    return rows.select("impression_id", "user_id", F.coalesce(F.size("history"), F.lit(-1)).cast("bigint").alias("n_history"),
                       joined("candidates"))


@query
def history_for_test(spark, sf):
    late = late_histories(spark, sf)
    return readers.history_for_test(unify.latest_users(late), users(spark, sf), per_user=True).select(
        "user_id", joined("history"))


@query
def profile_files(spark, sf):
    frames = [readers.profile_files(t.table(spark, sf, n)) for n in ("events", "documents", "embeddings")]
    return splits.union_all(frames).select(
        F.element_at(F.split("file_path", "/"), -1).alias("file_name"), "n_rows", "n_columns")


# Sinks -----------------------------------------------------------------------------------------

@query
def write_table(spark, sf):
    root = staging_path(spark, "table")
    path = writers.write_table(t.impressions(spark, sf), root, "impressions", "one")
    return spark.read.parquet(path).select(
        "dataset", "impression_id", "user_id", stamp("time"), joined("clicked_articles"), joined("unclicked_articles"))


@query
def write_splits(spark, sf):
    path = writers.write_splits(splits.temporal_split(t.impressions(spark, sf)), staging_path(spark, "splits"), "one")
    return spark.read.parquet(path).groupBy("dataset", "split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("user_id").alias("n_users"))


@query
def write_index(spark, sf):
    """All values of the three stored tables in one shape: postings by term and article, lengths, and the statistics."""
    root = staging_path(spark, "index")
    writers.write_index(index(spark, sf), root, "one")
    stored_ = build.index_from_store(readers.load_store(spark, root, "one", ("postings", "docs", "stats")))
    none = F.lit(None).cast("double")
    rows = stored_.postings.select("term", "article_id", "tf", "dl", r6("weight").alias("weight"), r6("idf").alias("idf"))
    docs = stored_.docs.select(F.lit("").alias("term"), "article_id", F.lit(None).cast("bigint").alias("tf"), "dl", none.alias("weight"), none.alias("idf"))
    stats = stored_.stats.select(F.lit("").alias("term"), F.lit("").alias("article_id"), "n", F.lit(None).cast("bigint").alias("dl"), r6("avgdl").alias("weight"), r6("b").alias("idf"))
    return splits.union_all([rows, docs, stats.withColumnRenamed("n", "tf")])


@query
def write_embeddings(spark, sf):
    root = staging_path(spark, "vectors")
    rows = t.vectors(spark, sf)
    first = t.table(spark, sf, "embeddings").where(F.col("label") == 0).select(F.col("vec_id").cast("string").alias("article_id"), "embedding")
    writers.write_embeddings(first, root, "one")
    writers.write_embeddings(rows, root, "one")
    return spark.read.parquet(f"{root}/vectors").select(
        "article_id", F.size("embedding").cast("bigint").alias("dims"), r6(l2_norm(F.col("embedding"))).alias("norm"))


@query
def write_metrics(spark, sf):
    path = staging_path(spark, "metrics")
    writers.write_metrics(metrics.mean_by_slice(test_metrics(spark, sf)), path)
    stored = spark.read.schema("model string, slice string, metric string, value double").json(path)
    return rounded(stored, "value")


@query
def write_predictions(spark, sf):
    path = staging_path(spark, "predictions")
    writers.write_predictions(popularity.popularity_predictions(unlabeled_test(spark, sf), train_popularity(spark, sf)), path)
    return spark.read.text(path)


# Projections and scalar functions --------------------------------------------------------------

@query
def unify_articles(spark, sf):
    parquet = t.table(spark, sf, "documents").withColumnsRenamed({"doc_id": "article_id", "text": "title", "source": "subtitle", "lang": "category"})
    tsv = unify.unify_articles(t.news(spark, sf), "tsv").withColumn("kind", F.lit("tsv"))
    return tsv.unionByName(unify.unify_articles(parquet, "parquet").withColumn("kind", F.lit("parquet")))


@query
def parse_time(spark, sf):
    return t.behaviors(spark, sf).select("impression_id", times.parse_time(F.col("time")).alias("time")).select(
        "impression_id", stamp("time"))


@query
def parse_labeled_impressions(spark, sf):
    parsed = t.behaviors(spark, sf).select("impression_id", text.parse_labeled_impressions(F.col("impressions")).alias("p"))
    return lists.unnest(parsed, "p").select("impression_id", joined("clicked"), joined("unclicked"))


@query
def parse_history(spark, sf):
    parsed = text.parse_history(F.col("history"))
    return t.behaviors(spark, sf).select(
        "impression_id", F.array_join(parsed, ",").alias("ids"), F.size(parsed).cast("bigint").alias("n_ids"))


@query
def parse_candidates(spark, sf):
    return t.behaviors(spark, sf).select(
        "impression_id", F.array_join(text.parse_candidates(F.regexp_replace("impressions", "-[01]", "")), ",").alias("ids"))


@query
def ids_to_string(spark, sf):
    ids = lists.ids_to_string(F.col("article_ids_inview"))
    return t.inview_log(spark, sf).select("impression_id", F.array_join(ids, "|").alias("ids"))


@query
def unclicked(spark, sf):
    rest = lists.unclicked(F.col("article_ids_inview"), F.col("article_ids_clicked"))
    return t.inview_log(spark, sf).select("impression_id", F.array_join(rest, " ").alias("unclicked"))


@query
def full_text(spark, sf):
    return t.articles(spark, sf).select("article_id", text.full_text("title", "abstract").alias("full_text"))


@query
def tokenize(spark, sf):
    tokens = text.tokenize(text.full_text("title", "abstract"))
    return t.articles(spark, sf).select("article_id", F.array_join(tokens, " ").alias("tokens"),
                                        F.size(tokens).cast("bigint").alias("n_tokens"))


@query
def list_len(spark, sf):
    return t.inview_log(spark, sf).select(
        "impression_id", lists.list_len(F.col("article_ids_inview")).alias("n_inview"),
        lists.list_len(F.col("article_ids_clicked")).alias("n_clicked"))


@query
def string_helpers(spark, sf):
    items = t.behaviors(spark, sf).select("impression_id", F.explode(text.split_ids(F.col("impressions"))).alias("item"))
    return items.select("impression_id", "item", text.char_len(F.col("item")).alias("n_chars"),
                        F.col("item").endswith("-1").alias("is_click"),
                        text.strip_click_suffix(F.col("item")).alias("stripped"))


@query
def parse_entities(spark, sf):
    rows = t.news(spark, sf).select("article_id", F.explode(text.parse_entities(F.col("title_entities"))).alias("e"))
    return rows.select("article_id", F.col("e.Label").alias("label"), F.col("e.Type").alias("entity_type"),
                       F.col("e.WikidataId").alias("wikidata_id"), F.col("e.Confidence").alias("confidence"))


@query
def click_rate(spark, sf):
    raw = F.col("impressions")
    return t.behaviors(spark, sf).select(
        "impression_id", text.click_count(raw).alias("n_clicks"), r6(text.click_rate(raw)).alias("click_rate"))


@query
def rename_and_default(spark, sf):
    out = lists.rename_and_default(t.inview_log(spark, sf).select("impression_id", "article_id", "gender"),
                                   {"article_id": "clicked_id"}, {"gender": -1, "split_name": "none"}, ["clicked_id"])
    return out.select("impression_id", F.col("clicked_id").cast("bigint").alias("clicked_id"),
                      F.col("gender").cast("bigint").alias("gender"), "split_name")


@query
def explode_with_pos(spark, sf):
    rows = t.inview_log(spark, sf).select("impression_id", "article_ids_inview")
    return lists.explode_with_pos(rows, "article_ids_inview").select(
        "impression_id", F.col("pos").cast("bigint").alias("pos"), F.col("article_id").cast("bigint").alias("article_id"))


@query
def explode_ids(spark, sf):
    rows = t.inview_log(spark, sf).select("impression_id", "article_ids_clicked")
    return lists.explode_ids(rows, "article_ids_clicked", keep_empty=True).select(
        "impression_id", F.coalesce(F.col("article_id"), F.lit(-1)).cast("bigint").alias("article_id"))


@query
def unnest(spark, sf):
    rows = t.inview_log(spark, sf).select("impression_id", F.struct(F.col("device_type").cast("bigint").alias("device"), "is_sso_user").alias("s"))
    return lists.unnest(rows, "s")


@query
def has_labels(spark, sf):
    raw = F.col("impressions")
    rows = t.behaviors(spark, sf)
    bare = rows.withColumn("impressions", F.regexp_replace(raw, "-[01]", "")).withColumn("kind", F.lit("bare"))
    return rows.withColumn("kind", F.lit("labeled")).unionByName(bare).groupBy("kind", text.has_labels(raw).alias("has_labels")).agg(
        F.count(F.lit(1)).alias("n_rows"))


# Filters ---------------------------------------------------------------------------------------

@query
def between_times(spark, sf):
    low, high = (F.lit(f"2024-01-{d} 00:00:00").cast("timestamp_ntz") for d in ("10", "20"))
    return splits.between_times(t.impressions(spark, sf), low, high).select("impression_id", stamp("time"))


@query
def only_labeled(spark, sf):
    rows = t.impressions(spark, sf)
    one = splits.only_labeled(rows).select("impression_id", F.lit("clicked").alias("kept_by"))
    return one.unionByName(splits.only_labeled(rows, True).select("impression_id", F.lit("clicked_and_not").alias("kept_by")))


@query
def with_history(spark, sf):
    rows = evaluate.attach_history(t.impressions(spark, sf), users(spark, sf))
    return splits.with_history(rows).select("impression_id", "user_id")


@query
def all_candidates_known(spark, sf):
    cands = unify.labeled_candidates(t.impressions(spark, sf))
    flags = t.vectors(spark, sf).select("article_id", F.lit(1.0).alias("semantic"))
    rows = skew.skew_join(cands, flags, ["article_id"], "left")
    return evaluate.all_candidates_known(rows).groupBy("row_id").agg(F.count(F.lit(1)).alias("n_candidates"))


@query
def only_clicked_items(spark, sf):
    return popularity.clicked_items(t.behaviors(spark, sf)).groupBy("item").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def select_dataset(spark, sf):
    root = staging_path(spark, "families")
    writers.write_table(t.impressions(spark, sf), root, "impressions", "mind_log")
    path = writers.write_table(splits.only_labeled(t.impressions(spark, sf)), root, "impressions", "ebnerd_log")
    picked = [splits.select_dataset(spark.read.parquet(path), k).groupBy("dataset").agg(F.count(F.lit(1)).alias("n_rows"))
              .withColumn("kind", F.lit(k)) for k in ("mind", "ebnerd", "both")]
    return splits.union_all(picked)


@query
def slice_by_history(spark, sf):
    rows = evaluate.attach_hist_len(t.impressions(spark, sf), users(spark, sf))
    return splits.slice_by_history(rows).select("impression_id", "hist_len", "slice")


# Joins -----------------------------------------------------------------------------------------

@query
def attach_history(spark, sf):
    return evaluate.attach_history(t.impressions(spark, sf), users(spark, sf)).select("impression_id", joined("history"))


@query
def history_text(spark, sf):
    return lexical.history_text(users(spark, sf), t.articles(spark, sf)).select("user_id", "article_id", "text")


@query
def known_history(spark, sf):
    return semantic.known_history(users(spark, sf), t.vectors(spark, sf)).select("user_id", "article_id", "n")


@query
def attach_vectors(spark, sf):
    cands = all_candidates(spark, sf)
    rows = [semantic.attach_vectors(cands, t.vectors(spark, sf), policy).select(
        F.lit(policy).alias("policy"), "row_id", "article_id", F.col("embedding").isNotNull().alias("known"))
        for policy in ("null", "drop")]
    return rows[0].unionByName(rows[1])


@query
def match_terms(spark, sf):
    idx = index(spark, sf)
    asked = lexical.history_query(users(spark, sf), idx.postings, by_article=True)
    return lexical.match_terms(stage(all_pairs(spark, sf), "pairs"), asked, idx.postings).select(
        "user_id", "article_id", "term", "tf", r6("weight").alias("weight"))


def stored_postings(spark, sf) -> DataFrame:
    """The postings in buckets of the article, as a store keeps them."""
    path = stored(spark, sf, "buckets", lambda: writers.write_bucketed(
        index(spark, sf).postings, staging_path(spark, "store"), "postings", "article_id"))
    return readers.read_bucketed(spark, path)


@query
def match_terms_stored(spark, sf):
    idx = index(spark, sf)
    asked = lexical.history_query(users(spark, sf), idx.postings, by_article=True)
    rows = lexical.match_terms(stage(all_pairs(spark, sf), "pairs"), asked, stored_postings(spark, sf))
    return rows.groupBy("user_id", "article_id").agg(F.count(F.lit(1)).alias("n_terms"), F.sum("tf").alias("total_tf"), r6(F.sum("weight")).alias("weight"))


@query
def attach_popularity(spark, sf):
    cands = unify.labeled_candidates(t.impressions(spark, sf))
    return popularity.attach_popularity(cands, train_popularity(spark, sf)).select("row_id", "article_id", "clicks")


@query
def attach_category(spark, sf):
    top = ranking.top_k(semantic_ranked(spark, sf), 5)
    return metrics.attach_category(top, t.articles(spark, sf)).select("row_id", "article_id", "category")


# Aggregations ----------------------------------------------------------------------------------

@query
def first_history(spark, sf):
    return unify.first_history(t.behaviors(spark, sf)).select("user_id", joined("history"))


@query
def distinct_users(spark, sf):
    rows = t.history_log(spark, sf).select(F.col("user_id").cast("string").alias("user_id"), F.col("article_id_fixed").alias("history"))
    return unify.distinct_users(rows).select("user_id", joined("history"))


@query
def latest_users(spark, sf):
    rows = t.history_log(spark, sf).select(
        F.col("user_id").cast("string").alias("user_id"), F.col("article_id_fixed").alias("history"), F.col("event_id").alias("source_rank"))
    return unify.latest_users(rows).select("user_id", joined("history"))


@query
def max_time(spark, sf):
    return splits.max_time(t.impressions(spark, sf)).select(stamp("max_time"))


@query
def term_freq(spark, sf):
    return lexical.term_freq(t.articles(spark, sf)).select("article_id", "term", "tf")


@query
def corpus_stats(spark, sf):
    arts = t.articles(spark, sf)
    return rounded(lexical.corpus_stats(arts, lexical.term_freq(arts)), "avgdl")


@query
def idf(spark, sf):
    arts = t.articles(spark, sf)
    n = arts.agg(F.count(F.lit(1)).alias("n")).scalar()
    return lexical.doc_freq(lexical.term_freq(arts)).select("term", "df", r6(lexical.idf(F.col("df"), n)).alias("idf"))


@query
def popularity_counts(spark, sf):
    return popularity.popularity(t.impressions(spark, sf))


@query
def popularity_from_behaviors(spark, sf):
    return popularity.popularity_from_behaviors(t.behaviors(spark, sf))


@query
def popularity_summary(spark, sf):
    return popularity.popularity_summary(popularity.popularity(t.impressions(spark, sf)))


@query
def value_counts(spark, sf):
    return profile.value_counts(t.news(spark, sf), ["category", "subcategory"])


@query
def null_profile(spark, sf):
    return rounded(profile.null_profile(t.inview_log(spark, sf)), "pct_nulls")


@query
def distinct_profile(spark, sf):
    return profile.distinct_profile(t.inview_log(spark, sf), ["impression_id", "user_id", "session_id"])


def _measures() -> dict[str, Column]:
    return {"n_inview": F.size("article_ids_inview"), "n_clicked": F.size("article_ids_clicked"),
            "read_time": F.col("read_time"), "scroll_percentage": F.col("scroll_percentage")}


@query
def summary_stats(spark, sf):
    out = profile.summary_stats(t.inview_log(spark, sf), _measures())
    return rounded(out, "min_value", "max_value", "mean_value", "median_value")


def log_sketches(spark, sf) -> DataFrame:
    log = t.inview_log(spark, sf)
    distinct = {c: F.col(c) for c in ("impression_id", "user_id", "session_id")}
    return stored(spark, sf, "sketches", lambda: stage(profile.day_sketches(log, "impression_time", distinct, {"read_time": F.col("read_time"), "value": F.col("impression_id").cast("double")}), "sketches"))


@query
def distinct_profile_sketch(spark, sf):
    """Distinct counts of all days from stored sketches, held against the exact ones: within four in a hundred."""
    found = profile.distinct_from_sketches(log_sketches(spark, sf))
    exact = profile.distinct_profile(t.inview_log(spark, sf), ["impression_id", "user_id", "session_id"])
    return found.withColumnRenamed("n_distinct", "estimate").join(exact, "column_name").select(
        "column_name", "n", "n_distinct", (F.abs(F.col("estimate") - F.col("n_distinct")) <= 0.04 * F.col("n_distinct")).alias("within"))


@query
def distinct_profile_approx(spark, sf):
    """Distinct counts by one sketch per task, held against the exact ones: within one in ten."""
    cols = ["impression_id", "user_id", "session_id"]
    found = profile.distinct_profile(t.inview_log(spark, sf), cols, approx=True).withColumnRenamed("n_distinct", "estimate")
    return found.join(profile.distinct_profile(t.inview_log(spark, sf), cols), "column_name").select(
        "column_name", "n_distinct", (F.abs(F.col("estimate") - F.col("n_distinct")) <= 0.1 * F.col("n_distinct")).alias("within"))


@query
def quantile_sketch(spark, sf):
    """Quantiles of half the month from stored sketches, held against the ranks in the log: within one in a hundred."""
    first, last = "2024-01-05", "2024-01-20"
    found = profile.quantiles_from_sketches(log_sketches(spark, sf), (0.1, 0.5, 0.95), first, last)
    log = t.inview_log(spark, sf).where(F.to_date("impression_time").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    cells = F.explode(F.array(*[F.struct(F.lit(n).alias("column_name"), c.alias("x")) for n, c in (("read_time", F.col("read_time")), ("value", F.col("impression_id").cast("double")))]))
    rows = log.select(cells.alias("c")).select("c.*").join(F.broadcast(found), "column_name")
    ranks = rows.groupBy("column_name", "q", "n", "low", "high").agg(
        (F.count_if(F.col("x") < F.col("value")) / F.count("x")).alias("under"), (F.count_if(F.col("x") <= F.col("value")) / F.count("x")).alias("upto"))
    within = (F.col("under") <= F.col("q") + 0.01) & (F.col("upto") >= F.col("q") - 0.01)
    return rounded(ranks.select("column_name", "q", "n", "low", "high", within.alias("within")), "q", "low", "high")


@query
def exact_quantiles(spark, sf):
    out = profile.exact_quantiles(t.table(spark, sf, "events"), {"value": F.col("value"), "event_id": F.col("event_id")}, (0.1, 0.5, 0.95))
    return rounded(out, "q", "value")


@query
def share(spark, sf):
    return rounded(profile.share(t.inview_log(spark, sf), ["is_sso_user", "is_subscriber"]), "share_true")


@query
def activity_per_user(spark, sf):
    out = profile.activity_per_user(t.impressions(spark, sf))
    return rounded(out, "min_value", "max_value", "mean_value", "median_value")


@query
def most_active_users(spark, sf):
    return profile.most_active_users(t.impressions(spark, sf))


@query
def clicks_per_impression(spark, sf):
    return profile.clicks_per_impression(t.impressions(spark, sf))


@query
def histogram(spark, sf):
    return rounded(profile.histogram(t.table(spark, sf, "documents"), F.col("n_chars"), 50), "low", "high")


@query
def mean_vectors(spark, sf):
    rows = t.table(spark, sf, "embeddings").select(F.col("label").cast("bigint").alias("label"), "embedding")
    out = semantic.mean_vectors(rows, "label")
    return out.select("label", F.posexplode("embedding").alias("dim", "value")).select(
        "label", F.col("dim").cast("bigint").alias("dim"), r6("value").alias("value"))


@query
def ranks_to_list(spark, sf):
    pop = train_popularity(spark, sf)
    ranked = ranking.rank_by_popularity(popularity.attach_popularity(all_candidates(spark, sf), pop))
    return ranking.ranks_to_list(ranked).select("row_id", joined("ranks"))


@query
def split_sizes(spark, sf):
    return splits.split_sizes(splits.temporal_split(t.impressions(spark, sf)))


@query
def mean_by_slice(spark, sf):
    return rounded(metrics.mean_by_slice(test_metrics(spark, sf)), "value")


# Windows, sorts, sets --------------------------------------------------------------------------

@query
def rank_by_popularity(spark, sf):
    cands = popularity.attach_popularity(unify.labeled_candidates(t.impressions(spark, sf)), train_popularity(spark, sf))
    return ranking.rank_by_popularity(cands).select("row_id", "article_id", "clicks", F.col("rank").cast("bigint").alias("rank"))


@query
def ranks_from_scores(spark, sf):
    return semantic_ranked(spark, sf).select("row_id", "article_id", F.col("rank").cast("bigint").alias("rank"))


@query
def order_by_score(spark, sf):
    ranked = ranking.rank_candidates(lexical_scored(spark, sf))
    ordered = ranked.groupBy("row_id").agg(F.array_sort(F.collect_list(F.struct("rank", "article_id"))).alias("o"))
    return ordered.select("row_id", F.array_join(F.col("o.article_id"), " ").alias("ordered"))


@query
def tie_groups(spark, sf):
    cands = popularity.attach_popularity(all_candidates(spark, sf), train_popularity(spark, sf))
    return ranking.tie_groups(cands, "clicks").select(
        "row_id", "article_id", F.col("tie_rank").cast("bigint").alias("tie_rank"), "tie_size", r6("avg_rank").alias("avg_rank"))


@query
def sort_by_time(spark, sf):
    return splits.sort_by_time(t.impressions(spark, sf)).select("impression_id", stamp("time"))


@query
def top_n(spark, sf):
    return splits.top_n(popularity.popularity(t.impressions(spark, sf)), [F.desc("clicks"), "article_id"], 10)


@query
def top_k(spark, sf):
    return ranking.top_k(semantic_ranked(spark, sf), 5).select("row_id", "article_id", F.col("rank").cast("bigint").alias("rank"))


@query
def head(spark, sf):
    return splits.head(t.impressions(spark, sf).orderBy("time", "impression_id"), 5).select("impression_id", "user_id")


@query
def union_all(spark, sf):
    rows = splits.temporal_split(t.impressions(spark, sf))
    parts = [rows.where(F.col("split") == s) for s in splits.SPLITS]
    return splits.union_all([*parts, parts[-1]]).groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def candidate_set(spark, sf):
    return unify.candidate_set(t.impressions(spark, sf)).select("impression_id", joined("candidates"))


@query
def labeled_candidates(spark, sf):
    return unify.labeled_candidates(t.impressions(spark, sf)).select(
        "row_id", "user_id", F.col("pos").cast("bigint").alias("pos"), "article_id", F.col("label").cast("bigint").alias("label"))


@query
def hits(spark, sf):
    return ranking.hits(semantic_ranked(spark, sf), 3)


@query
def list_minus(spark, sf):
    rest = lists.list_minus(F.col("article_id_fixed"), F.col("article_ids_inview"))
    rows = t.history_log(spark, sf).select("event_id", "article_id_fixed").join(
        t.inview_log(spark, sf).select(F.col("impression_id").alias("event_id"), "article_ids_inview"), "event_id")
    return rows.select("event_id", F.array_join(rest.cast("array<string>"), " ").alias("not_in_view"))


@query
def column_presence(spark, sf):
    log = t.inview_log(spark, sf)
    test = log.drop("article_ids_clicked", "article_id").withColumn("is_beyond_accuracy", F.col("user_id") % 2 == 0)
    return features.column_presence({"train": log, "test": test})


# Scoring and retrieval -------------------------------------------------------------------------

@query
def build_bm25_index(spark, sf):
    return rounded(lexical.build_bm25_index(t.articles(spark, sf)).postings, "idf", "weight")


@query
def history_query(spark, sf):
    return lexical.history_query(users(spark, sf), index(spark, sf).postings).select("user_id", "term")


@query
def bm25_score(spark, sf):
    cands = lexical_scored(spark, sf)
    return cands.select("row_id", "article_id", "score")


@query
def l2_normalize(spark, sf):
    unit = semantic.l2_normalize(t.vectors(spark, sf))
    return unit.select("article_id", F.posexplode("embedding").alias("dim", "value")).select(
        "article_id", F.col("dim").cast("bigint").alias("dim"), r6("value").alias("value"))


@query
def user_vector(spark, sf):
    vecs = semantic.all_user_vectors(users(spark, sf), t.vectors(spark, sf), 64)
    return vecs.select("user_id", F.posexplode("user_vector").alias("dim", "value")).select(
        "user_id", F.col("dim").cast("bigint").alias("dim"), r6("value").alias("value"))


@query
def semantic_score(spark, sf):
    cands = evaluate.score_semantic(all_candidates(spark, sf), users(spark, sf), t.vectors(spark, sf), "last")
    return cands.select("row_id", "article_id", "score")


@query
def popularity_score(spark, sf):
    lines = popularity.popularity_predictions(unlabeled_test(spark, sf), train_popularity(spark, sf))
    return writers.prediction_lines(lines)


@query
def embed_articles(spark, sf):
    def make():
        return lambda texts: np.array([[len(x), x.count(" "), x.count("e")] for x in texts], dtype="float32")
    out = semantic.embed_articles(t.articles(spark, sf), make)
    return out.select("article_id", F.posexplode("embedding").alias("dim", "value")).select(
        "article_id", F.col("dim").cast("bigint").alias("dim"), F.col("value").cast("double").alias("value"))


@query
def hash_encoder_vectors(spark, sf):
    out = semantic.hash_encoder_vectors(t.articles(spark, sf), 32)
    return out.select("article_id", F.posexplode("embedding").alias("dim", "value")).select(
        "article_id", F.col("dim").cast("bigint").alias("dim"), F.col("value").cast("double").alias("value"))


@query
def exact_vector_index(spark, sf):
    return balls(spark, sf)[0].select(
        "article_id", F.col("cell").cast("bigint").alias("cell"), r6("angle").alias("angle"), r6(l2_norm(F.col("embedding"))).alias("norm"))


@query
def vector_cells(spark, sf):
    rows = balls(spark, sf)[1].select("cell", "radius", "n", F.posexplode("centre").alias("dim", "value"))
    return rows.select(F.col("cell").cast("bigint").alias("cell"), F.col("dim").cast("bigint").alias("dim"),
                       r6("value").alias("value"), r6("radius").alias("radius"), "n")


@query
def rank_candidates(spark, sf):
    cands = lexical_scored(spark, sf)
    return ranking.rank_candidates(cands).select("row_id", "article_id", F.col("rank").cast("bigint").alias("rank"))


@query
def generate_predictions(spark, sf):
    test = unlabeled_test(spark, sf)
    return writers.prediction_lines(predict.generate_predictions(test, t.vectors(spark, sf), users(spark, sf)))


@query
def generate_predictions_inline(spark, sf):
    raw = splits.temporal_split(t.inview_log(spark, sf).select("impression_id", F.col("impression_time").alias("time")))
    late = raw.where(F.col("split") == "test").select(F.col("impression_id").cast("string").alias("impression_id"))
    rows = readers.unlabeled_from_behaviors(t.behaviors(spark, sf).withColumn("impressions", F.regexp_replace("impressions", "-[01]", "")))
    test = rows.join(late, "impression_id").withColumn("row_id", F.col("impression_id").cast("bigint"))
    return writers.prediction_lines(predict.generate_predictions(test, t.vectors(spark, sf)))


# Splits and store ------------------------------------------------------------------------------

@query
def temporal_split(spark, sf):
    return splits.temporal_split(t.impressions(spark, sf)).select("impression_id", "split")


@query
def temporal_split_days(spark, sf):
    return splits.temporal_split(t.impressions(spark, sf), 3, 5).select("impression_id", "split")


@query
def assert_split_order(spark, sf):
    rows = splits.temporal_split(t.impressions(spark, sf))
    splits.assert_split_order(rows)
    return splits.split_order(rows)


@query
def build_feature_store(spark, sf):
    late = late_histories(spark, sf)
    _, merged = build.build_feature_store(t.articles(spark, sf), [users(spark, sf), unify.latest_users(late)])
    return merged.select("user_id", joined("history"))


@query
def build_all(spark, sf):
    raw, root = staging_path(spark, "raw"), staging_path(spark, "store")
    write_tsv(t.news(spark, sf), f"{raw}/news.tsv")
    write_tsv(t.behaviors(spark, sf), f"{raw}/behaviors.tsv")
    build.build_from_tsv(spark, raw, root, "one")
    return store_digest(readers.load_store(spark, root, "one"))


def log_folders(spark, sf) -> str:
    """A raw Parquet click log: articles, and behaviors and histories in a training and a validation folder."""
    raw = staging_path(spark, "raw")
    docs = t.table(spark, sf, "documents")
    docs.select(F.col("doc_id").cast("int").alias("article_id"), F.col("text").alias("title"), F.col("source").alias("subtitle"),
                F.length("source").cast("smallint").alias("category")).write.option("compression", "zstd").parquet(f"{raw}/articles.parquet")
    for part, kept in (("train", "split = 'train'"), ("validation", "split <> 'train'")):
        for name, log in (("behaviors", t.inview_log(spark, sf)), ("history", t.history_log(spark, sf))):
            rows = splits.temporal_split(log.withColumn("time", F.col("impression_time"))).where(kept).drop("time", "split")
            rows.write.option("compression", "zstd").parquet(f"{raw}/{part}/{name}.parquet")
    return raw


@query
def build_all_parquet(spark, sf):
    root = staging_path(spark, "store")
    build.build_from_parquet(spark, log_folders(spark, sf), root, "one")
    return store_digest(readers.load_store(spark, root, "one"))


# Metrics ---------------------------------------------------------------------------------------

RECALLS = tuple(f"recall_{k}" for k in KS)


@query
def lexical_recall(spark, sf):
    out = evaluate.lexical_recall(test_impressions(spark, sf), users(spark, sf), index(spark, sf), KS)
    return rounded(out, *RECALLS)


@query
def semantic_recall(spark, sf):
    out = evaluate.semantic_recall(test_impressions(spark, sf), users(spark, sf), t.vectors(spark, sf), KS)
    return rounded(out, *RECALLS)


@query
def mean_recall(spark, sf):
    out = evaluate.semantic_recall(test_impressions(spark, sf), users(spark, sf), t.vectors(spark, sf), KS)
    return rounded(evaluate.mean_recall(out, KS), *RECALLS)


def popularity_scored(spark, sf) -> DataFrame:
    """All candidates by click count of the training part, which ties often."""
    cands = unify.labeled_candidates(splits.only_labeled(t.impressions(spark, sf), True))
    return popularity.attach_popularity(cands, train_popularity(spark, sf)).withColumnRenamed("clicks", "score")


@query
def auc(spark, sf):
    return rounded(metrics.auc(popularity_scored(spark, sf)), "auc")


@query
def mrr(spark, sf):
    return rounded(metrics.mrr(popularity_scored(spark, sf)), "mrr")


@query
def ndcg_at(spark, sf):
    return rounded(metrics.ndcg_at(popularity_scored(spark, sf)), "ndcg_5", "ndcg_10")


@query
def category_diversity(spark, sf):
    out = metrics.category_diversity(semantic_ranked(spark, sf), t.articles(spark, sf))
    return rounded(out, "category_diversity_5")


@query
def evaluate_impressions(spark, sf):
    return rounded(test_metrics(spark, sf), *metrics.METRICS)


@query
def slice_report(spark, sf):
    return rounded(metrics.slice_report(test_metrics(spark, sf)), "value")


@query
def compare_models(spark, sf):
    report = metrics.slice_report(test_metrics(spark, sf))
    return rounded(metrics.compare_models(report), "lexical", "semantic")


# Requirement operators -------------------------------------------------------------------------

def test_readers(spark, sf) -> DataFrame:
    return evaluate.wanted_users(users(spark, sf), test_impressions(spark, sf))


def lexical_top(spark, sf, k: int = TOP) -> DataFrame:
    query_ = stage(retrieval.history_terms(test_readers(spark, sf), forward(spark, sf)), "query")
    return stage(retrieval.bm25_retrieve(query_, forward(spark, sf), k), "top")


def semantic_top(spark, sf, k: int = TOP) -> DataFrame:
    vecs = stage(semantic.user_vectors(test_readers(spark, sf), t.vectors(spark, sf)), "user-vectors")
    return stage(retrieval.vector_retrieve(vecs, balls(spark, sf), k), "top")


def test_clicks(spark, sf) -> DataFrame:
    """(user_id, article_id) clicked in the test day, with the length of the user's history and the article's band."""
    clicks = test_candidates(spark, sf).where("label = 1").select("user_id", "article_id").distinct()
    people = users(spark, sf).select("user_id", F.size("history").cast("bigint").alias("hist_len"))
    bands = beyond.head_tail(train_popularity(spark, sf)).select("article_id", "band")
    rows = clicks.join(people, "user_id", "left").join(bands, "article_id", "left")
    return rows.withColumns({"hist_len": F.coalesce("hist_len", F.lit(0)), "band": F.coalesce("band", F.lit("tail"))})


def catalog_lists(spark, sf) -> DataFrame:
    """The 200 best articles per user and model, over the whole catalog."""
    deep = max(metrics.RECALL_CUTS)
    return stage(splits.union_all([lexical_top(spark, sf, deep).withColumn("model", F.lit("lexical")),
                                   semantic_top(spark, sf, deep).withColumn("model", F.lit("semantic"))]), "lists")


def catalog_recalls(spark, sf, lists_: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """recall_50, recall_100 and recall_200 per key for both models."""
    clicks = stage(test_clicks(spark, sf), "clicks")
    return splits.union_all([metrics.retrieval_recall(lists_.where(F.col("model") == m).drop("model"), clicks, key=key).withColumn("model", F.lit(m))
                             for m in ("lexical", "semantic")])


DEEP_RECALLS = tuple(f"recall_{k}" for k in metrics.RECALL_CUTS)


@query
def retrieval_recall(spark, sf):
    rows = catalog_recalls(spark, sf, catalog_lists(spark, sf), ("user_id", "hist_len"))
    return rounded(rows.groupBy("model").agg(*[F.avg(m).alias(m) for m in DEEP_RECALLS]), *DEEP_RECALLS)


@query
def retrieval_recall_by_slice(spark, sf):
    lists_ = catalog_lists(spark, sf)
    people = metrics.recall_by_slice(catalog_recalls(spark, sf, lists_, ("user_id", "hist_len")), DEEP_RECALLS)
    long = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in DEEP_RECALLS]))
    bands = catalog_recalls(spark, sf, lists_, ("user_id", "band")).select("model", F.col("band").alias("slice"), long.alias("cell"))
    bands = bands.groupBy("model", "slice", "cell.metric").agg(F.avg("cell.value").alias("value"))
    return rounded(people.unionByName(bands), "value")


def _top(df: DataFrame) -> DataFrame:
    return df.select("user_id", "article_id", F.col("rank").cast("bigint").alias("rank"), r6("score").alias("score"))


@query
def bm25_retrieve(spark, sf):
    return _top(lexical_top(spark, sf))


@query
def vector_retrieve(spark, sf):
    return _top(semantic_top(spark, sf))


@query
def ann_retrieve(spark, sf):
    vecs = stage(semantic.user_vectors(test_readers(spark, sf), t.vectors(spark, sf)), "user-vectors")
    return _top(retrieval.ann_retrieve(vecs, t.vectors(spark, sf), TOP, index=balls(spark, sf)))


@query
def intra_list_diversity(spark, sf):
    out = beyond.intra_list_diversity(semantic_top(spark, sf), t.vectors(spark, sf), ("user_id",))
    return rounded(out, "ild")


@query
def novelty(spark, sf):
    out = beyond.novelty(semantic_top(spark, sf), train_popularity(spark, sf), t.articles(spark, sf), ("user_id",))
    return rounded(out, "novelty")


@query
def coverage(spark, sf):
    both = splits.union_all([lexical_top(spark, sf).withColumn("model", F.lit("lexical")),
                             semantic_top(spark, sf).withColumn("model", F.lit("semantic"))])
    return rounded(beyond.coverage(both, t.articles(spark, sf)), "coverage")


@query
def bootstrap_ci(spark, sf):
    scored = popularity_scored(spark, sf)
    rows = metrics.ranking_metrics(scored, diversity_k=None).withColumn("model", F.lit("popularity"))
    return rounded(beyond.bootstrap_ci(rows, ("auc", "mrr", "ndcg_5", "ndcg_10"), b=200), "low", "high")


@query
def compare_models_interval(spark, sf):
    out = beyond.compare_with_ci(stage(test_metrics(spark, sf), "metrics"), metrics.METRICS, ("lexical", "semantic"), b=1000)
    return rounded(out, "lexical", "semantic", "difference", "low", "high")


@query
def harness_report(spark, sf):
    people = users(spark, sf).select("user_id", F.size("history").cast("bigint").alias("hist_len"))
    tops = splits.union_all([lexical_top(spark, sf).withColumn("model", F.lit("lexical")),
                             semantic_top(spark, sf).withColumn("model", F.lit("semantic"))]).join(people, "user_id")
    report = beyond.harness_report(stage(test_metrics(spark, sf), "metrics"), metrics.METRICS, tops, t.articles(spark, sf),
                                   t.vectors(spark, sf), train_popularity(spark, sf), b=1000)
    return rounded(report, "value", "low", "high")


@query
def head_tail(spark, sf):
    return beyond.head_tail(train_popularity(spark, sf)).select("article_id", "clicks", "band")


@query
def hits_by_band(spark, sf):
    ranked = semantic_ranked(spark, sf).withColumn("model", F.lit("semantic"))
    return beyond.hits_by_band(ranked, train_popularity(spark, sf), 3)


def _log_end():
    return F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")


@query
def recency_features(spark, sf):
    clicks = features.history_clicks(t.history_log(spark, sf))
    out = features.recency_features(clicks, _log_end(), 86400.0 * 7)
    return rounded(out, "last_click_age", "decay_sum")


@query
def recency_vectors(spark, sf):
    clicks = features.history_clicks(t.history_log(spark, sf))
    out = features.recency_vectors(clicks, t.vectors(spark, sf), _log_end(), 86400.0 * 7)
    return out.select("user_id", F.posexplode("embedding").alias("dim", "value")).select(
        "user_id", F.col("dim").cast("bigint").alias("dim"), r6("value").alias("value"))


@query
def recency_at_impression(spark, sf):
    clicks = features.history_clicks(t.history_log(spark, sf))
    out = timeline.recency_at_impression(t.impressions(spark, sf), clicks, 86400.0 * 2)
    return rounded(out.select("impression_id", "user_id", F.col("n_clicks").cast("bigint").alias("n_clicks"), "last_click_age", "decay_sum"), "last_click_age", "decay_sum")


@query
def session_features(spark, sf):
    out = timeline.session_features(t.impressions(spark, sf), 6 * 3600.0)
    counts = [F.col(c).cast("bigint").alias(c) for c in ("session", "position", "n_before_clicked", "session_length")]
    return rounded(out.select("impression_id", "user_id", *counts, "session_seconds", "session_click_rate"), "session_seconds", "session_click_rate")


@query
def article_features(spark, sf):
    return features.article_features(t.news(spark, sf)).select("article_id", "category", "subcategory", joined("entities"), "n_entities")


@query
def entity_vectors(spark, sf):
    """Mean vectors of the entities of news articles, from a .vec file of them."""
    path = staging_path(spark, "entities")
    line = F.concat_ws("\t", F.concat(F.lit("Q"), "article_id"), F.array_join(F.col("embedding").cast("array<string>"), "\t"))
    t.vectors(spark, sf).select(line.alias("value")).write.text(path)
    out = features.entity_vectors(features.article_features(t.news(spark, sf)), readers.read_vec(spark, path, 64))
    return out.select("article_id", "n_known", F.posexplode("embedding").alias("dim", "value")).select(
        "article_id", "n_known", F.col("dim").cast("bigint").alias("dim"), r6("value").alias("value"))


@query
def store_features(spark, sf):
    """The feature tables that both builds leave in the store: entities of articles, recency of users."""
    raw, one, two = staging_path(spark, "raw"), staging_path(spark, "store"), staging_path(spark, "store")
    write_tsv(t.news(spark, sf), f"{raw}/news.tsv")
    write_tsv(t.behaviors(spark, sf), f"{raw}/behaviors.tsv")
    build.build_from_tsv(spark, raw, one, "one")
    build.build_from_parquet(spark, log_folders(spark, sf), two, "one")
    none = F.lit(None).cast("double")
    arts = readers.load_store(spark, one, "one", ("article_features",))["article_features"].select(
        F.col("article_id").alias("id"), F.array_join("entities", " ").alias("entities"), F.col("n_entities").alias("n"), none.alias("last_click_age"), none.alias("decay_sum"))
    people = readers.load_store(spark, two, "one", ("user_recency",))["user_recency"].select(
        F.concat(F.lit("user "), "user_id").alias("id"), F.lit("").alias("entities"), F.col("n_clicks").alias("n"), r6("last_click_age").alias("last_click_age"), r6("decay_sum").alias("decay_sum"))
    return arts.unionByName(people)


@query
def leakage_report(spark, sf):
    rows = splits.temporal_split(t.impressions(spark, sf))
    clicks = features.history_clicks(t.history_log(spark, sf))
    return features.leakage_report(rows, clicks, t.published(spark, sf))


@query
def serving_time_view(spark, sf):
    log = t.inview_log(spark, sf)
    view = features.serving_time_view(log, log.drop("article_ids_clicked", "article_id", "read_time"), keep=("article_ids_clicked",))
    return view.groupBy(F.col("device_type").cast("bigint").alias("device_type")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.size("article_ids_clicked")).cast("bigint").alias("n_clicks"),
        F.lit(len(view.columns)).cast("bigint").alias("n_columns"))


@query
def serving_time_ablation(spark, sf):
    rows = evaluate.attach_hist_len(splits.temporal_split(t.impressions(spark, sf)), users(spark, sf))
    cands = ablation.candidate_features(rows, t.inview_log(spark, sf), users(spark, sf), train_popularity(spark, sf))
    return rounded(ablation.serving_time_ablation(cands, b=500), "all", "serving", "difference", "low", "high")


@query
def tfidf_score(spark, sf):
    cands = all_candidates(spark, sf)
    readers_ = evaluate.wanted_users(users(spark, sf), cands)
    pairs = stage(evaluate.distinct_pairs(cands), "pairs")
    scores = lexical.tfidf_score(pairs, readers_, index(spark, sf))
    return scores.select("user_id", "article_id", F.round("score", 7).alias("score"))


@query
def word_vectors(spark, sf):
    out = semantic.l2_normalize(semantic.word_vectors(t.articles(spark, sf), dims=16))
    return out.select("article_id", F.posexplode("embedding").alias("dim", "value")).select(
        "article_id", F.col("dim").cast("bigint").alias("dim"), r6("value").alias("value"))


@query
def recall_by_slice(spark, sf):
    rows, people = test_impressions(spark, sf), users(spark, sf)
    lex = evaluate.lexical_recall(rows, people, index(spark, sf), KS).withColumn("model", F.lit("lexical"))
    sem = evaluate.semantic_recall(rows, people, t.vectors(spark, sf), KS).withColumn("model", F.lit("semantic"))
    lengths = evaluate.attach_hist_len(rows, people).select(F.col("impression_id").alias("row_id"), "hist_len")
    return rounded(metrics.recall_by_slice(lex.unionByName(sem).join(lengths, "row_id"), RECALLS), "value")


# Repeated ids: the last row counts ----------------------------------------------------------------

def repeated_articles(spark, sf) -> DataFrame:
    """Every third article comes a second time from a later source, with other text and another category."""
    rows = t.articles(spark, sf).withColumn("source_rank", F.lit(0))
    again = rows.where(F.col("article_id").cast("bigint") % 3 == 0).withColumns({
        "title": F.concat(F.lit("late "), "title"), "category": F.concat(F.lit("late "), "category"), "source_rank": F.lit(1)})
    return rows.unionByName(again)


def repeated_vectors(spark, sf) -> DataFrame:
    """Every third vector comes a second time from a later source, with its values in reverse order."""
    rows = t.vectors(spark, sf).withColumn("source_rank", F.lit(0))
    again = rows.where(F.col("article_id").cast("bigint") % 3 == 0).withColumns({
        "embedding": F.reverse("embedding"), "source_rank": F.lit(1)})
    return rows.unionByName(again)


@query
def build_bm25_index_repeats(spark, sf):
    return rounded(lexical.build_bm25_index(repeated_articles(spark, sf)).postings, "idf", "weight")


def grown_index(spark, sf) -> str:
    """An index grown by two loads: three quarters of the articles, then the others and the later form of every third one."""
    root, number = staging_path(spark, "segments"), F.col("article_id").cast("bigint")
    rows = repeated_articles(spark, sf)
    growing.append_segment(spark, root, rows.where((F.col("source_rank") == 0) & (number % 4 != 1)))
    growing.append_segment(spark, root, rows.where((F.col("source_rank") == 1) | (number % 4 == 1)))
    return root


@query
def index_append(spark, sf):
    return rounded(growing.read_growing_index(spark, grown_index(spark, sf)).postings, "idf", "weight")


@query
def index_compact(spark, sf):
    target = staging_path(spark, "compacted")
    growing.compact(spark, grown_index(spark, sf), target)
    found = growing.read_growing_index(spark, target)
    return found.docs.select("article_id", "dl", found.stats.select("n").scalar().alias("n"), r6(found.stats.select("avgdl").scalar()).alias("avgdl"))


@query
def semantic_score_repeats(spark, sf):
    scores = evaluate.score_semantic(all_candidates(spark, sf), users(spark, sf), repeated_vectors(spark, sf), "last")
    return scores.select("row_id", "article_id", "score")


@query
def attach_category_repeats(spark, sf):
    return metrics.attach_category(all_candidates(spark, sf), repeated_articles(spark, sf)).select("row_id", "pos", "article_id", "category")


@query
def recent_query(spark, sf):
    return lexical.history_query(users(spark, sf), index(spark, sf).postings, recent=3).select("user_id", "term")
