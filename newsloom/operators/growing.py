"""A lexical index that grows by segments: a load tokenizes and writes its own articles only.

A segment holds the term counts and lengths of the articles of one load, and what the load changes in the totals: document
frequency per term, number of articles, sum of lengths. An article that was there before is masked in its old segment, and the
load's changes take its old terms off. Document frequencies, idf and weights are bound when the index is read, so no old
segment is ever rewritten; `compact` merges all into one. The statistics of a segment are written last and list it: a load that
died before leaves files that nothing reads, and is simply run again under another number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators.lexical import TEXT_COLS, LexicalIndex, doc_freq, doc_lengths, term_freq, weighted_postings
from newsloom.operators.skew import hot_keys
from newsloom.operators.unify import one_per_id
from newsloom.session import stage
from newsloom.sources.writers import path_exists

SCHEMAS = {
    "terms": "article_id string, term string, tf long, dl long, segment long", "docs": "article_id string, dl long, segment long",
    "masked": "article_id string, of long, segment long", "changes": "term string, df long, segment long", "totals": "n long, length long, segment long"}


def _table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The rows of listed segments; an absent table is empty."""
    if not path_exists(spark, f"{root}/totals") or not path_exists(spark, f"{root}/{name}"):
        return spark.createDataFrame([], SCHEMAS[name])
    rows = spark.read.schema(SCHEMAS[name]).parquet(f"{root}/{name}")
    return rows if name == "totals" else rows.where(F.col("segment").isin(_listed(spark, root)))


def _listed(spark: SparkSession, root: str) -> list[int]:
    return sorted(r["segment"] for r in _table(spark, root, "totals").select("segment").distinct().collect())


def _next_segment(spark: SparkSession, root: str) -> int:
    """One more than any segment that has files, so that what a dead load left is never taken for part of another."""
    numbers = [-1]
    for name, schema in SCHEMAS.items():
        if path_exists(spark, f"{root}/{name}"):
            found = spark.read.schema(schema).parquet(f"{root}/{name}").agg(F.max("segment")).first()[0]
            numbers.append(-1 if found is None else found)
    return max(numbers) + 1


def _write(df: DataFrame, root: str, name: str, segment: int) -> None:
    df.withColumn("segment", F.lit(segment).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("segment").parquet(f"{root}/{name}")


def live_docs(spark: SparkSession, root: str) -> DataFrame:
    """(article_id, dl, segment) of the articles that no later load replaced."""
    masked = _table(spark, root, "masked").select("article_id", F.col("of").alias("segment"))
    return _table(spark, root, "docs").join(masked, ["article_id", "segment"], "left_anti")


def live_terms(spark: SparkSession, root: str) -> DataFrame:
    """The term counts of the live articles; they stream past the masked ones and are not sorted."""
    masked = _table(spark, root, "masked").select("article_id", F.col("of").alias("segment"))
    return _table(spark, root, "terms").join(masked.hint("shuffle_hash"), ["article_id", "segment"], "left_anti")


def append_segment(spark: SparkSession, root: str, articles: DataFrame, text_cols: tuple[str, ...] = TEXT_COLS) -> int:
    """Add a load of articles to the index under `root` and return its segment number.

    Of repeated ids the last row of the load counts; articles that the index has already are replaced. Old segments are read
    for the replaced articles' terms only, through a join on the article.
    """
    number = _next_segment(spark, root)
    articles = one_per_id(articles, *text_cols)
    terms = stage(term_freq(articles, text_cols).select("article_id", "term", F.col("tf").cast("long").alias("tf"), F.col("dl").cast("long").alias("dl")), "segment-terms")
    docs = stage(doc_lengths(articles, terms).select("article_id", F.col("dl").cast("long").alias("dl")), "segment-docs")
    old = stage(live_docs(spark, root).join(docs.select("article_id"), "article_id", "left_semi"), "replaced")
    gone = live_terms(spark, root).join(old.select("article_id", "segment").hint("shuffle_hash"), ["article_id", "segment"], "left_semi")
    changes = terms.select("term", F.lit(1).alias("d")).unionByName(gone.select("term", F.lit(-1).alias("d")))
    changes = changes.groupBy("term").agg(F.sum("d").alias("df")).where("df <> 0")
    both = docs.select(F.lit(1).alias("d"), "dl").unionByName(old.select(F.lit(-1).alias("d"), "dl"))
    totals = both.agg(F.coalesce(F.sum("d"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.col("d") * F.col("dl")), F.lit(0)).alias("length"))
    totals = stage(totals, "totals")
    masked, changes = stage(old.select("article_id", F.col("segment").alias("of")), "masked"), stage(changes, "changes")
    for name, df in (("terms", terms), ("docs", docs), ("masked", masked), ("changes", changes), ("totals", totals)):
        _write(df, root, name, number)
    return number


def read_growing_index(spark: SparkSession, root: str, k1: float = 1.5, b: float = 0.75, staged: bool = True) -> LexicalIndex:
    """The index over all live articles; document frequencies are the sums of the segments' changes."""
    stats = _table(spark, root, "totals").agg(F.sum("n").alias("n"), F.sum("length").alias("length")).select(
        F.coalesce("n", F.lit(0)).alias("n"), F.when(F.col("n") > 0, F.col("length") / F.col("n")).otherwise(0.0).alias("avgdl"),
        F.lit(float(k1)).alias("k1"), F.lit(float(b)).alias("b"))
    dfs = _table(spark, root, "changes").groupBy("term").agg(F.sum("df").alias("df")).where("df > 0")
    terms = live_terms(spark, root).drop("segment")
    hot = hot_keys(terms, ["term"], counts=dfs.withColumnRenamed("df", "_n"))
    postings = weighted_postings(terms, dfs, stats, hot, k1, b)
    return LexicalIndex(stats, live_docs(spark, root).drop("segment"), stage(postings, "postings") if staged else postings)


def compact(spark: SparkSession, root: str, target: str) -> None:
    """Write the live rows of all segments under `root` as the only segment of an index under `target`; nothing is tokenized."""
    terms, docs = live_terms(spark, root).drop("segment"), live_docs(spark, root).drop("segment")
    _write(terms, target, "terms", 0)
    _write(docs, target, "docs", 0)
    _write(doc_freq(terms).select("term", F.col("df").cast("long").alias("df")), target, "changes", 0)
    _write(docs.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("dl"), F.lit(0)).alias("length")), target, "totals", 0)
