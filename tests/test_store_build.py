"""The build of a store moves texts and term counts once, and gives the same rows."""

import glob
import random

from pyspark.sql import functions as F

from newsloom.catalog.queries import write_tsv
from newsloom.operators import lexical, semantic
from newsloom.operators.unify import one_per_id, settle_repeats
from newsloom.plans import build
from newsloom.session import staging_root

SCHEMA = "article_id string, title string, abstract string, body string, category string"


def made(spark, n=60):
    draw = random.Random(3)
    ids = [f"a{i}" for i in range(n - 2)] + ["tab\tin id", None]
    texts = [" ".join(["the"] * (1 + i % 3) + [f"w{draw.randrange(90)}" for _ in range(i % 17)] + ["é", "ß" * (i % 4)]) for i in range(n)]
    return spark.createDataFrame([(i, x, None if k % 5 else "abs", "", "c") for k, (i, x) in enumerate(zip(ids, texts))], SCHEMA)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(repr, df.collect()))


def test_clustered_postings_are_the_postings_of_the_index(spark):
    arts = made(spark).unionByName(spark.createDataFrame([("empty", "", None, "", "c")], SCHEMA))
    plain, cut = lexical.build_bm25_index(arts), lexical.build_bm25_index(arts, unique=True, clustered=True)
    counted = lexical.counted_words(arts, unique=True)
    bounds, hot = lexical.term_ranges(counted, 40)
    assert bounds == sorted(bounds) and hot == {"the": (60, 2), "é": (60, 2)}
    small = lexical.clustered_postings(counted, plain.stats, 1.5, 0.75, range_rows=40)
    for got in (cut.postings, small):
        assert rows(got.select(plain.postings.columns)) == rows(plain.postings)
    assert rows(cut.docs) == rows(plain.docs) and rows(cut.stats) == rows(plain.stats)
    tasks = small.rdd.mapPartitions(lambda part: [[(r.term, r.article_id or "") for r in part]]).filter(len).collect()
    assert len(tasks) > 4 and all(t == sorted(t) for t in tasks)
    assert all(sum(w in {k for k, _ in t} for t in tasks) == 1 for w in {k for t in tasks for k, _ in t} - set(hot))
    assert all(sum(w in {k for k, _ in t} for t in tasks) == 2 for w in hot)


def test_clustered_postings_of_nothing(spark):
    index = lexical.build_bm25_index(made(spark).where("false"), unique=True, clustered=True)
    assert index.postings.count() == index.docs.count() == 0 and index.stats.first().n == 0


def test_only_rows_of_repeated_ids_are_grouped(spark, tmp_path):
    arts = made(spark)
    again = arts.where("article_id is null or article_id in ('a1', 'a7')").withColumn("title", F.concat(F.lit("z "), "title"))
    more = arts.unionByName(again).unionByName(arts.where("article_id in ('a7', 'a9')"))
    assert rows(settle_repeats(more)) == rows(one_per_id(more)) and settle_repeats(more).count() == 60
    more.write.parquet(path := str(tmp_path / "articles"))
    plan = plan_of(settle_repeats(spark.read.parquet(path)))
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
    assert plan.count("Exchange hashpartitioning") == 1  # the rows of repeated ids


def test_texts_of_unique_articles_are_not_shuffled(spark):
    arts = made(spark)
    words, vectors = lexical.counted_words(arts, unique=True), semantic.hash_encoder_vectors(arts, 8, unique=True)
    assert "Exchange" not in plan_of(words) and "Exchange" not in plan_of(vectors)
    assert rows(words) == rows(lexical.counted_words(arts)) and rows(vectors) == rows(semantic.hash_encoder_vectors(arts, 8))
    plan = vectors.select(F.posexplode("embedding"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_sort(") == 1  # a reader's filter does not build the counts again
    want = {i: [0.0] * 8 for i, *_ in arts.collect()}
    for i, code in made(spark).selectExpr("article_id", "explode(regexp_extract_all(lower(concat_ws(' ', title, abstract)), '[\\\\p{L}\\\\p{N}_]+', 0)) AS term").select(
            "article_id", semantic.term_code(F.col("term"))).collect():
        want[i][code % 8] += 1 if code // 8 % 2 == 0 else -1
    assert {r.article_id: r.embedding for r in vectors.collect()} == want


def test_a_store_is_built_without_writing_postings_aside(spark, tmp_path):
    staged = f"{staging_root(spark)}/newsloom/{spark.sparkContext.applicationId}/postings-*"
    before = len(glob.glob(staged))
    users = spark.createDataFrame([("u", ["a1"])], "user_id string, history array<string>")
    seen = spark.sql("SELECT '1' impression_id, 'u' user_id, timestamp_ntz'2024-01-01 00:00:00' time, array('a1') clicked_articles, array('a2') unclicked_articles")
    arts = made(spark)
    build.build_store(spark, str(tmp_path), "one", arts, [users], seen)
    assert len(glob.glob(staged)) == before
    got = spark.read.parquet(f"{tmp_path}/postings").drop("dataset")
    want = lexical.build_bm25_index(arts).postings
    assert rows(got.select(want.columns)) == rows(want)


def test_raw_text_is_compressed_in_files_of_bounded_rows(spark, tmp_path):
    raw = spark.range(70000, numPartitions=1).selectExpr("cast(id AS string) AS a", "if(id % 2 = 0, null, 'x') AS b")
    path = write_tsv(raw, str(tmp_path / "raw.tsv"))
    assert len(glob.glob(f"{path}/part-*.gz")) == 2
    assert rows(spark.read.csv(path, sep="\t", schema="a string, b string")) == rows(raw)
