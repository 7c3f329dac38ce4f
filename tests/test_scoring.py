import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.operators import beyond, lexical, metrics, popularity, profile, ranking, retrieval, semantic, skew, splits, unify
from newsloom.plans import evaluate, predict


@pytest.fixture(scope="module")
def arts(spark):
    rows = [("1", "red fox", "runs red"), ("2", "blue fox", None), ("3", "", ""), ("4", "green tree", "tall")]
    return spark.createDataFrame(rows, "article_id string, title string, abstract string").withColumn("category", F.lit("c"))


def test_bm25_by_hand(spark, arts):
    index = lexical.build_bm25_index(arts)
    stats = index.stats.first()
    assert (stats.n, stats.avgdl) == (4, 9 / 4)
    weights = {(r.term, r.article_id): r.weight for r in index.postings.collect()}
    idf = math.log(1 + (4 - 2 + 0.5) / 2.5)
    assert weights["fox", "1"] == pytest.approx(idf * 2.5 / (1 + 1.5 * (0.25 + 0.75 * 4 / 2.25)))
    users = spark.createDataFrame([("u", ["1", "1", "9"]), ("w", [])], "user_id string, history array<string>")
    pairs = spark.createDataFrame([("u", "1"), ("u", "2"), ("u", "4"), ("w", "1"), ("u", "9")], "user_id string, article_id string")
    query = lexical.history_query(users, index.postings)
    got = {(r.user_id, r.article_id): r.score for r in lexical.bm25_score(pairs, query, index.postings).collect()}
    assert got["u", "2"] == pytest.approx(weights["fox", "2"], abs=1e-8)
    assert got["u", "1"] == pytest.approx(sum(w for (_, a), w in weights.items() if a == "1"), abs=1e-8)
    assert got["u", "4"] == got["w", "1"] == got["u", "9"] == 0.0
    forward = retrieval.forward_index(index.postings)
    one = retrieval.history_terms(users.where("user_id = 'u'"), forward)
    top = retrieval.bm25_retrieve(one, forward, k=5, user_block=1).collect()
    assert [(r.article_id, r.rank) for r in sorted(top, key=lambda r: r.rank)] == [("1", 1), ("2", 2)]


def test_skew_join_equals_plain_join(spark):
    left = spark.range(3000).select(F.when(F.col("id") < 1500, "hot").otherwise((F.col("id") % 40).cast("string")).alias("k"), "id")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("3", 3), ("zz", 4)], "k string, v int")
    hot = skew.hot_keys(left, ["k"], slices=8)
    assert [(r.k, r._slices) for r in hot.table.collect()] == [("hot", 4)]
    for how in ("inner", "left", "left_semi", "left_anti"):
        got = sorted(map(tuple, skew.skew_join(left, right, ["k"], how, hot=hot).collect()), key=repr)
        assert got == sorted(map(tuple, left.join(right, ["k"], how).collect()), key=repr)
    assert skew.hot_keys(left.where("id >= 1500"), ["k"], slices=8).table is None


def scored(spark, rows):
    return spark.createDataFrame(rows, "row_id string, pos int, label int, score double, category string")


def test_metrics_with_ties(spark):
    rows = [("t", i, int(i == 0), 0.0, "c") for i in range(4)]
    rows += [("m", 0, 0, 0.9, "a"), ("m", 1, 1, 0.5, "b"), ("m", 2, 1, 0.4, "a"), ("m", 3, 0, 0.1, "a")]
    got = {r.row_id: r for r in metrics.ranking_metrics(scored(spark, rows)).collect()}
    assert got["t"].auc == 0.5 and got["t"].mrr == 1.0
    assert got["t"].ndcg_5 == pytest.approx(0.6404, abs=1e-4)
    assert got["m"].auc == 0.5 and got["m"].mrr == 0.5
    ideal = 1 + 1 / math.log2(3)
    assert got["m"].ndcg_5 == pytest.approx((1 / math.log2(3) + 0.5) / ideal)
    assert got["m"].category_diversity_5 == 0.5


def test_ranks_are_permutations_and_do_not_depend_on_partitions(spark):
    rows = [(str(i % 7), i, 0, float((i * 13) % 5), "c") for i in range(200)]
    one = ranking.ranks_to_list(ranking.rank_candidates(scored(spark, rows))).collect()
    two = ranking.ranks_to_list(ranking.rank_candidates(scored(spark, rows[::-1]).repartition(3))).collect()
    assert {r.row_id: r.ranks for r in one} == {r.row_id: r.ranks for r in two}
    assert all(sorted(r.ranks) == list(range(1, len(r.ranks) + 1)) for r in one)


def test_slices_of_an_empty_group(spark):
    df = spark.createDataFrame([("lexical", 9, 0.5)], "model string, hist_len int, auc double")
    assert {r.slice: r.value for r in metrics.mean_by_slice(df, ("auc",)).collect()} == {"global": 0.5, "cold": 0.0, "warm": 0.5}


def vectors(spark, n=60, d=5, seed=3):
    rng = np.random.default_rng(seed)
    data = rng.normal(size=(n, d))
    data[0] = 0
    return data, spark.createDataFrame([(f"a{i:03d}", [float(x) for x in v]) for i, v in enumerate(data)],
                                       "article_id string, embedding array<float>")


def test_user_vector_and_scores(spark):
    data, vecs = vectors(spark)
    users = spark.createDataFrame([("u", ["a001", "a001", "a002", "nope"]), ("w", ["nope"]), ("z", [])], "user_id string, history array<string>")
    got = {r.user_id: r.user_vector for r in semantic.all_user_vectors(users, vecs, 5).collect()}
    unit = data.astype("float32").astype("float64")
    unit = unit / np.where(np.linalg.norm(unit, axis=1) > 0, np.linalg.norm(unit, axis=1), 1)[:, None]
    mean = (2 * unit[1] + unit[2]) / 3
    np.testing.assert_allclose(got["u"], mean / np.linalg.norm(mean), atol=1e-9)
    assert got["w"] == got["z"] == [0.0] * 5
    pairs = spark.createDataFrame([("u", "a003"), ("u", "a000"), ("u", "nope"), ("w", "a003"), ("w", "nope")], "user_id string, article_id string")
    uv = semantic.user_vectors(users, vecs)
    for policy, unknown in (("null", None), ("last", -999.0)):
        s = {(r.user_id, r.article_id): r.score for r in semantic.semantic_score(pairs, uv, vecs, policy).collect()}
        assert s["u", "a003"] == pytest.approx(float(unit[3] @ mean / np.linalg.norm(mean)), abs=1e-8)
        assert s["u", "a000"] == 0.0 and s["w", "a003"] == 0.0 and s["u", "nope"] == unknown
        assert s["w", "nope"] == (0.0 if policy == "last" else None)
    assert semantic.semantic_score(pairs, uv, vecs, "drop").count() == 3


def brute_top(data, k):
    unit = data.astype("float32").astype("float64")
    unit = unit / np.where(np.linalg.norm(unit, axis=1) > 0, np.linalg.norm(unit, axis=1), 1)[:, None]
    best = np.argsort(-np.round(data.astype("float32").astype("float64") @ unit.T, 9), axis=1, kind="stable")[:, :k]
    return {(f"ua{i:03d}", f"a{j:03d}", r + 1) for i, row in enumerate(best) for r, j in enumerate(row)}


def test_vector_retrieval_by_balls_equals_brute_force(spark):
    data, vecs = vectors(spark)
    users = vecs.select(F.concat(F.lit("u"), "article_id").alias("user_id"), F.col("embedding").cast("array<double>").alias("user_vector"))
    for bits in (0, 3):
        index = retrieval.exact_vector_index(vecs, bits)
        got = retrieval.vector_retrieve(users, index, 7, user_block=16, article_block=11)
        assert {(r.user_id, r.article_id, r.rank) for r in got.collect()} == brute_top(data, 7)
    near = retrieval.ann_retrieve(users, vecs, 7, tables=4, bits=3, probes=8)
    assert {(r.user_id, r.article_id, r.rank) for r in near.collect()} == brute_top(data, 7)
    sliced = retrieval.ann_retrieve(users, vecs, 7, tables=4, bits=3, probes=8, slices=3)
    assert {(r.user_id, r.article_id, r.rank) for r in sliced.collect()} == brute_top(data, 7)
    none = vecs.limit(0)
    assert retrieval.vector_retrieve(users, retrieval.exact_vector_index(none), 3).collect() == []


def test_balls_shut_out_far_clusters(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16)) * 10
    data = np.concatenate([c + rng.normal(size=(40, 16)) * 0.3 for c in centres])
    vecs = spark.createDataFrame([(f"a{i:03d}", [float(x) for x in row]) for i, row in enumerate(data)], "article_id string, embedding array<float>")
    users = vecs.where("article_id LIKE '%7'").select(F.concat(F.lit("u"), "article_id").alias("user_id"), F.col("embedding").cast("array<double>").alias("user_vector"))
    index = retrieval.exact_vector_index(vecs)
    top, shipped = retrieval.vector_rounds(users, index, 5)
    want = {(u, a, r) for u, a, r in brute_top(data, 5) if u.endswith("7")}
    assert {(r.user_id, r.article_id, r.rank) for r in top.collect()} == want
    assert shipped.count() < 0.4 * users.count() * index[1].count()


def test_ann_retrieve_finds_nine_tenths_and_full_lists(spark):
    from newsloom.catalog import queries as q
    from newsloom.operators.semantic import user_vectors
    from newsloom.session import stage

    sf = "/root/testdata/sf0.1"
    vecs = q.t.vectors(spark, sf)
    users = stage(user_vectors(q.users(spark, sf), vecs), "user-vectors")
    index = retrieval.exact_vector_index(vecs)
    want = {(r.user_id, r.article_id) for r in retrieval.vector_retrieve(users, index, 10).collect()}
    got = [(r.user_id, r.article_id) for r in retrieval.ann_retrieve(users, vecs, 10, index=index).collect()]
    assert len(want & set(got)) >= 0.9 * len(want) and len(got) == len(want)
    data, vecs = vectors(spark)
    users = vecs.select("article_id", F.col("embedding").cast("array<double>").alias("user_vector")).withColumnRenamed("article_id", "user_id")
    for k in (len(data) // 2, len(data) + 5):
        lists = retrieval.ann_retrieve(users, vecs, k, tables=4, bits=4, probes=1).groupBy("user_id").count().collect()
        assert len(lists) == len(data) and {r["count"] for r in lists} == {min(k, len(data))}


def test_flip_patterns_and_planes():
    assert retrieval.flip_patterns(6, 4) == [0, 1, 2, 3, 4, 5] and len(set(retrieval.flip_patterns(16, 4))) == 16
    planes = retrieval.sign_planes(8, 8, 64)
    assert abs(planes.mean()) < 0.01 and abs(planes).max() <= 0.5 and abs(np.corrcoef(planes.reshape(64, 64))[np.triu_indices(64, 1)]).max() < 0.6


def lexical_fixture(spark, n=120):
    rng = np.random.default_rng(8)
    texts = [" ".join(f"t{int(x)}" for x in rng.zipf(1.3, int(rng.integers(1, 80))) % 400) for _ in range(n)] + ["", "t1 t1"]
    arts = spark.createDataFrame([(f"a{i:03d}", x, "") for i, x in enumerate(texts)], "article_id string, title string, abstract string")
    users = spark.createDataFrame([(f"u{i}", [f"a{int(j):03d}" for j in rng.integers(0, n + 3, int(rng.integers(0, 6)))]) for i in range(30)], "user_id string, history array<string>")
    return lexical.build_bm25_index(arts), users


def test_bm25_retrieval_in_two_rounds_equals_all_pairs(spark):
    index, users = lexical_fixture(spark)
    query = lexical.history_query(users, index.postings)
    scores = query.join(index.postings.select("term", "article_id", "weight"), "term").groupBy("user_id", "article_id").agg(F.round(F.sum("weight"), 9).alias("score"))
    want = {}
    for r in scores.collect():
        want.setdefault(r.user_id, []).append((-r.score, r.article_id))
    want = {(u, a, n): -s for u, rows in want.items() for n, (s, a) in enumerate(sorted(rows)[:4], 1)}
    for rows, bins, most in ((1 << 18, 4096, 1 << 14), (300, 64, 1 << 14), (100, 2, 1 << 14), (10, 64, 3)):
        forward = retrieval.forward_index(index.postings, rows, bins, most)
        asked = retrieval.history_terms(users, forward)
        top, shipped = retrieval.bm25_rounds(asked, forward, 4, user_block=7)
        assert {(r.user_id, r.article_id, r.rank): r.score for r in top.collect()} == pytest.approx(want)
        assert shipped.count() == shipped.distinct().count() <= asked.count() * forward.select("block").distinct().count()
    # Totals fall from block to block, and the numbers of terms are the whole numbers from 0.
    tops = [r.top for r in retrieval.forward_index(index.postings, 300, 64).groupBy("block").agg(F.max("top").alias("top")).orderBy("block").collect()]
    assert tops == sorted(tops, reverse=True) and len(tops) > 3
    numbers = [r.number for r in retrieval.term_numbers(index.postings, 8).collect()]
    assert sorted(numbers) == list(range(len(numbers)))


def test_history_terms_are_those_of_the_query(spark):
    index, users = lexical_fixture(spark, 40)
    forward = retrieval.forward_index(index.postings)
    names = {r.number: r.term for r in retrieval.term_numbers(index.postings).collect()}
    for recent in (None, 2):
        got = {(r.user_id, names[n]) for r in retrieval.history_terms(users, forward, recent).collect() for n in r.terms}
        assert got == {(r.user_id, r.term) for r in lexical.history_query(users, index.postings, recent).collect()}


def test_predictions(spark):
    _, vecs = vectors(spark)
    rows = [(1, "i1", "u", ["a001"], ["a002", "nope", "a001"]), (2, "i1", "w", [], ["x", "y"]), (3, "i3", "u", ["a001"], [])]
    test = spark.createDataFrame(rows, "row_id long, impression_id string, user_id string, history array<string>, candidates array<string>")
    got = {r.row_id: (r.impression_id, r.ranks) for r in predict.generate_predictions(test, vecs).collect()}
    assert got == {1: ("i1", [2, 3, 1]), 2: ("i1", [1, 2]), 3: ("i3", [])}
    pop = spark.createDataFrame([("y", 3)], "article_id string, clicks long")
    ranks = {r.row_id: r.ranks for r in popularity.popularity_predictions(test, pop).collect()}
    assert ranks == {1: [1, 2, 3], 2: [2, 1], 3: []}


def test_recall_is_monotone_and_counts_unknown_clicks(spark):
    _, vecs = vectors(spark)
    imps = spark.createDataFrame([("i", "u", ["a001", "nope"], ["a002", "a003"]), ("j", "u", ["nope"], [])],
                                 "impression_id string, user_id string, clicked_articles array<string>, unclicked_articles array<string>")
    users = spark.createDataFrame([("u", ["a001"])], "user_id string, history array<string>")
    rows = evaluate.semantic_recall(imps, users, vecs, (1, 2, 50)).collect()
    assert [(r.row_id, r.recall_1, r.recall_2, r.recall_50) for r in rows] == [("i", 0.5, 0.5, 0.5)]


def test_split_is_complete_and_ordered(spark):
    from datetime import datetime, timedelta

    rows = [(str(i), datetime(2024, 1, 1) + timedelta(hours=6 * i)) for i in range(20)] + [("n", None)]
    df = splits.temporal_split(spark.createDataFrame(rows, "impression_id string, time timestamp_ntz"))
    assert {r.split: r.n_rows for r in splits.split_sizes(df).collect()} == {"train": 12, "val": 4, "test": 4, None: 1}
    splits.assert_split_order(df)
    with pytest.raises(ValueError):
        splits.assert_split_order(df.replace({"train": "test", "test": "train"}, subset=["split"]))


def test_exact_quantiles(spark):
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 10, 501):
        x = rng.integers(0, 50, n).astype(float)
        df = spark.createDataFrame([(float(v),) for v in x], "x double")
        got = {r.q: r.value for r in profile.exact_quantiles(df, {"x": F.col("x")}, (0.05, 0.5, 0.95), accuracy=100).collect()}
        assert got == pytest.approx({q: float(np.quantile(x, q)) for q in (0.05, 0.5, 0.95)})


def test_intra_list_diversity_and_bootstrap(spark):
    data, vecs = vectors(spark)
    top = spark.createDataFrame([("r", f"a{i:03d}") for i in (1, 2, 3)] + [("s", "a004")], "row_id string, article_id string")
    got = {r.row_id: r.ild for r in beyond.intra_list_diversity(top, vecs).collect()}
    u = [data[i] / np.linalg.norm(data[i]) for i in (1, 2, 3)]
    assert got["r"] == pytest.approx(np.mean([1 - u[0] @ u[1], 1 - u[0] @ u[2], 1 - u[1] @ u[2]]), abs=1e-6) and got["s"] == 0.0
    values = np.random.default_rng(5).random(400)
    df = spark.createDataFrame([("m", str(i), float(v)) for i, v in enumerate(values)], "model string, row_id string, auc double")
    ci = beyond.bootstrap_ci(df, ("auc",), b=300).first()
    half = 1.96 * values.std() / 20
    assert ci.low == pytest.approx(values.mean() - half, abs=0.01) and ci.high == pytest.approx(values.mean() + half, abs=0.01)


def test_candidate_sets(spark):
    df = spark.createDataFrame([("i", "u", ["a", "a"], ["b", "a"])], "impression_id string, user_id string, clicked_articles array<string>, unclicked_articles array<string>")
    assert unify.candidate_set(df).first().candidates == ["a", "b"]
    assert [(r.pos, r.article_id, r.label) for r in unify.labeled_candidates(df).collect()] == [(0, "a", 1), (1, "a", 1), (2, "b", 0), (3, "a", 0)]
    assert [(r.article_id, r.label) for r in unify.labeled_candidates(df, distinct=True).collect()] == [("a", 1), ("b", 0)]


def test_repeated_ids_count_once_and_the_last_row_wins(spark):
    arts = spark.createDataFrame([("1", "a b", "", "x", 0), ("1", "a a", "", "y", 1), ("2", "c", "", "z", 0)],
                                 "article_id string, title string, abstract string, category string, source_rank int")
    idx = lexical.build_bm25_index(arts)
    assert sorted((r.term, r.article_id, r.tf) for r in idx.postings.collect()) == [("a", "1", 2), ("c", "2", 1)]
    assert idx.stats.first()["n"] == 2
    assert sorted(tuple(r) for r in idx.docs.collect()) == [("1", 2), ("2", 1)]
    vecs = spark.createDataFrame([("1", [1.0, 0.0], 0), ("1", [0.0, 1.0], 1)], "article_id string, embedding array<float>, source_rank int")
    cands = spark.createDataFrame([("u", "1"), ("u", "2")], "user_id string, article_id string")
    assert sorted((r.article_id, r.embedding) for r in semantic.attach_vectors(cands, vecs).collect()) == [("1", [0.0, 1.0]), ("2", None)]
    assert sorted((r.article_id, r.category) for r in metrics.attach_category(cands, arts).collect()) == [("1", "y"), ("2", "z")]


def test_retrieval_recall_counts_missing_lists_as_zero(spark):
    top = spark.createDataFrame([("u", "1", 1), ("u", "2", 60)], "user_id string, article_id string, rank int")
    clicks = spark.createDataFrame([("u", "1"), ("u", "2"), ("u", "2"), ("v", "1")], "user_id string, article_id string")
    got = {r.user_id: (r.recall_50, r.recall_100) for r in metrics.retrieval_recall(top, clicks, (50, 100)).collect()}
    assert got == {"u": (0.5, 1.0), "v": (0.0, 0.0)}
