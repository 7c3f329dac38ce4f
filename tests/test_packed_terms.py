"""Terms meet pairs inside rows: they are neither shuffled nor counted one by one."""

import collections
import math
import random
import re

import pytest

from newsloom.operators import lexical


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def made(spark):
    rng = random.Random(5)
    texts = {f"a{i}": " ".join(rng.choices([f"w{k}" for k in range(40)], k=rng.randint(0, 60))) for i in range(50)}
    users = {f"u{i}": rng.choices([*texts, "gone"], k=rng.randint(0, 5)) for i in range(12)}
    pairs = sorted({(rng.choice([*users, "stranger"]), rng.choice([*texts, "gone"])) for _ in range(200)})
    arts = spark.createDataFrame([(a, x, None) for a, x in texts.items()], "article_id string, title string, abstract string")
    people = spark.createDataFrame([*users.items()], "user_id string, history array<string>")
    index = lexical.build_bm25_index(arts)
    return texts, users, pairs, index, people, spark.createDataFrame([*pairs, (None, "a1"), ("u1", None)], "user_id string, article_id string")


def test_match_and_scores_equal_brute_force(spark, made):
    texts, users, pairs, index, people, rows = made
    weight = {(r.article_id, r.term): (r.tf, r.weight, r.idf) for r in index.postings.collect()}
    asked = {u: {w for a in h for w in texts.get(a, "").split()} for u, h in users.items()}
    want = {(u, a, w): weight[a, w] for u, a in pairs for w in asked.get(u, ()) if (a, w) in weight}
    query = lexical.history_query(people, index.postings)
    assert sorted((r.user_id, r.term) for r in query.collect()) == sorted((u, w) for u, ws in asked.items() for w in ws)
    got = {(r.user_id, r.article_id, r.term): (r.tf, r.weight, r.idf) for r in lexical.match_terms(rows, query, index.postings).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in got)
    scores = lexical.bm25_score(rows, query, index.postings).collect()
    sums = collections.Counter()
    for (u, a, _), (_, x, _) in want.items():
        sums[u, a] += x
    assert len(scores) == rows.count()
    assert {(r.user_id, r.article_id): r.score for r in scores} == pytest.approx({p: sums[p] for p in [*pairs, (None, "a1"), ("u1", None)]}, abs=2e-9)
    n, df = len(texts), collections.Counter(w for x in texts.values() for w in set(x.split()))
    idf = {w: math.log((n + 1) / (k + 1)) for w, k in df.items()}

    def cosine(u, a):
        counts = collections.Counter(texts.get(a, "").split())
        left, right = math.sqrt(sum(idf[w] ** 2 for w in asked.get(u, ()))), math.sqrt(sum((k * idf[w]) ** 2 for w, k in counts.items()))
        return sum(idf[w] * counts[w] * idf[w] for w in asked.get(u, ())) / left / right if left and right else 0.0
    found = {(r.user_id, r.article_id): r.score for r in lexical.tfidf_score(rows, people, index).collect()}
    assert {p: found[p] for p in pairs} == pytest.approx({p: cosine(*p) for p in pairs}, abs=2e-9)


def test_no_step_is_dealt_by_term(spark, made):
    _, _, _, index, people, rows = made
    query = lexical.history_query(people, index.postings)
    for df in (query, lexical.match_terms(rows, query, index.postings), lexical.bm25_score(rows, query, index.postings), lexical.tfidf_score(rows, people, index)):
        plan = plan_of(df)
        assert not re.search(r"(hashpartitioning\(|keys=\[)[^\])]*\bterm#", plan)


def test_words_are_counted_inside_the_row(spark):
    rows = [("1", "b a B", None), ("1", "a c", "x y"), ("1", "a c c", None), ("2", "", None), ("3", "é é", "z"), ("4", None, None), (None, "q", None)]
    found = lexical.term_freq(spark.createDataFrame(rows, "article_id string, title string, abstract string"))
    assert "term#" not in "".join(re.findall(r"keys=\[[^\]]*", plan_of(found)))
    # Texts of one article with equally many words count together.
    assert sorted(map(tuple, found.collect()), key=repr) == sorted([
        ("1", 3, "a", 2), ("1", 3, "b", 2), ("1", 3, "c", 2), ("1", 4, "a", 1), ("1", 4, "c", 1), ("1", 4, "x", 1), ("1", 4, "y", 1),
        ("3", 3, "é", 2), ("3", 3, "z", 1), (None, 1, "q", 1)], key=repr)
