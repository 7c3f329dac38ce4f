"""Pairs are scored in blocks of users: the terms of an article are sent once per block, not once per pair."""

import collections
import functools
import random

import pytest

from newsloom.operators import lexical

PAIRS = "user_id string, article_id string"


@pytest.fixture(scope="module")
def made(spark):
    rng = random.Random(9)
    texts = {f"a{i}": " ".join(rng.choices([f"w{k}" for k in range(60)], k=rng.randint(1, 40))) for i in range(40)}
    arts = spark.createDataFrame([(a, x, None) for a, x in texts.items()], "article_id string, title string, abstract string")
    return texts, lexical.build_bm25_index(arts)


def sent(monkeypatch):
    """Rows that meet one row per article."""
    seen, plain = [], lexical.skew_join

    def watched(left, right, on, *args, **options):
        if on == ["article_id"] and "terms" in right.columns:
            seen.append(left.count())
        return plain(left, right, on, *args, **options)
    monkeypatch.setattr(lexical, "skew_join", watched)
    return seen


def test_an_article_is_sent_once_for_users_who_share_it(spark, made, monkeypatch):
    _, index = made
    users = spark.createDataFrame([(f"u{i}", ["a1", "a2"]) for i in range(50)], "user_id string, history array<string>")
    pairs = spark.createDataFrame([(f"u{i}", f"a{j}") for i in range(50) for j in range(1, 6)], PAIRS)
    seen = sent(monkeypatch)
    query = lexical.history_query(users, index.postings, by_article=True)
    assert lexical.bm25_score(pairs, query, index.postings).count() == 250
    assert seen == [5]


@pytest.mark.parametrize("block_pairs", [3, 40, 1 << 15])
def test_scores_are_those_of_all_pairs_in_any_blocks(spark, made, monkeypatch, block_pairs):
    texts, index = made
    monkeypatch.setattr(lexical, "_in_blocks", functools.partial(lexical._in_blocks, block_pairs=block_pairs))
    rng = random.Random(block_pairs)
    users = {f"u{i}": rng.choices([*texts, "gone"], k=rng.randint(0, 4)) for i in range(15)} | {"all": ["a0", "a0", "a7"], None: ["a1"]}
    pairs = [(u, rng.choice([*texts, "gone"])) for u in users for _ in range(6)] + [("all", a) for a in texts] + [("stranger", "a1"), ("all", None), (None, None)]
    pairs += pairs[:9]
    people = spark.createDataFrame([*users.items()], "user_id string, history array<string>")
    rows = spark.createDataFrame(pairs, PAIRS)
    posting = {(r.article_id, r.term): r for r in index.postings.collect()}
    asked = {u: {w for a in h for w in texts.get(a, "").split()} for u, h in users.items() if u}
    want = collections.Counter((u, a, w) for u, a in pairs for w in asked.get(u, ()) if (a, w) in posting)
    sums = {p: sum(posting[p[1], w].weight for w in asked.get(p[0], ()) if (p[1], w) in posting) for p in pairs}
    for short in (True, False):
        query = lexical.history_query(people, index.postings, by_article=short)
        found = lexical.match_terms(rows, query, index.postings).collect()
        assert collections.Counter((r.user_id, r.article_id, r.term) for r in found) == want
        assert all((r.tf, r.dl, r.idf, r.weight) == pytest.approx((p.tf, p.dl, p.idf, p.weight)) for r in found for p in [posting[r.article_id, r.term]])
        scores = lexical.bm25_score(rows, query, index.postings).collect()
        assert len(scores) == len(set(pairs)) and {(r.user_id, r.article_id): r.score for r in scores} == pytest.approx(sums, abs=2e-9)


def test_recent_query_by_article(spark, made):
    texts, index = made
    people = spark.createDataFrame([("u", ["a1", "a2", "a3"])], "user_id string, history array<string>")
    assert [sorted(r.articles) for r in lexical.history_query(people, index.postings, 2, by_article=True).collect()] == [["a2", "a3"]]


def test_nothing_to_score(spark, made):
    _, index = made
    people = spark.createDataFrame([("u", ["a1"])], "user_id string, history array<string>")
    query = lexical.history_query(people, index.postings, by_article=True)
    assert lexical.match_terms(spark.createDataFrame([], PAIRS), query, index.postings).collect() == []
    unknown = lexical.bm25_score(spark.createDataFrame([("x", "gone")], PAIRS), query, index.postings)
    assert [tuple(r) for r in unknown.collect()] == [("x", "gone", 0.0)]
