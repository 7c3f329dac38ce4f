import random

import pytest
from pyspark.sql import functions as F

from newsloom.operators import growing, lexical, profile

SCHEMA = "article_id string, title string, abstract string, source_rank int"


def load(rng, ids, rank):
    return [(i, " ".join(f"t{rng.randrange(30)}" for _ in range(rng.randrange(8))), rng.choice(["", "t1 x"]), rank) for i in ids]


def same(a, b):
    got = {(r.term, r.article_id): (r.tf, r.dl, r.df, pytest.approx(r.idf), pytest.approx(r.weight)) for r in a.postings.collect()}
    assert {(r.term, r.article_id): (r.tf, r.dl, r.df, r.idf, r.weight) for r in b.postings.collect()} == got
    assert sorted(map(tuple, a.docs.select("article_id", "dl").collect())) == sorted(map(tuple, b.docs.select("article_id", "dl").collect()))
    assert a.stats.first()["n"] == b.stats.first()["n"] and a.stats.first()["avgdl"] == pytest.approx(b.stats.first()["avgdl"])


def test_grown_index_equals_a_rebuild(spark, tmp_path, monkeypatch):
    rng = random.Random(6)
    loads = [load(rng, [f"a{i}" for i in range(20)], 0), load(rng, [f"a{i}" for i in range(15, 30)], 1),
             load(rng, ["a3", "a16", "a3", "a99"], 2), load(rng, [f"a{i}" for i in range(30, 33)], 3)]
    root, rows, seen = f"{tmp_path}/grown", [], []
    tokenized = growing.term_freq
    monkeypatch.setattr(growing, "term_freq", lambda articles, cols: (seen.append(articles.count()), tokenized(articles, cols))[1])
    for number, part in enumerate(loads):
        assert growing.append_segment(spark, root, spark.createDataFrame(part, SCHEMA)) == number
        rows += part
        same(lexical.build_bm25_index(spark.createDataFrame(rows, SCHEMA)), growing.read_growing_index(spark, root))
    assert seen == [len({r[0] for r in part}) for part in loads]  # only the new articles were cut into words
    growing.compact(spark, root, f"{tmp_path}/compact")
    whole = growing.read_growing_index(spark, f"{tmp_path}/compact")
    same(lexical.build_bm25_index(spark.createDataFrame(rows, SCHEMA)), whole)
    assert growing.live_docs(spark, f"{tmp_path}/compact").select("segment").distinct().count() == 1


def test_a_load_that_died_leaves_no_trace(spark, tmp_path, monkeypatch):
    rng, root = random.Random(7), f"{tmp_path}/grown"
    first, second = load(rng, ["a", "b", "c"], 0), load(rng, ["b", "d"], 1)
    growing.append_segment(spark, root, spark.createDataFrame(first, SCHEMA))
    write = growing._write
    def dying(df, where, name, segment):
        if name == "totals":
            raise RuntimeError("lost")
        write(df, where, name, segment)
    monkeypatch.setattr(growing, "_write", dying)
    with pytest.raises(RuntimeError):
        growing.append_segment(spark, root, spark.createDataFrame(load(rng, ["a", "x"], 1), SCHEMA))
    monkeypatch.setattr(growing, "_write", write)
    same(lexical.build_bm25_index(spark.createDataFrame(first, SCHEMA)), growing.read_growing_index(spark, root))
    assert growing.append_segment(spark, root, spark.createDataFrame(second, SCHEMA)) == 2
    same(lexical.build_bm25_index(spark.createDataFrame(first + second, SCHEMA)), growing.read_growing_index(spark, root))


def test_empty_loads_and_indexes(spark, tmp_path):
    assert growing.read_growing_index(spark, f"{tmp_path}/none").stats.first()["n"] == 0
    growing.append_segment(spark, f"{tmp_path}/one", spark.createDataFrame([], SCHEMA))
    assert growing.read_growing_index(spark, f"{tmp_path}/one").postings.collect() == []


def test_sketches_of_days_merge_over_any_range(spark):
    df = spark.range(60_000).select(
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval((F.col("id") % 10).cast("int"))).alias("at"),
        (F.col("id") % 7919).alias("who"), F.when(F.col("id") % 5 > 0, (F.col("id") * 7919 % 60_000).cast("double")).alias("x"))
    sketches = profile.day_sketches(df, "at", {"who": F.col("who")}, {"x": F.col("x")})
    assert sketches.count() == 20
    for first, last, days in ((None, None, range(10)), ("2024-01-03", "2024-01-05", range(2, 5)), ("2025-01-01", None, range(0))):
        ids = [i for i in range(60_000) if i % 10 in days]
        got = profile.distinct_from_sketches(sketches, first, last).collect()
        want = len({i % 7919 for i in ids})
        assert [(r.column_name, r.n) for r in got] == ([("who", len(ids))] if ids else [])
        assert not ids or abs(got[0].n_distinct - want) <= 0.04 * want
        values = sorted(i * 7919 % 60_000 for i in ids if i % 5)
        for r in profile.quantiles_from_sketches(sketches, (0.1, 0.5, 0.95), first, last).collect():
            assert abs(sum(v <= r.value for v in values) / len(values) - r.q) < 0.01
            assert (r.n, r.low, r.high) == (len(values), values[0], values[-1])
