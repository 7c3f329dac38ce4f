"""A staged index keeps one row of term counts per article and deals them to ranges of terms in blocks."""

from newsloom.operators import lexical


def test_staged_index_equals_the_plain_one(spark, monkeypatch):
    rows = [(f"a{i}", " ".join(f"w{(i * k) % 23}" for k in range(i % 9))) for i in range(60)] + [("a3", "w1 other w1"), (None, "w2 w3"), ("b", None)]
    arts = spark.createDataFrame(rows, "article_id string, title string").selectExpr("*", "'' AS abstract")
    seen, plain = {}, lexical.stage

    def watched(df, name):
        seen[name] = plain(df, name)
        return seen[name]
    monkeypatch.setattr(lexical, "stage", watched)
    index = lexical.build_bm25_index(arts)
    terms = seen["terms"].select("article_id").collect()
    assert len(terms) == len(set(terms))
    other = lexical.build_bm25_index(arts, staged=False)
    for one, two in ((index.postings, other.postings), (index.docs, other.docs), (index.stats, other.stats)):
        assert one.dtypes == two.dtypes
        assert sorted(map(tuple, one.collect()), key=repr) == sorted(map(tuple, two.collect()), key=repr)
