"""Words of an article are sorted once, not once per word."""

import collections

from newsloom.operators import lexical


def test_words_are_sorted_in_one_place_of_the_plan(spark):
    texts = {"a": "b a b c", "b": "", "c": None, "d": "x x"}
    rows = spark.createDataFrame([*texts.items()], "article_id string, title string").selectExpr("*", "'' AS abstract")
    terms = lexical.term_freq(rows)
    assert terms._jdf.queryExecution().optimizedPlan().toString().count("sort_array(") == 1
    want = {(k, len(x.split()), w, n) for k, x in texts.items() if x for w, n in collections.Counter(x.split()).items()}
    assert sorted((r.article_id, r.dl, r.term, r.tf) for r in terms.collect()) == sorted(want)
