from datetime import datetime

from pyspark.sql import functions as F

from newsloom.functions import lists, text, times
from newsloom.operators import unify


def test_labeled_impressions(spark):
    df = spark.createDataFrame([("1-0 2-1",), ("3-1",), (None,), ("a-b-1 plain  c-x",)], "s string")
    got = [r.p for r in df.select(text.parse_labeled_impressions(F.col("s")).alias("p")).collect()]
    assert [(p.clicked, p.unclicked) for p in got] == [(["2"], ["1"]), (["3"], []), ([], []), (["a-b"], ["c"])]


def test_times_ignore_session_zone(spark):
    rows = [("11/11/2019 9:05:58 AM",), ("11/11/2019 21:05:58",), ("1/2/2020 12:00:00 PM",), ("bad",), (None,), ("3/10/2019 2:30:00 AM",)]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = [r.t for r in spark.createDataFrame(rows, "s string").select(times.parse_time(F.col("s")).alias("t")).collect()]
            assert got == [datetime(2019, 11, 11, 9, 5, 58), datetime(2019, 11, 11, 21, 5, 58), datetime(2020, 1, 2, 12),
                           None, None, datetime(2019, 3, 10, 2, 30)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_tokens_of_other_scripts(spark):
    df = spark.createDataFrame([("Blåbær, snake_case 42x!",), (None,), ("",)], "s string")
    got = [r.t for r in df.select(text.tokenize(F.col("s")).alias("t")).collect()]
    assert got == [["blåbær", "snake_case", "42x"], [], []]


def test_history_and_lists(spark):
    df = spark.createDataFrame([(None, [1, 2, 2, 3], [2])], "h string, v array<int>, c array<int>")
    row = df.select(text.parse_history(F.col("h")).alias("h"), lists.unclicked(F.col("v"), F.col("c")).alias("u"),
                    lists.list_len(F.col("v")).alias("n")).first()
    assert (row.h, row.u, row.n) == ([], ["1", "3"], 4)


def test_first_history_takes_the_earliest_parsed_time(spark):
    rows = [("u", "2", "1/10/2020 9:00:00 AM", "late"), ("u", "1", "1/9/2020 9:00:00 PM", "a b"), ("v", "3", "bad", None)]
    df = spark.createDataFrame(rows, "user_id string, impression_id string, time string, history string")
    assert {r.user_id: r.history for r in unify.first_history(df).collect()} == {"u": ["a", "b"], "v": []}


def test_latest_users_and_articles(spark):
    users = spark.createDataFrame([("u", ["a"], 0), ("u", ["b"], 2), ("v", ["c"], 1)], "user_id string, history array<string>, source_rank int")
    assert {r.user_id: r.history for r in unify.latest_users(users).collect()} == {"u": ["b"], "v": ["c"]}
    arts = spark.createDataFrame([("1", "z old", 1, 0), ("1", "new", 2, 0), ("1", "newer", 2, 1)],
                                 "article_id string, title string, source_rank int, row_position int")
    assert [tuple(r) for r in unify.one_per_id(arts).collect()] == [("1", "newer")]
    assert unify.one_per_id(arts.drop("source_rank", "row_position"), "title").first()["title"] == "z old"


def test_numeric_category_becomes_text(spark):
    df = spark.createDataFrame([(1, "t", 7)], "article_id int, title string, category int")
    assert unify.unify_articles(df, "parquet").first().asDict() == {
        "article_id": "1", "title": "t", "abstract": "", "body": "", "category": "7"}


def test_has_labels_and_click_rate(spark):
    df = spark.createDataFrame([("N1-1 N2-0",), ("N1 N2",)], "s string")
    got = df.select(text.has_labels(F.col("s")).alias("h"), text.click_rate(F.col("s")).alias("r")).collect()
    assert [(r.h, r.r) for r in got] == [(True, 0.5), (False, 0.0)]
