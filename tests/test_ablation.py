"""What an impression knows meets it before its candidates become rows."""

import re

import numpy as np

from newsloom.plans import ablation


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_features_of_candidates_are_joined_by_impression(spark):
    imps = spark.createDataFrame([("1", "u", ["a", "b"], ["c", "a"], "train", 2), ("2", "v", ["b"], [], "test", 0), ("2", "u", None, ["a", None], "test", 2), ("3", None, ["a"], ["c"], None, 0)],
                                 "impression_id string, user_id string, clicked_articles array<string>, unclicked_articles array<string>, split string, hist_len long")
    users = spark.createDataFrame([("u", ["a", None]), ("u", ["c"]), ("v", None), (None, ["a"])], "user_id string, history array<string>")
    log = spark.createDataFrame([(1, "a", 3.0), (1, "a", 5.0), (1, "b", None), (2, "a", 7.0), (2, None, 9.0), (None, "a", 8.0)], "impression_id long, article_id string, read_time double")
    pop = spark.createDataFrame([("a", 1), ("c", 3)], "article_id string, clicks long")
    out = ablation.candidate_features(imps, log, users, pop)
    got = sorted((r.row_id, str(r.user_id), r.pos, r.label, round(np.expm1(r.popularity)), r.seen, r.logged_read) for r in out.collect())
    assert got == [("1", "u", 0, 1, 1, 1.0, 5.0), ("1", "u", 1, 1, 0, 0.0, 0.0), ("1", "u", 2, 0, 3, 1.0, 0.0), ("1", "u", 3, 0, 1, 1.0, 5.0),
                   ("2", "u", 0, 0, 1, 1.0, 7.0), ("2", "u", 1, 0, 0, 0.0, 0.0), ("2", "v", 0, 1, 0, 0.0, 0.0), ("3", "None", 0, 1, 1, 0.0, 0.0), ("3", "None", 1, 0, 3, 0.0, 0.0)]
    assert not re.search(r"Join \[(user_id|row_id)#\d+, article_id", plan_of(out))
