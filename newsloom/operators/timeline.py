"""Features of impressions as of their own time: earlier clicks with decay, and sessions.

A user's events are one stream in time order. It is cut into pieces of time; running sums go over the rows of a piece, and what
comes before a piece is carried in from a table with one row per user and piece. So a user with very many events is many
groups, and no event is paired with another.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions.times import epoch_seconds
from newsloom.session import stage

#: Pieces are this many decay times long, and what lies `FAR` decay times back is 0 in double precision.
SPAN, FAR = 8, 745


def recency_at_impression(impressions: DataFrame, clicks: DataFrame, tau_seconds: float = 86400.0 * 7) -> DataFrame:
    """(impression_id, user_id, n_clicks, last_click_age, decay_sum): one row per impression, from strictly earlier clicks.

    `clicks` has user_id and click_time. The age is null without an earlier click; `decay_sum` adds exp(-age / tau). A click at
    the very time of an impression is not earlier. Impressions without a time have no earlier clicks; clicks without one count
    nowhere.
    """
    length = float(SPAN * tau_seconds)
    shown = impressions.select("user_id", epoch_seconds(F.col("time")).alias("t"), F.lit(0).alias("kind"), "impression_id")
    clicked = clicks.select("user_id", epoch_seconds(F.col("click_time")).alias("t"), F.lit(1).alias("kind"), F.lit(None).cast("string").alias("impression_id"))
    stream = shown.unionByName(clicked.where(F.col("t").isNotNull())).withColumn("piece", F.floor(F.col("t") / length))
    since = (F.col("t") - F.col("piece") * length) / tau_seconds  # from 0 to SPAN
    hit = F.col("kind") == 1
    pieces = stream.groupBy("user_id", "piece").agg(
        F.sum("kind").alias("n"), F.max(F.when(hit, F.col("t"))).alias("last"), F.sum(F.when(hit, F.exp(since - SPAN)).otherwise(0.0)).alias("held"))
    by_user = Window.partitionBy("user_id").orderBy("piece")
    before = by_user.rowsBetween(Window.unboundedPreceding, -1)
    near = F.collect_list(F.struct("piece", "held")).over(by_user.rangeBetween(-math.ceil(FAR / SPAN), -1))
    carried = F.aggregate(near, F.lit(0.0), lambda sum_, x: sum_ + x["held"] * F.exp((x["piece"] + 1 - F.col("piece")).cast("double") * SPAN))
    carry = pieces.where(F.col("piece").isNotNull()).select(
        "user_id", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"), F.max("last").over(before).alias("last0"), carried.alias("held0"))
    earlier = Window.partitionBy("user_id", "piece").orderBy("t", "kind").rowsBetween(Window.unboundedPreceding, -1)
    inside = stream.select(
        "user_id", "piece", "kind", "impression_id", "t", since.alias("since"), F.coalesce(F.sum("kind").over(earlier), F.lit(0)).alias("n1"),
        F.max(F.when(hit, F.col("t"))).over(earlier).alias("last1"), F.coalesce(F.sum(F.when(hit, F.exp(since)).otherwise(0.0)).over(earlier), F.lit(0.0)).alias("held1"))
    rows = inside.where("kind = 0").join(carry, ["user_id", "piece"], "left")
    known = F.col("t").isNotNull()
    return rows.select(
        "impression_id", "user_id", F.when(known, F.col("n0") + F.col("n1")).otherwise(0).alias("n_clicks"),
        F.when(known, F.col("t") - F.greatest("last0", "last1")).alias("last_click_age"),
        F.when(known, (F.col("held0") + F.col("held1")) * F.exp(-F.col("since"))).otherwise(0.0).alias("decay_sum"))


def session_features(impressions: DataFrame, gap_seconds: float = 1800.0, piece_seconds: float = 86400.0) -> DataFrame:
    """One row per impression with a time: its session, place in it, and the session's length, duration and click rate.

    Columns: impression_id, user_id, session (from 1 per user), position (from 1), n_before_clicked (clicked impressions of the
    session before this one), session_length, session_seconds, session_click_rate. A session ends when the next impression comes
    more than `gap_seconds` later; order is by time, then impression id. All but position and n_before_clicked look at
    the whole session, so they describe a log and are no features to serve with.
    """
    rows = impressions.select("impression_id", "user_id", epoch_seconds(F.col("time")).alias("t"), (F.size("clicked_articles") > 0).cast("int").alias("clicked"))
    rows = rows.where(F.col("t").isNotNull()).withColumn("piece", F.floor(F.col("t") / float(piece_seconds)))
    ends = rows.groupBy("user_id", "piece").agg(F.max("t").alias("end"))
    ends = ends.select("user_id", "piece", F.lag("end").over(Window.partitionBy("user_id").orderBy("piece")).alias("end0"))
    inside = Window.partitionBy("user_id", "piece").orderBy("t", "impression_id")
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    gap = F.col("t") - F.coalesce(F.lag("t").over(inside), F.col("end0"))
    rows = rows.join(ends, ["user_id", "piece"]).withColumn("opens", F.coalesce(gap > gap_seconds, F.lit(True)).cast("int"))
    rows = stage(rows.select("impression_id", "user_id", "piece", "t", "clicked", F.sum("opens").over(so_far).alias("session1"),
                             F.row_number().over(inside).alias("place1"), F.sum("clicked").over(so_far).alias("clicked1")), "sessions")
    totals = rows.groupBy("user_id", "piece").agg(
        F.max("session1").alias("s"), F.max("place1").alias("p"), F.max("clicked1").alias("c"))
    before = Window.partitionBy("user_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select("user_id", "piece", *[F.coalesce(F.sum(x).over(before), F.lit(0)).alias(f"{x}0") for x in "spc"])
    rows = rows.join(carry, ["user_id", "piece"]).select(
        "impression_id", "user_id", "t", "clicked", (F.col("s0") + F.col("session1")).alias("session"),
        (F.col("p0") + F.col("place1")).alias("place"), (F.col("c0") + F.col("clicked1")).alias("clicks"))
    whole = rows.groupBy("user_id", "session").agg(
        F.min("place").alias("place0"), F.min(F.col("clicks") - F.col("clicked")).alias("clicks0"), F.count(F.lit(1)).alias("session_length"),
        (F.max("t") - F.min("t")).alias("session_seconds"), F.avg("clicked").alias("session_click_rate"))
    return rows.join(whole, ["user_id", "session"]).select(
        "impression_id", "user_id", "session", (F.col("place") - F.col("place0") + 1).alias("position"),
        (F.col("clicks") - F.col("clicked") - F.col("clicks0")).alias("n_before_clicked"), "session_length", "session_seconds", "session_click_rate")
