"""Temporal splitting, its checks, and the row selections around it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.times import days

SPLITS = ("train", "val", "test")


def max_time(df: DataFrame) -> DataFrame:
    return df.agg(F.max("time").alias("max_time"))


def cuts(df: DataFrame, test_days: float = 1, val_days: float = 1) -> tuple[Column, Column]:
    """(last time before the test days, last time before the validation days) as scalar subqueries.

    The subtraction is inside the subquery, so a filter on `time` is a plain comparison that a scan can use.
    """
    return tuple(df.agg((F.max("time") - days(n)).alias("cut")).scalar() for n in (test_days, test_days + val_days))


def one_split(df: DataFrame, split: str, test_days: float = 1, val_days: float = 1) -> DataFrame:
    """The rows of one split with its name, by comparisons on `time` alone."""
    test_from, val_from = cuts(df, test_days, val_days)
    time = F.col("time")
    kept = {"test": time > test_from, "val": (time > val_from) & (time <= test_from), "train": time <= val_from}[split]
    return df.where(kept).withColumn("split", F.lit(split))


def temporal_split(df: DataFrame, test_days: float = 1, val_days: float = 1) -> DataFrame:
    """`split` = test for the last days, val for the days before, train for the rest; null time gives null.

    One pass: the cuts enter as scalar subqueries. Lower bounds are exclusive.
    """
    test_from, val_from = cuts(df, test_days, val_days)
    split = (F.when(F.col("time") > test_from, "test").when(F.col("time") > val_from, "val")
             .when(F.col("time") <= val_from, "train"))
    return df.withColumn("split", split)


def split_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))


def split_order(df: DataFrame) -> DataFrame:
    """One row per pair of neighbouring splits: `ok` unless the earlier one reaches past the later one.

    A missing split makes its pairs pass, as there is nothing to leak.
    """
    def edge(side, name):
        return side(F.when(F.col("split") == name, F.col("time")))

    bounds = df.agg(edge(F.max, "train").alias("train_max"), edge(F.min, "val").alias("val_min"),
                    edge(F.max, "val").alias("val_max"), edge(F.min, "test").alias("test_min"))
    pair = F.explode(F.array(
        F.struct(F.lit("train").alias("earlier"), F.lit("val").alias("later"),
                 F.coalesce(F.col("train_max") <= F.col("val_min"), F.lit(True)).alias("ok")),
        F.struct(F.lit("val").alias("earlier"), F.lit("test").alias("later"),
                 F.coalesce(F.col("val_max") <= F.col("test_min"), F.lit(True)).alias("ok"))))
    return bounds.select(pair.alias("pair")).select("pair.*")


def assert_split_order(df: DataFrame) -> None:
    """Raise where a split holds rows later than its successor starts."""
    bad = split_order(df).where(~F.col("ok")).take(1)
    if bad:
        raise ValueError(f"time leak between {bad[0]['earlier']} and {bad[0]['later']}")


def between_times(df: DataFrame, low=None, high=None, col: str = "time") -> DataFrame:
    """Rows with low < time <= high; either bound may be absent."""
    out = df
    if low is not None:
        out = out.where(F.col(col) > low)
    if high is not None:
        out = out.where(F.col(col) <= high)
    return out


def only_labeled(df: DataFrame, need_unclicked: bool = False) -> DataFrame:
    """Impressions with a click and, if asked, also with a non-click."""
    out = df.where(F.size("clicked_articles") > 0)
    return out.where(F.size("unclicked_articles") > 0) if need_unclicked else out


def with_history(df: DataFrame) -> DataFrame:
    """Rows whose history list is not empty."""
    return df.where(F.size("history") > 0)


def select_dataset(df: DataFrame, kind: str) -> DataFrame:
    """Rows of one dataset family by its folder prefix (mind, ebnerd), or all of them (both)."""
    if kind == "both":
        return df
    return df.where(F.lower(F.col("dataset")).startswith(kind.lower()))


def slice_by_history(df: DataFrame, cut: int = 5) -> DataFrame:
    """`slice` = cold below `cut` history entries, else warm."""
    return df.withColumn("slice", F.when(F.col("hist_len") < cut, "cold").otherwise("warm"))


def sort_by_time(df: DataFrame) -> DataFrame:
    """Global time order. Writers use a sort inside partitions instead, which needs no shuffle."""
    return df.orderBy("time")


def top_n(df: DataFrame, order: list, n: int) -> DataFrame:
    """First `n` rows in the given order; each task keeps only n rows."""
    return df.orderBy(*order).limit(n)


def head(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames by column name, duplicates kept."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
