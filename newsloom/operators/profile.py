"""Data profiling: counts, null shares, summaries and histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsloom.session import stage


#: Pieces of a column's distinct values; a quantile orders the values of one.
PIECES = 1000


def value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows per distinct value combination, most frequent first."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows")).orderBy(F.desc("n_rows"), *cols)


def null_profile(df: DataFrame) -> DataFrame:
    """(column_name, n_nulls, pct_nulls) from one pass over the data."""
    total = F.count(F.lit(1))
    row = df.agg(total.alias("__n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_nulls")) for c in df.columns])
    share = F.when(F.col("__n") > 0, F.col("cell.n_nulls") * 100.0 / F.col("__n")).otherwise(0.0)
    return row.select("__n", F.explode(cells).alias("cell")).select("cell.*", share.alias("pct_nulls"))


def distinct_profile(df: DataFrame, cols: list[str], approx: bool = False) -> DataFrame:
    """(column_name, n_distinct); `approx` shuffles one sketch per task and column instead of the values."""
    count = F.approx_count_distinct if approx else F.countDistinct
    row = df.agg(*[count(F.col(c)).alias(c) for c in cols])
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_distinct")) for c in cols])
    return row.select(F.explode(cells).alias("cell")).select("cell.*")


def _long(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(n).alias("column_name"), c.cast("double").alias("value")) for n, c in cols.items()])
    return df.select(F.explode(cells).alias("cell")).select("cell.*").where(F.col("value").isNotNull())


def value_frequencies(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    """(column_name, value, c): how often each value of some expressions occurs; written once, as all the rest reads it."""
    return stage(_long(df, cols).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("c")), "frequencies")


def quantiles_of(counts: DataFrame, qs: tuple[float, ...], accuracy: int = 10000) -> DataFrame:
    """(column_name, q, value): interpolated quantiles of counted values, exact at any size.

    The distinct values of a column are cut into PIECES of about the same number; sums per piece say which one holds the
    asked ranks, and only its values are ordered. Cuts and sums are a fixed number of rows per column.
    """
    steps = F.percentile_approx("value", F.array(*[F.lit(i / PIECES) for i in range(1, PIECES)]), accuracy)
    cuts = F.broadcast(counts.groupBy("column_name").agg(steps.alias("cuts")))
    placed = counts.join(cuts, "column_name").withColumn("piece", F.size(F.filter("cuts", lambda x: x < F.col("value")))).drop("cuts")
    sums = placed.groupBy("column_name", "piece").agg(F.sum("c").alias("s"))
    column = Window.partitionBy("column_name")
    sums = sums.select("column_name", "piece", "s", (F.sum("s").over(column.orderBy("piece")) - F.col("s")).alias("before"), F.sum("s").over(column).alias("n"))
    rank = F.col("q") * (F.col("n") - 1)
    ends = F.array(*[F.struct(F.lit(i).alias("end"), f(rank).cast("long").alias("at")) for i, f in enumerate((F.floor, F.ceil))])
    asked = sums.select("*", F.explode(F.array(*[F.lit(float(q)) for q in qs])).alias("q")).select("*", F.explode(ends).alias("e"))
    asked = asked.where("e.at >= before AND e.at < before + s").select("column_name", "piece", "q", "n", "e.end", (F.col("e.at") - F.col("before")).alias("at"))
    inside = placed.join(F.broadcast(asked.select("column_name", "piece").distinct()), ["column_name", "piece"])
    upto = F.sum("c").over(Window.partitionBy("column_name", "piece").orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    found = inside.withColumn("upto", upto).join(F.broadcast(asked), ["column_name", "piece"]).where("at < upto AND at >= upto - c")
    both = found.groupBy("column_name", "q").agg(
        F.max("n").alias("n"), F.max(F.when(F.col("end") == 0, F.col("value"))).alias("a"), F.max(F.when(F.col("end") == 1, F.col("value"))).alias("b"))
    part = rank - F.floor(rank)
    return both.select("column_name", "q", (F.col("a") + (F.col("b") - F.col("a")) * part).alias("value"))


def exact_quantiles(df: DataFrame, cols: dict[str, Column], qs: tuple[float, ...] = (0.5,), accuracy: int = 10000) -> DataFrame:
    """(column_name, q, value): interpolated quantiles of expressions, from one pass over the data (see `quantiles_of`)."""
    return quantiles_of(value_frequencies(df, cols), qs, accuracy)


def summary_stats(df: DataFrame, cols: dict[str, Column], median: str = "exact") -> DataFrame:
    """(column_name, n, min, max, mean, median) of expressions; `median` is exact or approx. Both read the data once."""
    if median == "approx":
        return _long(df, cols).groupBy("column_name").agg(
            F.count(F.lit(1)).alias("n"), F.min("value").alias("min_value"), F.max("value").alias("max_value"), F.avg("value").alias("mean_value"),
            F.percentile_approx("value", F.lit(0.5)).alias("median_value"))
    counts = value_frequencies(df, cols)
    medians = quantiles_of(counts, (0.5,)).select("column_name", F.col("value").alias("median_value"))
    sums = counts.groupBy("column_name").agg(
        F.sum("c").alias("n"), F.min("value").alias("min_value"), F.max("value").alias("max_value"), (F.sum(F.col("value") * F.col("c")) / F.sum("c")).alias("mean_value"))
    return sums.join(F.broadcast(medians), "column_name")


def share(df: DataFrame, bool_cols: list[str]) -> DataFrame:
    """(column_name, share_true) of boolean columns over their non-null rows."""
    row = df.agg(*[F.avg(F.col(c).cast("int")).alias(c) for c in bool_cols])
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("share_true")) for c in bool_cols])
    return row.select(F.explode(cells).alias("cell")).select("cell.*")


def impressions_per_user(impressions: DataFrame) -> DataFrame:
    return impressions.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_impressions"))


def activity_per_user(impressions: DataFrame) -> DataFrame:
    """Mean, median and maximum number of impressions per user."""
    counts = impressions_per_user(impressions)
    return summary_stats(counts, {"n_impressions": F.col("n_impressions")})


def most_active_users(impressions: DataFrame, n: int = 5) -> DataFrame:
    return impressions_per_user(impressions).orderBy(F.desc("n_impressions"), "user_id").limit(n)


def clicks_per_impression(impressions: DataFrame) -> DataFrame:
    """Number of impressions per click count."""
    clicks = F.size("clicked_articles").cast("bigint").alias("n_clicked")
    return impressions.groupBy(clicks).agg(F.count(F.lit(1)).alias("n_impressions")).orderBy("n_clicked")


def histogram(df: DataFrame, value: Column, bins: int = 50) -> DataFrame:
    """(bin, low, high, n_rows) for equal-width bins 1..bins; the maximum falls in the last one."""
    values = df.select(value.cast("double").alias("x")).where(F.col("x").isNotNull())
    low = values.agg(F.min("x").alias("a")).scalar()
    high = values.agg(F.max("x").alias("b")).scalar()
    placed = values.select("x", low.alias("a"), high.alias("b")).withColumn("width", (F.col("b") - F.col("a")) / bins)
    number = F.when(F.col("width") > 0, F.least(F.floor((F.col("x") - F.col("a")) / F.col("width")) + 1, F.lit(bins)))
    binned = placed.withColumn("bin", F.coalesce(number, F.lit(1)).cast("bigint"))
    return binned.groupBy("bin", "a", "width").agg(F.count(F.lit(1)).alias("n_rows")).select(
        "bin", (F.col("a") + (F.col("bin") - 1) * F.col("width")).alias("low"),
        (F.col("a") + F.col("bin") * F.col("width")).alias("high"), "n_rows")


# Sketches -----------------------------------------------------------------------------------------

def day_sketches(df: DataFrame, time: str, distinct: dict[str, Column], values: dict[str, Column], lg_k: int = 14, k: int = 800) -> DataFrame:
    """(day, column_name, n, low, high, distinct_sketch, value_sketch): what a day needs to be merged with others.

    Named expressions of `distinct` get a HyperLogLog sketch of 2^lg_k registers, those of `values` a KLL sketch of parameter
    `k`. A row is a few dozen kB at most whatever the day holds; rows without a time are under the null day.
    """
    day = F.to_date(time).alias("day")
    cells = [F.struct(F.lit(name).alias("column_name"), F.count(c).alias("n"), F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"),
                      F.hll_sketch_agg(c.cast("string"), F.lit(lg_k)).alias("distinct_sketch"), F.lit(None).cast("binary").alias("value_sketch")) for name, c in distinct.items()]
    cells += [F.struct(F.lit(name).alias("column_name"), F.count(c).alias("n"), F.min(c.cast("double")).alias("low"), F.max(c.cast("double")).alias("high"),
                       F.lit(None).cast("binary").alias("distinct_sketch"), F.kll_sketch_agg_double(c.cast("double"), F.lit(k)).alias("value_sketch")) for name, c in values.items()]
    return df.groupBy(day).agg(F.array(*cells).alias("cells")).select("day", F.explode("cells").alias("c")).select("day", "c.*")


def _days(sketches: DataFrame, first, last) -> DataFrame:
    for bound, keep in ((first, lambda b: F.col("day") >= F.lit(b).cast("date")), (last, lambda b: F.col("day") <= F.lit(b).cast("date"))):
        sketches = sketches if bound is None else sketches.where(keep(bound))
    return sketches


def distinct_from_sketches(sketches: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """(column_name, n, n_distinct) over the days from `first` to `last`, from stored sketches alone; within about 1.04 / 2^(lg_k / 2)."""
    rows = _days(sketches, first, last).where(F.col("distinct_sketch").isNotNull())
    return rows.groupBy("column_name").agg(F.sum("n").alias("n"), F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("n_distinct"))


def quantiles_from_sketches(sketches: DataFrame, qs: tuple[float, ...] = (0.5,), first: str | None = None, last: str | None = None) -> DataFrame:
    """(column_name, n, q, value, low, high) over the days from `first` to `last`, from stored sketches alone.

    The value's rank is off by about 2 / k of the rows; `low` and `high` are exact.
    """
    rows = _days(sketches, first, last).where(F.col("value_sketch").isNotNull() & (F.col("n") > 0))
    merged = rows.groupBy("column_name").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.kll_merge_agg_double("value_sketch").alias("s"))
    cells = [F.struct(F.lit(q).alias("q"), F.kll_sketch_get_quantile_double("s", F.lit(float(q))).alias("value")) for q in qs]
    return merged.select("column_name", "n", "low", "high", F.explode(F.array(*cells)).alias("c")).select("column_name", "n", "c.*", "low", "high")
