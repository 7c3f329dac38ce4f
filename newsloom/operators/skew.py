"""Equi-joins that stay balanced when single keys hold a large part of the rows."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SPREADABLE = (T.StringType, T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def default_slices(df: DataFrame) -> int:
    """As many slices as a shuffle has partitions, so a slice is no larger than a mean partition."""
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


@dataclass(frozen=True)
class HotKeys:
    """Keys that hold more than 1/slices of some rows; `table` has the slice number per key, None if no key does."""

    table: DataFrame | None


def hot_keys(df: DataFrame, keys: list[str], slices: int | None = None, counts: DataFrame | None = None) -> HotKeys:
    """Find the hot keys of `df` by one counting job that combines inside each map task before its shuffle.

    Fewer than `slices` keys can qualify whatever the size of the data, so the driver sees at most that
    many rows and the result is safe to broadcast. `counts` (keys, `_n`) skips the counting where the
    row numbers are known already.
    """
    slices = slices or default_slices(df)
    if counts is None:
        counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    seen = Observation()
    top = counts.observe(seen, F.sum("_n").alias("total")).orderBy(F.desc("_n")).limit(slices).collect()
    if not top:
        return HotKeys(None)
    total = seen.get["total"]
    hot = [(*[row[k] for k in keys], math.ceil(row["_n"] * slices / total)) for row in top if row["_n"] * slices > total]
    if not hot:
        return HotKeys(None)
    schema = T.StructType([counts.schema[k] for k in keys] + [T.StructField("_slices", T.IntegerType())])
    return HotKeys(df.sparkSession.createDataFrame(hot, schema))


def skew_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner",
              hot: HotKeys | None = None, spread: list[str] | None = None, hint: str | None = None) -> DataFrame:
    """`left` joined to `right`, with the rows of hot left keys spread over several tasks.

    Hot left rows get a slice number from a hash of their other columns (fixed for a row, so a re-run
    task repeats it); the matching right rows are copied once per slice. All other keys join as usual.
    Without `hot` this is a plain join: nothing is counted ahead, Spark picks the physical form by the sizes it
    sees at run time, and its adaptive skew join splits the partitions of frequent keys. Pass `hot` where the
    counts exist anyway. It may come from any superset of the left rows. `how`: inner, left, left_semi or left_anti. `hint` names
    a join strategy for the right side.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    if hot is None or hot.table is None:
        return left.join(right.hint(hint) if hint else right, on, how)
    if spread is None:
        spread = [f.name for f in left.schema.fields if f.name not in on and isinstance(f.dataType, _SPREADABLE)]
    if not spread:
        raise ValueError("left rows need a column besides the key to be spread by; aggregate them first")
    table = F.broadcast(hot.table)
    cut = F.coalesce(F.col("_slices"), F.lit(1))
    salted_left = (
        left.join(table, on, "left")
        .withColumn("_salt", F.when(cut > 1, F.pmod(F.xxhash64(*spread), cut).cast("int")).otherwise(0))
        .drop("_slices")
    )
    salted_right = (
        right.join(table, on, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), cut - 1)))
        .drop("_slices")
    )
    return salted_left.join(salted_right.hint(hint) if hint else salted_right, [*on, "_salt"], how).drop("_salt")
