"""Exact duplicates by an extendible-hash index on shared files.

A document's key is 64 bits of the hash of its text without white space. The directory starts with one bucket; a
bucket with more than `capacity` chains is split by the next key bit, and the directory doubles whenever a split goes
deeper than it. Chains — one record per key and digest, pre-aggregated in the map tasks — are written to the shared
folder by ranges of (bucket, key), so each owner task holds a range of whole buckets. Where a chain has several rows,
their bytes are compared with those of the row that stays; large chains are compared in slices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.session import stage, staging_path

#: Directory entries are at most 2**MAX_DEPTH, whatever the size of the data; deeper buckets just hold more chains.
MAX_DEPTH = 16
#: Rows of one chain that are compared in one slice.
SLICE = 512


def normalised(text):
    """The text without blanks and the characters 09 to 0D; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def directory(chains: DataFrame, capacity: int, max_depth: int = MAX_DEPTH) -> tuple[int, list[tuple[int, int]]]:
    """(global depth, entries): (bucket, local depth) for each of the 2**global depth key prefixes.

    Overfull buckets are split, and the directory doubles when a split goes deeper than it. Only counts per prefix
    reach the driver: at most 2**max_depth rows.
    """
    counts = {r["prefix"]: r["n"] for r in chains.groupBy("prefix").agg(F.count(F.lit(1)).alias("n")).collect()}
    sums = [[0] * (1 << d) for d in range(max_depth + 1)]
    for prefix, n in counts.items():
        for d in range(max_depth + 1):
            sums[d][prefix >> (max_depth - d)] += n
    deep, entries, queue, buckets = 0, [(0, 0)], [(0, 0)], 1
    while queue:
        at, depth = queue.pop()
        if sums[depth][at] <= capacity or depth == max_depth:
            continue
        if depth == deep:
            entries, deep = [e for e in entries for _ in (0, 1)], deep + 1
        width = 1 << (deep - depth - 1)
        low = 2 * at * width
        bucket = entries[low][0]
        entries[low:low + 2 * width] = [(bucket, depth + 1)] * width + [(buckets, depth + 1)] * width
        buckets += 1
        queue += [(2 * at, depth + 1), (2 * at + 1, depth + 1)]
    return deep, entries


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1000,
                     max_depth: int = MAX_DEPTH) -> DataFrame:
    """One row per row of `docs`: id, `keep_id`, `group_size`, `kept`, `text_sha256`, `bucket`, `points` (code points).

    Of texts that are equal without white space, the row with the most code points and then the smallest id stays.
    Null and empty texts are one group. Rows that repeat id, text and length are one row each in the result, and of
    them only one is `kept`. A null id is the largest. Texts of any length are compared whole. Further columns of `docs` are
    not read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    text = normalised(F.col(text_col))
    read = docs.select(
        F.col(id_col).alias("id"), text.alias("body"),
        F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("points"),
    ).withColumns({"key": F.xxhash64("body"), "digest": F.sha2("body", 256)})
    entries = stage(
        read.groupBy("id", "key", "digest", "points").agg(F.count(F.lit(1)).alias("times")), "entries")
    # The row that stays has the smallest (-points, id is null, id).
    rank = F.struct((-F.col("points")).alias("less"), F.col("id").isNull().alias("no_id"), "id")
    prefix = F.shiftrightunsigned(F.col("key"), 64 - max_depth).cast("int")
    chains = entries.groupBy("key", "digest").agg(F.sum("times").alias("n"), F.min(rank).alias("head")).withColumn("prefix", prefix)
    chains = stage(chains, "chains")
    deep, pages = directory(chains, capacity, max_depth)
    table = spark.createDataFrame([(p, b) for p, (b, _) in enumerate(pages)], "page int, bucket int")
    path = staging_path(spark, "hash-index")
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    (chains.withColumn("page", F.shiftright("prefix", max_depth - deep)).join(F.broadcast(table), "page").drop("page").repartitionByRange(parts, "bucket", "key")
        .sortWithinPartitions("bucket", "key").write.parquet(path))
    index = spark.read.schema(T.StructType([*chains.schema.fields, T.StructField("bucket", T.IntegerType())])).parquet(path)
    shared = index.where("n > 1").select(
        "key", "digest", "bucket", F.col("head.id").alias("head_id"), (-F.col("head.less")).alias("head_points"),
        F.ceil(F.col("n") / SLICE).cast("int").alias("slices"))
    members = read.join(shared, ["key", "digest"])
    members = members.withColumn("slice", F.pmod(F.xxhash64("id", "points"), F.col("slices")))
    heads = (members.where(F.col("id").eqNullSafe(F.col("head_id")) & (F.col("points") == F.col("head_points")))
             .groupBy("key", "digest", "slices").agg(F.min("body").alias("head_body"))
             .withColumn("slice", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slices").cast("bigint") - 1))).drop("slices"))
    # A row whose bytes differ from its head's goes to a chain of its own text.
    compared = members.join(heads, ["key", "digest", "slice"]).select(
        "id", "key", "digest", "points", "bucket", F.when(F.col("body") != F.col("head_body"), F.col("body")).alias("other"))
    compared = stage(
        compared.groupBy("id", "key", "digest", "points", "bucket", "other").agg(F.count(F.lit(1)).alias("times")), "compared")
    chain = ["key", "digest", "other"]
    groups = compared.groupBy(*chain).agg(F.sum("times").alias("group_size"), F.min(rank).alias("head"))
    l, r = compared.alias("l"), groups.alias("r")
    same = F.expr("l.key = r.key AND l.digest = r.digest AND l.other <=> r.other")
    several = l.join(r, same).select("l.id", "l.points", "l.times", "l.digest", "l.bucket", "r.group_size", "r.head")
    single = entries.join(index.where("n = 1").select("key", "digest", "bucket"), ["key", "digest"]).select(
        "id", "points", "times", "digest", "bucket", F.lit(1).cast("long").alias("group_size"), rank.alias("head"))
    head = F.col("id").eqNullSafe(F.col("head.id")) & (-F.col("points") == F.col("head.less"))
    return several.unionByName(single).withColumn("turn", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select(
        F.col("id").alias(id_col), F.col("head.id").alias("keep_id"), "group_size",
        (head & (F.col("turn") == 1)).alias("kept"), F.col("digest").alias("text_sha256"), "bucket", "points")


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns; of rows that agree in id and text any one stays."""
    stay = exact_duplicates(docs, id_col, text_col).where("kept").select(
        F.col(id_col).alias("__id"), F.col("text_sha256").alias("__digest"), F.col("points").alias("__points"))
    keyed = docs.withColumns({"__d": F.sha2(normalised(F.col(text_col)), 256), "__p": F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("long")})
    left = keyed.join(stay, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__d") == F.col("__digest")) & (F.col("__p") == F.col("__points")), "left_semi")
    if docs.groupBy(id_col).count().where("count > 1").limit(1).count():
        left = left.dropDuplicates([id_col, "__d", "__p"])
    return left.select(*docs.columns)
