"""Sinks: Parquet tables, metric files and prediction text."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, root: str, name: str, dataset: str, mode: str = "overwrite") -> str:
    """One store table, partitioned by dataset; only the given dataset is replaced."""
    path = f"{root}/{name}"
    (
        df.withColumn("dataset", F.lit(dataset))
        .write.mode(mode).option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
        .partitionBy("dataset").parquet(path)
    )
    return path


def write_splits(df: DataFrame, root: str, dataset: str) -> str:
    """Impressions partitioned by dataset and split, ordered by time inside each file."""
    path = f"{root}/impressions"
    (
        df.where(F.col("split").isNotNull()).withColumn("dataset", F.lit(dataset))
        .sortWithinPartitions("split", "time")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
        .partitionBy("dataset", "split").parquet(path)
    )
    return path


def write_index(index, root: str, dataset: str, task_rows: int = 1 << 20) -> None:
    """The three index tables. Postings are clustered by term, so a term filter skips row groups.

    Postings shrink well in a shuffle, so Spark would join many partitions into one by their bytes: their number goes by rows
    instead, and a task sorts about `task_rows` of them. Postings that come clustered are written as they come.
    """
    postings = index.postings
    if not index.clustered:
        tasks = -(-postings.count() // task_rows) or 1
        postings = postings.repartitionByRange(tasks, "term", "article_id").sortWithinPartitions("term", "article_id")
    write_table(postings, root, "postings", dataset)
    write_table(index.docs, root, "docs", dataset)
    write_table(index.stats, root, "stats", dataset)


def bucket_table(path: str) -> str:
    """Name in the catalog of the bucketed table at `path`."""
    return "bucketed_" + hashlib.md5(path.encode()).hexdigest()[:16]


def dealt(df: DataFrame, buckets: int, key: str, block_rows: int = 1 << 20) -> DataFrame:
    """`df.repartition(buckets, key)` with the rows shuffled in compressed blocks: a map task packs some `block_rows` rows at a time
    into one block per bucket, in the order in which they come."""
    names = df.columns

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n = [], 0
        for batch in chain(batches, [None]):
            if batch is not None:
                waiting.append(batch)
                n += batch.num_rows
            if n >= block_rows or (batch is None and n):
                rows = pa.Table.from_batches(waiting)
                rows = rows.take(pc.sort_indices(rows, [("_bucket", "ascending")]))
                bucket, rows = rows["_bucket"].to_numpy(), rows.select(names)
                starts = np.flatnonzero(np.diff(bucket, prepend=-1))
                for start, end in zip(starts, [*starts[1:], len(bucket)]):
                    out = pa.BufferOutputStream()
                    with pa.ipc.new_stream(out, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                        stream.write_table(rows.slice(start, end - start).combine_chunks())
                    yield pa.RecordBatch.from_pydict({"_bucket": pa.array([bucket[start]], pa.int32()), "block": pa.array([out.getvalue().to_pybytes()], pa.binary())})
                waiting, n = [], 0

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch["block"]:
                yield from pa.ipc.open_stream(block.as_buffer())

    numbered = df.withColumn("_bucket", F.pmod(F.hash(key), F.lit(buckets)))
    return numbered.mapInArrow(pack, "_bucket int, block binary").repartitionById(buckets, F.col("_bucket")).select("block").mapInArrow(unpack, df.schema)


def write_bucketed(df: DataFrame, root: str, name: str, key: str, buckets: int | None = None) -> str:
    """A store table in hash buckets of `key`, sorted in each; joins on the key read it without a shuffle of its side.

    The default is as many buckets as a shuffle has partitions, so that the other side of a join comes to the buckets. One
    task writes one bucket. The number of buckets is part of the path, so that a session that finds the files can declare the table.
    """
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    path = f"{root}/{name}_by_{key}_{buckets}"
    rows = dealt(df, buckets, key)
    rows.write.mode("overwrite").option("path", path).option("compression", "zstd").bucketBy(buckets, key).sortBy(key).saveAsTable(bucket_table(path))
    return path


def write_embeddings(df: DataFrame, root: str, dataset: str) -> DataFrame:
    """Append the vectors of articles that the store lacks, and return the rows written."""
    spark = df.sparkSession
    path = f"{root}/vectors"
    new = df
    if path_exists(spark, path):
        stored = spark.read.parquet(path).where(F.col("dataset") == dataset).select("article_id")
        new = df.join(stored, "article_id", "left_anti")
    write_table(new, root, "vectors", dataset, mode="append")
    return new


def missing_embeddings(articles: DataFrame, stored: DataFrame) -> DataFrame:
    """Articles without a stored vector: the only ones an encoder has to see."""
    return articles.join(stored.select("article_id"), "article_id", "left_anti")


def write_metrics(df: DataFrame, path: str) -> None:
    """Metric means as JSON lines. The frame has one row per model, slice and metric, so one file is enough."""
    df.coalesce(1).write.mode("overwrite").json(path)


def prediction_lines(df: DataFrame, key: str = "impression_id") -> DataFrame:
    """`impression_id [r1,r2,...]` per row, `[]` where there are no candidates."""
    body = F.array_join(F.coalesce("ranks", F.array().cast("array<int>")).cast("array<string>"), ",")
    return df.select("row_id", F.concat(F.col(key), F.lit(" ["), body, F.lit("]")).alias("value"))


def write_predictions(df: DataFrame, path: str) -> None:
    """Prediction lines as text, range-sorted by input row so that the part files read in order."""
    prediction_lines(df).orderBy("row_id").select("value").write.mode("overwrite").text(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)
