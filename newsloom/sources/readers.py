"""Raw and stored inputs as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.lists import ids_to_string, rename_and_default
from newsloom.functions.text import parse_candidates, parse_history
from newsloom.sources.writers import bucket_table

# Column order of the headerless TSV files.
NEWS_SCHEMA = (
    "article_id string, category string, subcategory string, title string, abstract string, "
    "url string, title_entities string, abstract_entities string"
)
BEHAVIORS_SCHEMA = "impression_id string, user_id string, time string, history string, impressions string"


def _tsv(spark: SparkSession, paths, schema: str) -> DataFrame:
    """Tab-separated text taken literally: no quoting, no escapes, short rows padded with null."""
    return (
        spark.read.schema(schema)
        .options(sep="\t", quote="", escape="", mode="PERMISSIVE", header=False, recursiveFileLookup=True)
        .csv(paths)
    )


def read_news_tsv(spark: SparkSession, paths) -> DataFrame:
    return _tsv(spark, paths, NEWS_SCHEMA)


def read_behaviors_tsv(spark: SparkSession, paths) -> DataFrame:
    return _tsv(spark, paths, BEHAVIORS_SCHEMA)


def read_vec(spark: SparkSession, paths, dims: int = 100) -> DataFrame:
    """Lines of an id and `dims` tab-separated floats."""
    parts = F.split("value", "\t")
    return spark.read.text(paths).select(
        F.get(parts, F.lit(0)).alias("entity_id"),
        F.slice(parts, 2, dims).cast("array<float>").alias("embedding"),
    )


def read_articles_parquet(spark: SparkSession, paths, rename: dict[str, str] | None = None) -> DataFrame:
    """Articles with absent subtitle, body and category_str columns filled by empty text."""
    raw = spark.read.parquet(*_as_list(paths)).withColumnsRenamed(rename or {})
    if "category_str" not in raw.columns and "category" in raw.columns:
        raw = raw.withColumn("category_str", F.col("category").cast("string"))
    return rename_and_default(raw, defaults={"subtitle": "", "body": "", "category_str": ""})


def read_history_parquet(spark: SparkSession, paths) -> DataFrame:
    """User id and clicked ids; the other parallel lists are never read."""
    return spark.read.parquet(*_as_list(paths)).select(
        F.col("user_id").cast("string"), ids_to_string(F.col("article_id_fixed")).alias("history"))


def read_behaviors_parquet(spark: SparkSession, paths, labeled: bool = True) -> DataFrame:
    """Impression columns of the Parquet click log; unlabeled files have no clicked list."""
    cols = [F.col("impression_id").cast("string"), F.col("user_id").cast("string"),
            F.col("impression_time").alias("time"), ids_to_string(F.col("article_ids_inview")).alias("inview")]
    if labeled:
        cols.append(ids_to_string(F.col("article_ids_clicked")).alias("clicked"))
    return spark.read.parquet(*_as_list(paths)).select(*cols)


def scan_many(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Files of one schema as one frame, `source_rank` giving the position of the path in the list."""
    if not paths:
        raise ValueError("no paths given")
    frames = [spark.read.parquet(p).withColumn("source_rank", F.lit(i)) for i, p in enumerate(paths)]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def dataset_of(path: Column, level: int = 1) -> Column:
    """Folder name `level` steps above the file."""
    return F.element_at(F.split(path, "/"), -1 - level)


def read_all_datasets(spark: SparkSession, pattern: str, kind: str, file_name: str, level: int = 1) -> DataFrame:
    """One read over all dataset folders that match `pattern`, nested copies of the folder included.

    `kind` is news, behaviors or parquet. The dataset column is the folder `level` steps above the file.
    """
    options = {"pathGlobFilter": file_name, "recursiveFileLookup": "true"}
    schemas = {"news": NEWS_SCHEMA, "behaviors": BEHAVIORS_SCHEMA}
    if kind in schemas:
        raw = (spark.read.schema(schemas[kind]).options(sep="\t", quote="", escape="", **options).csv(pattern))
    elif kind == "parquet":
        raw = spark.read.options(**options).parquet(pattern)
    else:
        raise ValueError(f"unknown kind: {kind}")
    return raw.select("*", dataset_of(F.col("_metadata.file_path"), level).alias("dataset"))


def with_row_id(df: DataFrame) -> DataFrame:
    """A unique `row_id` per input row, so that repeated impression ids stay apart.

    Apply it on a frame fresh from a scan: there the number depends on file layout alone, and a
    re-run task gives the same one.
    """
    return df.withColumn("row_id", F.monotonically_increasing_id())


def unlabeled_from_behaviors(raw: DataFrame) -> DataFrame:
    """TSV behaviors to (impression_id, user_id, history, candidates)."""
    return raw.select("impression_id", "user_id", parse_history(F.col("history")).alias("history"),
                      parse_candidates(F.col("impressions")).alias("candidates"))


def unlabeled_from_inview(behaviors: DataFrame) -> DataFrame:
    """Parquet behaviors to the same shape; the history comes from another table, so it is null here."""
    return behaviors.select("impression_id", "user_id", F.lit(None).cast("array<string>").alias("history"),
                            F.col("inview").alias("candidates"))


def read_test_impressions(spark: SparkSession, tsv_path: str | None = None,
                          parquet_path: str | None = None) -> DataFrame:
    """Unlabeled impressions of one or both formats in one shape."""
    frames = []
    if tsv_path:
        frames.append(unlabeled_from_behaviors(read_behaviors_tsv(spark, tsv_path)))
    if parquet_path:
        frames.append(unlabeled_from_inview(read_behaviors_parquet(spark, parquet_path, labeled=False)))
    if not frames:
        raise ValueError("no test file given")
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return with_row_id(out)


def history_for_test(test_history: DataFrame | None, store_users: DataFrame, per_user: bool = False) -> DataFrame:
    """Test-time histories, else the stored users; with `per_user` the choice is made for each user."""
    if test_history is None:
        return store_users.select("user_id", "history")
    if not per_user:
        return test_history.select("user_id", "history")
    stored = store_users.select("user_id", F.col("history").alias("stored"))
    return (
        test_history.select("user_id", "history").join(stored, "user_id", "full")
        .select("user_id", F.coalesce("history", "stored").alias("history"))
    )


def profile_files(df: DataFrame) -> DataFrame:
    """Rows, columns and bytes of each file behind a file-based frame."""
    return (
        df.select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size"))
        .groupBy("file_path")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.max("file_size").alias("n_bytes"))
        .withColumn("n_columns", F.lit(len(df.columns)).cast("bigint"))
    )


STORE_TABLES = ("articles", "users", "impressions", "vectors", "postings", "docs", "stats")


def load_store(spark: SparkSession, root: str, dataset: str, tables: tuple[str, ...] = STORE_TABLES) -> dict[str, DataFrame]:
    """Tables of one dataset in the feature store; the dataset filter prunes partitions."""
    return {t: spark.read.parquet(f"{root}/{t}").where(F.col("dataset") == dataset).drop("dataset") for t in tables}


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The table that `write_bucketed` left at `path`; declared to the catalog if this session doesn't know it yet."""
    table = bucket_table(path)
    if not spark.catalog.tableExists(table):
        key, buckets = path.rsplit("_by_", 1)[1].rsplit("_", 1)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    return spark.table(table)


def _as_list(paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)
