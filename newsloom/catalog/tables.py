"""The driver's tables as news data: articles, vectors, raw click log, impressions and users.

Everything is computed inside the row it comes from, so no table here needs a shuffle except `users`.

Every event is one impression of ten candidates; clicks and purchases have a clicked one. Its payload number k
(0..99) and its user pick candidates and an inline history from a catalog whose size follows the
embeddings table: item m (0..99) of a user is article (m + 1) * step + user_id % step, where step is
one hundredth of the number of embeddings. Item 99 lies past the embeddings, which gives candidates
without a vector. The table of documents may or may not hold the article.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators.unify import first_history

CLICKED = ("click", "purchase")  # Fixed values: event types whose impression has a click.


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def articles(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as articles: first line as title, the whole rest as abstract, language as category."""
    lines = F.split("text", "\n", 2)
    rest = F.coalesce(F.get(lines, F.lit(1)), F.lit(""))
    return table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("article_id"), F.get(lines, F.lit(0)).alias("title"),
        rest.alias("abstract"), F.lit("").alias("body"), F.col("lang").alias("category"))


def news(spark: SparkSession, sf: str) -> DataFrame:
    """Documents in the eight-column raw news shape; tabs and line ends become spaces."""
    flat = F.regexp_replace("text", "[\\t\\r\\n]", " ")
    entities = F.format_string('[{"Label":"%s","Type":"S","WikidataId":"Q%s","Confidence":0.5,"OccurrenceOffsets":[0],'
                               '"SurfaceForms":["%s"]},{"Label":"l","Type":"L","WikidataId":"Q%s","Confidence":1.0}]',
                               "source", F.length("source"), "source", F.col("doc_id") % 7)
    return table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("article_id"), F.col("lang").alias("category"),
        F.col("source").alias("subcategory"), flat.alias("title"),
        F.when(F.col("n_chars") % 2 == 0, F.col("source")).alias("abstract"),
        F.concat(F.lit("http://news.example/"), "doc_id").alias("url"),
        entities.alias("title_entities"), F.lit(None).cast("string").alias("abstract_entities"))


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("article_id"), "embedding")


def events(spark: SparkSession, sf: str) -> DataFrame:
    """Impression events with the payload number k and the catalog step."""
    step = table(spark, sf, "embeddings").agg(F.floor(F.count(F.lit(1)) / 100).alias("step")).scalar()
    return table(spark, sf, "events").select(
        "event_id", "user_id", "ts", "event_type", F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        step.alias("step"))


def _article(m: Column) -> Column:
    return ((m + 1) * F.col("step") + F.col("user_id") % F.col("step")).cast("string")


def _candidate(j: Column) -> Column:
    shift = (j - F.col("event_id") % 10) * (7 + 10 * (F.col("event_id") % 9))
    return _article((F.col("k") + 1000 + shift) % 100)


def _is_click(j: Column) -> Column:
    return F.col("event_type").isin(*CLICKED) & (j == F.col("event_id") % 10)


def _inview() -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(9)), _candidate)


def _clicked() -> Column:
    return F.when(F.col("event_type").isin(*CLICKED), F.array(_candidate(F.col("event_id") % 10))).otherwise(
        F.array().cast("array<string>"))


def _history() -> Column:
    """k % 16 items; every fifth event repeats one item."""
    items = F.transform(F.sequence(F.lit(1), F.lit(15)),
                        lambda i: _article((F.col("k") + 3 + (i - 1) * (F.col("event_id") % 5)) % 100))
    return F.slice(items, F.lit(1), (F.col("k") % 16).cast("int"))


def impressions(spark: SparkSession, sf: str) -> DataFrame:
    """The unified impressions."""
    return events(spark, sf).select(
        F.col("event_id").cast("string").alias("impression_id"), F.col("user_id").cast("string").alias("user_id"),
        F.col("ts").alias("time"), _clicked().alias("clicked_articles"),
        F.array_except(_inview(), _clicked()).alias("unclicked_articles"))


def behaviors(spark: SparkSession, sf: str) -> DataFrame:
    """Raw behaviors strings: both time formats, some unreadable times, null histories."""
    item = F.transform(F.sequence(F.lit(0), F.lit(9)),
                       lambda j: F.concat(_candidate(j), F.when(_is_click(j), "-1").otherwise("-0")))
    time = (F.when(F.col("k") == 50, "n/a").when(F.col("k") % 2 == 0, F.date_format("ts", "M/d/yyyy h:mm:ss a"))
            .otherwise(F.date_format("ts", "M/d/yyyy H:mm:ss")))
    history = F.when(F.size(_history()) > 0, F.array_join(_history(), " "))
    return events(spark, sf).select(
        F.col("event_id").cast("string").alias("impression_id"), F.col("user_id").cast("string").alias("user_id"),
        time.alias("time"), history.alias("history"), F.array_join(item, " ").alias("impressions"))


def users(spark: SparkSession, sf: str) -> DataFrame:
    """Per user the inline history of the first event."""
    rows = events(spark, sf).select(
        F.col("user_id").cast("string").alias("user_id"), F.col("ts").alias("time"),
        F.col("event_id").alias("impression_id"), F.array_join(_history(), " ").alias("history"))
    return first_history(rows)


def inview_log(spark: SparkSession, sf: str) -> DataFrame:
    """The click log in its Parquet shape: in-view and clicked integer lists with reading measures."""
    as_int = "array<int>"
    return events(spark, sf).select(
        F.col("event_id").alias("impression_id"), F.col("user_id"), F.col("ts").alias("impression_time"),
        _inview().cast(as_int).alias("article_ids_inview"), _clicked().cast(as_int).alias("article_ids_clicked"),
        F.when(F.size(_clicked()) > 0, F.get(_clicked(), F.lit(0)).cast("int")).alias("article_id"),
        F.col("k").cast("double").alias("read_time"),
        F.when(F.col("k") % 3 > 0, (F.col("k") * 7 % 101).cast("double")).alias("scroll_percentage"),
        (F.col("k") % 3).cast("tinyint").alias("device_type"), (F.col("k") % 4 == 0).alias("is_sso_user"),
        F.when(F.col("k") % 5 > 0, F.col("k") % 2 == 0).alias("is_subscriber"),
        F.when(F.col("k") % 33 == 0, (F.col("k") % 2).cast("tinyint")).alias("gender"),
        (F.col("user_id") * 1000 + F.col("k") % 7).alias("session_id"))


def history_log(spark: SparkSession, sf: str) -> DataFrame:
    """Reading histories as parallel lists, one row per event; the click times run backwards hour by hour
    from a day after the event, so that some lie in its future."""
    size = (F.col("k") % 16).cast("int")
    numbers = F.slice(F.sequence(F.lit(1), F.lit(15)), F.lit(1), size)
    hour = F.make_dt_interval(F.lit(0), F.lit(1))
    return events(spark, sf).select(
        "event_id", "user_id", F.col("ts").alias("impression_time"),
        F.transform(numbers, lambda i: F.col("ts") + hour * (3 - i * 2)).alias("impression_time_fixed"),
        F.transform(numbers, lambda i: (i * 7 % 101).cast("double")).alias("scroll_percentage_fixed"),
        _history().cast("array<int>").alias("article_id_fixed"),
        F.transform(numbers, lambda i: (F.col("k") + i).cast("double")).alias("read_time_fixed"))


def published(spark: SparkSession, sf: str) -> DataFrame:
    """Articles with a publishing time: hour n of the log for a text of n characters, over 30 days."""
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("article_id"),
        (start + F.make_dt_interval(F.lit(0), (F.col("n_chars") % 720).cast("int"))).alias("published_time"))
