"""A training corpus from `documents`: known language, no copies, no near copies, no benchmark passages, mixed by source.

Each stage reads what its predecessor kept, and all but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import decontaminate, exact, jaccard, language, mixing
from newsloom.llm.common import held_out
from newsloom.llm.queries import TARGETS
from newsloom.session import ship_package, stage


#: Least share of trigrams that the best language must explain, and the length of text from which more is asked.
LOOSE, LONG = 0.2, 40


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter and those of which the best language explains too few trigrams.

    The cut of texts of 40 characters or more lies halfway between a fifth and what all but a hundredth of the labelled
    rows kept out of training reach when their label agrees; shorter ones need a fifth. Null and empty texts go; without any
    label all texts go. Rows are judged one by one, so repeated rows fare alike; very long texts are judged whole, and
    columns of any other name are passed on as they are.
    """
    ship_package(spark)
    apart = held_out(F.col("doc_id"), 4)
    model = language.train(docs.where(~apart))
    cut = language.calibrated(docs.where(apart), model, LOOSE, LONG)
    return language.known(docs, model, cut, LOOSE, LONG)


def no_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal without white space, the longest and then first stays.

    Null counts as empty, so all null and empty texts are one group. Of rows that agree in id too, one stays. Texts are
    compared whole; further columns come with the row that stays.
    """
    ship_package(spark)
    return exact.without_copies(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a Jaccard similarity of 0.8 over five-word shingles, the document of smallest id stays.

    Null and empty texts link with nothing and stay; a null id counts as the smallest; rows with equal id and text stay or
    go together. Whole texts are compared; further columns come with the row that stays.
    """
    ship_package(spark)
    return jaccard.one_of_each(docs, n=5, percent=80)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, up to a fifth of its words edited, go.

    Null and empty texts stay, repeated rows fare alike, very long texts are searched whole; an empty benchmark removes
    nothing. All columns are passed on.
    """
    ship_package(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their place in the mixed corpus.

    Null is a source of its own, null and empty texts have a place, rows that agree in id, source and text stand next to each
    other, and a text longer than a block covers several. Only columns named like the three new ones are replaced.
    """
    ship_package(spark)
    return mixing.mix(docs, TARGETS)


STAGES = [
    ("language", known_language),
    ("exact_dedup", no_copies),
    ("jaccard_join", no_near_copies),
    ("decontamination", no_benchmark),
    ("mixing", mixed),
]

#: Mixture inference, edit matching and scheduling have no SQL; the tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
