"""Article vectors, pooled user vectors and cosine scores."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import Normalizer
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import full_text, tokenize
from newsloom.functions.vectors import from_ml_vector, l2_normalized, to_ml_vector, unit_dot
from newsloom.operators.lexical import TEXT_COLS, counted_words
from newsloom.operators.skew import skew_join
from newsloom.operators.unify import history_rows, one_per_id
from newsloom.session import stage

UNKNOWN_SCORE = -999.0  # Fixed value: score of a candidate without a vector in prediction files.


def l2_normalize(vectors: DataFrame, col: str = "embedding") -> DataFrame:
    """Vectors scaled to unit length; a zero vector stays zero."""
    return vectors.withColumn(col, l2_normalized(F.col(col)))


def known_history(users: DataFrame, vectors: DataFrame) -> DataFrame:
    """(user_id, article_id, n): history entries that have a vector, with their repeat count."""
    counted = history_rows(users).groupBy("user_id", "article_id").agg(F.count(F.lit(1)).alias("n"))
    return skew_join(counted, vectors.select("article_id"), ["article_id"], "left_semi", spread=["user_id"])


def mean_vectors(rows: DataFrame, key: str, vector: str = "embedding", weight: str | None = None) -> DataFrame:
    """Element-wise (weighted) mean of an array column per key, combined map-side."""
    ml = rows.select(key, to_ml_vector(F.col(vector)).alias("v"), *([weight] if weight else []))
    mean = Summarizer.mean(F.col("v"), F.col(weight)) if weight else Summarizer.mean(F.col("v"))
    return ml.groupBy(key).agg(mean.alias("m")).select(key, from_ml_vector(F.col("m")).alias(vector))


def user_vectors(users: DataFrame, vectors: DataFrame) -> DataFrame:
    """(user_id, user_vector): unit mean of the normalized vectors of known history entries.

    Repeats count as often as they occur, through a weight rather than through repeated rows. Users
    without a known entry have no row; their scores are 0.0.
    """
    counted = history_rows(users).groupBy("user_id", "article_id").agg(F.count(F.lit(1)).alias("n"))
    rows = skew_join(counted, one_per_id(vectors, "embedding"), ["article_id"])
    unit = Normalizer(inputCol="raw", outputCol="v", p=2.0)
    ready = unit.transform(rows.select("user_id", F.col("n").cast("double").alias("n"),
                                       to_ml_vector(F.col("embedding")).alias("raw")))
    pooled = ready.groupBy("user_id").agg(Summarizer.mean(F.col("v"), F.col("n")).alias("m"))
    final = Normalizer(inputCol="m", outputCol="u", p=2.0).transform(pooled)
    return final.select("user_id", from_ml_vector(F.col("u")).alias("user_vector"))


def all_user_vectors(users: DataFrame, vectors: DataFrame, dims: int) -> DataFrame:
    """Vectors of all users, zeros where no history entry is known."""
    zeros = F.array_repeat(F.lit(0.0), dims)
    return users.select("user_id").join(user_vectors(users, vectors), "user_id", "left").select(
        "user_id", F.coalesce("user_vector", zeros).alias("user_vector"))


def attach_vectors(rows: DataFrame, vectors: DataFrame, unknown: str = "null") -> DataFrame:
    """Rows with the embedding of their article, the last one where ids repeat. `unknown`: null keeps rows without one, drop removes them."""
    how = {"null": "left", "drop": "inner"}[unknown]
    return skew_join(rows, one_per_id(vectors, "embedding"), ["article_id"], how)


def semantic_score(pairs: DataFrame, user_vecs: DataFrame, vectors: DataFrame, unknown: str = "null",
                   name: str = "score") -> DataFrame:
    """Cosine of user and article vector per pair, other pair columns kept.

    A user without a vector scores 0.0 everywhere. Candidates without a vector, by `unknown`: drop
    removes the pair, null gives a null score, last gives the fixed low score if the user has a vector.
    Pairs meet the narrower float article vectors first; user vectors come to them in a second shuffle.
    """
    if unknown not in ("drop", "null", "last"):
        raise ValueError(f"unknown policy: {unknown}")
    with_article = attach_vectors(pairs, vectors, "drop" if unknown == "drop" else "null")
    both = skew_join(with_article, user_vecs, ["user_id"], "left")
    dot = F.round(unit_dot(F.col("user_vector"), F.col("embedding")), 9)
    missing = {"null": F.lit(None).cast("double"), "drop": F.lit(None).cast("double"),
               "last": F.when(F.col("user_vector").isNull(), 0.0).otherwise(UNKNOWN_SCORE)}[unknown]
    score = F.when(F.col("embedding").isNull(), missing).when(F.col("user_vector").isNull(), 0.0).otherwise(dot)
    return both.select(*pairs.columns, score.alias(name))


def term_code(term: Column) -> Column:
    """A number from the first 32 bits of the word's md5."""
    return F.conv(F.substring(F.md5(term.cast("binary")), 1, 8), 16, 10).cast("bigint")


def dense(by_dim: str, dims: int) -> Column:
    """The array of a map from axis to value, 0.0 where an axis is absent."""
    return F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda d: F.coalesce(F.element_at(by_dim, d), F.lit(0.0)))


def _hashed_in_rows(articles: DataFrame, dims: int, text_cols: tuple[str, ...]) -> DataFrame:
    """`hash_encoder_vectors` of unique articles: tokens are counted per axis and sign inside the row, as runs of their sorted cells.

    The counts pass a generator, below which no filter of a reader is pushed; there it would build them again for each axis.
    """
    code = F.transform(tokenize(full_text(*text_cols)), term_code)
    cells = articles.select("article_id", F.array_sort(F.transform(code, lambda c: (c % dims) * 2 + F.floor(c / dims) % 2)).alias("cells"))
    starts = F.filter(F.transform("cells", lambda c, i: i), lambda i: (i == 0) | (F.get("cells", i) != F.get("cells", i - 1)))
    runs = cells.withColumn("first", starts)
    counts = F.transform("first", lambda at, i: F.struct(
        F.get("cells", at), (F.coalesce(F.get("first", i + 1), F.size("cells")) - at).cast("double")))
    found = runs.select("article_id", F.explode_outer(F.array(F.map_from_entries(counts))).alias("n"))
    values = F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda d: F.coalesce(F.element_at("n", d.cast("bigint") * 2), F.lit(0.0))
                         - F.coalesce(F.element_at("n", d.cast("bigint") * 2 + 1), F.lit(0.0)))
    return found.select("article_id", values.cast("array<float>").alias("embedding"))


def hash_encoder_vectors(articles: DataFrame, dims: int = 64, text_cols: tuple[str, ...] = TEXT_COLS, unique: bool = False) -> DataFrame:
    """Text vectors by signed feature hashing of tokens, for use without a model.

    Texts are spread by article once; counting per article and axis and gathering at most `dims` values per article
    fit that partitioning. Of repeated article ids the last row counts; with `unique` no id repeats, and nothing is shuffled.
    """
    if unique:
        return _hashed_in_rows(articles, dims, text_cols)
    tokens = one_per_id(articles, *text_cols).select("article_id", F.explode_outer(tokenize(full_text(*text_cols))).alias("term"))
    code = term_code(F.col("term"))
    cells = (
        tokens.select("article_id", (code % dims).cast("int").alias("dim"),
                      F.when((code / dims).cast("bigint") % 2 == 0, 1).otherwise(-1).alias("sign"))
        .groupBy("article_id", "dim").agg(F.sum("sign").cast("double").alias("value"))
    )
    packed = cells.groupBy("article_id").agg(F.map_from_entries(F.collect_list(
        F.when(F.col("dim").isNotNull(), F.struct("dim", "value")))).alias("by_dim"))
    return packed.select("article_id", dense("by_dim", dims).cast("array<float>").alias("embedding"))


def embed_articles(articles: DataFrame, make_encoder: Callable[[], Callable[[list[str]], np.ndarray]],
                   batch: int = 32, text_cols: tuple[str, ...] = TEXT_COLS) -> DataFrame:
    """(article_id, embedding) from any text encoder.

    `make_encoder` runs once per task and returns a function from a list of texts to a matrix; texts
    reach it in lists of at most `batch`.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = make_encoder()
        for frame in frames:
            for start in range(0, len(frame), batch):
                part = frame.iloc[start:start + batch]
                rows = np.asarray(encode(part["text"].tolist()), dtype="float32")
                yield pd.DataFrame({"article_id": part["article_id"].to_numpy(), "embedding": list(rows)})

    texts = articles.select("article_id", full_text(*text_cols).alias("text"))
    return texts.mapInPandas(run, "article_id string, embedding array<float>")


def _words(block: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(row of the block, tf, number of the word, distinct words) per word of the articles of a block."""
    words = pc.split_pattern(block["terms"].combine_chunks(), "\t")
    row = np.repeat(np.arange(block.num_rows), pc.list_value_length(words).to_numpy())
    coded = words.flatten().dictionary_encode()
    return row, block["tfs"].combine_chunks().flatten().to_numpy().astype(float), coded.indices.to_numpy(), coded.dictionary


def _sums(at: np.ndarray, tf: np.ndarray, vectors: np.ndarray, source: np.ndarray, n: int) -> np.ndarray:
    """Sums of tf times the source row of `vectors` into n places, one axis at a time."""
    return np.column_stack([np.bincount(at, tf * axis[source], n) for axis in vectors.T])


def _nested(matrix: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]), pa.array(matrix.ravel()))


def word_vectors(articles: DataFrame, terms: DataFrame | None = None, dims: int = 32, text_cols: tuple[str, ...] = TEXT_COLS,
                 block_rows: int = 1 << 20) -> DataFrame:
    """Article vectors as means of word vectors, by random indexing.

    Every word has a fixed random direction: one of `dims` axes and a sign, both from its hash. A word's vector is the sum of
    the directions of all words of the articles it occurs in, as often as they occur together; an article's vector is
    the mean over its words. Articles, one row each, are dealt into blocks of about `block_rows` term counts. A block adds up the
    vectors of its own words, these sums meet by word, and each block gets the vectors of its words back: a vector is shuffled
    once per block and word, not once per article and word, and a frequent word has no more rows than there are blocks. Every word
    counts. `terms` are the term counts of the articles, if known. Articles without a word have a zero vector.
    """
    if terms is None:
        packed = counted_words(one_per_id(articles, *text_cols), text_cols)
    else:
        packed = terms.groupBy("article_id").agg(F.collect_list(F.struct("term", "tf")).alias("counts"))
    packed = stage(packed.where("article_id is not null").select(
        "article_id", F.array_join("counts.term", "\t").alias("terms"), F.col("counts.tf").cast("array<int>").alias("tfs")), "word-counts")
    blocks = -(-(packed.agg(F.sum(F.size("tfs"))).first()[0] or 1) // block_rows)
    dealt = packed.select(F.pmod(F.xxhash64("article_id"), F.lit(blocks)).cast("int").alias("block"), "article_id", "terms", "tfs").repartition(blocks, "block")

    def add_up(block: pa.Table) -> pa.Table:
        row, tf, word, words = _words(block)
        codes = [int(hashlib.md5(w.encode()).hexdigest()[:8], 16) for w in words.to_pylist()]
        axis, sign = np.array([c % dims for c in codes]), np.array([1.0 if c // dims % 2 == 0 else -1.0 for c in codes])
        sketch = np.bincount(row * dims + axis[word], tf * sign[word], block.num_rows * dims).reshape(-1, dims)
        sums = _sums(word, tf, sketch, row, len(words))
        return pa.table({"block": pa.array([block["block"][0].as_py()] * len(words), pa.int32()), "term": words, "v": _nested(sums)})

    def average(block: pa.Table, known: pa.Table) -> pa.Table:
        row, tf, word, words = _words(block)
        vectors = known["v"].combine_chunks().flatten().to_numpy().reshape(-1, dims)
        at = pc.index_in(words, value_set=known["term"].combine_chunks()).to_numpy()
        sums = _sums(row, tf, vectors, at[word], block.num_rows) / np.bincount(row, tf, block.num_rows)[:, None]
        return pa.table({"article_id": block["article_id"], "m": _nested(sums)})

    own = stage(dealt.groupBy("block").applyInArrow(add_up, "block int, term string, v array<double>"), "block-words")
    sums = own.groupBy("term").agg(*[F.sum(F.get("v", F.lit(d))).alias(f"v{d}") for d in range(dims)])
    back = own.select("block", "term").join(sums, "term").select("block", "term", F.array(*[f"v{d}" for d in range(dims)]).alias("v"))
    means = dealt.groupBy("block").cogroup(back.repartition(blocks, "block").groupBy("block")).applyInArrow(average, "article_id string, m array<double>")
    zeros = F.array_repeat(F.lit(0.0), dims)
    return articles.select("article_id").distinct().join(means, "article_id", "left").select(
        "article_id", F.coalesce("m", zeros).alias("embedding"))
