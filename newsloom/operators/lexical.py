"""BM25 index, history queries and lexical scores."""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import full_text, tokenize
from newsloom.functions.vectors import ranges
from newsloom.operators.skew import hot_keys, skew_join
from newsloom.operators.unify import history_rows, one_per_id
from newsloom.session import stage

TEXT_COLS = ("title", "abstract")


@dataclass(frozen=True)
class LexicalIndex:
    """stats (n, avgdl, k1, b), docs (article_id, dl), postings (term, article_id, tf, dl, df, idf, weight).

    `clustered`: postings come in ranges of terms, sorted by term and article in each, and are not stored yet.
    """

    stats: DataFrame
    docs: DataFrame
    postings: DataFrame
    clustered: bool = False


def history_text(users: DataFrame, articles: DataFrame, text_cols: tuple[str, ...] = TEXT_COLS) -> DataFrame:
    """(user_id, article_id, text) for the distinct history entries that are in the catalog."""
    seen = history_rows(users).select("user_id", "article_id").distinct()
    texts = one_per_id(articles, *text_cols).select("article_id", full_text(*text_cols).alias("text"))
    return skew_join(seen, texts, ["article_id"])


def doc_lengths(articles: DataFrame, terms: DataFrame) -> DataFrame:
    """(article_id, dl) from the term counts, which carry it; articles without a token count with length 0."""
    known = terms.groupBy("article_id").agg(F.max("dl").alias("dl"))
    return articles.select("article_id").distinct().join(known, "article_id", "left").withColumn("dl", F.coalesce("dl", F.lit(0).cast("long")))


def counted_words(articles: DataFrame, text_cols: tuple[str, ...] = TEXT_COLS, unique: bool = False) -> DataFrame:
    """(article_id, dl, counts): one row per article with its distinct words as an array of (term, tf).

    The texts of an article meet before they are cut into words, which is the only shuffle (none where the articles come
    grouped by id, or are `unique`), and words are counted inside the row: a task holds one article's words at a time and no
    table of counts. Texts of the same article with equally many words count as one.
    """
    texts = articles.select("article_id", full_text(*text_cols).alias("text"))
    texts = texts.select("article_id", F.array("text").alias("texts")) if unique else texts.groupBy("article_id").agg(F.collect_list("text").alias("texts"))
    cut = texts.select("article_id", F.transform("texts", tokenize).alias("cut"))
    lengths = cut.select("article_id", "cut", F.explode(F.array_distinct(F.transform("cut", F.size))).alias("dl")).where("dl > 0")
    words = lengths.select("article_id", F.col("dl").cast("bigint").alias("dl"), F.sort_array(
        F.flatten(F.filter("cut", lambda x: F.size(x) == F.col("dl")))).alias("words"))
    first = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: (i == 0) | (F.get("words", i) != F.get("words", i - 1)))
    runs = words.withColumn("first", first)
    counts = F.transform("first", lambda at, i: F.struct(
        F.get("words", at).alias("term"), (F.coalesce(F.get("first", i + 1), F.size("words")) - at).cast("bigint").alias("tf")))
    return runs.select("article_id", "dl", counts.alias("counts"))


def term_freq(articles: DataFrame, text_cols: tuple[str, ...] = TEXT_COLS, unique: bool = False) -> DataFrame:
    """(article_id, dl, term, tf), the rows of `counted_words`. The length comes along from the row, so it costs no join.

    No article of `counted_words` is without words, so the outer form gives the same rows. The inner form makes Spark filter on
    the size of `counts` below the projections, where the sorted words are built again for each word.
    """
    return counted_words(articles, text_cols, unique).select("article_id", "dl", F.inline_outer("counts"))


def doc_freq(terms: DataFrame) -> DataFrame:
    """(term, df) from (article_id, term) rows."""
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def corpus_stats(articles: DataFrame, terms: DataFrame, k1: float = 1.5, b: float = 0.75) -> DataFrame:
    """One row (n, avgdl, k1, b). Empty articles count in n; token totals reuse the term counts."""
    total = terms.agg(F.coalesce(F.sum("tf"), F.lit(0)).alias("t")).scalar()
    n = F.countDistinct("article_id")
    return articles.agg(n.alias("n"), F.when(n > 0, total / n).otherwise(F.lit(0.0)).alias("avgdl")).select(
        "n", "avgdl", F.lit(float(k1)).alias("k1"), F.lit(float(b)).alias("b"))


def idf(df, n):
    """BM25 inverse document frequency, always positive."""
    return F.log1p((n - df + F.lit(0.5)) / (df + F.lit(0.5)))


def bm25_weight(tf, dl, idf_col, avgdl, k1: float, b: float):
    """Contribution of one matching term to a document's score."""
    return idf_col * tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / avgdl))


def weighted_postings(terms: DataFrame, dfs: DataFrame, stats: DataFrame, hot, k1: float, b: float) -> DataFrame:
    """Term counts per article with document frequency, idf and BM25 weight; `hot` spreads the terms that most articles have.

    Term counts are many times larger in memory than in files, so they are neither broadcast nor sorted: they stream past a
    hash table of the terms of their partition.
    """
    n, avgdl = stats.select("n").scalar(), stats.select("avgdl").scalar()
    joined = skew_join(terms, dfs.withColumn("idf", idf(F.col("df"), n)), ["term"], hot=hot, spread=["article_id"], hint="shuffle_hash")
    return joined.select(
        "term", "article_id", "tf", "dl", "df", "idf",
        bm25_weight(F.col("tf"), F.col("dl"), F.col("idf"), avgdl, k1, b).alias("weight"))


def term_ranges(counted: DataFrame, range_rows: int, per_range: int = 64) -> tuple[list[str], dict[str, tuple[int, int]]]:
    """(bounds, hot): terms that cut the sorted postings into ranges of about `range_rows`, and the terms that have more
    rows alone, with their df and the number of slices they are cut into.

    Bounds and candidates come from about `per_range` terms per range, and the counts of candidates from all rows. A
    rare bad draw makes a range larger; what stands in the ranges does not depend on it.
    """
    total = counted.agg(F.sum(F.size("counts"))).first()[0] or 0
    if total <= range_rows:
        return [], {}
    words = counted.select(F.explode("counts.term").alias("term"))
    drawn = sorted(r.term for r in words.sample(min(1.0, per_range / range_rows), seed=7).collect())
    often = [w for w, n in Counter(drawn).items() if n >= per_range // 2]
    dfs = doc_freq(words.where(F.col("term").isin(often))).where(F.col("df") > range_rows).collect() if often else []
    hot = {r.term: (r.df, -(-r.df // range_rows)) for r in dfs}
    return sorted({w for w in [w for w in drawn if w not in hot][per_range::per_range]}), hot


def clustered_postings(counted: DataFrame, stats: DataFrame, k1: float, b: float, range_rows: int = 1 << 20) -> DataFrame:
    """The rows of `weighted_postings`, in ranges of terms that are sorted by term and article.

    One shuffle deals the term counts to ranges, in Parquet blocks of many articles, and a range holds all rows of its
    terms, so their document frequencies are counted there. A hot term is cut by article into ranges of its own.
    """
    bounds, hot = term_ranges(counted, range_rows)
    slices = [n for _, n in hot.values()]
    first_hot = dict(zip(hot, accumulate([len(bounds) + 1, *slices])))
    block = pa.schema([("term", pa.string()), ("article_id", pa.string()), ("tf", pa.int64()), ("dl", pa.int64())])
    block_rows = 1 << 21

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.list_value_length(batch["counts"]).to_numpy(zero_copy_only=False)
            pieces = (np.cumsum(sizes) - 1) // block_rows
            for piece in np.unique(pieces):
                at = np.flatnonzero(pieces == piece)
                part, flat = batch.slice(at[0], len(at)), batch["counts"].slice(at[0], len(at)).flatten()
                row, codes = np.repeat(np.arange(len(at)), sizes[at]), flat.field("term").dictionary_encode()
                words = codes.dictionary.to_pylist()
                number = np.array([first_hot[w] if w in hot else bisect_right(bounds, w) for w in words])
                n_slices = np.array([hot[w][1] if w in hot else 1 for w in words])
                rank = np.empty(len(words), int)
                rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
                code = codes.indices.to_numpy()
                dealt = number[code] + part["spread"].to_numpy()[row] % n_slices[code]
                order = np.lexsort((rank[code], dealt))
                rows = pa.table({"term": flat.field("term"), "article_id": part["article_id"].take(pa.array(row)),
                                 "tf": flat.field("tf"), "dl": part["dl"].take(pa.array(row))}, schema=block).take(pa.array(order))
                starts = np.flatnonzero(np.diff(dealt[order], prepend=-1))
                packed = []
                for start, end in zip(starts, [*starts[1:], len(order)]):
                    out = pa.BufferOutputStream()
                    pq.write_table(rows.slice(start, end - start), out, compression="zstd", use_dictionary=["term", "tf", "dl"],
                                   column_encoding={"article_id": "DELTA_BYTE_ARRAY"}, write_statistics=False, store_schema=False)
                    packed.append(out.getvalue().to_pybytes())
                yield pa.RecordBatch.from_pydict({"range": pa.array(dealt[order][starts], pa.int32()), "block": pa.array(packed, pa.binary())})

    def settle(blocks: pa.Table) -> pa.Table:
        rows = pa.concat_tables(pq.read_table(pa.BufferReader(x.as_buffer())) for x in blocks["block"])
        rows = rows.take(pc.sort_indices(rows, [("term", "ascending"), ("article_id", "ascending")], null_placement="at_start"))
        codes = rows["term"].combine_chunks().dictionary_encode()
        own = np.bincount(codes.indices.to_numpy(), minlength=len(codes.dictionary))
        dfs = np.array([hot[w][0] if w in hot else n for w, n in zip(codes.dictionary.to_pylist(), own)], dtype=np.int64)
        return rows.append_column("df", pa.array(dfs[codes.indices.to_numpy()]))

    spread = F.abs(F.hash("article_id").cast("bigint"))
    dealt = counted.select("article_id", "dl", "counts", spread.alias("spread")).mapInArrow(deal, "range int, block binary")
    n_ranges = len(bounds) + 1 + sum(slices)
    rows = dealt.repartitionById(n_ranges, F.col("range")).groupBy("range").applyInArrow(settle, "term string, article_id string, tf long, dl long, df long")
    n, avgdl = stats.select("n").scalar(), stats.select("avgdl").scalar()
    return rows.withColumn("idf", idf(F.col("df"), n)).withColumn(
        "weight", bm25_weight(F.col("tf"), F.col("dl"), F.col("idf"), avgdl, k1, b))


def build_bm25_index(articles: DataFrame, text_cols: tuple[str, ...] = TEXT_COLS, k1: float = 1.5, b: float = 0.75,
                     staged: bool = True, unique: bool = False, clustered: bool = False) -> LexicalIndex:
    """Index tables of the given text columns.

    An index is read by several steps, so `staged` (the default) writes the term counts and then the
    postings to the staging folder: text is tokenized once, and no reader recomputes the index.

    Of repeated article ids the last row counts. Document frequencies are row counts of `terms` per term, so the
    terms that nearly every article has are known before the join and are spread over tasks.

    With `unique` no article id repeats. With `clustered` the term counts alone are staged, and postings are left to their
    one reader, `write_index`, in the order in which it stores them.
    """
    articles = articles if unique else one_per_id(articles, *text_cols)
    if clustered:
        counted = stage(counted_words(articles, text_cols, unique), "terms")
        terms = counted.select("article_id", "dl", F.inline_outer("counts"))
        stats = corpus_stats(articles, terms, k1, b)
        return LexicalIndex(stats, doc_lengths(articles, terms), clustered_postings(counted, stats, k1, b), clustered=True)
    if staged:
        counted = stage(counted_words(articles, text_cols, unique), "terms")
        terms = counted.select("article_id", "dl", F.inline_outer("counts"))
        stats = corpus_stats(articles, terms, k1, b)
        return LexicalIndex(stats, doc_lengths(articles, terms), stage(clustered_postings(counted, stats, k1, b), "postings"))
    terms = term_freq(articles, text_cols, unique)
    stats = corpus_stats(articles, terms, k1, b)
    dfs = doc_freq(terms)
    hot = hot_keys(terms, ["term"], counts=dfs.withColumnRenamed("df", "_n"))
    return LexicalIndex(stats, doc_lengths(articles, terms), weighted_postings(terms, dfs, stats, hot, k1, b))


def recent_history(users: DataFrame, n: int) -> DataFrame:
    """Users with only the last `n` history entries."""
    size = F.size("history")
    return users.withColumn("history", F.slice("history", F.greatest(size - n + 1, F.lit(1)), n))


def history_query(users: DataFrame, postings: DataFrame, recent: int | None = None, by_article: bool = False) -> DataFrame:
    """Distinct (user_id, term, idf) over the texts of each user's history, or of its last `recent` entries.

    History ids are reduced to distinct pairs, which meet one row per article. A user's terms are made distinct inside
    the user's row, and the rows come grouped by user. `by_article` gives the same query in short, as (user_id, articles): the
    scoring functions look its terms up and make them distinct where a user's articles are.
    """
    users = recent_history(users, recent) if recent else users
    seen = history_rows(users).select("user_id", "article_id").distinct()
    if by_article:
        return seen.groupBy("user_id").agg(F.collect_list("article_id").alias("articles"))
    texts = postings.groupBy("article_id").agg(F.sort_array(F.collect_list(F.struct("term", "idf"))).alias("terms"))
    asked = skew_join(seen, texts, ["article_id"]).groupBy("user_id").agg(F.flatten(F.collect_list("terms")).alias("terms"))
    asked = asked.select("user_id", F.sort_array("terms").alias("terms"))
    once = F.filter("terms", lambda x, i: (i == 0) | (x != F.get("terms", i - 1)))
    return asked.select("user_id", F.inline(once))


def article_terms(postings: DataFrame) -> DataFrame:
    """(article_id, dl, terms, tfs, shares, idfs): one row per article, its terms in one text, parted by tabs.

    A share is the weight without the idf. It takes few values inside an article; terms are ordered by it, so that unlike
    the weights the shares shrink well when they are shuffled.
    """
    share = F.when(F.col("idf") != 0, F.col("weight") / F.col("idf")).otherwise(0.0)
    packed = F.sort_array(F.collect_list(F.struct(F.col("tf").cast("int").alias("tf"), share.alias("share"), "term", "idf")))
    rows = postings.groupBy("article_id").agg(F.max("dl").alias("dl"), packed.alias("p"))
    return rows.select("article_id", "dl", F.array_join("p.term", "\t").alias("terms"), F.col("p.tf").alias("tfs"), F.col("p.share").alias("shares"), F.col("p.idf").alias("idfs"))


def _lists(pairs: DataFrame, query: DataFrame, unique: bool, most: int) -> DataFrame:
    """(user_id, articles, asked, words, idfs, sign): a user's articles, `most` to a row, with the user's query by article or by term.

    The sign is the smallest hash of all its articles, so users who have many articles in common often have the same one.
    """
    items = pairs.groupBy("user_id").agg(F.collect_list(F.struct("article_id")).alias("p")).select("user_id", F.col("p.article_id").alias("all"))
    if "articles" in query.columns:
        none = F.array()
        asked = query.select("user_id", F.col("articles").alias("asked"), none.cast("array<string>").alias("words"), none.cast("array<double>").alias("idfs"))
    else:
        asked = query.groupBy("user_id").agg(F.collect_list(F.struct("term", "idf")).alias("q"))
        asked = asked.select("user_id", F.array().cast("array<string>").alias("asked"), F.col("q.term").alias("words"), F.col("q.idf").alias("idfs"))
    rows = items.withColumn("all", F.array_distinct("all")) if unique else items
    cut = F.transform(F.sequence(F.lit(0), F.floor((F.size("all") - 1) / most).cast("int")), lambda i: F.slice("all", i * most + 1, most))
    rows = rows.join(asked, "user_id", "left").withColumn("articles", F.explode(cut)).drop("all")
    both = F.concat("articles", F.coalesce("asked", F.array().cast("array<string>")))
    return stage(rows.withColumn("sign", F.array_min(F.transform(both, lambda x: F.xxhash64(x)))), "lists")


def _in_blocks(pairs: DataFrame, query: DataFrame, postings: DataFrame, kernel: Callable[[pa.Table, pa.Table], Iterator[pa.RecordBatch]], schema: str,
               terms_of: Callable[[DataFrame], DataFrame] = article_terms, unique: bool = False, block_pairs: int = 1 << 15) -> DataFrame:
    """`kernel` over blocks of about `block_pairs` pairs: the users' rows of `_lists`, and one row of `terms_of` for each article in them.

    Users are blocked by their sign, so those with common articles mostly meet and an article is sent once for all of them. A sign with
    more pairs than a block holds is dealt by user. In the worst case, when no users have an article in common, an article is
    sent once per pair. Only postings of articles in some block are gathered.
    """
    lists = _lists(pairs, query, unique, block_pairs)
    sizes = lists.groupBy("sign").agg(F.sum(F.size("articles")).alias("_n"))
    blocks = max(1, -(-(sizes.agg(F.sum("_n")).first()[0] or 0) // block_pairs))
    hot = hot_keys(lists, ["sign"], blocks, sizes).table
    part = F.lit(0)
    if hot is not None:
        lists, part = lists.join(F.broadcast(hot), "sign", "left"), F.pmod(F.xxhash64("user_id", F.get("articles", F.lit(0))), F.coalesce("_slices", F.lit(1)))
    placed = lists.withColumn("block", F.pmod(F.xxhash64("sign", part), F.lit(blocks)).cast("int")).select("block", "user_id", "articles", "asked", "words", "idfs")
    both = F.explode(F.concat("articles", F.coalesce("asked", F.array().cast("array<string>"))))
    needed = stage(placed.select("block", both.alias("article_id")).where("article_id IS NOT NULL").distinct(), "needed")
    texts = terms_of(postings.join(needed.select("article_id"), "article_id", "left_semi"))
    at = skew_join(needed, texts, ["article_id"]).withColumnRenamed("idfs", "term_idfs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches))
        is_text = pc.is_valid(rows["article_id"])
        return kernel(rows.filter(pc.invert(is_text)).combine_chunks(), rows.filter(is_text).combine_chunks())

    rows = placed.unionByName(at, allowMissingColumns=True).repartitionById(blocks, F.col("block"))
    return rows.groupBy("block").applyInArrow(run, schema)


class _Block:
    """The terms of a block's articles as numbers, and the query of each of its users."""

    def __init__(self, people: pa.Table, texts: pa.Table):
        words = pc.split_pattern(self._column(texts, "terms"), "\t")
        coded = words.flatten().dictionary_encode()
        self.words, self.code, self.size = coded.dictionary, coded.indices.to_numpy(), pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.tf, self.share, idf = (self._column(texts, c).flatten().to_numpy() for c in ("tfs", "shares", "term_idfs"))
        self.dl = self._column(texts, "dl").to_numpy()
        self.idf, self.asked_idf = np.zeros(len(self.words)), np.zeros(len(self.words))
        self.idf[self.code] = idf
        self.known = np.zeros(len(self.words), bool)
        ids = self._column(texts, "article_id")
        self.people, self.articles = self._column(people, "user_id"), self._column(people, "articles").flatten()
        self.at, self.cuts = self._numbers(people, "articles", ids)
        self.asked, self.asked_cuts = self._numbers(people, "asked", ids)
        self.word, self.word_cuts = self._numbers(people, "words", self.words)
        self.word_idf = self._column(people, "idfs").flatten().to_numpy()

    @staticmethod
    def _column(table: pa.Table, name: str) -> pa.Array:
        column = table[name].combine_chunks()
        return pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column

    def _numbers(self, people: pa.Table, name: str, known: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(place of each item among the known ones or -1, where each user's items start and end)."""
        column = self._column(people, name)
        at = pc.fill_null(pc.index_in(column.flatten(), value_set=known, skip_nulls=True), -1).to_numpy(zero_copy_only=False)
        return at, np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)))

    def hits(self) -> Iterator[tuple[int, slice, np.ndarray, np.ndarray, np.ndarray, np.ndarray, float]]:
        """Per user (number, place of their articles, and of each hit the article's place, the posting, weight and idf; length of the query)."""
        for i in range(len(self.people)):
            source = self.asked[slice(*self.asked_cuts[i:i + 2])]
            source = source[source >= 0]
            own = slice(*self.word_cuts[i:i + 2])
            asked, idf = self.word[own], self.word_idf[own]
            norm = math.sqrt((idf * idf).sum())
            idf, asked = idf[asked >= 0], asked[asked >= 0]
            if len(source):
                asked = np.unique(self.code[ranges(self.start[source], self.size[source])])
                idf = self.idf[asked]
                norm = math.sqrt((idf * idf).sum())
            self.known[asked], self.asked_idf[asked] = True, idf
            mine = slice(*self.cuts[i:i + 2])
            at = self.at[mine]
            held = np.flatnonzero(at >= 0)
            at = at[held]
            posting, pair = ranges(self.start[at], self.size[at]), np.repeat(held, self.size[at])
            hit = self.known[self.code[posting]]
            posting, pair = posting[hit], pair[hit]
            self.known[asked] = False
            found = self.asked_idf[self.code[posting]]
            yield i, mine, pair, posting, self.share[posting] * found, found, norm


def match_terms(pairs: DataFrame, query: DataFrame, postings: DataFrame) -> DataFrame:
    """(user_id, article_id, term, idf, tf, dl, weight) for the terms a pair shares.

    `query` is a `history_query` of the same index, so both sides know a term by the same idf. Users, their queries and one row
    per article meet in blocks; terms become rows only where a pair has them, and are not shuffled.
    """
    def kernel(people: pa.Table, texts: pa.Table, most: int = 1 << 18) -> Iterator[pa.RecordBatch]:
        block, waiting, n = _Block(people, texts), [], 0

        def rows() -> pa.RecordBatch:
            user, pair, posting, weight, idf = (np.concatenate(x) for x in zip(*waiting))
            at = block.at[pair]
            return pa.RecordBatch.from_pydict({
                "user_id": block.people.take(pa.array(user)), "article_id": block.articles.take(pa.array(pair)), "term": block.words.take(pa.array(block.code[posting])),
                "idf": idf, "tf": block.tf[posting].astype(np.int64), "dl": block.dl[at], "weight": weight})

        for i, mine, pair, posting, weight, idf, _ in block.hits():
            waiting.append((np.full(len(pair), i), pair + mine.start, posting, weight, idf))
            n += len(pair)
            if n >= most:
                yield rows()
                waiting, n = [], 0
        if n:
            yield rows()

    return _in_blocks(pairs, query, postings, kernel, "user_id string, article_id string, term string, idf double, tf long, dl long, weight double")


def pair_sums(pairs: DataFrame, query: DataFrame, postings: DataFrame, terms_of: Callable[[DataFrame], DataFrame] = article_terms) -> DataFrame:
    """(user_id, article_id, weight, dot, norm) per distinct pair: over its matching terms the sum of the weights and that of idf
    times weight, 0.0 where nothing matches, and the length of the user's query as a vector of idf."""
    def kernel(people: pa.Table, texts: pa.Table) -> Iterator[pa.RecordBatch]:
        block = _Block(people, texts)
        weights, dots, norms = (np.zeros(len(block.articles)) for _ in range(3))
        for _, mine, pair, _, weight, idf, norm in block.hits():
            n = mine.stop - mine.start
            weights[mine], dots[mine], norms[mine] = np.bincount(pair, weight, n), np.bincount(pair, weight * idf, n), norm
        users = block.people.take(pa.array(np.repeat(np.arange(len(block.people)), np.diff(block.cuts))))
        yield pa.RecordBatch.from_pydict({"user_id": users, "article_id": block.articles, "weight": weights, "dot": dots, "norm": norms})

    return _in_blocks(pairs, query, postings, kernel, "user_id string, article_id string, weight double, dot double, norm double", terms_of, unique=True)


def bm25_score(pairs: DataFrame, query: DataFrame, postings: DataFrame, name: str = "score") -> DataFrame:
    """Distinct (user_id, article_id) pairs with their BM25 score, 0.0 where nothing matches; terms are matched as in `match_terms`."""
    return pair_sums(pairs, query, postings).select("user_id", "article_id", F.round("weight", 9).alias(name))


def tfidf_postings(index: LexicalIndex) -> DataFrame:
    """Postings with tf-idf weights scaled to unit length per article; idf is ln((n+1)/(df+1)). The rows come grouped by article."""
    n = index.stats.select("n").scalar()
    rows = index.postings.select("term", "article_id", "tf", "dl", F.log((n + 1) / (F.col("df") + 1)).alias("idf"))
    raw = rows.withColumn("raw", F.col("tf") * F.col("idf")).groupBy("article_id").agg(F.collect_list(F.struct("term", "tf", "dl", "idf", "raw")).alias("p"))
    norms = raw.withColumn("norm", F.sqrt(F.aggregate("p", F.lit(0.0), lambda a, x: a + x["raw"] * x["raw"])))
    unit = F.when(F.col("norm") > 0, F.col("raw") / F.col("norm")).otherwise(0.0)
    return norms.select("article_id", "norm", F.inline("p")).select("term", "article_id", "tf", "dl", "idf", unit.alias("weight"))


def tfidf_score(pairs: DataFrame, users: DataFrame, index: LexicalIndex, name: str = "score") -> DataFrame:
    """Cosine of the tf-idf vectors of query (each term once) and article, per distinct pair."""
    def terms_of(postings: DataFrame) -> DataFrame:
        return article_terms(tfidf_postings(replace(index, postings=postings)))

    sums = pair_sums(pairs, history_query(users, index.postings, by_article=True), index.postings, terms_of)
    score = F.when(F.col("norm") > 0, F.round(F.col("dot") / F.col("norm"), 9)).otherwise(0.0)
    return sums.select("user_id", "article_id", score.alias(name))
