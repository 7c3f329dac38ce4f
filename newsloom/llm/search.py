"""Ranked lexical search: the best documents of each item, found over intervals of documents with range-maximum tables.

A segment is a run of documents in id order with one posting list per term; sparse tables over the lists answer in
constant time where the highest impact of a term in any interval of documents lies. The sum of these maxima over the terms of an
item bounds every score in an interval. The search keeps a set of intervals, takes those of highest bound first, scores the
document of the greatest single impact in each, and goes on with what lies before and after it; intervals whose bound can't
reach the item's tenth score so far are dropped. So the ranking is exact without scoring every document.

Segments are built and searched by the task that reads their documents: no posting is shuffled, and a task carries each
item's best scores from segment to segment. Only its ten best rows per item leave it.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm import common
from newsloom.session import stage

#: Item text bytes that are searched for at a time; more items are searched in several passes over the counted texts.
PASS_BYTES = 8 << 20
#: Postings of a segment, the unit of memory of a search (a document with more is a segment of its own).
SEGMENT = 1 << 20
#: Intervals that are split in one step.
STEP = 128
#: Bytes of a text whose terms are held at a time.
PIECE = 1 << 20
#: Tasks whose rows meet in the first of the two final rankings.
FAN = 256
#: Over UTF-8 bytes: all but letters, digits and what lies beyond ASCII ends a term.
LOWER = common.LOWER.tobytes()
TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_BREAK = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


def terms(text: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, piece by piece; only A to Z are lower-cased, and null has none."""
    text, first = text or b"", 0
    while first < len(text):
        cut = _BREAK.search(text, first + PIECE)
        last = cut.start() if cut else len(text)
        yield TERM.findall(text[first:last].translate(LOWER))
        first = last


def order_of(doc_id) -> tuple:
    """Ids ascend, null comes last."""
    return (doc_id is None, 0 if doc_id is None else doc_id)


class Segment:
    """Documents 0, 1, … with posting lists of whole impacts, one list per term, and their sparse tables."""

    def __init__(self, docs: int, term: np.ndarray, doc: np.ndarray, impact: np.ndarray):
        order = np.lexsort((doc, term))
        self.docs, self.term, self.doc, self.impact = docs, term[order], doc[order], impact[order]
        self.key = self.term.astype(np.int64) * (docs + 1) + self.doc
        cuts = np.flatnonzero(np.diff(self.term)) + 1
        longest = int(np.diff(np.concatenate([[0], cuts, [len(term)]])).max()) if len(term) else 0
        # Row j holds the place of the first maximum of the 2^j postings from each place on.
        self.table = [np.arange(len(term), dtype=np.int32)]
        while 2 << len(self.table) - 1 <= longest:
            half = 1 << len(self.table) - 1
            left, right = self.table[-1][:-half], self.table[-1][half:]
            row = self.table[-1].copy()
            row[:-half] = np.where(self.impact[left] >= self.impact[right], left, right)
            self.table.append(row)
        self.table = np.stack(self.table)

    def places(self, term: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Place of the first posting of each term at or after a document (broadcast over both)."""
        return np.searchsorted(self.key, term * (self.docs + 1) + doc)

    def maxima(self, low: np.ndarray, high: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bound, document to split at) of intervals given as ranges of places, one column per term."""
        size = high - low
        some = size > 0
        level = np.where(some, np.frexp(np.maximum(size, 1))[1] - 1, 0)
        left = self.table[level, np.where(some, low, 0)]
        right = self.table[level, np.where(some, high - (1 << level), 0)]
        best = np.where(self.impact[left] >= self.impact[right], left, right)
        value = np.where(some, self.impact[best] * times, 0)
        peak = value.argmax(1)
        rows = np.arange(len(value))
        return value.sum(1), self.doc[best[rows, peak]]

    def search(self, term: np.ndarray, times: np.ndarray, k: int, ids: list, best: list) -> list:
        """`best`, the k least (-score, id), with this segment's documents taken in; `ids` rise."""
        if not len(self.key):
            return best
        low, high = self.places(term, 0)[None, :], self.places(term, self.docs)[None, :]
        here = np.flatnonzero(high[0] > low[0])
        term, times, low, high = term[here], times[here], low[:, here], high[:, here]
        if not len(here):
            return best
        bound, split = self.maxima(low, high, times)
        first = np.zeros(1, np.int64)
        while True:
            floor = -best[-1][0] if len(best) == k else 0
            # A tie with the last row kept counts only for a smaller id, so only before that id's place.
            reach = bisect_left(ids, order_of(best[-1][1]), key=order_of) if len(best) == k else 0
            alive = (bound > floor) | ((bound == floor) & (first < reach))
            if not alive.any():
                return best
            low, high, bound, split, first = low[alive], high[alive], bound[alive], split[alive], first[alive]
            order = np.lexsort((first, -bound))
            take, rest = order[:STEP], order[STEP:]
            at = self.places(term[None, :], split[take][:, None])
            hit = (at < high[take]) & (self.doc[np.minimum(at, len(self.doc) - 1)] == split[take][:, None])
            score = (np.where(hit, self.impact[np.minimum(at, len(self.doc) - 1)], 0) * times).sum(1)
            good = np.flatnonzero(score >= max(floor, 1))
            rows = [(-int(score[i]), ids[split[take[i]]]) for i in good]
            best = sorted(best + rows, key=lambda r: (r[0], order_of(r[1])))[:k]
            new_low = np.concatenate([low[take], at + hit])
            new_high = np.concatenate([at, high[take]])
            new_bound, new_split = self.maxima(new_low, new_high, times)
            new_first = np.concatenate([first[take], split[take].astype(np.int64) + 1])
            low, high = np.concatenate([low[rest], new_low]), np.concatenate([high[rest], new_high])
            bound, split = np.concatenate([bound[rest], new_bound]), np.concatenate([split[rest], new_split])
            first = np.concatenate([first[rest], new_first])


def item_passes(items: DataFrame, item_id: str, item_text: str) -> Iterator[list[tuple[object, str]]]:
    """(id, text) of the items in lists of about `PASS_BYTES` of text, by hash; one list if they are no more than that."""
    rows = items.select(F.col(item_id).alias("item"), F.col(item_text).alias("text"))
    passes = (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // PASS_BYTES + 1
    for i in range(passes):
        some = rows if passes == 1 else rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(passes)) == i)
        found = sorted(((r["item"], r["text"] or "") for r in some.collect()), key=lambda r: (order_of(r[0]), r[1]))
        if found:
            yield found


def counted(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """(`id`, `n`, `terms`, `times`) per row of `docs`: its terms with repeats, and how often it has those of the vocabulary."""
    kind = dict(docs.dtypes)[id_col]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, terms_, times = [], [], []
            for value in batch.column(1).cast(pa.binary()):
                n, seen = 0, Counter()
                for found in terms(value.as_py()):
                    n += len(found)
                    seen.update(map(vocabulary.get, found))
                seen.pop(None, None)
                sizes.append(n)
                terms_.append(list(seen))
                times.append(list(seen.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(terms_, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int64()))],
                ["id", "n", "terms", "times"])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(count, f"id {kind}, n long, terms array<int>, times array<bigint>")


def segments(batches: Iterator[pa.RecordBatch], weights: np.ndarray, total: int, length: int) -> Iterator[tuple[list, Segment]]:
    """(ids, segment) of runs of about `SEGMENT` postings of the counted rows; documents without a posting are left out."""
    held: list[tuple] = []
    postings = 0

    def build() -> tuple[list, Segment]:
        rows = sorted(held, key=lambda r: order_of(r[0]))
        doc = np.repeat(np.arange(len(rows)), [len(r[2]) for r in rows])
        term = np.concatenate([r[2] for r in rows]).astype(np.int64)
        times = np.concatenate([r[3] for r in rows]).astype(np.int64)
        m = np.array([25 + 75 * r[1] * total // length for r in rows], np.int64)[doc]
        return [r[0] for r in rows], Segment(len(rows), term, doc.astype(np.int64), weights[term] * (1_000_000_000 * times // (1000 * times + 8 * m)))

    for batch in batches:
        ids, n = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        places = batch.column(2)
        cuts = np.asarray(places.offsets)
        term, times = np.asarray(places.values), np.asarray(batch.column(3).values)
        for i in np.flatnonzero(np.diff(cuts)).tolist():
            held.append((ids[i], n[i], term[cuts[i]:cuts[i + 1]], times[cuts[i]:cuts[i + 1]]))
            postings += int(cuts[i + 1] - cuts[i])
            if postings >= SEGMENT:
                yield build()
                held, postings = [], 0
    if held:
        yield build()


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(`item_id`, `rank`, id, `score`): the `k` best rows of `docs` for each row of `items`, by whole texts.

    Terms are runs of letters, digits and characters beyond ASCII; A to Z are lower-cased. With N rows that have a term, L
    terms in them, n terms in a row, df rows that have a term and tf its times in a row, a term weighs
    floor(1000 ln((2N + 2) / (2df + 1))) and adds that times 10^9 tf div (1000 tf + 8 (25 + 75 n N div L)) for each time
    the item has it. Scores above 0 are ranked, equal ones by id, null ids last. Null and empty texts match nothing and are
    matched by nothing. Rows of `docs` that repeat an id compete row by row; of several items with one id each is ranked
    by itself. Other columns are not read; empty tables give no rows.
    """
    out = None
    kind, item_kind = dict(docs.dtypes)[id_col], dict(items.dtypes)[item_id]
    for some in item_passes(items, item_id, item_text):
        wanted = [Counter(t for part in terms(text.encode()) for t in part) for _, text in some]
        vocabulary = {t: i for i, t in enumerate(sorted(set().union(*wanted)))}
        base = stage(counted(docs, vocabulary, id_col, text_col), "counted")
        total, length = base.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
        weights = np.zeros(len(vocabulary), np.int64)
        for row in base.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect():
            weights[row["term"]] = math.floor(1000 * math.log((2 * total + 2) / (2 * row["df"] + 1)))
        asked = [(np.array([vocabulary[t] for t in w], np.int64), np.array(list(w.values()), np.int64)) for w in wanted]
        part = base.mapInArrow(finder(asked, weights, total or 0, length or 1, k), f"item int, score long, id {kind}, task int")
        names = docs.sparkSession.createDataFrame([(i, x) for i, (x, _) in enumerate(some)], f"item int, item_id {item_kind}")
        order = (F.desc("score"), F.asc_nulls_last("id"))
        near = Window.partitionBy("item", F.floor(F.col("task") / FAN)).orderBy(*order)
        part = part.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= k)
        part = part.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
        part = part.join(names, "item").select(F.col("item_id").alias(item_id), "rank", F.col("id").alias(id_col), "score")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return docs.sparkSession.createDataFrame([], f"`{item_id}` {item_kind}, rank int, `{id_col}` {kind}, score long")
    return out


def finder(asked: list[tuple[np.ndarray, np.ndarray]], weights: np.ndarray, total: int, length: int, k: int):
    """The search of one task: the best rows of its segments for every item."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in asked]
        kind = pa.int64()

        def seen() -> Iterator[pa.RecordBatch]:
            nonlocal kind
            for batch in batches:
                kind = batch.schema.field(0).type
                yield batch

        for ids, segment in segments(seen(), weights, total, length):
            for i, (term, times) in enumerate(asked):
                best[i] = segment.search(term, times, k, ids, best[i])
        task = TaskContext.get().partitionId()
        rows = [(i, -score, doc) for i, found in enumerate(best) for score, doc in found]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], kind),
             pa.array([task] * len(rows), pa.int32())], ["item", "score", "id", "task"])
    return find


#: The same ranking straight from the definition, in DuckDB SQL over `documents` and `benchmark`.
SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
     s AS (SELECT count(*) AS total, CAST(sum(len(w)) AS BIGINT) AS length FROM d WHERE len(w) > 0),
     tf AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d) GROUP BY ALL),
     q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
     g AS (SELECT term, CAST(floor(1000 * ln((2 * total + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM tf, s GROUP BY term, total),
     r AS (SELECT item_id, doc_id, CAST(sum(times * g.w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * total) // length)))) AS BIGINT) AS score
           FROM q JOIN tf USING (term) JOIN g USING (term), s GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM r WHERE score > 0 QUALIFY rank <= 10
"""
