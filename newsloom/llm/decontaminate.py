"""Benchmark passages in documents, by pigeonhole pieces and bit-parallel edit distance over words.

Words are lower-cased runs of letters and digits, so punctuation, case and white space play no part. An item of m
words may differ from a passage by e = ⌊budget · m⌋ word edits. It is cut into e + 2 pieces: at most e edits leave two of
them whole, at places that are at most e words out of line, so exact hits of two pieces find every passage; Myers'
bit-parallel distance verifies them. A piece that many items share gives hits, but without a second piece of the same item
nothing to verify. (Items of one or two words allow no edit and are one piece.)
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from newsloom.llm.common import PUNCTUATION, chunks, mix, words

#: Benchmark text bytes that are sent to the tasks at a time; larger benchmarks are searched in several passes.
PASS_BYTES = 16 << 20
#: Piece hits that are held at a time; a stretch of text with more is searched in halves that overlap.
HITS = 1 << 22
_STEP = np.uint64(0x9E3779B97F4A7C15)


def edits_allowed(m: int, budget: float) -> int:
    return int(budget * m + 1e-9)


def pieces(m: int, budget: float) -> list[tuple[int, int]]:
    """(first word, words) of each piece of an item of m words; one more than the edits allowed and another, if it has the words."""
    e = edits_allowed(m, budget)
    count = 1 if e + 2 > m else e + 2
    cuts = [m * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def runs(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k neighbouring word hashes."""
    out = np.zeros(max(len(h) - k + 1, 0), np.uint64)
    for j in range(k):
        out = (out + h[j:len(h) - k + 1 + j]) * _STEP
    return mix(out)


def best_match(item: list[int], text: list[int]) -> tuple[int, int]:
    """(least edits between the item and any part of `text`, words of `text` up to the end of the first such part)."""
    m, at = len(item), {}
    for i, w in enumerate(item):
        at[w] = at.get(w, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best, end = m, 0
    for j, w in enumerate(text, 1):
        eq = at.get(w, 0)
        x = eq | down
        d = (((x & up) + up) ^ up) | x
        hp = down | (full & ~(d | up))
        hn = up & d
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        hp = hp << 1 & full
        hn = hn << 1 & full
        up = hn | (full & ~(d | hp))
        down = hp & d
        if score < best:
            best, end = score, j
    return best, end


class Index:
    """The pieces of a list of items, looked up by hash; equal pieces share an entry. Results name items by place in the list."""

    def __init__(self, items: list[str], budget: float):
        self.items, found = [], {}
        for first, last, data, offsets in chunks(pa.array(items, pa.string())):
            h, before = words(data, offsets, PUNCTUATION)
            for i in range(first, last):
                item = h[before[i - first]:before[i - first + 1]]
                self.items.append(item)
                for number, (a, k) in enumerate(pieces(len(item), budget) if len(item) else []):
                    found.setdefault(k, []).append((int(runs(item[a:a + k], k)[0]), i, a, number))
        self.sizes = np.array([len(x) for x in self.items], np.int64)
        self.slack = np.array([edits_allowed(len(x), budget) for x in self.items], np.int64)
        self.single = np.array([len(x) > 0 and len(pieces(len(x), budget)) == 1 for x in self.items], bool)
        self.tables = {}
        for k, rows in found.items():
            rows.sort()
            self.tables[k] = (np.array([r[0] for r in rows], np.uint64), *(np.array([r[j] for r in rows], np.int64) for j in (1, 2, 3)))

    def looked_up(self, h: np.ndarray) -> list[tuple]:
        """Per piece length: (table, places in `h` with hits, first and last entry of each)."""
        out = []
        for k, table in self.tables.items():
            r = runs(h, k)
            low, high = np.searchsorted(table[0], r), np.searchsorted(table[0], r, side="right")
            at = np.flatnonzero(high > low)
            if len(at):
                out.append((table, at, low[at], high[at]))
        return out

    def places(self, h: np.ndarray, before: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(item, word where it would begin) of each item that has two pieces in line in the words `h`, or its only one."""
        found = self.looked_up(h)
        total = sum(int((high - low).sum()) for _, _, low, high in found)
        widest = int((self.sizes + 2 * self.slack).max()) if len(self.sizes) else 0
        if total > HITS and len(h) > 4 * widest:
            # Every passage lies whole in one of the halves.
            half = len(h) // 2
            for first, last in ((0, half + widest), (half - widest, len(h))):
                for who, begin in self.places(h[first:last], before):
                    yield who, begin + first
            return
        who, begin, number = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for (_, items, offset, piece), at, low, high in found:
            times = high - low
            entry = np.repeat(low, times) + np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
            who.append(items[entry])
            begin.append(np.repeat(at, times) - offset[entry])
            number.append(piece[entry])
        who, begin, number = np.concatenate(who), np.concatenate(begin), np.concatenate(number)
        order = np.lexsort((number, begin, who))
        who, begin, number = who[order], begin[order], number[order]
        good = self.single[who]
        if len(who) > 1:
            # The next hit of the same item by another piece lies behind the hits of the same piece.
            change = np.flatnonzero((who[1:] != who[:-1]) | (number[1:] != number[:-1])) + 1
            after = np.searchsorted(change, np.arange(len(who)), side="right")
            following = np.append(change, len(who))[after]
            leading = np.concatenate([[-1], change - 1])[after]
            for other in (following, leading):
                real = np.clip(other, 0, len(who) - 1)
                good |= (other == real) & (who[real] == who) & (np.abs(begin[real] - begin) <= self.slack[who])
        yield who[good], begin[good]

    def search(self, h: np.ndarray, before: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(text number, item, edits, end word) of passages of each item within its budget."""
        for who, begin in self.places(h, before):
            if not len(who):
                continue
            # A hit near the end of a text may begin before or run over it; the piece itself lies in one text.
            owner_low = np.searchsorted(before, np.maximum(begin, 0), side="right") - 1
            owner_high = np.searchsorted(before, np.minimum(begin + self.sizes[who], before[-1]) - 1, side="right") - 1
            done = set()
            for n, b, low, high in zip(who.tolist(), begin.tolist(), owner_low.tolist(), owner_high.tolist()):
                item, e = self.items[n], int(self.slack[n])
                for text in range(low, high + 1):
                    a = max(int(before[text]), b - e)
                    z = min(int(before[text + 1]), b + len(item) + e)
                    if z <= a or (text, n, a, z) in done:
                        continue
                    done.add((text, n, a, z))
                    edits, end = best_match(item.tolist(), h[a:z].tolist())
                    if edits <= e:
                        yield text, n, edits, a - int(before[text]) + end


def item_passes(benchmark: DataFrame, item_id: str, item_text: str) -> Iterator[list[tuple[object, str]]]:
    """The rows with a text in lists of about `PASS_BYTES` of text, by hash; one list if they are no more than that."""
    items = benchmark.where(F.col(item_text).isNotNull()).select(F.col(item_id).alias("item"), F.col(item_text).alias("text"))
    passes = (items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // PASS_BYTES + 1
    for i in range(passes):
        some = items if passes == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(passes)) == i)
        yield [(r["item"], r["text"]) for r in some.collect()]


def passages(docs: DataFrame, benchmark: DataFrame, budget: float = 0.2, id_col: str = "doc_id", text_col: str = "text",
             item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id, `item_id`, `edits`, `end_word`): every benchmark item with a passage within its budget in a row of `docs`.

    One row per row of `docs` and row of `benchmark`: the fewest edits, and the first word position after the first passage
    with so many. Ids of items may be of any type, null or repeated; each row of the benchmark counts by itself. Null and
    empty texts and items without a word match nothing; an item of fewer than 1 / budget words must occur
    exactly. Rows of `docs` that repeat an id are searched row by row, very long texts in stretches that overlap. The
    benchmark is sent to the tasks in passes of at most `PASS_BYTES` of text (or one item), which changes no result.
    Further columns are not read.
    """
    slim = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind, item_type = dict(slim.dtypes)["id"], benchmark.schema[item_id].dataType
    schema = f"id {kind}, item_id {item_type.simpleString()}, edits int, end_word long"
    arrow = to_arrow_type(item_type)

    def search(some: list[tuple[object, str]]) -> DataFrame:
        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Index([text for _, text in some], budget)
            for batch in batches:
                rows = []
                for first, last, data, offsets in chunks(batch.column(1)):
                    h, before = words(data, offsets, PUNCTUATION)
                    best: dict[tuple[int, int], tuple[int, int]] = {}
                    for text, item, edits, end in index.search(h, before):
                        best[text + first, item] = min(best.get((text + first, item), (edits, end)), (edits, end))
                    rows += [(*k, *v) for k, v in best.items()]
                who = pa.array([r[0] for r in rows], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(who), pa.array([some[r[1]][0] for r in rows], arrow),
                     pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.int64())],
                    ["id", "item_id", "edits", "end_word"])

        return slim.mapInArrow(find, schema)

    found = None
    for some in item_passes(benchmark, item_id, item_text):
        part = search(some)
        found = part if found is None else found.unionByName(part)
    return found.withColumnRenamed("id", id_col)


def clean(docs: DataFrame, benchmark: DataFrame, budget: float = 0.2, text_col: str = "text", item_id: str = "item_id",
          item_text: str = "text") -> DataFrame:
    """The rows of `docs` without a passage of any benchmark item (see `passages`), with all their columns.

    Rows are judged one by one in the tasks that read them: nothing is shuffled. Null and empty texts stay, repeated rows
    are judged alike, very long texts are searched whole.
    """
    schema = docs.schema

    def without(some: list[tuple[object, str]]):
        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Index([text for _, text in some], budget)
            for batch in batches:
                good = np.ones(batch.num_rows, bool)
                for first, _, data, offsets in chunks(batch.column(batch.schema.get_field_index(text_col))):
                    for text, _, _, _ in index.search(*words(data, offsets, PUNCTUATION)):
                        good[first + text] = False
                yield batch.filter(pa.array(good))
        return keep

    for some in item_passes(benchmark, item_id, item_text):
        docs = docs.mapInArrow(without(some), schema)
    return docs


def contaminated(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per id of `found`: `n_items`, `items` (ascending) and the fewest `edits`."""
    return found.groupBy(id_col).agg(
        F.countDistinct("item_id").alias("n_items"), F.sort_array(F.collect_set("item_id")).alias("items"), F.min("edits").alias("edits"))
