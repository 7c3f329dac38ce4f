"""Passages that occur earlier in the corpus, removed byte by byte with the help of suffix arrays.

1. Anchors. The anchor of a string of `length` bytes is its least hashed gram (the leftmost of equals), so equal
   strings have equal anchors wherever they stand. Starts that share an anchor are one segment.
2. Segments whose anchor gram occurs only once hold nothing repeated. Of equal segments, all but the first are repeats
   as a whole (copies in one batch never leave their task for this), and only first segments of anchors with several
   contexts go on.
3. These are dealt to shards by anchor. Each shard builds its suffix array by induced sorting, takes the common
   prefixes in text order, and keeps of each run of suffixes with `length` common bytes the earliest start.
   Anchors with very many contexts are settled string by string with a pre-aggregated minimum instead.
4. The repeated starts of a document give the bytes to remove.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import buffers, chunks, mix, numbered, powers
from newsloom.llm.suffixes import shared_prefix, suffix_array
from newsloom.session import stage

#: Text bytes of the input per shard.
SHARD = 1 << 20
#: Contexts of one anchor above which its strings are settled one by one, spread over all tasks.
CROWDED = 4000
#: An anchor seen this often in one Arrow batch is repeated for certain; its rows are spread over the tasks.
SURE = 64
#: Longer texts are cut into overlapping pieces of this many bytes for hashing.
PIECE = 1 << 22

_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x9E3779B97F4A7C15


@functools.lru_cache(maxsize=2)
def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.full(n, np.uint64(pow(_BASE, -1, 1 << 64)), np.uint64)
    inverse[0] = 1
    return powers(n), np.cumprod(inverse, dtype=np.uint64)


def _sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(prefix sums of a polynomial in the bytes, inverse powers): together the hash of any substring."""
    up, down = _tables(1 << max(int(len(data) + 1).bit_length(), 16))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * up[:len(data)], dtype=np.uint64, out=sums[1:])
    return sums, down


def string_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums, down = _sums(data)
    return (sums[ends] - sums[starts]) * down[starts]


def _segments(data: np.ndarray, starts: np.ndarray, length: int):
    """(anchor hash, segment hash, first start, last start) for ascending `starts` of strings in `data`."""
    gram = max(1, length // 5)
    window = length - gram + 1
    sums, down = _sums(data)
    hashes = mix((sums[gram:] - sums[:-gram]) * down[:len(data) - gram + 1])
    low = np.uint64((1 << 23) - 1)
    least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    width = 1
    while 2 * width <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if window > width:
        least = np.minimum(least[:-(window - width)], least[window - width:])
    anchor = (least[starts] & low).astype(np.int64)
    head = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    l, r = starts[head], starts[np.append(head[1:], len(starts)) - 1]
    a = anchor[head]
    body = (sums[r + length] - sums[l]) * down[l]
    body = mix(body + (a - l).astype(np.uint64) * np.uint64(0xA0761D6478BD642F) + (r - l).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return hashes[a].view(np.int64), body.view(np.int64), l, r


def segments(data: np.ndarray, offsets: np.ndarray, length: int):
    """(text number, anchor hash, segment hash, first start, last start), starts within the text."""
    sizes = np.diff(offsets)
    if len(data) > PIECE:
        parts = []
        for i in np.flatnonzero(sizes >= length):
            for at in range(0, int(sizes[i]) - length + 1, PIECE):
                piece = data[offsets[i] + at:min(offsets[i] + at + PIECE + length - 1, offsets[i + 1])]
                found = _segments(piece, np.arange(len(piece) - length + 1), length)
                parts.append((np.full(len(found[0]), i), found[0], found[1], found[2] + at, found[3] + at))
        return tuple(np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 5
    room = np.maximum(sizes - length + 1, 0)
    if not room.sum():
        return (np.zeros(0, np.int64),) * 5
    starts = np.arange(int(room.sum())) + np.repeat(offsets[:-1] - (np.cumsum(room) - room), room)
    anchor, body, l, r = _segments(data, starts, length)
    who = np.searchsorted(offsets, l, side="right") - 1
    return who, anchor, body, l - offsets[who], r - offsets[who]


def all_segments(docs: DataFrame, length: int) -> DataFrame:
    """(`anchor`, `salt`, `times`, `body`, `row`, `span`) of all texts; `span` is first start · length + starts - 1.

    Of equal segments in one Arrow batch only the earliest takes part in what follows: the others have a negative
    salt and are repeats for certain. Anchors that are frequent in the batch have their rows spread by positive
    salts. One row of each anchor keeps salt 0 and counts in `times` for those that do not.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0).to_numpy(zero_copy_only=False)
            parts = [(rows[first:last][who], *rest) for first, last, data, offsets in chunks(batch.column(1))
                     for who, *rest in [segments(data, offsets, length)]]
            row, anchor, body, l, r = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 5
            order = np.lexsort((l, row, body, anchor))
            row, anchor, body, l, r = (x[order].astype(np.int64) for x in (row, anchor, body, l, r))
            new = np.ones(len(row), bool)
            new[1:] = anchor[1:] != anchor[:-1]
            again = ~new
            again[1:] &= body[1:] == body[:-1]
            heads = np.flatnonzero(new)
            size = np.diff(np.append(heads, len(row)))
            spread = ~new & (again | np.repeat(size >= SURE, size))
            salt = np.where(spread, 1 + (row * 31 + l) % 8191, 0)
            salt[again] *= -1
            times = np.ones(len(row), np.int64)
            if len(heads):
                times[heads] += np.add.reduceat(spread, heads)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor), pa.array(salt.astype(np.int32)), pa.array(times.astype(np.int32)), pa.array(body), pa.array(row), pa.array(l * length + r - l)],
                ["anchor", "salt", "times", "body", "row", "span"])

    return docs.select("row", "text").mapInArrow(find, "anchor long, salt int, times int, body long, row long, span long")


def repeated_starts(row: np.ndarray, l: np.ndarray, parts: list[np.ndarray], length: int):
    """(row, first, last) of runs of starts whose string also starts earlier, among segments of one shard."""
    order = np.lexsort((l, row))
    row, l = row[order], l[order]
    text = np.concatenate([parts[i] for i in order])
    sizes = np.array([len(parts[i]) for i in order], np.int64)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    room = sizes - length + 1
    starts = np.arange(int(room.sum())) + np.repeat(begins - (np.cumsum(room) - room), room)
    own = np.zeros(len(text) + 1, bool)
    own[starts] = True
    sa = suffix_array(np.append(text.astype(np.int64) + 1, 0), 257)
    sa = sa[own[sa]]
    # Common prefix of each start with the one before it in suffix order, held in text order.
    before = np.full(len(text) + 1, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    here = starts[before[starts] >= 0]
    prefix = np.zeros(len(text) + 1, np.int64)
    prefix[here] = shared_prefix(text, here, before[here], length)
    head = np.flatnonzero(np.concatenate([[True], prefix[sa[1:]] < length]))
    earliest = np.minimum.reduceat(sa, head)
    own[earliest] = False
    again = np.flatnonzero(own)
    who = np.searchsorted(ends, again, side="right")
    cut = np.flatnonzero(np.concatenate([[True], (again[1:] != again[:-1] + 1) | (who[1:] != who[:-1])]))
    if not len(again):
        return (np.zeros(0, np.int64),) * 3
    last = again[np.append(cut[1:], len(again)) - 1]
    w = who[cut]
    return row[w], again[cut] - begins[w] + l[w], last - begins[w] + l[w]


def remove_repeats(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text",
                   crowded: int = CROWDED, keep_text: bool = False) -> DataFrame:
    """One row per document: id, `n_bytes`, `n_removed`, `n_spans`, `kept_sha256`, and `kept` (bytes) if `keep_text`.

    A byte goes if a string of `length` bytes around it also starts earlier: in a document of smaller id, or earlier in
    the same one. Null counts as empty; texts shorter than `length` stay whole. Documents of null id come first, rows
    of one id are ordered by a hash of their text, and rows equal in both count as one document and get the same
    result. Texts of any length are judged whole. Strings of a segment are compared byte by byte; whole segments, and the
    strings of anchors with more than `crowded` contexts, are equal when 128 bits of two hashes are. Further columns are not
    read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    base = numbered(docs, id_col, text_col).where("row IS NOT NULL")
    size = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(parts, size // SHARD + 1)

    found = all_segments(base, length)
    several = found.selectExpr("*", "sum(times) OVER (PARTITION BY anchor, salt) AS n").where("n > 1 OR salt != 0")
    marked = several.select("anchor", "body", "row", "span", F.least("salt", F.lit(0)).alias("aside"))
    marked = marked.selectExpr("*", "min(struct(row, span)) OVER (PARTITION BY anchor, body, aside) AS head")
    head = (F.col("aside") == 0) & (F.col("row") == F.col("head.row")) & (F.col("span") == F.col("head.span"))
    start = F.expr(f"span div {length}")
    marked = stage(marked.select(F.when(head, F.col("anchor")).alias("anchor"), "row", start.cast("int").alias("l"),
                                 (start + F.col("span") % length).cast("int").alias("r")), "segments")
    copies = marked.where("anchor IS NULL").select("row", F.col("l").alias("first"), F.col("r").alias("last"))
    heads = marked.where("anchor IS NOT NULL")
    contexts = heads.groupBy("anchor").agg(F.count(F.lit(1)).alias("contexts")).where("contexts > 1")
    mixed = heads.join(contexts, "anchor")

    dealt = base.repartition(parts, "row")

    def with_text(some: DataFrame) -> DataFrame:
        wanted = some.groupBy("row").agg(F.collect_list(F.struct("anchor", "l", "r")).alias("wanted"))
        return dealt.join(wanted, "row").select("row", "text", "wanted")

    def pieces(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            lists = batch.column(2)
            cut = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            anchor, l, r = (x.to_numpy(zero_copy_only=False) for x in lists.flatten().flatten())
            who = np.repeat(np.arange(batch.num_rows), np.diff(cut))
            yield batch.column(0).to_numpy()[who], anchor, l.astype(np.int64), r.astype(np.int64), offsets[who], data

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, anchor, l, r, at, data in pieces(batches):
            raw = memoryview(data)
            for some in np.array_split(np.arange(len(row)), len(row) // 20_000 + 1):
                yield pa.RecordBatch.from_arrays([
                    pa.array((anchor[some].view(np.uint64) % np.uint64(shards)).astype(np.int64)), pa.array(row[some]), pa.array(l[some].astype(np.int32)),
                    pa.array([bytes(raw[at[i] + l[i]:at[i] + r[i] + length]) for i in some], pa.binary()),
                ], ["shard", "row", "l", "bytes"])

    def settle(batch: pa.Table) -> pa.Table:
        column = batch.column("bytes").combine_chunks()
        data, offsets = buffers(column)
        strings = [data[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
        row, first, last = repeated_starts(
            batch.column("row").to_numpy(), batch.column("l").to_numpy().astype(np.int64), strings, length)
        return pa.table({"row": pa.array(row.astype(np.int64)), "first": pa.array(first.astype(np.int32)), "last": pa.array(last.astype(np.int32))})

    cold = with_text(mixed.where(F.col("contexts") <= crowded)).mapInArrow(cut_out, "shard long, row long, l int, bytes binary")
    sorted_out = cold.groupBy("shard").applyInArrow(settle, "row long, first int, last int")

    def every_string(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, _, l, r, at, data in pieces(batches):
            # A handful of segments at a time: each text is hashed where it is needed.
            for i in range(len(row)):
                piece = data[at[i] + l[i]:at[i] + r[i] + length]
                starts = np.arange(r[i] - l[i] + 1)
                h = string_hashes(piece, starts, starts + length)
                g = mix(string_hashes(piece[::-1], starts, starts + length)[::-1] + np.uint64(1))
                yield pa.RecordBatch.from_arrays([
                    pa.array(mix(h).view(np.int64)), pa.array(g.view(np.int64)),
                    pa.array(np.full(len(starts), row[i])), pa.array((starts + l[i]).astype(np.int32))], ["h", "g", "row", "at"])

    strings = with_text(mixed.where(F.col("contexts") > crowded)).mapInArrow(every_string, "h long, g long, row long, at int")
    firsts = strings.groupBy("h", "g").agg(F.min(F.struct("row", "at")).alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1")
    crowd = strings.join(firsts, ["h", "g"]).where("row != head.row OR at != head.at").select(
        "row", F.col("at").alias("first"), F.col("at").alias("last"))

    runs = copies.unionByName(sorted_out).unionByName(crowd).groupBy("row").agg(
        F.collect_list(F.struct("first", "last")).alias("runs"))

    def cut_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            raw = memoryview(data)
            out: dict[str, list] = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "kept": []}
            for i, found in enumerate(batch.column(2)):
                text, spans, kept, digest, start = raw[offsets[i]:offsets[i + 1]], 0, [], hashlib.sha256(), 0
                if found.is_valid:
                    first, last = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in found.values.flatten())
                    order = np.argsort(first)
                    first, stop = first[order], np.maximum.accumulate(last[order] + length)
                    heads = np.flatnonzero(np.concatenate([[True], first[1:] > stop[:-1]]))
                    spans = len(heads)
                    for a, b in zip(first[heads], stop[np.append(heads[1:], len(first)) - 1]):
                        kept.append(text[start:a])
                        start = int(b)
                kept.append(text[start:])
                for piece in kept:
                    digest.update(piece)
                left = sum(map(len, kept))
                for name, value in (("n_bytes", len(text)), ("n_removed", len(text) - left), ("n_spans", spans),
                                    ("kept_sha256", digest.hexdigest()), ("kept", b"".join(kept) if keep_text else None)):
                    out[name].append(value)
            yield pa.RecordBatch.from_arrays([
                batch.column(3), *(pa.array(out[x], pa.int64()) for x in ("n_bytes", "n_removed", "n_spans")),
                pa.array(out["kept_sha256"], pa.string()), pa.array(out["kept"], pa.binary())], [id_col, *out])

    kind = dict(base.dtypes)["id"]
    result = dealt.join(runs, "row", "left").select("row", "text", "runs", "id").mapInArrow(
        cut_texts, f"`{id_col}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return result if keep_text else result.drop("kept")
