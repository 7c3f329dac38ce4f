"""Shared pieces of the training-data operators: row keys, held-out folds, byte buffers and hashes inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.session import stage

#: Bytes of text that a Python task holds as arrays at a time; a single longer text is a chunk of its own.
CHUNK = 1 << 20
#: The white space of the contracts: blank and the bytes 09 to 0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes that end a word when punctuation does not count: all of ASCII but letters and digits.
PUNCTUATION = np.ones(256, bool)
PUNCTUATION[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False

_B = np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id: Column, folds: int, fold: int = 2) -> Column:
    """Whether crc32 of the id as text falls in `fold`; a null id is never held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def numbered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(`row`, `id`, `text`) of `docs`, with a distinct long `row` per document that rises with the id.

    Where ids are whole numbers, not null and not repeated, `row` is the id itself. Else rows are counted in the
    order (id, hash of the text), nulls first; rows that agree in both share a number and hence every result. The numbered
    rows are then written once, as they have several readers.
    """
    slim = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    whole = dict(slim.dtypes)["id"] in ("tinyint", "smallint", "int", "bigint")
    if whole:
        ids = slim.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
        worst = ids.agg(F.max("n"), F.max(F.col("id").isNull())).first()
        if worst[0] is None or (worst[0] == 1 and not worst[1]):
            return slim.select(F.col("id").cast("long").alias("row"), "id", "text")
    keyed = slim.withColumn("h", F.xxhash64("text"))
    keys = keyed.select("id", "h").distinct().orderBy(F.asc_nulls_first("id"), "h")
    # The place within a range of the order is part of the written key, so a lost task can't change it.
    keys = stage(keys.withColumn("place", F.monotonically_increasing_id()), "row-keys")
    cut = keys.withColumns({"range": F.shiftright("place", 33), "at": F.col("place").bitwiseAND((1 << 33) - 1)})
    sizes = cut.groupBy("range").agg((F.max("at") + 1).alias("n"))
    before = sizes.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("before"))
    order = cut.join(F.broadcast(before), "range").select(F.col("id").alias("key"), F.col("h").alias("hash"), (F.col("before") + F.col("at")).alias("row"))
    found = keyed.join(order, F.col("id").eqNullSafe(F.col("key")) & (F.col("h") == F.col("hash"))).select("row", "id", "text")
    return stage(found, "numbered")


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes and offsets of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offsets


def chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets from 0) of runs of whole texts of about `limit` bytes."""
    data, offsets = buffers(column)
    n, first = len(offsets) - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        base = offsets[first]
        yield first, last, data[base:offsets[last]], offsets[first:last + 1] - base
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the usual multiply and shift rounds)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    """1, B, B², … modulo 2⁶⁴."""
    out = np.full(max(n, 1), _B, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def words(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, words before each text): lower-cased runs of bytes outside `breaks`, cut at text ends.

    Hashes are 64 bits of a polynomial in the bytes and the length, so equal words of any task agree.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~breaks[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < n]
    first[heads] = inside[heads]
    starts = np.flatnonzero(first)
    before = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), before
    place = np.arange(n, dtype=np.int64)
    place -= np.repeat(np.concatenate([[0], starts]), np.diff(np.concatenate([[0], starts, [n]])))
    value = LOWER[data].astype(np.uint64) + np.uint64(1)
    value *= powers(int(place.max()) + 1)[place]
    value[~inside] = 0
    return mix(np.add.reduceat(value, starts)), before
