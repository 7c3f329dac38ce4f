"""URL filters: rules by host and path, and where no rule fits, the ratio of two character language models.

One model is learned from the URLs that rules allow, one from those they block. Both are variable-order Markov models:
the estimate after a context of `ORDER` characters falls back smoothly on shorter contexts. A URL's score is the
difference of its log-likelihoods per character; the cut between the classes is calibrated on ruled URLs that were
not learned from.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import LOWER, chunks, mix

ORDER = 5
#: Bits of the slots per order and class for contexts and for contexts with their next character: four slots for each
#: context that training holds, from 2**16 to 2**19 of them; then the model is 50 MB.
BITS = (16, 19)
#: Pseudo-count of the shorter context's estimate.
STRENGTH = 2.0
#: Score bins of the calibration.
BINS = 4000


def host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty for null or without `://`."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; empty for null or without `://`."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, else nulls; `rules` are (allow or block, `host/path`).

    Of two rules with the same text the later one holds.
    """
    rule = verdict = F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def grams(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, context slots, slots with the next byte); a row of slots per order 0 to `ORDER`.

    Contexts do not reach beyond the start of the text: there they hold zeros.
    """
    n = len(data)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    place = np.arange(n) - offsets[:-1][owner] if n else np.zeros(0, np.int64)
    here = LOWER[data].astype(np.uint64) + np.uint64(1)
    context, after = np.zeros((ORDER + 1, n), np.int64), np.zeros((ORDER + 1, n), np.int64)
    history, shift = np.zeros(n, np.uint64), np.uint64(64 - bits)
    for order in range(ORDER + 1):
        if order:
            back = np.zeros(n, np.uint64)
            back[order:] = here[:-order] if n > order else here[:0]
            back[place < order] = 0
            history = history * np.uint64(257) + back
        seed = np.uint64((order + 1) * 0xA0761D6478BD642F & 0xFFFFFFFFFFFFFFFF)
        context[order] = mix(history + seed) >> shift
        after[order] = mix((history + seed) * np.uint64(0x9E3779B97F4A7C15) + here) >> shift
    return owner, context, after


def slot_bits(ruled: DataFrame, url_col: str = "url") -> int:
    """Bits that give four slots to each of the longest contexts with their next character, within `BITS`.

    They are counted over all URLs by a mergeable sketch of their 63-bit hashes.
    """
    def longest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(grams(data, offsets, 63)[2][ORDER]))], ["h"])

    found = ruled.where(F.col(url_col).isNotNull()).select(url_col).mapInArrow(longest, "h long")
    n = found.agg(F.approx_count_distinct("h", 0.05)).first()[0]
    return min(max(math.ceil(math.log2(4 * max(n, 1))), BITS[0]), BITS[1])


def train(ruled: DataFrame, url_col: str = "url", verdict_col: str = "verdict") -> tuple[int, np.ndarray, np.ndarray]:
    """(bits, slots, counts) of all allowed and blocked URLs; a slot number runs over class, context or with next, order and hash.

    Counted in the tasks, summed across tasks; the driver gets 2 × 2 × (ORDER + 1) × 2**bits numbers at most.
    """
    bits = slot_bits(ruled, url_col)
    shape = (2, 2, ORDER + 1, 1 << bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(shape, np.int32)
        for batch in batches:
            blocked = np.array([v == "block" for v in batch.column(1).to_pylist()], np.int64)
            for first, last, data, offsets in chunks(batch.column(0)):
                owner, context, after = grams(data, offsets, bits)
                kind = blocked[first:last][owner]
                for c in (0, 1):
                    for order in range(ORDER + 1):
                        sums[c, 0, order] += np.bincount(context[order][kind == c], minlength=1 << bits)
                        sums[c, 1, order] += np.bincount(after[order][kind == c], minlength=1 << bits)
        flat = sums.reshape(-1)
        slots = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int32)), pa.array(flat[slots].astype(np.int64))], ["slot", "n"])

    rows = ruled.where(F.col(url_col).isNotNull()).select(url_col, verdict_col)
    found = rows.mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    return bits, found["slot"].to_numpy(np.int32), found["n"].to_numpy(np.float32)


def dense(model: tuple[int, np.ndarray, np.ndarray]) -> np.ndarray:
    """Counts [class][context or with next][order][slot] of a model; only its slots with a count are sent to the tasks."""
    bits, slots, counts = model
    out = np.zeros((2, 2, ORDER + 1, 1 << bits), np.float32)
    out.reshape(-1)[slots] = counts
    return out


def difference(owner: np.ndarray, context: np.ndarray, after: np.ndarray, urls: int, model: np.ndarray) -> np.ndarray:
    """Mean over a URL's bytes of log P(byte | allowed) - log P(byte | blocked); 0 for an empty URL."""
    logs = []
    for c in (0, 1):
        p = np.full(len(owner), 1 / 257)
        for order in range(ORDER + 1):
            # Slots are shared by chance, so the estimate is kept a probability.
            total = model[c, 0, order][context[order]].astype(np.float64)
            own = np.minimum(model[c, 1, order][after[order]], total)
            p = (own + STRENGTH * p) / (total + STRENGTH)
        logs.append(np.log(p))
    length = np.maximum(np.bincount(owner, minlength=urls), 1)
    return np.bincount(owner, logs[0] - logs[1], urls) / length


def rate(pages: DataFrame, model: tuple[int, np.ndarray, np.ndarray], url_col: str = "url") -> DataFrame:
    """`pages` with `url_score`, the difference above; a column of that name is replaced."""
    pages = pages.drop("url_score")
    bits = model[0]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = dense(model)
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for first, last, data, offsets in chunks(batch.column(batch.schema.get_field_index(url_col))):
                out[first:last] = difference(*grams(data, offsets, bits), last - first, counts)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], [*batch.schema.names, "url_score"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema)
    return pages.mapInArrow(judge, f"{fields}, url_score double")


def calibrate(rated: DataFrame, verdict_col: str = "verdict") -> float:
    """The cut with the best mean of both classes' hit rates, over a histogram of at most 2 × BINS rows.

    Of equally good cuts the one nearest 0 is taken; 0 if a class has no rows.
    """
    slot = F.least(F.greatest(F.floor((F.col("url_score") + 10) * (BINS / 20)), F.lit(0)), F.lit(BINS - 1)).cast("int")
    found = rated.groupBy(slot.alias("slot"), (F.col(verdict_col) == "block").alias("blocked")).count().collect()
    sums = np.zeros((2, BINS))
    for r in found:
        sums[int(r["blocked"]), r["slot"]] += r["count"]
    if not sums.sum(1).all():
        return 0.0
    below = np.concatenate([np.zeros((2, 1)), sums.cumsum(1)], axis=1)
    good = below[1] / sums[1].sum() + 1 - below[0] / sums[0].sum()
    cuts = np.arange(BINS + 1) * (20 / BINS) - 10
    best = np.flatnonzero(good >= good.max() - 1e-12)
    return float(cuts[best[np.argmin(np.abs(cuts[best]))]])


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, `host`, `path`, `rule`, `verdict`, `url_score`) for each row of `pages`. URLs of any length are judged whole.

    Four fifths of the ruled URLs (by the hash of the URL) teach the models, one fifth calibrates the cut. A null or
    empty URL has score 0 and is judged like any other. Rows are judged one by one; other columns are not read.
    """
    slim = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    slim = slim.withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = slim.withColumns({"rule": rule, "verdict": verdict})
    known = ruled.where(F.col("verdict").isNotNull() & F.col("url").isNotNull())
    fifth = F.pmod(F.xxhash64("url"), F.lit(5))
    model = train(known.where(fifth != 2))
    cut = calibrate(rate(known.where(fifth == 2).select("url", "verdict"), model))
    return rate(ruled, model).select(
        F.col("id").alias(id_col), "host", "path", "rule",
        F.coalesce("verdict", F.when(F.col("url_score") >= cut, "allow").otherwise("block")).alias("verdict"), "url_score")
