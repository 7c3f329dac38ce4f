"""Toxicity by logistic regression with the FTRL-proximal rule over hashed word n-grams and skip-grams.

Features of a text are the distinct slots of its words, pairs of neighbours and pairs with one word between. Each
slot has its own learning rate, and the L1 term keeps most weights at zero, so the model is a small list of weights.
It is fitted in one task on a bounded sample of labelled texts; scoring runs over all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.common import PUNCTUATION, chunks, mix, words

#: Slots of the hashed features: 2**20 weights at most.
BITS = 20
#: Labelled rows that are fitted at most, those with the smallest hashed ids.
SAMPLE = 12_000
#: Text bytes of these rows at most; rows are taken in the order of their hashed ids as long as they fit.
SAMPLE_BYTES = 64 << 20


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, slot) of every word, neighbour pair and pair around one word."""
    h, before = words(data, offsets, PUNCTUATION)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(before))
    shift = np.uint64(64 - BITS)
    who, slot = [owner], [h >> shift]
    for gap, factor in ((1, 0xD6E8FEB86659FD93), (2, 0xA0761D6478BD642F)):
        if len(h) > gap:
            same = owner[gap:] == owner[:-gap]
            pair = mix(h[:-gap] * np.uint64(factor) + h[gap:] + np.uint64(gap))
            who.append(owner[:-gap][same])
            slot.append(pair[same] >> shift)
    return np.concatenate(who), np.concatenate(slot).astype(np.int64)


class Ftrl:
    """FTRL-proximal state: one accumulated gradient and one sum of squares per slot."""

    def __init__(self, alpha: float = 1.0, beta: float = 1.0, l1: float = 10.0, l2: float = 0.0):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(self, slots) -> np.ndarray:
        z = self.z[slots]
        return np.where(np.abs(z) <= self.l1, 0.0,
                        -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(self.n[slots])) / self.alpha + self.l2))

    def learn(self, slots: np.ndarray, label: int) -> None:
        w = self.weights(slots)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[slots]
        self.z[slots] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[slots] = n + g * g


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, passes: int = 6, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "toxic") -> tuple[np.ndarray, np.ndarray]:
    """(slots, weights) learned from at most `sample` texts of labelled ids (an id with several labels has the largest).

    The sample is the ids with the smallest hashes, so it is the same for any partitioning; of an id that `docs` repeats
    one text counts, the one of smallest hash. Texts are read whole, up to `SAMPLE_BYTES` together. Null labels and ids are
    left out; without rows the model is empty. The driver gets the weights only.
    """
    chosen = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("label"))
              .orderBy(F.xxhash64("id"), "id").limit(sample))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    one = F.min_by("text", F.struct(F.xxhash64("text"), F.octet_length("text"))).alias("text")
    rows = texts.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(one)
    so_far = F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).over(Window.orderBy("turn", "id").rowsBetween(Window.unboundedPreceding, 0))
    rows = (rows.select(F.xxhash64("id").alias("turn"), "id", "text", F.col("label").cast("int").alias("label"))
            .withColumn("so_far", so_far).where(F.col("so_far") <= SAMPLE_BYTES).select("turn", "text", "label"))
    end = 1 << BITS

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, model = [], Ftrl()
        for batch in batches:
            label = batch.column(2).to_pylist()
            for first, last, data, offsets in chunks(batch.column(1)):
                owner, slot = features(data, offsets)
                keys = np.unique(owner << BITS | slot)
                cut = np.searchsorted(keys >> BITS, np.arange(last - first + 1))
                slot = (keys & (end - 1)).astype(np.int32)
                seen += [(np.append(slot[cut[i]:cut[i + 1]], np.int32(end)), label[first + i]) for i in range(last - first)]
        for _ in range(passes):
            for slot, label in seen:
                model.learn(slot, label)
        w = model.weights(slice(None))
        kept = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(kept.astype(np.int32)), pa.array(w[kept])], ["slot", "weight"])

    found = rows.mapInArrow(fit, "slot int, weight double").toPandas()
    return found["slot"].to_numpy(np.int64), found["weight"].to_numpy(np.float64)


def scores(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, `score`) for each row of `docs`: the probability of the label, by whole texts.

    Null and empty texts and those without a word get the model's intercept. Rows are scored one by one, so repeated
    ids and texts need no care; columns besides id and text are not read.
    """
    slots, values = model
    end = 1 << BITS

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = np.zeros(end + 1)
        w[slots] = values
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for first, last, data, offsets in chunks(batch.column(1)):
                owner, slot = features(data, offsets)
                some = w[slot] != 0
                keys = np.unique(owner[some] << BITS | slot[some])
                out[first:last] = np.bincount(keys >> BITS, w[keys & (end - 1)], last - first)
            out = 1 / (1 + np.exp(-np.clip(out + w[end], -35, 35)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], [id_col, "score"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(score, f"`{id_col}` {kind}, score double")
