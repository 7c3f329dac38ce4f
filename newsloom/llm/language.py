"""Language ID by mixture inference: each document is a mixture of languages over byte trigrams.

Training counts the trigrams of every language in hashed slots. For a document, expectation-maximisation estimates the
share of each language from the trigram likelihoods; the language set is the leading set of languages whose penalised
log-likelihood is best, and the largest share within it is the prediction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import CHUNK, LOWER, chunks

#: Slots of a language; the same for any number of languages, so that one language more changes no other.
BITS = 16
#: Languages that one model holds at most: 2**16 slots of 512 languages are 128 MB in a task.
LANGUAGES = 512
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_BLANKED = np.where(_LETTER, LOWER, 32).astype(np.uint64)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def trigrams(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, slot) of each byte trigram around a letter; all but letters count as blanks, also text ends."""
    n, count = len(data), len(offsets) - 1
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    here = _BLANKED[data]
    left, right = np.full(n, 32, np.uint64), np.full(n, 32, np.uint64)
    left[1:], right[:-1] = here[:-1], here[1:]
    full = offsets[:-1] < offsets[1:]
    left[offsets[:-1][full]] = 32
    right[offsets[1:][full] - 1] = 32
    slot = ((left << np.uint64(16) | here << np.uint64(8) | right) * _MULTIPLIER) >> np.uint64(64 - bits)
    keep = here != 32
    owner = np.repeat(np.arange(count), np.diff(offsets))
    return owner[keep], slot[keep].astype(np.int64)


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray, int]:
    """(languages, log likelihood per slot and language, slot bits) from all rows of `labelled`.

    Counts are summed in each task, then across tasks; the driver gets languages × 2^BITS numbers. More than `LANGUAGES`
    labels raise an error, as they are no languages.
    """
    names = labelled.where(F.col(lang_col).isNotNull()).select(lang_col).distinct().limit(LANGUAGES + 1).collect()
    if len(names) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    langs, bits = sorted(r[0] for r in names), BITS
    place = {name: i for i, name in enumerate(langs)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            who = np.array([place[x] for x in batch.column(1).to_pylist()], np.int64)
            for first, last, data, offsets in chunks(batch.column(0)):
                owner, slot = trigrams(data, offsets, bits)
                lang = who[first:last][owner]
                for i in np.unique(lang):
                    found = np.bincount(slot[lang == i], minlength=1 << bits)
                    sums[i] = sums[i] + found if i in sums else found
        for i, found in sums.items():
            slots = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(slots), i, np.int32)), pa.array(slots.astype(np.int32)), pa.array(found[slots].astype(np.int64))],
                ["lang", "slot", "n"])

    table = np.zeros((1 << bits, max(len(langs), 1)), np.float32)
    if langs:
        rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(text_col, lang_col)
        sums = rows.mapInArrow(count, "lang int, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()
        table[sums["slot"].to_numpy(), sums["lang"].to_numpy()] = sums["n"].to_numpy()
    total = table.sum(0, dtype=np.float64) + 0.1 * (1 << bits)
    table += np.float32(0.1)
    return langs, np.log(table, out=table) - np.log(total).astype(np.float32), bits


def mixtures(owner: np.ndarray, slot: np.ndarray, docs: int, logs: np.ndarray, bits: int, rounds: int = 15):
    """(shares, languages chosen, share of trigrams likelier in the first language than by chance) of each of `docs` texts."""
    k = logs.shape[1]
    keys, times = np.unique(owner << bits | slot, return_counts=True)
    d, s, c = keys >> bits, keys & ((1 << bits) - 1), times.astype(np.float64)
    shares, chosen, fit_share = np.full((docs, k), 1 / k), np.zeros((docs, k), bool), np.zeros(docs)
    if not len(keys):
        return shares, chosen, fit_share
    like = np.exp(logs[s].astype(np.float64))
    starts = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
    who = d[starts]
    local = np.repeat(np.arange(len(starts)), np.diff(np.concatenate([starts, [len(d)]])))
    total = np.add.reduceat(c, starts)
    pi = np.full((len(starts), k), 1 / k)
    for _ in range(rounds):
        part = pi[local] * like
        part *= (c / part.sum(1))[:, None]
        pi = np.add.reduceat(part, starts, axis=0) / total[:, None]
    order = np.argsort(-pi, axis=1, kind="stable")
    best, size = np.full(len(starts), -np.inf), np.ones(len(starts), int)
    # No subset of languages has a likelihood above this one: each trigram by its best language.
    full = np.add.reduceat(c * np.log(np.maximum(like.max(1), 1e-300)), starts)
    for m in range(1, k + 1):
        mask = np.zeros_like(pi, bool)
        np.put_along_axis(mask, order[:, :m], True, axis=1)
        some = np.where(mask, pi, 0)
        some /= np.maximum(some.sum(1, keepdims=True), 1e-300)
        ll = np.add.reduceat(c * np.log(np.maximum((some[local] * like).sum(1), 1e-300)), starts)
        if m == 1:
            fit_share[who] = np.add.reduceat(c * ((some[local] * like).sum(1) > 2.0 ** -bits), starts) / total
        fit = ll - 0.5 * (m - 1) * np.log(total + 1) * 3
        size = np.where(fit > best, m, size)
        best = np.maximum(fit, best)
        # The likelihood can't rise beyond that of all languages; when no text can make up for the penalty, stop.
        if m < k and (full - 0.5 * m * np.log(total + 1) * 3 <= best).all():
            break
    picked = np.zeros_like(pi, bool)
    np.put_along_axis(picked, order, np.arange(k)[None, :] < size[:, None], axis=1)
    shares[who], chosen[who] = pi, picked
    return shares, chosen, fit_share


def piece(langs: list[str]) -> int:
    """Bytes of text judged at a time: the likelihoods of a piece take up to 8 bytes per trigram and language."""
    return min(CHUNK, max((1 << 23) // max(len(langs), 1), 1 << 16))


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray, int], text_col: str = "text") -> DataFrame:
    """`docs` with `lang_pred`, `lang_score` (its share), `langs` (the chosen set) and `lang_fit`.

    `und` with score 0 for null texts, texts without a letter and an empty model. Ties go to the language first in
    alphabetic order. `lang_fit` is the share of trigrams that the best language makes likelier than a slot at random:
    near 0, no learned language explains the text. Columns of `docs` with these names are replaced.
    """
    langs, logs, bits = model
    docs = docs.drop("lang_pred", "lang_score", "langs", "lang_fit")
    if text_col != "text" and "text" in docs.columns:
        raise ValueError("name the text column `text`, or drop the other column of that name")
    fields = docs.schema

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text_col))
            pred, score, sets, fits = [], [], [], []
            for first, last, data, offsets in chunks(column, piece(langs)):
                owner, slot = trigrams(data, offsets, bits)
                shares, chosen, fit = mixtures(owner, slot, last - first, logs, bits)
                top = np.argmax(shares, axis=1)
                pred += [langs[i] if langs else "und" for i in top]
                score += shares[np.arange(last - first), top].tolist()
                sets += [[langs[i] for i in np.flatnonzero(row)] if langs else [] for row in chosen]
                fits += fit.tolist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64()),
                 pa.array(sets, pa.list_(pa.string())), pa.array(fits, pa.float64())],
                [*batch.schema.names, "lang_pred", "lang_score", "langs", "lang_fit"])

    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    rated = docs.mapInArrow(judge, f"{out}, lang_pred string, lang_score double, langs array<string>, lang_fit double")
    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    known = letters & F.lit(bool(langs))
    return rated.withColumns({
        "lang_pred": F.when(known, F.col("lang_pred")).otherwise("und"),
        "lang_score": F.when(known, F.least(F.col("lang_score"), F.lit(1.0))).otherwise(0.0),
        "langs": F.when(known, F.col("langs")).otherwise(F.array().cast("array<string>")),
        "lang_fit": F.when(known, F.col("lang_fit")).otherwise(0.0),
    })


def known(docs: DataFrame, model: tuple[list[str], np.ndarray, int], cut: float, loose: float, long: int, text_col: str = "text") -> DataFrame:
    """The rows of `docs` whose text is in a learned language, with all their columns as they are.

    A text of `long` code points needs a `lang_fit` of `cut`, a shorter one of `loose`. Null texts, texts without a
    letter and, with an empty model, all texts go. Rows are judged one by one in the tasks that read them.
    """
    langs, logs, bits = model
    letter = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text_col))
            fits = np.zeros(batch.num_rows)
            for first, last, data, offsets in chunks(column, piece(langs)):
                owner, slot = trigrams(data, offsets, bits)
                fits[first:last] = mixtures(owner, slot, last - first, logs, bits)[2]
            need = np.where(pc.utf8_length(column).to_numpy(zero_copy_only=False) >= long, cut, loose)
            yield batch.filter(pa.array(fits >= need))

    return docs.where(letter & F.lit(bool(langs))).mapInArrow(keep, docs.schema)


def calibrated(labelled: DataFrame, model: tuple[list[str], np.ndarray, int], loose: float, long: int, text_col: str = "text",
               lang_col: str = "lang") -> float:
    """The cut for texts of `long` code points or more: halfway between `loose` and what 99 of 100 rows of `labelled` reach.

    Only rows whose label the model agrees with count; without any the cut is `loose`.
    """
    own = labelled.where(F.col(lang_col).isNotNull() & (F.length(text_col) >= long)).select(F.col(text_col).alias("text"), F.col(lang_col).alias("label"))
    low = identify(own, model).where("lang_pred = label").agg(F.percentile_approx("lang_fit", 0.01, 10000)).first()[0]
    return loose if low is None else max(loose, (loose + low) / 2)
