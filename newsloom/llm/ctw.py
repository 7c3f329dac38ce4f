"""Language-model scoring by context-tree weighting over bytes.

A byte (or the end of the text) is nine binary decisions: end or not, then the eight bits from the top. Each decision
has a Krichevsky-Trofimov estimate in every context of 0 to `DEPTH` preceding bytes, and the estimates of all depths
are mixed with the weights that the training counts give them. Contexts and counts come from all training texts.

Training counts (context, symbol) pairs in the map tasks and sums them in one shuffle. Scoring works in blocks of
texts: a block asks for the values of its own distinct keys, packed by key bucket; every bucket answers, `ASKERS` blocks at
a time; the block adds up its texts. Neither a task nor the driver ever holds the whole model: the driver gets the two lowest depths.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import buffers, chunks, numbered
from newsloom.session import stage

#: Bytes of context. With four, one pair of bytes has at most 2**16 · 257 keys, which bounds a group.
DEPTH = 4
END = 256
#: Text bytes per scoring block.
BLOCK = 4 << 20
#: Distinct keys that a counting task holds before it passes them on.
HELD = 1 << 20
#: Keys whose trees are held at a time, about a kB each, and keys of a group of byte pairs.
KEYS = 1 << 17
#: Blocks whose requests to a bucket are answered together.
ASKERS = 2048


def keys_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, context << 9 | symbol) of each byte and each text end; before a text stand zeros."""
    count = len(offsets) - 1
    sizes = np.diff(offsets) + 1
    ends = np.cumsum(sizes)
    n = int(ends[-1]) if count else 0
    owner = np.repeat(np.arange(count), sizes)
    symbol = np.full(n, END, np.int64)
    inner = np.ones(n, bool)
    inner[ends - 1] = False
    symbol[inner] = data
    begin = np.repeat(ends - sizes, sizes)
    place = np.arange(n) - begin
    context = np.zeros(n, np.int64)
    for back in range(1, DEPTH + 1):
        some = np.zeros(n, np.int64)
        some[back:] = symbol[:-back] if n > back else symbol[:0]
        some[place < back] = 0
        context |= some << (8 * (back - 1))
    return owner, context << 9 | symbol


def tally(keys: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys in order, how often or the sum of `times`)."""
    if times is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys)
        keys, times = keys[order], times[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1]]))
    if times is None:
        return keys[first], np.diff(np.append(first, len(keys)))
    return keys[first], np.add.reduceat(times, first) if len(first) else times


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Of x ≥ 0.5, by Stirling's series after moving x up to 8 or more."""
    x = np.array(x, np.float64)
    shift = np.zeros_like(x)
    for _ in range(8):
        low = x < 8
        shift += np.where(low, np.log(np.where(low, x, 1.0)), 0.0)
        x = np.where(low, x + 1, x)
    r = 1 / x
    return (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + r / 12 - r**3 / 360 + r**5 / 1260 - shift


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Krichevsky-Trofimov log probability of n0 zeros and n1 ones."""
    return log_gamma(n0 + 0.5) + log_gamma(n1 + 0.5) - log_gamma(n0 + n1 + 1) - math.log(math.pi)


def decisions(symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in `symbol`, node, bit) of every decision: node 0 asks for the end, 1 to 255 are bit prefixes."""
    at = np.arange(len(symbol))
    byte = at[symbol != END]
    places, nodes, bits = [at], [np.zeros(len(at), np.int64)], [(symbol == END).astype(np.int64)]
    for j in range(8):
        value = symbol[byte]
        places.append(byte)
        nodes.append((1 << j) | (value >> (8 - j)))
        bits.append(value >> (7 - j) & 1)
    return np.concatenate(places), np.concatenate(nodes), np.concatenate(bits)


class Subtrees:
    """Nodes of depth 3 to `DEPTH` of the keys of whole depth-3 contexts, with counts and mixture weights."""

    def __init__(self, keys: np.ndarray, times: np.ndarray):
        at, node, bit = decisions(keys & 511)
        context, n = (keys >> 9)[at], times[at].astype(np.float64)
        self.ids, self.n0, self.n1, self.kt, self.mixed = {}, {}, {}, {}, {}
        below = None
        for depth in range(DEPTH, 1, -1):
            ids, back = np.unique((context & ((1 << 8 * depth) - 1)) << 8 | node, return_inverse=True)
            n1 = np.bincount(back, n * bit, len(ids))
            n0 = np.bincount(back, n, len(ids)) - n1
            children = np.zeros(len(ids))
            if below is not None:
                parent = (below >> 8 & ((1 << 8 * depth) - 1)) << 8 | below & 255
                children = np.bincount(np.searchsorted(ids, parent), self.mixed[depth + 1], len(ids))
            if depth == 2:
                self.above = ids, n0, n1, children
                break
            kt = log_kt(n0, n1)
            mixed = kt if below is None else math.log(0.5) + np.logaddexp(kt, children)
            self.ids[depth], self.n0[depth], self.n1[depth], self.kt[depth], self.mixed[depth] = ids, n0, n1, kt, mixed
            below = ids


class Forest:
    """The trees of a set of keys of whole depth-2 contexts, some whole depth-3 contexts of about `KEYS` keys at a time.

    Depth 2 is held for all of them: at most 256 nodes for each pair of bytes.
    """

    def __init__(self, keys: np.ndarray, times: np.ndarray):
        triple = keys >> 9 & 0xFFFFFF
        order = np.argsort(triple, kind="stable")
        self.keys, self.times, self.triple = keys[order], times[order], triple[order]
        starts = np.flatnonzero(np.concatenate([np.ones(min(len(keys), 1), bool), self.triple[1:] != self.triple[:-1]]))
        run = starts // KEYS
        self.cuts = starts[np.concatenate([np.ones(min(len(run), 1), bool), run[1:] != run[:-1]])]
        parts, self.tree = [], None
        for i in range(len(self.cuts)):
            self.tree = self.part(i)
            parts.append(self.tree.above)
        columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, np.int64)] + [np.zeros(0)] * 3
        self.ids, back = np.unique(columns[0], return_inverse=True)
        self.n0, self.n1, below = (np.bincount(back, c, len(self.ids)) for c in columns[1:])
        self.kt = log_kt(self.n0, self.n1)
        self.mixed = self.kt if DEPTH == 2 else math.log(0.5) + np.logaddexp(self.kt, below)

    def part(self, i: int) -> Subtrees:
        if self.tree is not None and len(self.cuts) == 1:
            return self.tree
        at = slice(self.cuts[i], self.cuts[i + 1] if i + 1 < len(self.cuts) else None)
        return Subtrees(self.keys[at], self.times[at])

    def log_probability(self, keys: np.ndarray, stop: np.ndarray, acc: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """Natural log of P(symbol | context) per key, given the mixture of depths 0 and 1 per (byte, node).

        A context that training never saw ends the path: the deepest one seen gets the weight that is left.
        """
        out = np.zeros(len(keys))
        first = self.triple[self.cuts] if len(self.cuts) else np.zeros(0, np.int64)
        part = np.maximum(np.searchsorted(first, keys >> 9 & 0xFFFFFF, side="right") - 1, 0)
        for i in range(max(len(self.cuts), 1)):
            mine = np.flatnonzero(part == i)
            if len(mine):
                # Trees are built again if there are several, so that one is held at a time.
                out[mine] = self._of(keys[mine], self.part(i) if len(self.cuts) else None, stop, acc, rest)
        return out

    def _of(self, keys: np.ndarray, tree: Subtrees | None, stop: np.ndarray, acc: np.ndarray, rest: np.ndarray) -> np.ndarray:
        at, node, bit = decisions(keys & 511)
        context = (keys >> 9)[at]
        near = context & 255
        p, sure, left = stop[near, node], acc[near, node].copy(), rest[near, node].copy()
        live = np.arange(len(at))
        for depth in range(2, DEPTH + 1):
            if depth == 2:
                ids, n0, n1, kt, mixed = self.ids, self.n0, self.n1, self.kt, self.mixed
            elif tree is None:
                break
            else:
                ids, n0, n1, kt, mixed = (x[depth] for x in (tree.ids, tree.n0, tree.n1, tree.kt, tree.mixed))
            if not len(ids):
                break
            want = (context[live] & ((1 << 8 * depth) - 1)) << 8 | node[live]
            found = np.minimum(np.searchsorted(ids, want), len(ids) - 1)
            seen = ids[found] == want
            live, found = live[seen], found[seen]
            one = (n1[found] + 0.5) / (n0[found] + n1[found] + 1)
            p[live] = sure[live] + left[live] * one
            weight = np.ones(len(live)) if depth == DEPTH else np.minimum(np.exp(math.log(0.5) + kt[found] - mixed[found]), 1.0)
            sure[live] += left[live] * weight * one
            left[live] *= 1 - weight
        return np.bincount(at, np.log(np.where(bit == 1, p, 1 - p)), len(keys))


def pair_group(key: Column, groups: int) -> Column:
    """The group of the two bytes before a symbol; keys of one pair are in one group."""
    return F.pmod(F.xxhash64(F.shiftright(key, 9).bitwiseAND(0xFFFF)), F.lit(groups)).cast("int")


def train(texts: DataFrame) -> DataFrame:
    """(`key`, `n`) over the `text` column: how often each context is followed by each symbol. Null counts as empty."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(keys, times):
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(times.astype(np.int64))], ["key", "n"])

        held, size = [], 0
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0)):
                held.append(tally(keys_of(data, offsets)[1]))
                size += len(held[-1][0])
                if size > 2 * HELD:
                    held = [tally(*(np.concatenate(x) for x in zip(*held)))]
                    size = len(held[0][0])
                    if size > HELD:
                        yield out(*held[0])
                        held, size = [], 0
        if held:
            yield out(*tally(*(np.concatenate(x) for x in zip(*held))))

    return texts.select("text").mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def roots(model: DataFrame, groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per (last byte, node): P(1) if the path ends at depth 1, the settled part of the mixture, the weight left.

    The driver gets one row per last byte and node at most: 2**16.
    """

    def top(batch: pa.Table) -> pa.Table:
        forest = Forest(batch.column("key").to_numpy(), batch.column("n").to_numpy())
        at, back = np.unique((forest.ids >> 8 & 255) << 8 | forest.ids & 255, return_inverse=True)
        n0, n1, mixed = (np.bincount(back, x, len(at)) for x in (forest.n0, forest.n1, forest.mixed))
        return pa.table({"near": (at >> 8).astype(np.int32), "node": (at & 255).astype(np.int32), "n0": n0, "n1": n1, "mixed": mixed})

    found = (model.groupBy(pair_group(F.col("key"), groups).alias("pair"))
             .applyInArrow(top, "near int, node int, n0 double, n1 double, mixed double")
             .groupBy("near", "node").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("mixed").alias("mixed")).toPandas())
    n0, n1, below = (np.zeros((256, 256)) for _ in range(3))
    at = (found["near"].to_numpy(), found["node"].to_numpy())
    for table, name in ((n0, "n0"), (n1, "n1"), (below, "mixed")):
        table[at] = found[name].to_numpy()
    kt = log_kt(n0, n1)
    mixed = math.log(0.5) + np.logaddexp(kt, below)
    all0, all1 = n0.sum(0), n1.sum(0)
    kt_root = log_kt(all0, all1)
    weight = np.minimum(np.exp(math.log(0.5) + kt_root - (math.log(0.5) + np.logaddexp(kt_root, mixed.sum(0)))), 1.0)
    one = (all1 + 0.5) / (all0 + all1 + 1)
    acc, rest = np.tile(weight * one, (256, 1)), np.tile(1 - weight, (256, 1))
    seen = n0 + n1 > 0
    here = (n1 + 0.5) / (n0 + n1 + 1)
    weight = np.minimum(np.exp(math.log(0.5) + kt - mixed), 1.0)
    stop = np.where(seen, acc + rest * here, one)
    return stop, acc + rest * weight * here, rest * (1 - weight)


def tokens_of(data: memoryview, a: int, b: int) -> list[bytes]:
    """Words of a text: A-Z lower-cased, cut at blanks and the bytes 09 to 0D."""
    return bytes(data[a:b]).lower().split()


def by_bucket(tokens, buckets: int) -> dict[int, list[bytes]]:
    out: dict[int, list[bytes]] = {}
    for token in sorted(tokens):
        out.setdefault(zlib.crc32(token) % buckets, []).append(token)
    return out


def key_buckets(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys in order of bucket and key, their buckets)."""
    bucket = ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(buckets)
    order = np.lexsort((keys, bucket))
    return keys[order], bucket[order].astype(np.int64)


def score_texts(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, `n_tokens`, `n_known`, `train_tokens`, `base_score`, `score`.

    `learn` is a condition on the id column, there called `id`, that picks the training texts. `score` is the log10 probability of
    the whole text and its end; `base_score` that of its words and one end under word counts with one added. Null
    counts as an empty text, which has one token, its end. Repeated ids and texts are counted and scored row by row,
    but rows that agree in id and text share a number and appear once per row. Without training texts every decision
    has probability one half. Texts of any length are scored whole, in one block. Further columns are not read.
    """
    spark = docs.sparkSession
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    base = numbered(docs, id_col, text_col).withColumn("learn", F.coalesce(learn, F.lit(False)))
    size, trained = base.agg(F.sum(F.octet_length("text")), F.sum(F.col("learn").cast("long"))).first()
    trained, blocks = trained or 0, max(1, (size or 0) // BLOCK + 1)
    model = stage(train(base.where("learn")), "ctw-counts")
    groups = max(parts, model.count() // KEYS + 1)
    stop, acc, rest = roots(model, groups)
    slices = blocks // ASKERS + 1
    salt = (F.col("block") % slices).cast("int")
    dealt = base.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks))).repartition(parts, "block")

    def ask_tokens(batch: pa.Table) -> pa.Table:
        data, offsets = buffers(batch.column("text"))
        raw, learned, other = memoryview(data), Counter(), set()
        for i, known in enumerate(batch.column("learn").to_pylist()):
            (learned if known else other).update(tokens_of(raw, offsets[i], offsets[i + 1]))
        found = by_bucket(learned.keys() | other, blocks)
        return pa.table({
            "bucket": pa.array(list(found), pa.int64()), "block": pa.array([batch.column("block")[0].as_py()] * len(found), pa.int64()),
            "tokens": pa.array([b"\n".join(x) for x in found.values()], pa.binary()),
            "n": pa.array([np.array([learned[t] for t in x], np.int64).tobytes() for x in found.values()], pa.binary())})

    def sum_tokens(batch: pa.Table) -> pa.Table:
        """One row for a bucket: its tokens of the rows given, and their counts added up."""
        total: Counter = Counter()
        for tokens, n in zip(batch.column("tokens").to_pylist(), batch.column("n").to_pylist()):
            for token, k in zip(tokens.split(b"\n"), np.frombuffer(n, np.int64).tolist()):
                total[token] += k
        counts = np.fromiter(total.values(), np.int64, len(total))
        return pa.table({"bucket": batch.column("bucket").slice(0, 1), "tokens": pa.array([b"\n".join(total)], pa.binary()),
                         "n": pa.array([counts.tobytes()], pa.binary()), "distinct": [int((counts > 0).sum())], "total": [int(counts.sum())]})

    def answer_tokens(asked: pa.Table, counted: pa.Table) -> pa.Table:
        total: dict[bytes, int] = {}
        for tokens, n in zip(counted.column("tokens").to_pylist(), counted.column("n").to_pylist()):
            total.update(zip(tokens.split(b"\n"), np.frombuffer(n, np.int64).tolist()))
        packs = [np.array([total[t] for t in x.split(b"\n")], np.int64).tobytes() for x in asked.column("tokens").to_pylist()]
        return pa.table({"block": asked.column("block"), "bucket": asked.column("bucket"), "kind": np.zeros(len(packs), np.int32), "values": pa.array(packs, pa.binary())})

    def ask_keys(batch: pa.Table) -> pa.Table:
        found = [tally(keys_of(data, offsets)[1])[0] for _, _, data, offsets in chunks(batch.column("text").combine_chunks())]
        keys, bucket = key_buckets(tally(np.concatenate(found))[0], blocks)
        first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        ends = np.append(first[1:], len(keys))
        return pa.table({"bucket": bucket[first], "block": np.full(len(first), batch.column("block")[0].as_py()),
                         "keys": pa.array([keys[a:b].tobytes() for a, b in zip(first, ends)], pa.binary())})

    def wanted_keys(batch: pa.Table) -> pa.Table:
        packs = [np.frombuffer(x, np.int64) for x in batch.column("keys").to_pylist()]
        return pa.table({"key": tally(np.concatenate(packs))[0]})

    def rate(batch: pa.Table) -> pa.Table:
        keys, n, asked = (batch.column(x).to_numpy() for x in ("key", "n", "asked"))
        learned = n > 0
        wish = keys[asked > 0]
        if not len(wish):
            return pa.table({"bucket": np.zeros(0, np.int64), "key": wish, "value": np.zeros(0)})
        wish, bucket = key_buckets(wish, blocks)
        return pa.table({"bucket": bucket, "key": wish, "value": Forest(keys[learned], n[learned]).log_probability(wish, stop, acc, rest)})

    def answer_keys(asked: pa.Table, rated: pa.Table) -> pa.Table:
        keys, value = rated.column("key").to_numpy(), rated.column("value").to_numpy()
        order = np.argsort(keys)
        keys, value = keys[order], value[order]
        packs = [value[np.searchsorted(keys, np.frombuffer(x, np.int64))].tobytes() for x in asked.column("keys").to_pylist()]
        return pa.table({"block": asked.column("block"), "bucket": asked.column("bucket"), "kind": np.ones(len(packs), np.int32), "values": pa.array(packs, pa.binary())})

    def to_all(df: DataFrame) -> DataFrame:
        """A bucket's rows for each slice of the blocks that ask it."""
        return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))

    answer, slice_ = "block long, bucket long, kind int, values binary", ["bucket", "salt"]
    asked_tokens = stage(dealt.groupBy("block").applyInArrow(ask_tokens, "bucket long, block long, tokens binary, n binary").withColumn("salt", salt), "ctw-tokens")
    packed = "bucket long, tokens binary, n binary, distinct long, total long"
    counted = asked_tokens.groupBy(*slice_).applyInArrow(sum_tokens, packed)
    if slices > 1:
        counted = counted.groupBy("bucket").applyInArrow(sum_tokens, packed)
    counted = stage(counted, "ctw-words")
    token_answers = asked_tokens.groupBy(*slice_).cogroup(to_all(counted).groupBy(*slice_)).applyInArrow(answer_tokens, answer)
    asked = dealt.groupBy("block").applyInArrow(ask_keys, "bucket long, block long, keys binary").withColumn("salt", salt).repartition(parts, *slice_)
    wanted = asked.groupBy(*slice_).applyInArrow(wanted_keys, "key long")
    rated = (model.select("key", "n", F.lit(0).alias("asked")).unionByName(wanted.select("key", F.lit(0).cast("long").alias("n"), F.lit(1).alias("asked")))
             .groupBy("key").agg(F.sum("n").alias("n"), F.max("asked").alias("asked"))
             .groupBy(pair_group(F.col("key"), groups).alias("pair")).applyInArrow(rate, "bucket long, key long, value double"))
    key_answers = asked.groupBy(*slice_).cogroup(to_all(rated).groupBy(*slice_)).applyInArrow(answer_keys, answer)
    answers = token_answers.unionByName(key_answers)

    def add_up(texts: pa.Table, found: pa.Table) -> pa.Table:
        column = texts.column("text").combine_chunks()
        data, offsets = buffers(column)
        raw = memoryview(data)
        packs: dict[int, dict[int, bytes]] = {0: {}, 1: {}}
        for kind, bucket, values in zip(*(found.column(x).to_pylist() for x in ("kind", "bucket", "values"))):
            packs[kind][bucket] = values
        lists = [tokens_of(raw, a, b) for a, b in zip(offsets[:-1], offsets[1:])]
        times: dict[bytes, int] = {}
        for bucket, tokens in by_bucket(set().union(*lists), blocks).items():
            times.update(zip(tokens, np.frombuffer(packs[0][bucket], np.int64).tolist()))
        sizes = np.array([len(x) for x in lists], np.int64)
        c = np.fromiter((times[t] for x in lists for t in x), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(lists)), sizes)
        keys = [tally(keys_of(d, o)[1])[0] for _, _, d, o in chunks(column)]
        keys, bucket = key_buckets(tally(np.concatenate(keys))[0], blocks)
        value = np.frombuffer(b"".join(packs[1][b] for b in np.unique(bucket).tolist()), np.float64)
        order = np.argsort(keys)
        keys, value = keys[order], value[order]
        score = np.zeros(len(lists))
        for first, last, d, o in chunks(column):
            who, key = keys_of(d, o)
            bits = max(1, int(last - first - 1).bit_length())
            both = np.sort(key << bits | who)
            score[first:last] = np.bincount(both & ((1 << bits) - 1), value[np.searchsorted(keys, both >> bits)], last - first)
        return pa.table({
            "id": texts.column("id"), "n_tokens": sizes + 1, "n_known": np.bincount(owner, c > 0, len(lists)).astype(np.int64) + int(trained > 0),
            "logs": np.bincount(owner, np.log10(c + 1.0), len(lists)) + math.log10(trained + 1), "score": score / math.log(10)})

    kind = dict(base.dtypes)["id"]
    summed = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        add_up, f"id {kind}, n_tokens long, n_known long, logs double, score double")
    totals = counted.agg(F.coalesce(F.sum("total"), F.lit(0)).alias("total"), F.coalesce(F.sum("distinct"), F.lit(0)).alias("distinct")).select(
        (F.col("total") + trained).alias("train_tokens"), (F.col("distinct") + int(trained > 0)).alias("vocabulary"))
    return summed.join(F.broadcast(totals)).select(
        F.col("id").alias(id_col), "n_tokens", "n_known", "train_tokens",
        (F.col("logs") - F.col("n_tokens") * F.log10(F.col("train_tokens") + F.col("vocabulary") + 1)).alias("base_score"), "score")
