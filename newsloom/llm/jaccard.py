"""Jaccard join of word n-grams by prefix filters under several global token orders, and the groups it links.

Two sets that are similar enough share a token among the first few of each under any order of all tokens, so a pair is
a candidate only if its prefixes meet under every order. The first order finds pairs by an equi-join on tokens, with bounds by
set size and position; tokens of crowded hash slots come last in it, which keeps common phrases out of prefixes. A
bitmap of each set bounds what a pair can share, and the other orders are looked at before a pair is verified on the
whole sets. Equal sets are one class from the start. Pairs of a token's members with its
cleanest member are looked at first; after that only pairs of different components are, so a large group of copies
is not expanded into all its pairs and no link between groups is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import SPACE, chunks, mix, numbered, words
from newsloom.session import stage

#: Slots of the token counts that the orders are made from: a table of this size goes to every task.
SLOTS = 1 << 16
#: Documents of one verification block and side.
SIDE = 512
#: Members of a token's group on one side of a join task.
GROUP = 2000
#: Rows of ids that may be broadcast to pick out their texts; more are joined by a shuffle.
PICKED = 500_000
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], np.uint64)
_SEEDS = (0x2545F4914F6CDD1D, 0x589965CC75374CC3)


def shingles(h: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of every n neighbouring words of one text; fewer words are one shingle, none are none."""
    k = min(n, len(h))
    if not k:
        return h[:0]
    out = np.full(len(h) - k + 1, np.uint64(k), np.uint64)
    for j in range(k):
        out = out * np.uint64(0xFF51AFD7ED558CCD) + h[j:len(h) - k + 1 + j] * _FACTORS[j % len(_FACTORS)]
    out = np.sort(mix(out))
    return out[np.concatenate([[True], out[1:] != out[:-1]])]


def sets_of(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    for first, last, data, offsets in chunks(column):
        h, before = words(data, offsets, SPACE)
        for i in range(last - first):
            yield shingles(h[before[i]:before[i + 1]], n)


def slot_levels(base: DataFrame, n: int) -> np.ndarray:
    """Per hash slot how far its tokens stand above the usual count: 0 for most, then by halves of powers of two."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for s in sets_of(batch.column(0), n):
                sums += np.bincount((s >> np.uint64(48)).astype(np.int64), minlength=SLOTS) if len(s) > SLOTS // 8 else 0
                if len(s) <= SLOTS // 8:
                    np.add.at(sums, (s >> np.uint64(48)).astype(np.int64), 1)
        slots = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int32)), pa.array(sums[slots])], ["slot", "n"])

    found = base.select("text").mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(SLOTS)
    counts[found["slot"].to_numpy()] = found["n"].to_numpy()
    usual = np.median(counts)
    return np.where(counts <= 1.25 * usual + 8, 0, np.log2(np.maximum(counts / max(usual, 1), 1) * 4).astype(np.int64) + 1)


def prefix_length(size: int, percent: int) -> int:
    return size - -(-percent * size // 100) + 1


def in_order(s: np.ndarray, levels: np.ndarray, order: int, length: int) -> np.ndarray:
    """32 bits of the first `length` tokens of a set under a global order."""
    turn = s if not order else mix(s + np.uint64(_SEEDS[order - 1]))
    # The level goes above the hash bits, so one sort of whole numbers orders by both.
    key = levels[(s >> np.uint64(48)).astype(np.int64)].astype(np.uint64) << np.uint64(57) | turn >> np.uint64(7)
    first = np.argpartition(key, length - 1)[:length] if length < len(s) else np.arange(len(s))
    first = first[np.argsort(key[first])]
    return (s[first] & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)


def sketch(s: np.ndarray) -> bytes:
    """A bitmap of about twice as many bits as the set has tokens; halving the bits keeps the order of slots."""
    bits = max(6, int(2 * len(s) - 1).bit_length()) if len(s) else 6
    out = np.zeros(1 << bits, np.uint8)
    out[(mix(s ^ np.uint64(_SEEDS[0])) >> np.uint64(64 - bits)).astype(np.int64)] = 1
    return np.packbits(out).tobytes()


def overlap_bound(a: bytes, b: bytes, n: int, m: int) -> int:
    """At most so many tokens can two sets of n and m tokens share: a bit that only one has is a token that only it has."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) != len(y):
        x, y = (z if len(z) == min(len(x), len(y)) else np.packbits(
            np.unpackbits(z).reshape(8 * min(len(x), len(y)), -1).any(1)) for z in (x, y))
    return min(n - int(np.bitwise_count(x & ~y).sum()), m - int(np.bitwise_count(y & ~x).sum()))


def sketched(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (`a`, `b`) whose bitmaps leave room for enough shared tokens; only bitmaps move for this."""
    a = sketches.selectExpr("row AS a", "n AS n_a", "sketch AS sketch_a")
    b = sketches.selectExpr("row AS b", "n AS n_b", "sketch AS sketch_b")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, n, m = (batch.column(i).to_pylist() for i in (2, 3, 4, 5))
            good = [(100 + percent) * overlap_bound(*z) >= percent * (z[2] + z[3]) for z in zip(x, y, n, m)]
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    return pairs.join(a, "a").join(b, "b").select("a", "b", "sketch_a", "sketch_b", "n_a", "n_b").mapInArrow(keep, "a long, b long")


def may_link(percent: int) -> str:
    """SQL: sizes are close enough, and so is what is left of both sets from the shared token on."""
    need = f"({percent} * (l.n + r.n) + {99 + percent}) div {100 + percent}"
    return (f"100 * least(l.n, r.n) >= {percent} * greatest(l.n, r.n) "
            f"AND least(l.n - l.pos, r.n - r.pos) >= {need}")


def components(edges: DataFrame) -> DataFrame:
    """(`node`, `component`): the smallest node reachable over `edges` (`a`, `b`), for every node that has an edge."""
    both = stage(edges.selectExpr("a AS node", "b AS other").union(edges.selectExpr("b", "a")).distinct(), "edges")
    labels = stage(both.groupBy("node").agg(F.least(F.min("other"), F.min("node")).alias("component")), "labels")
    while True:
        near = both.join(labels.selectExpr("node AS other", "component AS seen"), "other").groupBy("node").agg(F.min("seen").alias("seen"))
        lower = labels.join(near, "node").select("node", "component", F.least("component", "seen").alias("next"))
        jump = labels.selectExpr("node AS next", "component AS further")
        fresh = stage(lower.join(jump, "next").select("node", F.col("further").alias("component"), (F.col("further") < F.col("component")).alias("moved")), "labels")
        labels = fresh.select("node", "component")
        if not fresh.where("moved").limit(1).count():
            return labels


def verify(base: DataFrame, pairs: DataFrame, homes: DataFrame, levels: np.ndarray, n: int, percent: int) -> DataFrame:
    """The pairs (`a`, `b`) whose prefixes meet under all orders and whose sets are similar enough.

    Pairs are gathered by the homes of both sides, each cut into parts of about `SIDE` documents, so a text goes once to
    a block however many pairs it has there.
    """
    homes = homes.select("row", F.struct("home", F.pmod(F.xxhash64("row"), F.ceil(F.col("size") / SIDE)).alias("part")).alias("home"))
    placed = pairs.join(homes.selectExpr("row AS a", "home AS home_a"), "a").join(homes.selectExpr("row AS b", "home AS home_b"), "b")
    placed = stage(placed.select(F.xxhash64("home_a", "home_b").alias("block"), "a", "b"), "pairs")
    wanted = placed.selectExpr("block", "a AS row").union(placed.selectExpr("block", "b AS row")).distinct()
    rows = wanted.select("row").distinct()
    few = rows.limit(PICKED + 1).count() <= PICKED
    texts = base.select("row", "text").dropDuplicates(["row"]) if not few else base.select("row", "text").join(
        F.broadcast(rows), "row", "left_semi").dropDuplicates(["row"])
    needed = texts.join(wanted, "row").select(F.col("block").alias("at"), "row", "text")

    def check(pairs: pa.Table, texts: pa.Table) -> pa.Table:
        sets = dict(zip(texts.column("row").to_pylist(), sets_of(texts.column("text").combine_chunks(), n)))
        heads = {row: [frozenset(in_order(s, levels, o, prefix_length(len(s), percent)).tolist()) for o in range(1, len(_SEEDS) + 1)]
                 for row, s in sets.items()}
        good = []
        for a, b in zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist()):
            if any(x.isdisjoint(y) for x, y in zip(heads[a], heads[b])):
                continue
            x, y = sets[a], sets[b]
            both = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * both >= percent * (len(x) + len(y) - both):
                good.append((a, b))
        return pa.table({"a": pa.array([g[0] for g in good], pa.int64()), "b": pa.array([g[1] for g in good], pa.int64())})

    return stage(placed.groupBy("block").cogroup(needed.groupBy("at")).applyInArrow(check, "a long, b long"), "links")


def linked(base: DataFrame, n: int, percent: int) -> DataFrame:
    """(`row`, `n`, `component`) per row of `base` (`row`, `text`): set size and the smallest row its links lead to."""
    levels = slot_levels(base, n)

    def signature(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, one, two, heads, maps = [], [], [], [], []
            for s in sets_of(batch.column(1), n):
                sizes.append(len(s))
                one.append(int(s.sum(dtype=np.uint64)))
                two.append(int(mix(s).sum(dtype=np.uint64)))
                maps.append(sketch(s))
                heads.append(in_order(s, levels, 0, prefix_length(len(s), percent)) if len(s) else np.zeros(0, np.int32))
            ends = np.concatenate([[0], np.cumsum([len(x) for x in heads])]).astype(np.int32)
            flat = np.concatenate(heads) if heads else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(sizes, pa.int64()), pa.array(np.array(one, np.uint64).view(np.int64)),
                pa.array(np.array(two, np.uint64).view(np.int64)), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                pa.array(maps, pa.binary())], ["row", "n", "h1", "h2", "prefix", "sketch"])

    sets = stage(base.select("row", "text").mapInArrow(signature, "row long, n long, h1 long, h2 long, prefix array<int>, sketch binary"), "sets")
    kind = ["n", "h1", "h2"]
    classes = stage(sets.where("n > 0").groupBy(*kind).agg(F.min(F.struct("row", "prefix", "sketch")).alias("head")).select(
        *kind, "head.row", "head.prefix", "head.sketch"), "classes")
    postings = classes.select("row", "n", F.posexplode("prefix").alias("pos", "token"))
    groups = postings.groupBy("token").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct("pos", "row", "n")).alias("lead")).where("size > 1")
    shared = stage(postings.join(groups, "token"), "postings")
    homes = stage(shared.groupBy("row").agg(F.min(F.struct("pos", "token", "size")).alias("first")).selectExpr(
        "row", "first.token AS home", "first.size AS size"), "homes")
    pair = [F.least("l.row", "r.row").alias("a"), F.greatest("l.row", "r.row").alias("b")]
    clean = shared.select(F.struct("row", "n", "pos").alias("l"), F.col("lead").alias("r")).where(
        f"l.row != r.row AND {may_link(percent)}").select(*pair).distinct()
    sketches = classes.select("row", "n", "sketch")
    first = verify(base, sketched(clean, sketches, percent), homes, levels, n, percent)
    labels = components(first)
    known = shared.join(labels.withColumnRenamed("node", "row"), "row", "left").select(
        "token", "row", "n", "pos", "size", F.coalesce("component", "row").alias("component"))
    open_tokens = known.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    known = stage(known.join(open_tokens, "token", "left_semi").withColumn("slices", F.ceil(F.col("size") / GROUP)), "open-postings")
    left = known.withColumn("slice", F.pmod(F.xxhash64("row"), F.col("slices")))
    right = known.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)))
    across = left.alias("l").join(right.alias("r"), F.expr(
        f"l.token = r.token AND l.slice = r.slice AND l.row < r.row AND l.component != r.component AND {may_link(percent)}")
    ).select(*pair).distinct()
    second = verify(base, sketched(across, sketches, percent), homes, levels, n, percent)
    labels = components(first.union(second))
    member = sets.join(classes.select(*kind, F.col("row").alias("head")), kind, "left").select("row", "n", F.coalesce("head", "row").alias("head"))
    return member.join(labels.withColumnRenamed("node", "head"), "head", "left").select("row", "n", F.coalesce("component", "head").alias("component"))


def jaccard_groups(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: id, `n_shingles` (set size) and `component_id`, the smallest id its links lead to.

    Sets are the distinct n-word shingles of the whole text, A-Z lower-cased; a text of fewer words is one shingle, null and
    empty texts and those without words have none and are linked with nothing. Documents link when
    100 · |intersection| ≥ `percent` · |union|. Equal sets always link. A null id is the smallest; rows that agree in id and text
    are rows of one document. Texts of any length are cut into shingles whole; shingles are equal when 64 bits of their
    hashes are. Further columns are not
    read. An empty table gives an empty result.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent is above 0 and at most 100")
    base = numbered(docs, id_col, text_col)
    ids = base.select("row", "id").distinct()
    return linked(base, n, percent).join(ids, "row").join(ids.selectExpr("row AS component", "id AS component_id"), "component").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, with all their columns, whose id is the smallest of their group (see `jaccard_groups`).

    Texts without words are groups of their own and stay. Rows that agree in id and text stay or go together.
    """
    base = numbered(docs, id_col, text_col)
    stay = linked(base, n, percent).where("row = component").select("row").distinct()
    stay = base.select("row", "id", F.xxhash64("text").alias("__h")).join(stay, "row").select(F.col("id").alias("__id"), "__h").distinct()
    keyed = docs.withColumn("__hash", F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    return keyed.join(stay, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__h")), "left_semi").select(*docs.columns)
