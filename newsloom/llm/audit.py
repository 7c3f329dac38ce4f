"""How quality filters overlap: what every order of five filters removes, from one count per set of failed filters.

A document's mask is the set of filters that it fails. In lexicographic order of all permutations (their Lehmer rank),
those that begin with a given prefix are neighbours: a prefix of s letters covers (5 - s)! ranks. A document leaves at step s
exactly under the prefixes whose last letter is in its mask and whose other letters are not. So a mask is a few intervals of
ranks; its count is added where an interval begins and taken off where it ends, and a running sum over the 120 ranks gives
the documents removed under each order. Documents are read once, whatever the number of orders.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.operators.skew import hot_keys, skew_join
from newsloom.session import stage

FILTERS = "ABCDE"
#: Code points of a text whose words are held at a time.
PIECE = 1 << 20
_SPACE = re.compile(r"[\x20\x09-\x0D]")
_CAPITALS = bytes(range(65, 91))
_MARKS = re.compile(r"[#$%&*|]")


def pieces(text: str, limit: int = PIECE) -> Iterator[str]:
    """`text` cut at white space into parts of about `limit` code points; a longer word stays whole."""
    first = 0
    while len(text) - first > limit:
        cut = _SPACE.search(text, first + limit)
        if not cut:
            break
        yield text[first:cut.start()]
        first = cut.end()
    yield text[first:]


def own_fails(text: str) -> int:
    """Bits 0 to 3: fewer than 50 words; under 65 % distinct words; over 5 % capitals; a mark of `#$%&*|`."""
    count, seen = 0, set()
    for part in pieces(text):
        words = part.encode().split()  # on bytes: the white space of the contract and nothing else
        count += len(words)
        seen.update(words)
    raw = text.encode()
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    return ((count < 50) | (100 * len(seen) < 65 * count) << 1 | (100 * capitals > 5 * len(text)) << 2
            | (_MARKS.search(text) is not None) << 3)


def masks(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(`id`, `part`, `mask`, `good`, `toxic`), one row per row of `docs`: the filters it fails, as bits A to E, and its labels.

    E holds where another row with the same text has a smaller id; texts are compared by SHA-256, so that they are not
    shuffled. Null texts are empty, null parts the empty string. A row without id never fails E and has no label; rows that
    share id and text don't fail E through each other. An id with several label rows is good (toxic) if one of them says so.
    """
    kind = dict(docs.select(id_col).dtypes)[id_col]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits, digests = [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                bits.append(own_fails(text))
                digests.append(hashlib.sha256(text.encode()).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(bits, pa.int32()), pa.array(digests, pa.binary()),
                 pa.array(range(batch.num_rows), pa.int32())], ["id", "part", "own", "digest", "turn"])

    slim = docs.select(F.col(id_col), F.col(text_col), F.coalesce(F.col(part_col).cast("string"), F.lit("")))
    rows = stage(slim.mapInArrow(judge, f"id {kind}, part string, own int, digest binary, turn int"), "masks")
    groups = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("_n"), F.min("id").alias("first"))
    copied = stage(groups.where("_n > 1"), "copied")
    hot = hot_keys(rows, ["digest"], counts=copied.select("digest", "_n"))
    rows = skew_join(rows, copied.select("digest", "first"), ["digest"], "left", hot, spread=["turn"])
    flag = {name: F.max((F.col(column) == 1).cast("int")) for name, column in (("good", "quality"), ("toxic", "toxic"))}
    marked = labels.groupBy(F.col("doc_id").alias("id")).agg(*[F.coalesce(c, F.lit(0)).alias(n) for n, c in flag.items()])
    late = F.coalesce(F.col("id") > F.col("first"), F.lit(False)).cast("int") * 16
    return rows.join(marked, "id", "left").select(
        "id", "part", (F.col("own") + late).alias("mask"), F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


def intervals(n: int) -> list[tuple[int, int, int, int]]:
    """(mask, step, first rank, rank after the last) of the orders of `n` filters under which `mask` leaves at `step`."""
    ranks = {order: rank for rank, order in enumerate(permutations(range(n)))}
    out = []
    for step in range(1, n + 1):
        width = math.factorial(n - step)
        for prefix in permutations(range(n), step):
            low = ranks[prefix + tuple(sorted(set(range(n)) - set(prefix)))]
            free = [i for i in range(n) if i not in prefix]
            for some in range(1 << len(free)):
                mask = 1 << prefix[-1] | sum(1 << f for i, f in enumerate(free) if some >> i & 1)
                out.append((mask, step, low, low + width))
    return out


def interactions(rows: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of `filters` and step: what is kept, removed, redundant, and lost, in documents of the part.

    `rows`: (`part`, `mask`, `good`, `toxic`) per document. Columns: `part`, `filter_order`, `step`, `filter`, `kept`,
    `removed`, `redundant`, `unique_fails`, `good_lost`, `toxic_lost`, `shapley` (removals of the step's filter over all
    orders). All but the last aggregation run on at most 2^n counts per part. No rows give no rows.
    """
    spark, n = rows.sparkSession, len(filters)
    table = stage(rows.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")), "mask-counts")
    spans = spark.createDataFrame(intervals(n), "mask int, step int, low int, high int")  # 840 rows for five filters
    ends = F.explode(F.array(F.struct(F.col("low").alias("rank"), F.lit(1).alias("sign")), F.struct(F.col("high").alias("rank"), F.lit(-1).alias("sign"))))
    edges = (table.join(F.broadcast(spans), "mask").select("part", "step", "n", "good", "toxic", ends.alias("end"))
             .groupBy("part", "step", F.col("end.rank").alias("rank"))
             .agg(*[F.sum(F.col(c) * F.col("end.sign")).alias(c) for c in ("n", "good", "toxic")]))
    orders = ["".join(p) for p in permutations(filters)]
    steps = [F.struct(F.lit(s).alias("step"), F.substring("filter_order", s, 1).alias("filter")) for s in range(1, n + 1)]
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("filter"), F.lit(1 << i).alias("bit")) for i, name in enumerate(filters)]))
    has = F.col("mask").bitwiseAND(F.col("bit")) != 0
    fails = table.select("*", each.alias("f")).select("part", "mask", "n", "f.*").groupBy("part", "filter").agg(
        F.sum(F.when(has, F.col("n")).otherwise(0)).alias("fails"),
        F.sum(F.when(F.col("mask") == F.col("bit"), F.col("n")).otherwise(0)).alias("unique_fails"), F.sum("n").alias("total"))
    places = spark.createDataFrame(list(enumerate(orders)), "rank int, filter_order string").select("*", F.explode(F.array(*steps)).alias("s"))
    places = places.select("rank", "filter_order", "s.step", "s.filter")  # 600 rows for five filters
    grid = fails.join(F.broadcast(places), "filter").join(edges, ["part", "step", "rank"], "left").repartition("part")
    up = Window.partitionBy("part", "step").orderBy("rank")
    swept = grid.select("part", "filter_order", "rank", "step", "filter", "fails", "unique_fails", "total", *[
        F.sum(F.coalesce(F.col(c), F.lit(0))).over(up).alias(name) for c, name in (("n", "removed"), ("good", "good_lost"), ("toxic", "toxic_lost"))])
    down = Window.partitionBy("part", "rank").orderBy("step")
    return swept.select(
        "part", "filter_order", "step", "filter", (F.col("total") - F.sum("removed").over(down)).alias("kept"), "removed",
        (F.col("fails") - F.col("removed")).alias("redundant"), "unique_fails", "good_lost", "toxic_lost",
        F.sum("removed").over(Window.partitionBy("part", "filter")).alias("shapley"))


#: The same table straight from the definition, in DuckDB SQL over `documents` and `labels`.
SQL = r"""
WITH raw AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part FROM documents),
     cut AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS first FROM raw),
     lab AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id),
     d AS (SELECT part, [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w), 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t),
                         regexp_matches(t, '[#$%&*|]'), coalesce(c.doc_id > first, false)] AS f, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad
           FROM cut c LEFT JOIN lab ON lab.doc_id = c.doc_id),
     m AS (SELECT part, f, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM d GROUP BY part, f),
     l AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
     p AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM l a, l b, l c, l d, l e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
     x AS (SELECT part, o, s.i AS step, sum(n) AS total, sum(CASE WHEN f[o[s.i]] THEN n ELSE 0 END) AS fails,
                  sum(CASE WHEN f[o[s.i]] AND list_sum([CAST(v AS INTEGER) FOR v IN f]) = 1 THEN n ELSE 0 END) AS alone,
                  sum(CASE WHEN h THEN n ELSE 0 END) AS removed, sum(CASE WHEN h THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN h THEN bad ELSE 0 END) AS toxic_lost
           FROM (SELECT m.*, o, s.i AS i, f[o[s.i]] AND NOT coalesce(list_bool_or([f[v] FOR v IN o[1:s.i - 1]]), false) AS h FROM m, p, l s) s GROUP BY part, o, s.i)
SELECT part, array_to_string([substr('ABCDE', v, 1) FOR v IN o], '') AS filter_order, CAST(step AS INTEGER) AS step, substr('ABCDE', o[step], 1) AS filter,
       CAST(total - sum(removed) OVER (PARTITION BY part, o ORDER BY step) AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(fails - removed AS BIGINT) AS redundant, CAST(alone AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, o[step]) AS BIGINT) AS shapley
FROM x
"""
