"""Mixing sources to target weights by Pfair scheduling.

Each source's documents, in hashed order, fill blocks of `block` bytes, and w blocks of a source of weight w (or what it has
left) belong to one round. A round in which the sources have W blocks takes W slots. Block q of the n that a source has in
it may start in slot ⌊qW / n⌋ of the round and must end by slot ⌈(q + 1)W / n⌉; slots go to the released block of earliest
deadline. Then no source is ever a whole block ahead of or behind its share, and at the end of a round all are level, so
that rounds are planned apart from each other. When a source runs out, the others go on with their own weights.

Sources that have equally many blocks in a round are interchangeable: a round is planned by classes (blocks of a source,
number of such sources), and a member finds its slot by its rank in the class. So plans are as small as the weights, whatever
the number of sources and blocks; all else is joins and windows.
"""

from __future__ import annotations

import heapq
from functools import lru_cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.session import stage

#: Rounds, ranks or slots that one running sum or join key covers.
SPAN = 4096
_PLAN = "array<struct<n:long,last:int,q:long,first:long,count:long,slot:long>>"


@lru_cache(4096)
def round_plan(classes: tuple[tuple[int, int, int], ...]) -> list[tuple[int, int, int, int, int, int]]:
    """(n, last, q, first rank, ranks, first slot): the slots of block q of the members of each class of a round.

    `classes` are (blocks of each member, whether it is the last round of the members, members). Earliest deadline first among
    the released blocks, ties by class, then by block and rank; a class is cut where another block's release or deadline
    comes between its members.
    """
    width = sum(n * m for n, _, m in classes)
    jobs = sorted((q * width // n, -(-(q + 1) * width // n), n, last, q, m) for n, last, m in classes for q in range(n))
    heap: list[list[int]] = []
    out, slot, at = [], 0, 0
    while slot < width:
        while at < len(jobs) and jobs[at][0] <= slot:
            _, deadline, n, last, q, m = jobs[at]
            heapq.heappush(heap, [deadline, n, last, q, 0, m])
            at += 1
        _, n, last, q, first, m = heap[0]
        count = min(m - first, (jobs[at][0] if at < len(jobs) else width) - slot)
        out.append((n, last, q, first, count, slot))
        slot += count
        heap[0][4] += count
        if heap[0][4] == m:
            heapq.heappop(heap)
    return out


def running(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """`df` with `name`, the sum of `value` over the rows of smaller `key` (a long from 0), in two steps of `SPAN`."""
    part = df.withColumn("__g", F.floor(F.col(key) / SPAN).cast("long"))
    groups = part.groupBy("__g").agg(F.sum(value).alias("__n"))
    groups = groups.select("__g", (F.sum("__n").over(Window.orderBy("__g")) - F.col("__n")).alias("__g0"))
    own = F.sum(value).over(Window.partitionBy("__g").orderBy(key)) - F.col(value)
    return part.join(groups, "__g").withColumn(name, F.col("__g0") + own).drop("__g", "__g0")


def weight_of(source: Column, weights: dict[str, int], default: int) -> Column:
    out = F.lit(default)
    for name, w in weights.items():
        out = F.when(source.eqNullSafe(F.lit(name)), F.lit(w)).otherwise(out)
    return out.cast("long")


def rounds(sources: DataFrame) -> DataFrame:
    """(`round`, `n`, `last`, `q`, `first`, `count`, `at`, `span`): the plans of all rounds, slots counted from the first.

    `sources` has (`w`, `full`, `rest`): weight, rounds with all of it, and blocks in one more. Plans repeat a row for each
    stretch of `SPAN` ranks that they cover, so that a key of the join with documents stays small.
    """
    spans = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("full") - 1) / SPAN).cast("long"))).alias("s")
    each = F.explode(F.sequence(F.col("s") * SPAN, F.least(F.col("full"), F.col("s") * SPAN + SPAN) - 1)).alias("round")
    whole = sources.where("full > 0").select("w", "full", spans).select(each, F.col("w").alias("n"), F.lit(0).alias("last"))
    final = sources.where("rest > 0").select(F.col("full").alias("round"), F.col("rest").alias("n"), F.lit(1).alias("last"))
    classes = whole.unionByName(final).groupBy("round", "n", "last").agg(F.count(F.lit(1)).alias("m"))
    by_round = classes.groupBy("round").agg(F.sort_array(F.collect_list(F.struct("n", "last", "m"))).alias("classes"), F.sum(F.col("n") * F.col("m")).alias("width"))
    planned = F.udf(lambda rows: round_plan(tuple(map(tuple, rows))), _PLAN)
    table = running(by_round, "round", "width", "base").select("round", "base", F.explode(planned("classes")).alias("p"))
    stretch = F.sequence(F.floor(F.col("p.first") / SPAN).cast("long"), F.floor((F.col("p.first") + F.col("p.count") - 1) / SPAN).cast("long"))
    return table.select("round", "p.n", "p.last", "p.q", "p.first", "p.count", (F.col("base") + F.col("p.slot")).alias("at"), F.explode(stretch).alias("span"))


def schedule(units: DataFrame, weights: dict[str, int], default: int, block: int, group: int) -> DataFrame:
    """`units` (`source`, `turn`, `rows`, `bytes`, …) with `mix_block`, `mix_slot` and `mix_position`.

    Units of a source follow one another in the order of `turn`, then of all their other columns.
    """
    # A running sum per source in two steps: over ranges of the hashed order, then inside each range.
    bits = max(0, (units.count() // group).bit_length())
    cut = units.withColumn("cell", F.shiftright("turn", 64 - bits) if bits else F.lit(0).cast("long"))
    cells = cut.groupBy(F.col("source").alias("s"), F.col("cell").alias("c")).agg(F.sum("bytes").alias("upto"))
    upto = F.sum("upto").over(Window.partitionBy("s").orderBy("c"))
    cells = stage(cells.select("s", "c", (upto - F.col("upto")).alias("before"), upto.alias("upto")), "mix-cells")
    # A row per source: its rounds, and its rank among those of its weight (longest first, so that those still in a round are
    # the first ones) and among those that end alike.
    blocks = F.ceil(F.col("bytes") / block).cast("long")
    sources = cells.groupBy("s").agg(F.max("upto").alias("bytes")).withColumn("w", weight_of(F.col("s"), weights, default))
    sources = sources.select("s", "w", F.floor(blocks / F.col("w")).cast("long").alias("full"), (blocks % F.col("w")).alias("rest"))
    by_weight = Window.partitionBy("w").orderBy(F.desc("full"), F.asc_nulls_first("s"))
    by_end = Window.partitionBy("full", "rest").orderBy(F.asc_nulls_first("s"))
    sources = stage(sources.withColumns({"rank0": F.row_number().over(by_weight) - 1, "rank1": F.row_number().over(by_end) - 1}), "mix-sources")
    cells = cells.drop("upto").join(sources.withColumnRenamed("s", "name"), F.col("s").eqNullSafe(F.col("name"))).drop("name")
    ties = [F.asc_nulls_first(c) for c in units.columns if c not in ("source", "turn")]
    inner = Window.partitionBy("source", "cell").orderBy("turn", *ties).rowsBetween(Window.unboundedPreceding, 0)
    placed = (cut.withColumn("own", F.sum("bytes").over(inner) - F.col("bytes"))
              .join(cells, F.col("source").eqNullSafe(F.col("s")) & (F.col("cell") == F.col("c")))
              .withColumn("start", F.col("before") + F.col("own"))
              .withColumn("mix_block", F.floor(F.col("start") / block).cast("long")).drop("cell", "own", "s", "c", "before"))
    placed = placed.withColumn("round", F.floor(F.col("mix_block") / F.col("w")).cast("long"))
    last = F.col("round") >= F.col("full")
    placed = placed.withColumns({"last": last.cast("int"), "n": F.when(last, F.col("rest")).otherwise(F.col("w")),
                                 "q": F.col("mix_block") % F.col("w"), "rank": F.when(last, F.col("rank1")).otherwise(F.col("rank0"))})
    plan = stage(rounds(sources), "mix-plan")
    placed = placed.withColumn("span", F.floor(F.col("rank") / SPAN).cast("long")).join(plan, ["round", "n", "last", "q", "span"])
    placed = placed.where("rank >= first AND rank < first + count").withColumn("mix_slot", F.col("at") + F.col("rank") - F.col("first"))
    # Positions count rows in the order of slots, then inside a slot.
    slots = running(placed.groupBy("mix_slot").agg(F.sum("rows").alias("n")), "mix_slot", "n", "s0").select(F.col("mix_slot").alias("slot"), "s0")
    within = F.sum("rows").over(Window.partitionBy("mix_slot").orderBy("start"))
    return placed.withColumn("within", within).join(slots, F.col("mix_slot") == F.col("slot")).withColumn(
        "mix_position", F.col("s0") + F.col("within") - F.col("rows")).select(*units.columns, "mix_block", "mix_slot", "mix_position")


def mix(docs: DataFrame, weights: dict[str, int], default: int = 1, block: int = 1 << 20, id_col: str = "doc_id",
        source_col: str = "source", text_col: str = "text", group: int = 50_000) -> DataFrame:
    """`docs` with `mix_block`, `mix_slot` and `mix_position` (long, from 0): the order of the mixed corpus.

    `weights` are whole numbers per source, `default` holds for others; null is a source of its own. A document
    belongs to the block in which its first byte falls (each text counts one byte more than it has, so empty and null
    texts have a place); one longer than a block takes up the slots of the blocks it covers. Rows that agree in id,
    source and text have neighbouring places and share a block. There may be any number of sources. Every row is kept once, in one place. Columns of
    `docs` with the three new names are replaced. `group` is the number of rows that one task sorts.
    """
    if default < 1 or any(w < 1 or w != int(w) for w in weights.values()):
        raise ValueError("weights are whole numbers from 1")
    docs = docs.drop("mix_block", "mix_slot", "mix_position")
    keyed = docs.withColumns({"__source": F.col(source_col).cast("string"), "__id": F.col(id_col), "__tie": F.xxhash64(F.col(text_col))})
    units = stage(
        keyed.groupBy(F.col("__source").alias("source"), F.xxhash64("__id", F.lit(17)).alias("turn"), F.col("__id").alias("id"), F.col("__tie").alias("tie"))
        .agg(F.count(F.lit(1)).alias("rows"), F.sum(F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + 1).alias("bytes")), "mix-units")
    placed = schedule(units, weights, default, block, group).select(
        *(F.col(c).alias(f"__u_{c}") for c in ("source", "id", "tie", "rows")), "mix_block", "mix_slot", "mix_position")
    same = [F.col(f"__{c}").eqNullSafe(F.col(f"__u_{c}")) for c in ("source", "id")] + [F.col("__tie") == F.col("__u_tie")]
    out = keyed.join(placed, same[0] & same[1] & same[2])
    if (units.agg(F.max("rows")).first()[0] or 0) > 1:
        turn = F.row_number().over(Window.partitionBy("__source", "__id", "__tie").orderBy(F.lit(0))) - 1
        out = out.withColumn("mix_position", F.col("mix_position") + turn)
    return out.select(*docs.columns, "mix_block", "mix_slot", "mix_position")
