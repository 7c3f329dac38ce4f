import random
from collections import Counter

import pytest

from newsloom.llm import mixing
from newsloom.llm.mixing import mix, round_plan


def naive_slots(blocks, weights):
    """Slot of (source, block): round by round and slot by slot, over single blocks in a list."""
    sources = sorted(blocks, key=lambda s: (s is not None, s or ""))
    out, base, v = {}, 0, 0
    while True:
        now = {s: min(weights[s], blocks[s] - v * weights[s]) for s in sources if blocks[s] > v * weights[s]}
        if not now:
            return out
        width = sum(now.values())
        full = {s: blocks[s] // weights[s] for s in sources}
        jobs = []
        for s, n in now.items():
            last = int(v >= full[s])
            rank = (0 if last else -full[s], sources.index(s))
            jobs += [(q * width // n, -(-(q + 1) * width // n), n, last, q, rank, s) for q in range(n)]
        for t in range(width):
            job = min((j for j in jobs if j[0] <= t), key=lambda j: j[1:6])
            jobs.remove(job)
            assert t < job[1]
            out[job[6], v * weights[job[6]] + job[4]] = base + t
        base += width
        v += 1


@pytest.mark.parametrize("weights", [[1], [1, 1], [4, 3, 3, 2, 1, 1], [97, 1, 2], [5, 7, 11], [1] * 9 + [30], [3] * 50 + [2] * 70 + [40]])
def test_a_source_is_never_a_block_off_its_share(weights):
    classes = tuple(sorted((n, 0, m) for n, m in Counter(weights).items()))
    slots, total = {}, sum(weights)
    for n, _, q, first, count, slot in round_plan(classes):
        for i in range(count):
            slots[slot + i] = (n, first + i, q)
    assert sorted(slots) == list(range(total)) and len(set(slots.values())) == total
    done = Counter()
    members = [(n, r) for n, _, m in classes for r in range(m)]
    for t in range(total):
        n, rank, q = slots[t]
        assert done[n, rank] == q
        done[n, rank] += 1
        if total < 400 or t % 17 == 0:
            assert all(abs(done[x] - (t + 1) * x[0] / total) < 1 for x in members)


def test_thousands_of_sources(spark):
    rng = random.Random(2)
    docs = [(i, f"s{i % 20000}", "x" * rng.randint(1, 200)) for i in range(24000)]
    rows = mix(spark.createDataFrame(docs, "doc_id long, source string, text string"), {"s0": 5, "s1": 2}, block=64).collect()
    assert sorted(r["mix_position"] for r in rows) == list(range(len(docs)))
    size = Counter()
    for _, s, t in docs:
        size[s] += len(t) + 1
    # Every source begins in the first round, whose width is the sum of what the sources have in it.
    blocks = {s: -(-n // 64) for s, n in size.items()}
    width = sum(min({"s0": 5, "s1": 2}.get(s, 1), n) for s, n in blocks.items())
    assert all(r["mix_slot"] < width for r in rows if r["mix_block"] == 0)
    assert max(r["mix_slot"] for r in rows) < sum(blocks.values())


def brute(docs, weights, default, block):
    size = Counter()
    for _, s, t in docs:
        size[s] += len((t or "").encode()) + 1
    return naive_slots({s: -(-n // block) for s, n in size.items()}, {s: weights.get(s, default) for s in size})


def test_mixed_order(spark, monkeypatch):
    rng = random.Random(4)
    docs = [(i, rng.choice(["a", "a", "a", "b", "c", None]), rng.choice([None, "", "x" * rng.randint(1, 90), "ß" * 200])) for i in range(400)]
    docs += [(400, "a", "same"), (400, "a", "same"), (None, "b", "q"), (None, None, None)]
    df = spark.createDataFrame([(*d, -1, "z") for d in docs], "doc_id long, source string, text string, mix_slot int, start string")
    weights = {"a": 3, "b": 2}
    rows = mix(df, weights, block=64, group=30).collect()
    assert len(rows) == len(docs) and sorted(r["mix_position"] for r in rows) == list(range(len(docs)))
    slot_of = brute([(d, s, t) for d, s, t in docs], weights, 1, 64)
    rows.sort(key=lambda r: r["mix_position"])
    begun = {}
    for r in rows:
        begun.setdefault(r["source"], 0)
        assert r["mix_block"] == begun[r["source"]] // 64 or r["doc_id"] == 400
        assert r["mix_slot"] == slot_of[r["source"], r["mix_block"]]
        begun[r["source"]] += len((r["text"] or "").encode()) + 1
    assert [r["mix_slot"] for r in rows] == sorted(r["mix_slot"] for r in rows)
    monkeypatch.setattr(mixing, "SPAN", 2)
    assert rows == sorted(mix(df.repartition(7), weights, block=64, group=1000).collect(), key=lambda r: r["mix_position"])
    assert mix(df.limit(0), weights).collect() == []
    long = spark.createDataFrame([(1, "a", "y" * 1_000_000), (2, "a", "z"), (3, "b", "w")], "doc_id long, source string, text string")
    got = mix(long, {}, block=1 << 16).collect()
    assert {r["doc_id"]: r["mix_slot"] for r in got}[3] == 1 and sorted(r["mix_position"] for r in got) == [0, 1, 2]
    with pytest.raises(ValueError):
        mix(df, {"a": 0})
