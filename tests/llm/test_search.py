import math
import re
from collections import Counter

import numpy as np
import pytest

from newsloom.llm import search

SCHEMA = "doc_id long, text string, score string, rank int, item_id long, terms string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    bags = [(i, Counter(words(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    total, length = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        rows = []
        for i, bag in bags:
            m = 100 - 75 + (75 * sum(bag.values()) * total) // length
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((1000000000 * bag[t]) // (1000 * bag[t] + 8 * m)) for t in words(text) if t in bag)
            if score:
                rows.append((-score, i is None, i or 0, i))
        out += [(item, n, r[3], -r[0]) for n, r in enumerate(sorted(rows)[:k], 1)]
    return sorted(out, key=repr)


def ranked(spark, docs, items, **more):
    df = spark.createDataFrame([(*d, "x", 1, 2, "y") for d in docs], SCHEMA).repartition(3)
    asked = spark.createDataFrame([(*i, "z", 5) for i in items], "item_id long, text string, score string, doc_id int")
    return sorted((tuple(r) for r in search.ranked(df, asked, **more).collect()), key=repr)


@pytest.fixture
def table():
    rng = np.random.default_rng(3)
    docs = [(int(i), " ".join(f"w{int(x)}" for x in rng.zipf(1.4, rng.integers(1, 60)) % 300)) for i in rng.permutation(400)]
    docs += [(1000 + i, "Same text, AGAIN été.") for i in range(40)] + [(2000, None), (2001, ""), (2002, " ,.;"), (2003, "É é" * 3)]
    docs += [(7, "w1 w2 twice"), (7, "w1 w2 twice"), (None, "w1 w2"), (None, "same text"), (3000, "long " * 90_000 + "w299")]
    items = [(1, "w1 w2 w2 w3"), (2, "same text again ÉTÉ été"), (3, "nothing"), (4, None), (5, ""), (6, docs[5][1]), (7, "w299 LONG"), (7, "w1"), (8, " ".join(f"w{i}" for i in range(300)))]
    return docs, items


def test_ranking_matches_brute_force(spark, table, monkeypatch):
    docs, items = table
    want = brute(docs, items)
    assert ranked(spark, docs, items) == want
    # Small segments, steps, pieces and passes change nothing.
    for name, value in (("SEGMENT", 40), ("STEP", 1), ("PIECE", 16), ("PASS_BYTES", 100), ("FAN", 1)):
        monkeypatch.setattr(search, name, value)
    assert ranked(spark, docs, items) == want
    assert ranked(spark, docs, items, k=3) == brute(docs, items, 3)


def test_empty_tables(spark, table):
    docs, items = table
    assert ranked(spark, [], items) == [] and ranked(spark, docs, []) == []
    assert ranked(spark, [(1, None)], items) == []


def test_range_maxima_and_pruning():
    rng = np.random.default_rng(5)
    docs, names = 500, 12
    cells = sorted({(int(t), int(d)) for t, d in zip(rng.integers(0, names, 3000), rng.integers(0, docs, 3000))})
    term, doc = np.array([c[0] for c in cells]), np.array([c[1] for c in cells])
    impact = (rng.pareto(1.5, len(cells)) * 100).astype(np.int64)
    segment = search.Segment(docs, term, doc, impact)
    asked = np.arange(names)
    for low, high in rng.integers(0, docs, (50, 2)):
        a, b = segment.places(asked, min(low, high)), segment.places(asked, max(low, high))
        bound, _ = segment.maxima(a[None, :], b[None, :], np.ones(names, np.int64))
        want = sum(max((v for t, d, v in zip(term, doc, impact) if t == x and min(low, high) <= d < max(low, high)), default=0) for x in asked)
        assert bound[0] == want
    seen = []
    inner = segment.maxima
    segment.maxima = lambda low, high, times: (seen.append(len(low)), inner(low, high, times))[1]
    best = segment.search(asked, np.ones(names, np.int64), 10, list(range(docs)), [])
    totals = np.bincount(doc, impact, docs).astype(int)
    assert [(-s, i) for s, i in best] == sorted(((int(v), i) for i, v in enumerate(totals)), key=lambda r: (-r[0], r[1]))[:10]
    assert sum(seen) < docs  # far fewer intervals than two per document
