import random

import numpy as np
import pytest

from newsloom.llm import jaccard
from newsloom.llm.jaccard import components, jaccard_groups, overlap_bound, sketch


def brute(docs, n, percent):
    sets = {}
    for i, text in docs:
        w = "".join(c.lower() if c.isascii() else c for c in text or "").split()
        sets[i] = {tuple(w[j:j + n]) for j in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
    up = {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return sorted((i, len(sets[i]), find(i)) for i in ids)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + rng.choice("xyz") + rng.choice(["", "Q", "é"])
    line = [word() for _ in range(30)]
    docs = []
    for _ in range(12):
        text = [word() for _ in range(rng.randint(20, 120))]
        for _ in range(rng.randint(1, 14)):
            copy = list(text)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 5])):
                copy[rng.randrange(len(copy))] = word()
            if rng.random() < 0.3:
                copy = line + copy
            docs.append(" ".join(copy))
    docs += ["", None, "  \t", "one", "ONE", "one two", "two one", "a b c", "a b c", "a b c d e", " ".join(line), " ".join(line[:25])]
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("n,percent,side,group", [(4, 85, 512, 2000), (5, 80, 2, 3), (2, 60, 512, 3), (1, 100, 4, 2000)])
def test_groups_match_brute_force(spark, monkeypatch, n, percent, side, group):
    monkeypatch.setattr(jaccard, "SIDE", side)
    monkeypatch.setattr(jaccard, "GROUP", group)
    docs = corpus(n * percent)
    df = spark.createDataFrame([(*d, 7, "z") for d in docs], "doc_id long, text string, n int, component_id string")
    assert sorted(map(tuple, jaccard_groups(df, n, percent).collect())) == brute(docs, n, percent)


def test_odd_ids_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PICKED", 0)
    text = "q w e r t y u i o p a s d f g h j k l z"
    rows = [(3, text), (3, text), (None, text + " x"), (9, "other words stand in this text"), (9, text + " b"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, jaccard_groups(df, 4, 85).collect()), key=repr)
    assert got == sorted([(3, 17, None), (3, 17, None), (None, 18, None), (9, 3, 9), (9, 18, None), (None, 0, None)], key=repr)
    assert jaccard_groups(df.limit(0)).collect() == []


def test_bitmaps_never_rule_out_what_sets_share():
    rng = np.random.default_rng(7)
    for _ in range(300):
        pool = rng.integers(0, 1 << 63, 400).astype(np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 300))) for _ in range(2))
        shared = len(np.intersect1d(a, b))
        assert shared <= overlap_bound(sketch(a), sketch(b), len(a), len(b)) <= min(len(a), len(b))


def test_components_of_chains(spark):
    edges = [(i + 1, i) for i in range(0, 40)] + [(100, 90), (95, 100), (60, 61)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(41)}, 100: 90, 95: 90, 90: 90, 60: 60, 61: 60}
