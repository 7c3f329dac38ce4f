import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from newsloom.llm import ctw
from newsloom.llm.common import held_out

SCHEMA = "doc_id long, text string, score double, n int"


def log_kt(a, b):
    return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)


def symbols(text):
    return [*text.encode(), 256]


def steps(symbol):
    yield 0, int(symbol == 256)
    if symbol != 256:
        for j in range(8):
            yield (1 << j) | (symbol >> (8 - j)), symbol >> (7 - j) & 1


def contexts(text):
    """(bytes before, latest first, zeros at the start; symbol)"""
    s = symbols(text)
    for i, x in enumerate(s):
        yield tuple(s[i - k] if i >= k else 0 for k in range(1, ctw.DEPTH + 1)), x


def brute(train, score):
    counts = defaultdict(lambda: [0, 0])
    children = defaultdict(set)
    for text in train:
        for past, x in contexts(text):
            for node, bit in steps(x):
                for d in range(ctw.DEPTH + 1):
                    counts[past[:d], node][bit] += 1
                    if d:
                        children[past[:d - 1], node].add(past[:d])
    mixed = {}

    def mix(past, node):
        if (past, node) not in mixed:
            kt = log_kt(*counts[past, node])
            if len(past) == ctw.DEPTH:
                mixed[past, node] = kt
            else:
                below = sum(mix(p, node) for p in children[past, node])
                top = max(kt, below)
                mixed[past, node] = math.log(0.5) + top + math.log(math.exp(kt - top) + math.exp(below - top))
        return mixed[past, node]

    def predict(past, node):
        acc, left = 0.0, 1.0
        for d in range(ctw.DEPTH + 1):
            a, b = counts.get((past[:d], node), (0, 0))
            one = (b + 0.5) / (a + b + 1)
            if d == ctw.DEPTH or past[:d + 1] not in children.get((past[:d], node), ()):
                return acc + left * one
            w = math.exp(math.log(0.5) + log_kt(a, b) - mix(past[:d], node))
            acc, left = acc + left * w * one, left * (1 - w)

    return [sum(math.log10(predict(past, node) if bit else 1 - predict(past, node))
                for past, x in contexts(text) for node, bit in steps(x)) for text in score]


def base(train, text):
    tokens = Counter(t for x in train for t in [*x.encode().lower().split(), None])
    n, v = sum(tokens.values()), len(tokens)
    own = [*text.encode().lower().split(), None]
    return len(own), sum(tokens[t] > 0 for t in own), n, sum(math.log10((tokens[t] + 1) / (n + v + 1)) for t in own)


@pytest.mark.parametrize("block", [1 << 22, 300])
def test_scores_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ctw, "BLOCK", block)
    if block < 1000:  # several trees per group, several slices of the asking blocks
        monkeypatch.setattr(ctw, "KEYS", 5)
        monkeypatch.setattr(ctw, "ASKERS", 2)
    rng = random.Random(block)
    docs = [(i, " ".join(rng.choice(["ab", "Ab", "ébc", "cab", "x\ty"]) for _ in range(rng.randint(0, 30)))) for i in range(40)]
    docs += [(40, None), (41, ""), (42, docs[3][1]), (43, "\0\0")]
    df = spark.createDataFrame([(*d, 1.0, 1) for d in docs], SCHEMA)
    got = {r["doc_id"]: r for r in ctw.score_texts(df, ~held_out(F.col("id"), 7)).collect()}
    train = [t or "" for i, t in docs if zlib.crc32(str(i).encode()) % 7 != 2]
    want = brute(train, [t or "" for _, t in docs])
    assert len(got) == len(docs)
    for (i, text), score in zip(docs, want):
        n, known, total, logs = base(train, text or "")
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["base_score"] == pytest.approx(logs, abs=1e-9)
        assert r["score"] == pytest.approx(score, abs=1e-7)


def test_no_training_texts_and_empty_tables(spark):
    df = spark.createDataFrame([(2, "ab", 1.0, 1), (None, None, None, None)], SCHEMA)
    got = {r["doc_id"]: r for r in ctw.score_texts(df, F.lit(False)).collect()}
    assert got[2]["score"] == pytest.approx(-(9 + 9 + 1) * math.log10(2))
    assert (got[2]["n_known"], got[2]["train_tokens"], got[2]["base_score"]) == (0, 0, 0.0)
    assert got[None]["n_tokens"] == 1
    assert ctw.score_texts(df.limit(0), F.lit(True)).collect() == []


def test_every_context_has_probabilities_that_add_up_to_one():
    import numpy as np
    keys, times = ctw.tally(ctw.keys_of(np.frombuffer(b"abracadabra", np.uint8), np.array([0, 11]))[1])
    tree = ctw.Forest(keys, times)
    near = [np.full((256, 256), x) for x in (0.5, 0.1, 0.8)]
    every = (keys[3] >> 9 << 9) | np.arange(257)
    assert np.exp(tree.log_probability(every, *near)).sum() == pytest.approx(1)
