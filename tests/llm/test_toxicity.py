import math
import random

import numpy as np
import pyarrow as pa
import pytest

from newsloom.llm import toxicity
from newsloom.llm.common import chunks

DOCS, LABELS = "doc_id long, text string, toxic int, score string", "doc_id long, quality int, toxic int"


def naive(rows, passes, alpha=1.0, beta=1.0, l1=10.0, l2=0.0):
    """The rule per coordinate, in dictionaries."""
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(passes):
        for features, label in rows:
            w = {i: weight(i) for i in features}
            g = 1 / (1 + math.exp(-sum(w.values()))) - label
            for i in features:
                sigma = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / alpha
                z[i] = z.get(i, 0.0) + g - sigma * w[i]
                n[i] = n.get(i, 0.0) + g * g
    return {i: weight(i) for i in z}


def test_rule_matches_the_naive_form():
    rng = random.Random(2)
    rows = [(sorted(rng.sample(range(50), 8)), rng.randint(0, 1)) for _ in range(200)]
    model = toxicity.Ftrl(l1=1.0)
    for _ in range(2):
        for slots, label in rows:
            model.learn(np.array(slots), label)
    want = naive(rows, 2, l1=1.0)
    assert model.weights(np.array(sorted(want))) == pytest.approx([want[i] for i in sorted(want)], abs=1e-9)


def test_features_do_not_cross_texts():
    def of(texts):
        out = [[] for _ in texts]
        for first, _, data, offsets in chunks(pa.array(texts)):
            for owner, slot in zip(*toxicity.features(data, offsets)):
                out[first + owner].append(int(slot))
        return [sorted(x) for x in out]
    texts = ["a b c", "", "A, b!! C", "c", "d e f g h"]
    assert of(texts) == [of([t])[0] for t in texts]
    assert of(texts)[0] == of(texts)[2] and len(of(texts)[4]) == 5 + 4 + 3


def corpus():
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(4))
    docs, labels = [], []
    for i in range(600):
        text, bad = [word() for _ in range(rng.randint(1, 40))], int(rng.random() < 0.3)
        for _ in range(3 * bad):
            text.insert(rng.randrange(len(text) + 1), rng.choice(["nasty", "vile"]))
        docs.append((i, " ".join(text), None, "s"))
        labels.append((i, 1, bad))
    return docs, labels


def test_held_out_accuracy_and_edges(spark):
    docs, labels = corpus()
    extra = [(1000, None, 1, ""), (1001, "", 1, ""), (1002, "... !", 1, ""), (None, "nasty vile", 1, ""), (1003, "vile nasty " * 100_000, 1, ""), (7, "vile vile nasty", 1, "")]
    d = spark.createDataFrame(docs + extra, DOCS)
    l = spark.createDataFrame(labels[:400] + [(None, 1, 1), (3, 1, None), (5000, 0, 1)], LABELS)
    model = toxicity.train(d.where("doc_id < 1000 AND text != 'vile vile nasty'"), l)
    again = toxicity.train(d.where("doc_id < 1000 AND text != 'vile vile nasty'").repartition(5), l.repartition(3))
    assert all((x == y).all() for x, y in zip(model, again))
    got = {}
    for r in toxicity.scores(d, model).collect():
        got.setdefault(r["doc_id"], []).append(r["score"])
    good = sum((got[i][0] >= 0.3) == bool(bad) for i, _, bad in labels[400:])
    assert good / 200 > 0.95
    assert got[1000] == got[1001] == got[1002] and 0 <= got[1000][0] < 0.3
    assert got[None][0] > 0.3 and got[1003][0] > 0.3 and max(got[7]) > 0.3
    none = toxicity.train(d, l.limit(0))
    assert {r["score"] for r in toxicity.scores(d, none).collect()} == {0.5}
    assert toxicity.scores(d.limit(0), model).collect() == []


def test_the_sample_bounds_the_rows(spark):
    docs, labels = corpus()
    d, l = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    small = toxicity.train(d, l, sample=20)
    assert len(small[0]) < len(toxicity.train(d, l)[0])


def test_a_labelled_id_that_docs_repeat_is_one_text_of_the_sample(spark, monkeypatch):
    docs, labels = corpus()
    once = toxicity.train(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))
    again = spark.createDataFrame(docs + [docs[0]] * 500, DOCS)
    many = toxicity.train(again, spark.createDataFrame(labels, LABELS))
    assert all((x == y).all() for x, y in zip(once, many))
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 2000)
    assert len(toxicity.train(again, spark.createDataFrame(labels, LABELS))[0]) < len(once[0])
