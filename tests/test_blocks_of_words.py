"""Word vectors travel once per block and word."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.operators import semantic


def brute(texts, dims):
    words = {a: re.findall(r"\w+", x) for a, x in texts.items()}
    code = lambda w: int(hashlib.md5(w.encode()).hexdigest()[:8], 16)
    sketch = {a: sum((np.eye(dims)[code(w) % dims] * (1 if code(w) // dims % 2 == 0 else -1) for w in ws), np.zeros(dims)) for a, ws in words.items()}
    vector = {w: sum((sketch[a] for a, ws in words.items() for v in ws if v == w), np.zeros(dims)) for ws in words.values() for w in ws}
    return {a: np.mean([vector[w] for w in ws], 0) if ws else np.zeros(dims) for a, ws in words.items()}


@pytest.mark.parametrize("block_rows", [7, 1 << 20])
def test_word_vectors_equal_brute_force_in_any_blocks(spark, block_rows):
    rng = random.Random(3)
    texts = {f"a{i}": " ".join(rng.choices([f"w{k}" for k in range(25)], k=rng.randint(0, 20))) for i in range(30)}
    arts = spark.createDataFrame([*texts.items(), (None, "w1 w2 other")], "article_id string, title string").withColumn("abstract", F.lit(None).cast("string"))
    want = brute(texts, 5)
    out = semantic.word_vectors(arts, dims=5, block_rows=block_rows)
    got = {r.article_id: r.embedding for r in out.collect()}
    assert got.pop(None) == [0.0] * 5
    assert {a: pytest.approx(list(v)) for a, v in want.items()} == got
    # No vector is summed or joined per article and word.
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "summarizer" not in plan.lower() and not re.search(r"hashpartitioning\(term#\d+, _salt", plan)
