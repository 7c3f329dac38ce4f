import hashlib
import random

import numpy as np
import pytest

from newsloom.llm.repeats import remove_repeats
from newsloom.llm import suffixes
from newsloom.llm.suffixes import doubled, suffix_array

SCHEMA = "doc_id long, text string, source string, row int, n string"


def brute(docs, length):
    """Every string of every text, in order of (id, start)."""
    seen, out = set(), {}
    for doc_id, text in sorted((d, t or "") for d, t in docs):
        data = text.encode()
        gone = np.zeros(len(data) + 1, bool)
        for i in range(len(data) - length + 1):
            s = data[i:i + length]
            if s in seen:
                gone[i:i + length] = True
            seen.add(s)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for i in range(len(data)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[doc_id] = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abé") for _ in range(rng.randint(1, 6)))
    passages = [" ".join(word() for _ in range(rng.randint(5, 60))) for _ in range(6)]
    docs = []
    for i in range(60):
        parts = [" ".join(word() for _ in range(rng.randint(0, 40)))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(passages), " ".join(word() for _ in range(rng.randint(0, 10)))]
        docs.append((i, " ".join(parts)))
    docs += [(60, None), (61, ""), (62, "a" * 700), (63, "ab" * 300), (64, docs[3][1]), (65, docs[3][1]), (66, "x" + docs[3][1] + "y")]
    return docs


@pytest.mark.parametrize("length,crowded", [(100, 4000), (40, 4000), (40, 2)])
def test_repeats_match_brute_force(spark, length, crowded):
    docs = corpus(length + crowded)
    df = spark.createDataFrame([(*d, "s", 1, "n") for d in docs], SCHEMA)
    got = {r[0]: tuple(r[1:]) for r in remove_repeats(df, length, crowded=crowded).collect()}
    assert got == brute(docs, length)


def test_repeats_of_odd_ids_and_empty_tables(spark):
    text = "abcdefghij" * 12
    rows = [(None, text), (5, text), (5, "z" + text), (5, text), (7, "short")]
    df = spark.createDataFrame([(*r, None, 1, None) for r in rows], SCHEMA)
    got = sorted(remove_repeats(df).collect(), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert len(got) == 5
    assert got[0]["n_removed"] < got[0]["n_bytes"] == 120
    assert all(r["n_removed"] == r["n_bytes"] for r in got if r["doc_id"] == 5 and r["n_bytes"] == 120)
    assert got[-1]["n_removed"] == 0
    assert remove_repeats(df.limit(0)).collect() == []


def test_suffix_arrays_match_sorting():
    rng = np.random.default_rng(5)
    for _ in range(300):
        s = np.append(rng.integers(1, rng.integers(2, 6), rng.integers(1, 80)), 0)
        want = sorted(range(len(s)), key=lambda i: s[i:].tolist())
        assert suffix_array(s, int(s.max()) + 1).tolist() == want
        assert doubled(s).tolist() == want


def test_long_strings_with_and_without_doubling(monkeypatch):
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(4000)]
    text = " ".join(rng.choice(words) for _ in range(9000)).encode()[:40_000]
    text += text[:5000]
    s = np.concatenate([np.frombuffer(text, np.uint8).astype(np.int64) + 1, [0]])
    want = [len(text)] + sorted(range(len(text)), key=lambda i: text[i:])
    for most, deep in ((1000, 2), (1 << 30, 3)):
        monkeypatch.setattr(suffixes, "SYMBOLS", most)
        sorted_, array = [], suffixes.suffix_array
        monkeypatch.setattr(suffixes, "suffix_array", lambda s, k: (sorted_.append(len(s)), array(s, k))[1])
        assert suffixes.suffix_array(s, 257).tolist() == want
        monkeypatch.setattr(suffixes, "suffix_array", array)
        # The text and its substrings' names at least; without doubling the names of those as well.
        assert len(sorted_) >= deep
