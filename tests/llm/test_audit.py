import re
from collections import Counter
from itertools import permutations

from newsloom.llm import audit

SCHEMA = "doc_id long, text string, source string, own int, mask int, id string, part string, good string"


def fails(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    return {f for f, bad in (("A", len(words) < 50), ("B", 100 * len(set(words)) < 65 * len(words)),
                             ("C", 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text)), ("D", any(c in "#$%&*|" for c in text))) if bad}


def brute(docs, labels):
    """Every document is walked through every order, filter by filter."""
    rows = []
    for i, t, s in docs:
        t = t or ""
        f = fails(t) | ({"E"} if i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs) else set())
        mine = [row for row in labels if row[0] is not None and row[0] == i]
        rows.append((s or "", f, any(q == 1 for _, q, _ in mine), any(x == 1 for _, _, x in mine)))
    out = {}
    shapley = Counter()
    for part in {r[0] for r in rows}:
        for order in permutations("ABCDE"):
            left = [r for r in rows if r[0] == part]
            total = list(left)
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                shapley[part, f] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), sum(f in r[1] for r in total) - len(gone),
                                                   sum(r[1] == {f} for r in total), sum(r[2] for r in gone), sum(r[3] for r in gone)]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audited(spark, docs, labels):
    df = spark.createDataFrame([(*d, 1, 2, "x", "y", "z") for d in docs], SCHEMA)
    lab = spark.createDataFrame([(*row, 9) for row in labels], "doc_id long, quality int, toxic int, mask int")
    got = audit.interactions(audit.masks(df, lab)).collect()
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in (
        "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")) for r in got}


def test_every_order_matches_a_walk_through_all_documents(spark, monkeypatch):
    many = " ".join(f"w{i}" for i in range(60))
    texts = [many, many.upper(), "a b " * 40, many + " #", "", None, " \t\n", "short", "SHORT |", many + " x", "é" * 30, "x " * 49 + "x", "q" * 5000]
    docs = [(i, texts[i % len(texts)], ["s1", "s1", None, ""][i % 4]) for i in range(45)]
    docs += [(3, many, "s2"), (3, many, "s2"), (3, many, "s1"), (None, many, "s1"), (None, None, None)]
    labels = [(i, i % 2, i % 3 // 2) for i in range(0, 40, 2)] + [(3, 0, 1), (3, 1, None), (None, 1, 1), (5, None, None)]
    want = brute(docs, labels)
    assert audited(spark, docs, labels) == want
    monkeypatch.setattr(audit, "PIECE", 7)
    assert audited(spark, docs, labels) == want


def test_long_texts_are_judged_in_pieces():
    text = "word other " * 300_000 + "end"
    assert audit.own_fails(text) == 0b10
    assert list(audit.pieces("a b  c", 2)) == ["a b", " c"] and "".join(audit.pieces("x" * 99, 10)) == "x" * 99


def test_empty_table(spark):
    assert audited(spark, [], []) == {}


def test_intervals_cover_each_order_once():
    spans = audit.intervals(5)
    for mask in range(1, 32):
        hit = Counter(rank for m, _, low, high in spans if m == mask for rank in range(low, high))
        assert hit == Counter(range(120))
    assert len(spans) == 840
