import random

import pytest

from newsloom.llm.decontaminate import best_match, contaminated, passages, pieces

BUDGET = 0.2


def least_edits(item, text):
    """(edits, end) of the part of `text` nearest to `item`, by the full table."""
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, v in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (w != v)))
        row = new
    return min((e, j) for j, e in enumerate(row))


def test_bit_parallel_distance_matches_the_table():
    rng = random.Random(3)
    for _ in range(500):
        item = [rng.randint(0, 4) for _ in range(rng.randint(1, 90))]
        text = [rng.randint(0, 4) for _ in range(rng.randint(0, 60))]
        assert best_match(item, text) == least_edits(item, text)


def test_pieces_cover_the_item():
    for m in range(1, 80):
        parts = pieces(m, BUDGET)
        assert [a for a, _ in parts] == [sum(k for _, k in parts[:i]) for i in range(len(parts))]
        assert sum(k for _, k in parts) == m and min(k for _, k in parts) > 0


def test_passages_match_brute_force(spark):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 40)))) for i in range(15)]
    docs = []
    for i in range(80):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 50))]
        for _ in range(rng.randint(0, 2)):
            part = rng.choice(items)[1].split()
            for _ in range(rng.randint(0, 8)):
                at = rng.randrange(len(part) + 1)
                part[at:at + rng.randint(0, 1)] = [rng.choice(vocabulary)] * rng.randint(0, 1)
            at = rng.randrange(len(words) + 1)
            words[at:at] = part
        docs.append((i, ", ".join(w.upper() if rng.random() < 0.3 else w for w in words)))
    docs += [(80, None), (81, ""), (82, items[3][1]), (82, items[3][1])]
    items += [(15, None), (16, ""), (17, "!?")]
    d = spark.createDataFrame([(*x, "t", 1) for x in docs], "doc_id long, text string, item_id string, edits int")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(map(tuple, passages(d, b).collect()))
    want = []
    for i, text in docs:
        words = (text or "").lower().split(", " if i < 80 else " ")
        for n, item in items[:15]:
            part = item.split()
            edits, end = least_edits(part, words)
            if text and edits <= int(BUDGET * len(part) + 1e-9):
                want.append((i, n, edits, end))
    assert got == sorted(want)
    assert contaminated(passages(d, b)).where("doc_id = 82").first()["edits"] == 0
    assert passages(d.limit(0), b).collect() == [] and passages(d, b.limit(0)).collect() == []


def test_large_benchmarks_are_searched_in_passes(spark, monkeypatch):
    from newsloom.llm import decontaminate
    d = spark.createDataFrame([(1, "one two three four five six")], "doc_id long, text string")
    b = spark.createDataFrame([(i, f"{w} two three") for i, w in enumerate(["one", "x", "y", "one"])], "item_id long, text string")
    want = sorted(map(tuple, passages(d, b).collect()))
    monkeypatch.setattr(decontaminate, "PASS_BYTES", 15)
    assert sorted(map(tuple, passages(d, b).collect())) == want == [(1, 0, 0, 3), (1, 3, 0, 3)]


def test_item_ids_of_any_type_and_repeated_ids_at_any_pass_size(spark, monkeypatch):
    from newsloom.llm import decontaminate
    d = spark.createDataFrame([(1, "one two three four five six"), (2, "nine ten eleven")], "doc_id long, text string")
    b = spark.createDataFrame([("a", "one two three"), ("a", "two three four"), ("a", "one two three"), (None, "nine ten"), ("b", "zero")], "item_id string, text string")
    want = sorted([(1, "a", 0, 3), (1, "a", 0, 4), (1, "a", 0, 3), (2, None, 0, 2)], key=repr)
    assert sorted(map(tuple, passages(d, b).collect()), key=repr) == want
    monkeypatch.setattr(decontaminate, "PASS_BYTES", 14)
    assert sorted(map(tuple, passages(d, b).collect()), key=repr) == want


def test_a_piece_that_thousands_of_items_share_costs_no_verification(monkeypatch):
    from newsloom.llm import decontaminate
    rng = random.Random(5)
    tail = lambda: " ".join(f"t{rng.randrange(10 ** 6)}" for _ in range(12))
    items = ["what is the capital " + tail() for _ in range(2000)]
    text = "what is the capital of it " * 120 + items[7] + " and so on " + items[9].replace("is", "was")
    calls = []
    monkeypatch.setattr(decontaminate, "best_match", lambda a, b: (calls.append(1), best_match(a, b))[1])
    index = decontaminate.Index(items, BUDGET)
    for bound in (1 << 22, 500):
        monkeypatch.setattr(decontaminate, "HITS", bound)
        calls.clear()
        found = set()
        for _, _, data, offsets in decontaminate.chunks(decontaminate.pa.array([text, "", "the capital " * 50])):
            h, before = decontaminate.words(data, offsets, decontaminate.PUNCTUATION)
            found |= {(t, n, e) for t, n, e, _ in index.search(h, before)}
        assert {(t, n, min(e for u, m, e in found if (u, m) == (t, n))) for t, n, _ in found} == {(0, 7, 0), (0, 9, 1)}
        assert len(calls) < 40


@pytest.mark.parametrize("text,found", [("a b c d e", True), ("a b x d e", True), ("a x b x d e", False)])
def test_budget_of_one_edit_in_five_words(spark, text, found):
    d = spark.createDataFrame([(1, text)], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b c d e")], "item_id long, text string")
    assert bool(passages(d, b).collect()) is found
