import hashlib
import re

from newsloom.llm import exact
from newsloom.llm.exact import directory, exact_duplicates, without_copies

SCHEMA = "doc_id long, text string, kept string, body int, id int"


def brute(docs):
    groups = {}
    for i, t in docs:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i))
    out = []
    for body, rows in groups.items():
        rows.sort(key=lambda r: (r[0], r[1], r[2] or 0))
        out += [(i, rows[0][2], len(rows), n == 0, hashlib.sha256(body.encode()).hexdigest()) for n, (_, _, i) in enumerate(rows)]
    return sorted(out, key=repr)


def test_groups_match_brute_force(spark, monkeypatch):
    docs = [(i, " ".join(["a", "b", "ä"][(i * k) % 3] for k in range(i % 7))) for i in range(120)]
    docs += [(120, None), (121, ""), (122, " \t\n"), (123, "x\x0by"), (124, "x y"), (124, "x y"), (124, "xy"), (None, "xy"), (None, "xy "), (125, " "), (126, "q" * 300000)]
    df = spark.createDataFrame([(*d, "k", 1, 2) for d in docs], SCHEMA)
    for capacity, piece in ((1000, 512), (1, 2)):
        monkeypatch.setattr(exact, "SLICE", piece)
        got = exact_duplicates(df, capacity=capacity).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
        assert sorted(map(tuple, got.collect()), key=repr) == brute(docs)
    left = without_copies(df)
    assert left.columns == df.columns
    assert sorted((r[0] for r in left.collect()), key=repr) == sorted((r[0] for r in brute(docs) if r[3]), key=repr)
    assert exact_duplicates(df.limit(0)).collect() == [] and without_copies(df.limit(0)).collect() == []


def test_colliding_digests_are_told_apart_by_their_bytes(spark, monkeypatch):
    from pyspark.sql import functions as F
    monkeypatch.setattr(F, "xxhash64", lambda *c: F.lit(7).cast("long"))
    monkeypatch.setattr(F, "sha2", lambda *c: F.lit("same"))
    docs = [(1, "a"), (2, "a "), (3, "b"), (4, "b"), (5, "c")]
    got = exact_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in got.collect()) == [
        (1, 2, 2, False), (2, 2, 2, True), (3, 3, 2, True), (4, 3, 2, False), (5, 5, 1, True)]


def test_directory_doubles_and_splits(spark):
    chains = spark.createDataFrame([(p,) for p in [0, 1, 2, 3, 3, 3, 8, 15]], "prefix int")
    deep, entries = directory(chains, 2, 4)
    assert len(entries) == 1 << deep and deep == 4
    load = {}
    for p in [0, 1, 2, 3, 3, 3, 8, 15]:
        load[entries[p][0]] = load.get(entries[p][0], 0) + 1
    assert load[entries[3][0]] == 3 and max(n for b, n in load.items() if b != entries[3][0]) <= 2
    assert entries[8][0] == entries[15][0] and entries[8][1] == 1
    assert directory(chains, 100, 4) == (0, [(0, 0)])
