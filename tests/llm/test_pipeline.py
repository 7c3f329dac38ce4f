import re

import corpus_pipeline
from newsloom.llm.mixing import mix
from test_decontaminate import BUDGET, least_edits
from test_jaccard import brute as components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return [w for w in re.split(rb"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text.lower().encode()) if w]


def test_pipeline_matches_brute_force(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    base = spark.read.parquet(f"{sf}/documents.parquet")
    extra = [(9001, None, "en", "src1", 0), (9002, "  12 !", None, None, 6), (None, base.first()["text"], None, None, 1),
             (9003, "the of and is in that", "en", None, 21), (9003, "the of and is in that", "en", None, 21), (9004, base.first()["text"] + " and more", "en", "src0", 1)]
    docs = base.select("doc_id", "text", "lang", "source", "n_chars").unionByName(spark.createDataFrame(extra, SCHEMA))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{sf}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    # Language: all texts with a letter are clean here.
    rows = [(i, t) for i, t in rows if t and re.search(r"[^\W\d_]", t)]
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t), []).append((-len(t), i is None, i or 0, t))
    rows = [(None if none else i, t) for g in groups.values() for _, none, i, t in [min(g)]]
    ids = {i: c for i, _, c in components([(-1 if i is None else i, t) for i, t in rows], 5, 80)}
    rows = [(i, t) for i, t in rows if ids[-1 if i is None else i] == (-1 if i is None else i)]
    items = [words(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    rows = [(i, t) for i, t in rows if not any(least_edits(x, words(t))[0] <= int(BUDGET * len(x) + 1e-9) for x in items)]
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=repr) == sorted(rows, key=repr)
    assert sorted(r["mix_position"] for r in got) == list(range(len(rows)))
    kept = spark.createDataFrame([r[:5] for r in got], SCHEMA)
    want = {r["doc_id"]: r["mix_position"] for r in mix(kept, corpus_pipeline.TARGETS).collect()}
    assert {r["doc_id"]: r["mix_position"] for r in got} == want


def test_stages_keep_the_columns_and_take_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    for _, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, none, "/root/testdata/sf0.001")
        assert out.columns == none.columns and out.collect() == []
    assert corpus_pipeline.STAGES[-1][1](spark, none, "").collect() == []
    assert len(corpus_pipeline.STAGES) == 5


def test_language_stage_rejects_unlearned_languages(spark):
    sf = "/root/testdata/sf0.001"
    base = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    foreign = [
        "Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura, perché la diritta via era smarrita.",
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem."]
    clean = ["the of and is in that", "the people", base.first()["text"][:60]]
    rows = [(9000 + i, t, None, "x", 1) for i, t in enumerate(foreign)] + [(9100 + i, t, None, "x", 1) for i, t in enumerate(clean)]
    docs = base.unionByName(spark.createDataFrame(rows, SCHEMA))
    kept = {r["doc_id"] for r in corpus_pipeline.known_language(spark, docs, sf).collect()}
    assert kept & {r[0] for r in rows} == {9100 + i for i in range(len(clean))}
    assert base.where("text RLIKE '[a-z]'").where(~base["doc_id"].isin(list(kept))).count() == 0
