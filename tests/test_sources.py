from pyspark.sql import functions as F

from newsloom.operators import features
from newsloom.plans import build, predict
from newsloom.sources import readers, writers

NEWS = [
    'N1\tsports\tgolf\tA "quoted" \\ title\tabs\thttp://x\t[{"Label":"L","Type":"P","WikidataId":"Q1","Confidence":0.9,"OccurrenceOffsets":[1],"SurfaceForms":["s"]}]\t[]',
    "N2\tnews\tworld\tshort row",
    "N3\tnews\tworld\ttitle\tabs\turl\t[]\t[]\textra\tmore",
]
BEHAVIORS = [
    "1\tU1\t11/11/2019 9:05:58 AM\tN1 N3\tN2-1 N3-0",
    "2\tU2\t11/12/2019 21:05:58\t\tN1-0 N2-1",
    "3\tU1\tnever\tN2\tN3-1",
    "4\tU3\t11/14/2019 1:00:00 PM\tN1\tN1-1 N2-0",
]


def raw(folder):
    folder.mkdir(parents=True)
    (folder / "news.tsv").write_text("\n".join(NEWS) + "\n", encoding="utf-8")
    (folder / "behaviors.tsv").write_text("\n".join(BEHAVIORS) + "\n", encoding="utf-8")
    return str(folder)


def test_ragged_news(spark, tmp_path):
    rows = {r.article_id: r for r in readers.read_news_tsv(spark, raw(tmp_path / "d") + "/news.tsv").collect()}
    assert rows["N1"].title == 'A "quoted" \\ title'
    assert rows["N2"].title == "short row" and rows["N2"].abstract is None
    assert rows["N3"].abstract_entities == "[]"
    got = features.article_features(readers.read_news_tsv(spark, str(tmp_path / "d/news.tsv"))).collect()
    assert {r.article_id: r.entities for r in got} == {"N1": ["Q1"], "N2": [], "N3": []}


def test_datasets_by_folder(spark, tmp_path):
    raw(tmp_path / "MINDsmall_train")
    raw(tmp_path / "MINDsmall_dev" / "MINDsmall_dev")
    got = readers.read_all_datasets(spark, f"{tmp_path}/MIND*", "behaviors", "behaviors.tsv")
    assert {r.dataset: r["count"] for r in got.groupBy("dataset").count().collect()} == {"MINDsmall_train": 4, "MINDsmall_dev": 4}


def test_vec(spark, tmp_path):
    (tmp_path / "e.vec").write_text("Q1\t0.5\t-1.25\t3.0\t\nQ2\t1\t2\t3\n")
    got = {r.entity_id: r.embedding for r in readers.read_vec(spark, str(tmp_path / "e.vec"), 3).collect()}
    assert got == {"Q1": [0.5, -1.25, 3.0], "Q2": [1.0, 2.0, 3.0]}


def test_build_store_and_predict(spark, tmp_path):
    source, root = raw(tmp_path / "MINDsmall_train"), str(tmp_path / "store")
    build.build_from_tsv(spark, source, root, "MINDsmall_train")
    build.build_from_tsv(spark, source, root, "MINDsmall_dev")
    build.build_from_tsv(spark, source, root, "MINDsmall_train")
    store = readers.load_store(spark, root, "MINDsmall_train")
    assert store["articles"].count() == store["vectors"].count() == 3
    assert {r.split: r["count"] for r in store["impressions"].groupBy("split").count().collect()} == {"train": 1, "val": 1, "test": 1}
    assert {r.user_id: r.history for r in store["users"].collect()} == {"U1": ["N1", "N3"], "U2": [], "U3": ["N1"]}
    index = build.index_from_store(store)
    assert index.stats.first().n == 3
    test = readers.read_test_impressions(spark, f"{source}/behaviors.tsv")
    lines = str(tmp_path / "out")
    writers.write_predictions(predict.generate_predictions(test, store["vectors"]), lines)
    got = [r.value for r in spark.read.text(lines).orderBy("value").collect()]
    assert len(got) == 4 and got[2] == "3 [1]" and got[0].startswith("1 [")


def test_history_choice(spark):
    stored = spark.createDataFrame([("a", ["1"]), ("b", ["2"])], "user_id string, history array<string>")
    fresh = spark.createDataFrame([("a", ["9"])], "user_id string, history array<string>")
    pick = lambda df: {r.user_id: r.history for r in df.collect()}
    assert pick(readers.history_for_test(None, stored)) == {"a": ["1"], "b": ["2"]}
    assert pick(readers.history_for_test(fresh, stored)) == {"a": ["9"]}
    assert pick(readers.history_for_test(fresh, stored, per_user=True)) == {"a": ["9"], "b": ["2"]}


def test_column_presence_and_serving_view(spark):
    train = spark.createDataFrame([(1, None, "x")], "id int, next int, label string")
    test = spark.createDataFrame([(1, True)], "id int, extra boolean")
    rows = {r.column_name: (r.in_train, r.in_test, r.n_train, r.n_test) for r in features.column_presence({"train": train, "test": test}).collect()}
    assert rows == {"id": (True, True, 1, 1), "next": (True, False, 0, 0), "label": (True, False, 1, 0), "extra": (False, True, 0, 1)}
    assert features.serving_time_view(train, test, keep=("label",)).columns == ["id", "label"]


def test_entry_has_rows(spark):
    import __spark_entry__ as contract

    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() == 30


def test_bucketed_postings_join_without_a_shuffle_of_their_side(spark, tmp_path):
    from newsloom.operators import lexical

    arts = spark.createDataFrame([(f"a{i}", f"t{i % 7} t{i % 5} x", "") for i in range(60)], "article_id string, title string, abstract string")
    postings = lexical.build_bm25_index(arts).postings
    path = writers.write_bucketed(postings, str(tmp_path), "postings", "article_id")
    stored = readers.read_bucketed(spark, path)
    assert sorted(map(tuple, stored.select(postings.columns).collect())) == sorted(map(tuple, postings.collect()))
    spark.sql(f"DROP TABLE {writers.bucket_table(path)}")  # a session that finds only the files declares the table again
    stored = readers.read_bucketed(spark, path)
    pairs = spark.createDataFrame([(f"u{i % 4}", f"a{i}") for i in range(0, 60, 2)], "user_id string, article_id string")
    query = spark.createDataFrame([(f"u{i}", "t1", 1.0) for i in range(4)], "user_id string, term string, idf double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        matched = lexical.match_terms(pairs, query, stored)
        plan = matched._jdf.queryExecution().sparkPlan().toString()
        executed = matched._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(tuple, matched.collect()))
        above = executed.split("FileScan parquet")[0].splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == sorted(map(tuple, lexical.match_terms(pairs, query, postings).collect()))
    # Of the two sides of the join on the article only the pairs are exchanged.
    scan = next(i for i, line in enumerate(executed.splitlines()) if "FileScan" in line and "Bucketed: true" in line)
    depth = executed.splitlines()[scan].find("FileScan")
    parents = []
    for line in reversed(executed.splitlines()[:scan]):
        at = next((i for i, c in enumerate(line) if c.isalpha()), 0)
        if at < depth:
            parents.append(line.strip(" :+-*()0123456789"))
            depth = at
    assert plan and above and "SortMergeJoin" in " ".join(parents)
    assert not any(p.startswith("Exchange") for p in parents[:next(i for i, p in enumerate(parents) if "SortMergeJoin" in p)])


def test_profile_files_has_the_bytes_of_each_file(spark, tmp_path):
    import os
    spark.range(100).repartition(3).write.parquet(f"{tmp_path}/t")
    got = readers.profile_files(spark.read.parquet(f"{tmp_path}/t")).collect()
    assert sum(r.n_rows for r in got) == 100 and len(got) == 3
    assert all(r.n_bytes == os.path.getsize(r.file_path.removeprefix("file:").replace("///", "/")) for r in got)
