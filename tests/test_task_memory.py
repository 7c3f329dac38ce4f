"""Term counts stream through joins, sorts of postings go by rows, and ranks are not written out."""

from newsloom.catalog import queries
from newsloom.operators import growing, lexical
from newsloom.sources.writers import write_index


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def made(spark):
    rows = [(f"a{i}", " ".join(f"w{k}" for k in range(i + 1))) for i in range(9)]
    return spark.createDataFrame(rows, "article_id string, title string").selectExpr("*", "'' AS abstract")


def test_postings_are_joined_without_sorting_or_sending_out_term_counts(spark, tmp_path):
    plan = plan_of(lexical.build_bm25_index(made(spark), staged=False).postings)
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    growing.append_segment(spark, str(tmp_path / "s"), made(spark))
    plan = plan_of(growing.live_terms(spark, str(tmp_path / "s")))
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_postings_are_sorted_in_tasks_of_bounded_rows(spark, tmp_path):
    index = lexical.build_bm25_index(made(spark))
    write_index(index, str(tmp_path), "one", task_rows=10)
    rows = spark.read.parquet(str(tmp_path / "postings")).selectExpr("*", "_metadata.file_path AS file")
    assert rows.select("file").distinct().count() > 2
    assert sorted(rows.select("term", "article_id", "tf").collect()) == sorted(index.postings.select("term", "article_id", "tf").collect())


def test_ranks_and_their_candidates_are_not_written_out(spark, small):
    files = queries.semantic_ranked(spark, small).inputFiles()
    assert not [f for f in files if "/ranked-" in f or "/candidates-" in f]
