"""Rows of a bucketed table are shuffled in blocks of many rows, and each bucket stays one file."""

import datetime

import pytest

from newsloom.sources import readers, writers


@pytest.mark.parametrize("block_rows", [7, 1 << 20])
def test_rows_travel_in_blocks(spark, tmp_path, monkeypatch, block_rows):
    rows = [(f"a{i % 13}" if i % 11 else None, i, [float(i), None], datetime.datetime(2024, 1, 1 + i % 9)) for i in range(200)]
    df = spark.createDataFrame(rows, "article_id string, n int, v array<double>, time timestamp_ntz").repartition(2)
    out = writers.dealt(df, 5, "article_id", block_rows)
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(rows, key=repr) and out.schema == df.schema
    assert out.selectExpr("spark_partition_id() = pmod(hash(article_id), 5) AS right").distinct().collect() == [(True,)]
    assert "binary" not in dict(out.dtypes).values() and "block#" in out._jdf.queryExecution().executedPlan().toString()
    path = writers.write_bucketed(df, str(tmp_path), "t", "article_id", 5)
    stored = readers.read_bucketed(spark, path)
    assert sorted(map(tuple, stored.select(df.columns).collect()), key=repr) == sorted(rows, key=repr)
    assert stored.selectExpr("_metadata.file_path AS f").distinct().count() == 5
