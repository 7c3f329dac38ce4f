"""newsloom: news click-log analytics and text retrieval on PySpark DataFrames."""
