import duckdb
import pandas as pd

from newsloom.llm.licenses import NOTICES, places, places_sql, scan, scan_sql

TEXTS = [
    None, "", "\n\n", "All rights reserved.", "ALL  RIGHTS, reserved\nReleased under the MIT License.",
    "Some prose.\nLicensed under the Apache License, Version 2.0.\n\nMore prose that goes on.", "rights", "all rights",
    "This work is licensed under\nthe GNU General Public License, version 3.", "a " * 50000, "MIT MIT MIT MIT License License",
    "Licensed under the Apache Licence, Version 2.0.", "Released under the MIT\tLicense", "All rights\n\n \n\n\n\n.\n\n\n\nreserved", "Über alle Rechte\nAll rights reserved!",
]


def test_scan_matches_sql(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3]), (None, TEXTS[4])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, license string, unit int")
    db = duckdb.connect()
    documents = pd.DataFrame({"doc_id": pd.array([r[0] for r in rows], "Int64"), "text": pd.array([r[1] for r in rows], "string")})  # noqa: F841
    for percent in (80, 50, 100):
        got = sorted(((r[0], r[1], r[2], round(r[3], 9)) for r in scan(df, percent=percent).collect()), key=repr)
        want = sorted(((r[0], r[1], r[2], round(r[3], 9)) for r in db.sql(scan_sql(percent=percent)).fetchall()), key=repr)
        assert got == want and got
    assert (13, 0, "all-rights-reserved", 1.0) in got
    assert (3, 0, "all-rights-reserved", 1.0) in got and (8, 0, "GPL-3.0", 1.0) in got
    assert scan(df.limit(0)).collect() == [] and scan(df, []).collect() == []


WRAPPED = [
    "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the",
    "Copyright (c) 2024 Example Corp. All rights reserved.", "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:",
    "All rights reserved. All rights reserved. No rights reserved", NOTICES[-2][1].replace(", ", ",\n"), "the software the software of the software",
]


def test_places_match_sql_and_find_wrapped_notices(spark):
    rows = [(i, "so it was said before " * 8 + t + " and after" * 9) for i, t in enumerate(WRAPPED)] + [(10 + i, t) for i, t in enumerate(TEXTS)] + [(3, WRAPPED[3]), (None, WRAPPED[1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    db = duckdb.connect()
    documents = pd.DataFrame({"doc_id": pd.array([r[0] for r in rows], "Int64"), "text": pd.array([r[1] for r in rows], "string")})  # noqa: F841
    for percent in (50, 100, 80):
        got = sorted(((*r[:4], round(r[4], 9)) for r in places(df, percent=percent).collect()), key=repr)
        want = sorted(((*r[:4], round(r[4], 9)) for r in db.sql(places_sql(percent=percent)).fetchall()), key=repr)
        assert got == want and got
    found = {(r[0], r[1]): r[4] for r in got}
    assert found[0, "MIT"] == found[1, "all-rights-reserved"] == found[2, "BSD-3-Clause"] == found[4, "MIT"] == 1.0
    assert {r["doc_id"] for r in scan(df.where("doc_id < 3")).collect()} & {0, 1, 2} == set()
    assert places(df.limit(0)).collect() == [] and places(df, []).collect() == []
