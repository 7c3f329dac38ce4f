"""License scans: lines and whole texts against licence templates, by the Dice coefficient over word bigrams.

Texts are normalised to lower-case words; a line of w words has w + 1 bigrams, the two at its ends included. A line and a
template of a and b bigrams cannot reach the wanted coefficient unless 200 · min(a, b) ≥ percent · (a + b), so most lines
are dropped by their number of words, and nearly all others by how many of their bigrams any template has. The rest is
reduced to distinct lines before it meets the templates.

`places` finds notices wherever they stand: windows of neighbouring words that begin and end in a bigram of a template. Of
any b - least + 1 bigrams of a template a window holds one, where `least` is what it must share, so a text without these
bigrams is dropped before it is normalised, by their longest words first; positions with too few hits ahead are dropped next.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsloom.session import stage

#: Notices as they are published, by SPDX name. Fixed values.
TEMPLATES = [
    ("all-rights-reserved", "All rights reserved."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

_AS_IS = ("is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the warranties of "
          "merchantability, fitness for a particular purpose and noninfringement. In no event shall the authors or copyright holders be "
          "liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of "
          "or in connection with the software or the use or other dealings in the software.")

#: The same and whole notices, for `places`.
NOTICES = TEMPLATES + [
    ("Apache-2.0", TEMPLATES[2][1] + " You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
     "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
     "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
     "permissions and limitations under the License."),
    ("BSD-3-Clause", TEMPLATES[3][1] + " 1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
     "the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
     "and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of "
     "the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
     "without specific prior written permission."),
    ("ISC", TEMPLATES[7][1] + ", provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", TEMPLATES[10][1] + " (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to "
     "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
     "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall "
     "be included in all copies or substantial portions of the Software. The software " + _AS_IS),
    ("MIT", "The software " + _AS_IS),
]


def normalised(text: Column) -> Column:
    """A-Z lower-cased; runs of anything but letters, digits and line feeds become one blank."""
    low = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_replace(low, r"[^\p{L}\p{N}\n]+", " ")


def bigrams(line: Column) -> Column:
    """Neighbouring words of a normalised line, with marks before the first and after the last."""
    marked = F.split(F.concat(F.lit("^ "), line, F.lit(" $")), " ")
    return F.zip_with(F.slice(marked, 1, F.size(marked) - 1), F.slice(marked, 2, F.size(marked) - 1),
                      lambda a, b: F.concat(a, F.lit(" "), b))


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, percent: int = 80, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """(id, `unit`, `license`, `dice`): the best template of every line and whole text that reaches `percent`.

    `unit` is the number of the line from 1, or 0 for the text as a whole (all its lines joined by blanks). Bigrams
    count as often as they occur. Ties go to the licence first in byte order; a licence of several templates counts by
    its best. Null and empty texts and lines without a word have no row. Each row of `docs` has its own results, also
    if ids or texts repeat; further columns are not read. The templates are the caller's list, so their table is small.
    """
    spark = docs.sparkSession
    if not templates:
        return docs.select(id_col, F.lit(0).alias("unit"), F.lit("").alias("license"), F.lit(0.0).alias("dice")).limit(0)
    given = spark.createDataFrame([(i, name, text) for i, (name, text) in enumerate(templates)], "template int, license string, text string")
    given = given.withColumn("line", F.trim(F.translate(normalised(F.col("text")), "\n", " "))).where("line != ''")
    given = given.withColumn("grams", bigrams(F.col("line"))).withColumn("b", F.size("grams"))
    sizes = sorted(r["b"] for r in given.select("b").distinct().collect())
    fitting = [a for a in range(1, max(sizes, default=0) * 200 // percent + 1) if any(200 * min(a, b) >= percent * (a + b) for b in sizes)]
    table = given.select("template", "license", "b", F.explode("grams").alias("gram")).groupBy("template", "license", "b", "gram").agg(
        F.count(F.lit(1)).alias("m"))

    body = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("body"))
    units = body.select("id", F.posexplode(F.concat(F.array(F.regexp_replace("body", " ?\n[ \n]*", " ")), F.split("body", "\n"))).alias("unit", "line"))
    units = units.select("id", "unit", F.trim("line").alias("line")).where("line != ''")
    # Words of a line: its blanks and one more; so its bigrams are its blanks and two more.
    units = units.withColumn("a", F.length("line") - F.length(F.translate("line", " ", "")) + 2).where(F.col("a").isin(fitting))
    # Shared bigrams are known ones, and a template has at least as many as it shares: fewer known ones cannot do.
    known = [r["gram"] for r in table.select("gram").distinct().collect()]
    hits = F.size(F.filter(bigrams(F.col("line")), lambda g: g.isin(known)))
    units = stage(units.where((200 - percent) * hits >= percent * F.col("a")), "license-lines")
    lines = units.select("line").distinct()
    grams = lines.select("line", F.size(bigrams(F.col("line"))).alias("a"), F.explode(bigrams(F.col("line"))).alias("gram"))
    grams = grams.groupBy("line", "a", "gram").agg(F.count(F.lit(1)).alias("n"))
    met = grams.join(F.broadcast(table), "gram").where(200 * F.least("a", "b") >= percent * (F.col("a") + F.col("b")))
    met = met.groupBy("line", "a", "b", "template", "license").agg(F.sum(F.least("n", "m")).alias("both"))
    met = met.where(200 * F.col("both") >= percent * (F.col("a") + F.col("b"))).withColumn("dice", 2 * F.col("both") / (F.col("a") + F.col("b")))
    best = met.groupBy("line").agg(F.min(F.struct((-F.col("dice")).alias("less"), "license")).alias("best"))
    return units.join(best, "line").select(
        F.col("id").alias(id_col), "unit", F.col("best.license").alias("license"), (-F.col("best.less")).alias("dice"))


def scan_sql(templates: list[tuple[str, str]] = TEMPLATES, percent: int = 80) -> str:
    """The same for `documents` in the SQL of DuckDB."""
    quoted = ", ".join("(%d, '%s', '%s')" % (i, a, b.replace("'", "''")) for i, (a, b) in enumerate(templates))
    return rf"""
WITH given(template, license, text) AS (VALUES {quoted}),
     t AS (SELECT template, license, string_split_regex(trim(regexp_replace(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' +') AS w FROM given),
     tg AS (SELECT template, license, len(w) + 1 AS b, unnest(list_transform(range(1, len(w) + 2), lambda i: coalesce(w[i - 1], '^') || ' ' || coalesce(w[i], '$'))) AS gram FROM t),
     tc AS (SELECT template, license, b, gram, count(*) AS m FROM tg GROUP BY ALL),
     d AS (SELECT doc_id, row_number() OVER () AS rid, regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\p{{L}}\p{{N}}\n]+', ' ', 'g') AS body FROM documents),
     u AS (SELECT doc_id, rid, 0 AS unit, replace(body, chr(10), ' ') AS line FROM d
           UNION ALL SELECT doc_id, rid, i AS unit, string_split(body, chr(10))[i] AS line FROM d, LATERAL (SELECT unnest(range(1, len(string_split(body, chr(10))) + 1)) AS i)),
     w AS (SELECT doc_id, rid, unit, string_split_regex(trim(line), ' +') AS w FROM u WHERE trim(line) <> ''),
     g AS (SELECT doc_id, rid, unit, len(w) + 1 AS a, unnest(list_transform(range(1, len(w) + 2), lambda i: coalesce(w[i - 1], '^') || ' ' || coalesce(w[i], '$'))) AS gram FROM w),
     c AS (SELECT doc_id, rid, unit, a, gram, count(*) AS n FROM g GROUP BY ALL),
     met AS (SELECT doc_id, rid, unit, a, b, template, license, sum(least(n, m)) AS s FROM c JOIN tc USING (gram) GROUP BY ALL),
     good AS (SELECT doc_id, rid, unit, license, 2 * s / (a + b) AS dice FROM met WHERE 200 * s >= {percent} * (a + b)),
     ranked AS (SELECT *, row_number() OVER (PARTITION BY rid, unit ORDER BY dice DESC, license) AS r FROM good)
SELECT doc_id, CAST(unit AS INTEGER) AS unit, license, CAST(dice AS DOUBLE) AS dice FROM ranked WHERE r = 1
"""


def _words(text: str) -> list[str]:
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return re.sub(r"[\W_]+", " ", low).split()


def places(docs: DataFrame, templates: list[tuple[str, str]] = NOTICES, percent: int = 80, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(id, `license`, `first_word`, `last_word`, `dice`): where a text holds a notice, across lines and within them.

    A window is a run of words, line breaks being blanks, that begins and ends in a bigram of a template (no marks at the
    ends). All windows that reach `percent` count; those of a licence that share a bigram make one place, from the first
    word to the last (from 1), with the best coefficient. Each row of `docs` has its own places, so rows that repeat an id
    repeat them. Null and empty texts hold nothing, very long ones are searched whole; equal coefficients make one place all
    the same. Further columns are not read, whatever their names; an empty table gives an empty result. Templates have two
    words at least.
    """
    spark = docs.sparkSession
    rows, anchors, longest = [], {}, 1
    for i, (name, text) in enumerate(templates):
        words = _words(text)
        grams = Counter(zip(words, words[1:]))
        b = sum(grams.values())
        if not b:
            raise ValueError(f"template {i} has fewer than two words")
        least = -(-b * percent // (200 - percent))
        need = b - least + 1
        for gram, m in sorted(grams.items(), key=lambda g: (-max(map(len, g[0])), g[0])):
            if need > 0:
                anchors.setdefault(max(gram, key=len), set()).add(gram)
                need -= m
        rows += [(i, name, b, least, " ".join(gram), m) for gram, m in grams.items()]
        longest = max(longest, b * (200 - percent) // percent)
    if not rows:
        return docs.select(id_col, F.lit("").alias("license"), F.lit(0).alias("first_word"), F.lit(0).alias("last_word"), F.lit(0.0).alias("dice")).limit(0)
    table = spark.createDataFrame(rows, "template int, license string, b int, least int, gram string, m int")
    whole = all(word.isascii() for pairs in anchors.values() for pair in pairs for word in pair)  # only A-Z are lower-cased for certain
    gap = r"[^\p{L}\p{N}]"

    def anchored(low: Column) -> Column:
        some = F.lit(not whole)
        for word, pairs in sorted(anchors.items()) if whole else []:
            near = F.lit(False)
            for x, y in sorted(pairs):
                near = near | (low.contains(y if x == word else x) & low.rlike(f"(?<!{gap[:1]}{gap[2:]}){x}{gap}+{y}(?!{gap[:1]}{gap[2:]})"))
            some = some | (low.contains(word) & near)
        return some

    # In an array, so that the text is lower-cased once and not for each word.
    some = F.exists(F.array(F.lower(F.col(text_col))), anchored)
    body = F.split(F.trim(F.translate(normalised(F.col(text_col)), "\n", " ")), " +")
    texts = docs.where(some).select(F.col(id_col).alias("id"), body.alias("w"))
    pairs = F.zip_with(F.slice("w", 1, F.size("w") - 1), F.slice("w", 2, F.size("w") - 1), lambda x, y: F.concat(x, F.lit(" "), y))
    grams = texts.where(F.size("w") > 1).select("id", F.monotonically_increasing_id().alias("rid"), pairs.alias("grams"))
    hits = grams.select("id", "rid", F.posexplode("grams").alias("pos", "gram"))
    hits = stage(hits.where(F.col("gram").isin(sorted({r[4] for r in rows}))), "license-hits").join(F.broadcast(table), "gram")
    # A hit adds to a window unless the hit of the same bigram m before it is inside as well.
    same = Window.partitionBy("rid", "template", "gram").orderBy("pos")
    back = F.lit(None).cast("int")
    for m in sorted({r[5] for r in rows}):
        back = F.when(F.col("m") == m, F.lag("pos", m).over(same)).otherwise(back)
    hits = hits.withColumn("hit", F.struct("pos", back.alias("back")))
    ahead = Window.partitionBy("rid", "template").orderBy("pos").rangeBetween(0, longest - 1)
    a = lambda h: h["pos"] - F.col("pos") + 1
    reach = F.filter(F.collect_list("hit").over(ahead), lambda h: percent * a(h) <= (200 - percent) * F.col("b"))
    opened = hits.withColumn("reach", reach).where(F.size("reach") >= F.col("least"))
    new = lambda h: h["back"].isNull() | (h["back"] < F.col("pos"))
    ends = F.transform("reach", lambda h, i: F.struct(
        h["pos"].alias("end"), a(h).alias("a"), F.size(F.filter(F.slice("reach", 1, i + 1), new)).alias("both")))
    met = opened.select("id", "rid", "license", "b", F.col("pos").alias("start"), F.explode(ends).alias("e"))
    met = met.where(200 * F.col("e.both") >= percent * (F.col("e.a") + F.col("b"))).select(
        "id", "rid", "license", "start", "e.end", (2 * F.col("e.both") / (F.col("e.a") + F.col("b"))).alias("dice"))
    order = Window.partitionBy("rid", "license").orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    met = met.withColumn("opens", F.when(F.col("start") <= before, 0).otherwise(1))
    met = met.withColumn("place", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return met.groupBy("rid", "license", "place").agg(
        F.first("id").alias(id_col), (F.min("start") + 1).cast("int").alias("first_word"),
        (F.max("end") + 2).cast("int").alias("last_word"), F.max("dice").alias("dice")).select(id_col, "license", "first_word", "last_word", "dice")


def places_sql(templates: list[tuple[str, str]] = NOTICES, percent: int = 80) -> str:
    """The same for `documents` in the SQL of DuckDB: all windows of hits are counted, without the bounds."""
    quoted = ", ".join("(%d, '%s', '%s')" % (i, a, b.replace("'", "''")) for i, (a, b) in enumerate(templates))
    plain = r"string_split_regex(trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\p{L}\p{N}]+', ' ', 'g')), ' +')"
    return rf"""
WITH given(template, license, text) AS (VALUES {quoted}),
     t AS (SELECT template, license, {plain} AS w FROM given),
     tg AS (SELECT template, license, len(w) - 1 AS b, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS gram FROM t),
     tc AS (SELECT template, license, b, gram, count(*) AS m FROM tg GROUP BY ALL),
     d AS (SELECT doc_id, row_number() OVER () AS rid, {plain} AS w FROM documents),
     p AS (SELECT rid, unnest(range(1, len(w))) AS pos, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS gram FROM d),
     h AS (SELECT rid, template, license, b, pos, gram, m FROM p JOIN tc USING (gram)),
     s AS (SELECT x.rid, x.template, x.license, x.b, x.pos AS first, y.pos AS last, y.pos - x.pos + 1 AS a FROM h x JOIN h y
           ON x.rid = y.rid AND x.template = y.template AND y.pos >= x.pos AND 200 * least(y.pos - x.pos + 1, x.b) >= {percent} * (y.pos - x.pos + 1 + x.b)),
     n AS (SELECT s.rid, s.template, s.license, s.b, first, last, a, gram, m, count(*) AS n FROM s JOIN h
           ON s.rid = h.rid AND s.template = h.template AND h.pos BETWEEN first AND last GROUP BY ALL),
     met AS (SELECT rid, template, license, b, first, last, a, sum(least(n, m)) AS both_ FROM n GROUP BY ALL),
     good AS (SELECT rid, license, first, last, 2 * both_ / (a + b) AS dice FROM met WHERE 200 * both_ >= {percent} * (a + b)),
     o AS (SELECT *, max(last) OVER (PARTITION BY rid, license ORDER BY first, last ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM good),
     i AS (SELECT *, sum(CASE WHEN first <= seen THEN 0 ELSE 1 END) OVER (PARTITION BY rid, license ORDER BY first, last ROWS UNBOUNDED PRECEDING) AS place FROM o)
SELECT doc_id, license, CAST(min(first) AS INTEGER) AS first_word, CAST(max(last) + 1 AS INTEGER) AS last_word, CAST(max(dice) AS DOUBLE) AS dice
FROM i JOIN d USING (rid) GROUP BY rid, doc_id, license, place
"""
