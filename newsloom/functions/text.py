"""Text and raw-string column functions. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: letters, digits and underscore of every script.
WORD = r"[\p{L}\p{N}_]+"


def full_text(*cols: str | Column) -> Column:
    """Text columns joined by one space, null as empty."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.concat_ws(" ", *[F.coalesce(p, F.lit("")) for p in parts])


def tokenize(text: Column) -> Column:
    """Lower-case word tokens in text order; null gives no tokens."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def split_ids(raw: Column) -> Column:
    """Space-separated ids to an array; null and blank give an empty array."""
    return F.filter(F.split(F.coalesce(raw, F.lit("")), r"\s+"), lambda x: x != "")


parse_history = split_ids
parse_candidates = split_ids


def item_id(item: Column) -> Column:
    """Id part of `id-label`, cut at the last dash."""
    return F.regexp_replace(item, "-[^-]*$", "")


def item_label(item: Column) -> Column:
    """Label part of `id-label`, after the last dash."""
    return F.substring_index(item, "-", -1)


def parse_labeled_impressions(raw: Column) -> Column:
    """`N1-1 N2-0` to struct(clicked, unclicked); items without a dash are left out."""
    items = F.filter(split_ids(raw), lambda x: x.contains("-"))
    clicked = F.transform(F.filter(items, lambda x: item_label(x) == "1"), item_id)
    unclicked = F.transform(F.filter(items, lambda x: item_label(x) != "1"), item_id)
    return F.struct(clicked.alias("clicked"), unclicked.alias("unclicked"))


def strip_click_suffix(item: Column) -> Column:
    """Drop a trailing `-1` and nothing else."""
    return F.regexp_replace(item, "-1$", "")


def char_len(text: Column) -> Column:
    return F.char_length(text).cast("bigint")


def has_labels(raw: Column) -> Column:
    """True where any item of a raw impression list carries a click label."""
    return F.exists(split_ids(raw), lambda x: x.rlike("-[01]$"))


def click_count(raw: Column) -> Column:
    """Number of clicked items in a raw impression list."""
    return F.size(F.filter(split_ids(raw), lambda x: x.endswith("-1"))).cast("bigint")


def click_rate(raw: Column) -> Column:
    """Clicked items over all items; null for an empty list."""
    total = F.size(split_ids(raw))
    return F.when(total > 0, click_count(raw) / total)


# Fixed value: entity fields of the news files.
ENTITY_SCHEMA = (
    "array<struct<Label:string,Type:string,WikidataId:string,Confidence:double,"
    "OccurrenceOffsets:array<int>,SurfaceForms:array<string>>>"
)


def parse_entities(raw: Column, schema: str = ENTITY_SCHEMA) -> Column:
    """JSON entity list to an array of structs; bad JSON gives null."""
    return F.from_json(raw, schema)
