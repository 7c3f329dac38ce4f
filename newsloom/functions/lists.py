"""Array column functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def empty_ids() -> Column:
    return F.array().cast("array<string>")


def ids_to_string(ids: Column) -> Column:
    """Elements of an id list as strings."""
    return ids.cast("array<string>")


def list_minus(left: Column, right: Column) -> Column:
    """Distinct elements of `left` that are not in `right`."""
    return F.array_except(left, right)


def unclicked(inview: Column, clicked: Column) -> Column:
    """In-view ids that were not clicked."""
    return list_minus(ids_to_string(inview), ids_to_string(clicked))


def list_len(ids: Column) -> Column:
    """Length of a list; null stays null."""
    return F.when(ids.isNotNull(), F.size(ids)).cast("bigint")


def explode_with_pos(df: DataFrame, col: str, value: str = "article_id", pos: str = "pos",
                     keep_empty: bool = False) -> DataFrame:
    """One row per element with its zero-based position."""
    generator = F.posexplode_outer if keep_empty else F.posexplode
    rest = [c for c in df.columns if c != col]
    return df.select(*rest, generator(col).alias(pos, value))


def explode_ids(df: DataFrame, col: str, value: str = "article_id", keep_empty: bool = False) -> DataFrame:
    """One row per element; empty and null lists give a null row with `keep_empty`."""
    generator = F.explode_outer if keep_empty else F.explode
    rest = [c for c in df.columns if c != col]
    return df.select(*rest, generator(col).alias(value))


def unnest(df: DataFrame, struct_col: str) -> DataFrame:
    """Struct fields as top-level columns."""
    rest = [c for c in df.columns if c != struct_col]
    return df.select(*rest, f"{struct_col}.*")


def rename_and_default(df: DataFrame, rename: dict[str, str] | None = None,
                       defaults: dict[str, object] | None = None,
                       required: list[str] | None = None) -> DataFrame:
    """Rename columns, add absent ones as literals, fill nulls with the default, drop rows null in `required`."""
    out = df.withColumnsRenamed(rename or {})
    for name, value in (defaults or {}).items():
        known = F.coalesce(F.col(name), F.lit(value)) if name in out.columns else F.lit(value)
        out = out.withColumn(name, known)
    return out.na.drop(subset=required) if required else out
