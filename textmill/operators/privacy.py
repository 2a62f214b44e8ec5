"""Public projections: rows and cells that may be seen."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_true(c: Column) -> Column:
    """A visibility flag: null is private."""
    return F.coalesce(c, F.lit(False))


def no_members(c: Column) -> Column:
    return F.size(F.coalesce(c, F.array().cast("array<string>"))) == 0


def restricted(private: Column, content_public: Column, content: Sequence[str], derived: Mapping[str, Sequence[str]] | None = None, reviewed: Sequence[str] = ()) -> Column:
    """Columns that a row withholds: its private ones, the content if that is not public, and unreviewed columns derived from a withheld source."""
    empty = F.array().cast("array<string>")
    base = F.array_union(F.coalesce(private, empty), F.when(is_true(content_public), empty).otherwise(F.array(*map(F.lit, content)) if content else empty))
    for source, columns in (derived or {}).items():
        open_ = [c for c in columns if c not in reviewed]
        if open_:
            base = F.array_union(base, F.when(F.array_contains(base, source), F.array(*map(F.lit, open_))).otherwise(empty))
    return base


def public_projection(df: DataFrame, *, public: str, withheld: Column, dropped: Sequence[str] = (), control: Sequence[str] = ()) -> DataFrame:
    """Rows that are public, without the dropped columns, withheld cells blank: an empty text, or null. Control columns are never withheld."""
    rows = df.where(is_true(F.col(public))).withColumn("__withheld", withheld)

    def cell(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if f.name in control or f.name == public:
            return c
        blank = F.lit("") if isinstance(f.dataType, T.StringType) else F.lit(None).cast(f.dataType)
        return F.when(F.array_contains("__withheld", f.name), blank).otherwise(c).alias(f.name)

    return rows.select(*(cell(f) for f in df.schema if f.name not in dropped))


def mask_content(df: DataFrame, columns: Sequence[str], flag: str) -> DataFrame:
    return df.withColumns({c: F.when(is_true(F.col(flag)), F.col(c)).otherwise(F.lit("")) for c in columns})


def strip_neighbours(df: DataFrame, key: str, neighbours: str, published: DataFrame) -> DataFrame:
    """Neighbour lists (arrays of id and score) with only published ids, in their order; null if none is left. By joins, as published ids may be many."""
    parts = df.select(key, F.posexplode(neighbours).alias("__i", "__n"))
    live = parts.join(published.select(F.col(key).alias("__id")), F.col("__n.id") == F.col("__id"), "left_semi")
    lists = live.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("__i", "__n"))), lambda x: x["__n"]).alias("__kept"))
    return df.join(lists, key, "left").withColumn(neighbours, F.col("__kept")).drop("__kept")


def projection_violations(df: DataFrame, *, public: str, withheld: Column, columns: Sequence[str], allowed: Sequence[str]) -> DataFrame:
    """One row of counts that must all be 0: private rows, withheld cells with content, columns that are not allowed."""
    filled = F.lit(0)
    for c in columns:
        filled = filled + F.when(F.array_contains(withheld, c) & (F.coalesce(F.col(c).cast("string"), F.lit("")) != ""), 1).otherwise(0)
    return df.agg(F.count_if(~is_true(F.col(public))).alias("private_rows"), F.coalesce(F.sum(filled), F.lit(0)).alias("open_cells")).withColumn("unknown_columns", F.lit(len(set(df.columns) - set(allowed))))
