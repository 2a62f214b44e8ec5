"""Authority files: names to ids, and how often and when each entry occurs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.functions.text import terms


def unique_titles(index: DataFrame, key: str, title: str) -> DataFrame:
    """(title, id) of titles that one entry alone bears."""
    return index.groupBy(F.col(title).alias("title")).agg(F.count("*").alias("n"), F.min(key).alias("id")).where("n = 1 and title is not null").select("title", "id")


def ambiguous_titles(index: DataFrame, title: str) -> DataFrame:
    return index.groupBy(F.col(title).alias("title")).agg(F.count("*").alias("n")).where("n > 1")


def resolve(items: DataFrame, index: DataFrame, item: str, ids: str, names: str, key: str, title: str, *, homonyms: str = "all") -> DataFrame:
    """(item, id): entries that an item names. Its ids count, those of the file; an item without ids is looked up by exact titles. homonyms: a title of several entries gives all of them, or, with 'none', nothing."""
    split = items.select(F.col(item).alias("item"), terms(F.col(ids)).alias("i"), terms(F.col(names)).alias("t"))
    by_id = split.select("item", F.explode("i").alias("id")).join(index.select(F.col(key).cast("string").alias("id")), "id", "left_semi")
    table = index.select(F.col(title).alias("title"), F.col(key).cast("string").alias("id")) if homonyms == "all" else unique_titles(index, key, title).select("title", F.col("id").cast("string").alias("id"))
    by_title = split.where(F.size("i") == 0).select("item", F.explode("t").alias("title")).join(table, "title")
    return by_id.select("item", "id").unionAll(by_title.select("item", "id")).distinct()


def frequencies(mentions: DataFrame, facts: DataFrame, item: str = "item") -> DataFrame:
    """(id, frequency, first, last, countries) from mentions (item, id) and facts (item, low, high, countries): items are counted once however often they name an entry."""
    one = mentions.distinct().join(facts, item)
    per = one.groupBy("id").agg(F.count_distinct(item).alias("frequency"), F.min("low").alias("first"), F.max("high").alias("last"))
    lands = one.select("id", F.explode("countries").alias("c")).where("c <> ''").groupBy("id").agg(F.array_join(F.array_sort(F.collect_set("c")), "|").alias("countries"))
    return per.join(lands, "id", "left").select("id", "frequency", F.coalesce("first", F.lit("")).alias("first"), F.coalesce("last", F.lit("")).alias("last"), F.coalesce("countries", F.lit("")).alias("countries"))


def attach(index: DataFrame, stats: DataFrame, key: str) -> DataFrame:
    """The index with its entries' numbers, 0 and empty for entries that nothing names."""
    out = index.join(stats.withColumnRenamed("id", key), key, "left")
    return out.select(*index.columns, F.coalesce("frequency", F.lit(0)).alias("frequency"), *(F.coalesce(c, F.lit("")).alias(c) for c in ("first", "last", "countries")))


def unmapped(df: DataFrame, source: str, derived: str, limit: int | None = None) -> DataFrame:
    """(value, n) of sources whose derived value is blank, the most frequent first."""
    rows = df.where((F.coalesce(F.trim(derived), F.lit("")) == "") & (F.coalesce(F.trim(source), F.lit("")) != "")).groupBy(F.col(source).alias("value")).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "value")
    return rows.limit(limit) if limit else rows


def outlet_key(ids: str, country: str, title: str):
    """An outlet's id, else 'country|title', else null."""
    return F.coalesce(F.nullif(F.trim(ids), F.lit("")), F.concat(F.coalesce(F.trim(country), F.lit("")), F.lit("|"), F.nullif(F.trim(title), F.lit(""))))


def filtered(df: DataFrame, *, country: str | None = None, years: tuple[int | None, int | None] = (None, None), country_column: str = "country", year_column: str = "year") -> DataFrame:
    """Rows of a country and of a window of years; rows without a year stay only where no window is asked for."""
    out = df.where(F.col(country_column) == country) if country else df
    low, high = years
    if low is not None:
        out = out.where(F.col(year_column) >= low)
    return out.where(F.col(year_column) <= high) if high is not None else out


def of_types(index: DataFrame, column: str, types: Sequence[str]) -> DataFrame:
    return index.where(F.lower(column).isin([t.lower() for t in types]))
