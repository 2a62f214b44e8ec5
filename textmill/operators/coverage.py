"""What a corpus covers: grouping sets, stable outlets, cohorts, exclusion ledgers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MISSING = "[missing]"


def shown(c: Column) -> Column:
    """A label for reports: null and blank are [missing]."""
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(MISSING))


def access(item_public: Column, text_public: Column) -> Column:
    """restricted_item goes before all; then public_text, restricted_text, unknown."""
    return F.when(item_public.isNull(), "unknown").when(~item_public, "restricted_item").when(text_public.isNull(), "unknown").when(text_public, "public_text").otherwise("restricted_text")


def reasons(tests: Mapping[str, Column]) -> Column:
    """Names of the tests that hold, joined by pipes in their order; empty: none does."""
    return F.concat_ws("|", *(F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in tests.items()))


def coverage(df: DataFrame, dimensions: Sequence[Sequence[str]], included: str, metrics: Sequence[str]) -> DataFrame:
    """(dimension, columns, n, n_included, each metric's count and share): one pass over all grouping sets; dimension names the set."""
    names = list(dict.fromkeys(c for d in dimensions for c in d))
    aggs = [F.count("*").alias("n"), F.count_if(F.col(included)).alias("n_included")]
    for m in metrics:
        aggs += [F.count_if(F.col(m)).alias(f"{m}_n"), F.round(F.count_if(F.col(m)) / F.count("*"), 6).alias(f"{m}_share")]
    out = df.groupingSets([[F.col(c) for c in d] for d in dimensions], *names).agg(F.grouping_id(*names).alias("__g"), *aggs)
    bits = {sum(1 << (len(names) - 1 - i) for i, c in enumerate(names) if c not in d): "+".join(d) or "all" for d in dimensions}
    label = F.coalesce(*(F.when(F.col("__g") == b, F.lit(n)) for b, n in bits.items()))
    return out.withColumn("dimension", label).select("dimension", *names, *(c for c in out.columns if c not in [*names, "__g"]))


def stable(df: DataFrame, keys: Sequence[str], year: str, first: int, last: int, least: int = 1) -> DataFrame:
    """Keys with at least `least` rows in every year of the window: a relational division."""
    per = df.where(F.col(year).between(first, last)).groupBy(*keys, year).agg(F.count("*").alias("n"))
    return per.groupBy(*keys).agg(F.count("*").alias("years"), F.min("n").alias("least"), F.sum("n").alias("rows")).where((F.col("years") == last - first + 1) & (F.col("least") >= least))


def cohort(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of a cohort; a cohort key without a row raises when the plan runs."""
    marked = ids.select(F.col(key)).distinct().join(df.select(F.col(key), F.lit(True).alias("__there")).distinct(), key, "left")
    sure = marked.select(F.when(F.col("__there"), F.col(key)).otherwise(F.raise_error(F.concat(F.lit("no such key: "), F.col(key).cast("string"))).cast(df.schema[key].dataType)).alias(key))
    return df.join(sure, key, "left_semi")


def language_is(c: Column, aliases: Sequence[str], *, unknown: bool = False) -> Column:
    """Exact alias match apart from case; 'A|B' is no match; null and blank only on request."""
    s = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    return s.isin([a.lower() for a in aliases]) | ((s == "") if unknown else F.lit(False))


def excluded_labels(df: DataFrame, column: str, kept: Column) -> DataFrame:
    return df.where(~F.coalesce(kept, F.lit(False))).groupBy(shown(F.col(column)).alias("label")).agg(F.count("*").alias("n"))


def precision_counts(df: DataFrame, precision: str) -> DataFrame:
    """Rows by the precision of dates that are no points."""
    return df.where(~F.col(precision).isin("day", "month", "year")).groupBy(precision).agg(F.count("*").alias("n"))


def text_stats(df: DataFrame, column: str) -> DataFrame:
    n = F.length(F.nullif(F.col(column), F.lit("")))
    return df.agg(F.count("*").alias("n"), F.count(n).alias("non_empty"), F.round(F.avg(n), 4).alias("mean_length"), F.max(n).alias("max_length"))


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """(value, n, share): one small aggregate joined to its own sum."""
    n = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    return n.crossJoin(F.broadcast(n.agg(F.sum("n").alias("all")))).select("value", "n", F.round(F.col("n") / F.col("all"), 6).alias("share"))
