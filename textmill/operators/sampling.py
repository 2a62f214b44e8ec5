"""Reproducible samples and review sheets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.functions.hashing import stable_rank
from textmill.operators.graphs import components


def stratified(df: DataFrame, key: str, strata: Sequence[str], per: int = 3, seed: int = 42) -> DataFrame:
    """The `per` lowest hash ranks of each stratum, with population, sampled, probability and weight."""
    ranked = df.withColumn("__rank", stable_rank(seed, F.col(key)))
    order = Window.partitionBy(*strata).orderBy("__rank", key)
    chosen = ranked.withColumn("__r", F.row_number().over(order)).where(F.col("__r") <= per)
    sizes = df.groupBy(*strata).agg(F.count("*").alias("population"))
    same = None
    for s in strata:
        c = F.col(f"c.{s}").eqNullSafe(F.col(f"s.{s}"))
        same = c if same is None else same & c
    out = chosen.alias("c").join(sizes.alias("s"), same) if strata else chosen.alias("c").crossJoin(sizes.alias("s"))
    n = F.least(F.col("s.population"), F.lit(per))
    return out.select(*(F.col(f"c.`{c}`") for c in df.columns), F.col("s.population").alias("population"), n.alias("sampled"), F.round(n / F.col("s.population"), 6).alias("probability"), F.round(F.col("s.population") / n, 6).alias("weight"))


def challenge(df: DataFrame, chosen: DataFrame, key: str, difficult: Column, disputed: Column, size: int = 30, seed: int = 42) -> DataFrame:
    """Up to `size` rows that were not chosen: difficult ones first, then disputed ones, each by hash rank."""
    rows = df.join(chosen.select(key), key, "left_anti").where(difficult | disputed)
    return rows.orderBy(F.when(difficult, 0).otherwise(1), stable_rank(seed, F.col(key)), key).limit(size)


def blinded(df: DataFrame, columns: Sequence[str], blanks: Sequence[str], text: str | None = None, excerpt: int = 0) -> DataFrame:
    """A sheet with metadata, an excerpt and empty columns to be filled in."""
    return df.select(*columns, *([F.substring(text, 1, excerpt).alias("excerpt")] if text and excerpt else []), *(F.lit("").alias(b) for b in blanks))


def representatives(df: DataFrame, group: str, key: str, prob: str, margin: str, length: str, *, top: int = 5, borderline: int = 5, least: int = 100) -> DataFrame:
    """Of each group the `top` long enough rows of highest probability, and of the rest the `borderline` ones of least margin, with role and place."""
    good = df.where(F.col(length) >= least)
    first = good.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(F.col(prob).desc(), key))).where(F.col("place") <= top).withColumn("role", F.lit("representative"))
    rest = good.where(F.col(margin).isNotNull()).join(first.select(key), key, "left_anti")
    edge = rest.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(margin, key))).where(F.col("place") <= borderline).withColumn("role", F.lit("borderline"))
    return first.unionByName(edge)


def review_validity(estimate: Column, model: Column, verified: Column) -> Column:
    """The last reason that applies: no estimate, missing identity, unverified name; empty if none does."""
    return F.when(~F.coalesce(verified, F.lit(False)) & model.isNotNull(), "unverified_name").when(model.isNull() | (F.trim(model) == ""), "missing_identity").when(estimate.isNull(), "no_estimate").otherwise("")


def directional(df: DataFrame, value: str, key: str, sign: int = 1, n: int = 5) -> DataFrame:
    """The n largest positive, or the n smallest negative values."""
    rows = df.where(F.col(value) > 0) if sign > 0 else df.where(F.col(value) < 0)
    return rows.orderBy(F.col(value).desc() if sign > 0 else F.col(value).asc(), key).limit(n)


def hash_split(df: DataFrame, group: str, fraction: float, seed: int = 42, *, text: str | None = None) -> DataFrame:
    """Adds held_out: round(n * fraction) of the groups, at least one and not all, by hash rank. Whole groups, null among them as one, so that no source stands on both sides; with text, groups that share an exact text are one group, so that no copy does either."""
    name = F.coalesce(F.concat(F.lit("g"), F.col(group).cast("string")), F.lit("null"))
    rows = df.withColumn("__g", name)
    if text:
        # a text joins its groups to the least of them; components of those links are the groups to be dealt out
        links = rows.select("__g", F.sha2(F.coalesce(text, F.lit("")), 256).alias("h")).distinct()
        first = links.groupBy("h").agg(F.min("__g").alias("a"), F.count("*").alias("n")).where("n > 1")
        joined = components(links.join(first, "h").select("a", F.col("__g").alias("b")).where("a <> b").distinct())
        rows = rows.join(joined.select(F.col("node").alias("__g"), F.col("component").alias("__c")), "__g", "left").withColumn("__g", F.coalesce("__c", "__g")).drop("__c")
    ranks = rows.select("__g").distinct().withColumn("__h", stable_rank(seed, F.expr("if(__g = 'null', null, substring(__g, 2))")))
    n = ranks.count()
    take = max(1, min(n - 1, int(n * fraction + 0.5)))
    # the limit keeps as many rows as are held out at most, and needs no window over all groups
    chosen = ranks.orderBy(F.col("__h").asc_nulls_first(), "__g").limit(take).select("__g", F.lit(True).alias("held_out"))
    return rows.join(chosen, "__g", "left").withColumn("held_out", F.coalesce("held_out", F.lit(False))).select(*df.columns, "held_out")
