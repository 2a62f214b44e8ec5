"""Agreement and consensus of raters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.functions.numbers import ordinal


def long_form(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, rater, rating) of wide ratings, missing ones left out."""
    return df.select(key, F.explode(F.filter(F.array(*(F.struct(F.lit(c).alias("rater"), F.col(c).cast("string").alias("rating")) for c in columns)), lambda x: x["rating"].isNotNull())).alias("v")).select(key, "v.rater", "v.rating")


def label_consensus(votes: Column) -> Column:
    """The label that more than half of at least two votes name; empty if none does; null with fewer votes."""
    v = F.array_compact(votes)
    winner = F.filter(F.array_distinct(v), lambda x: 2 * F.size(F.filter(v, lambda y: y == x)) > F.size(v))
    return F.when(F.size(v) >= 2, F.coalesce(F.get(winner, F.lit(0)), F.lit("")))


def score_consensus(scores: Column) -> Column:
    """(median, disputed): exact median of at least two scores; disputed if they are two or more apart."""
    v = F.array_sort(F.array_compact(F.transform(scores, lambda x: x.cast("double"))))
    n = F.size(v)
    middle = (F.get(v, F.floor((n - 1) / 2).cast("int")) + F.get(v, F.floor(n / 2).cast("int"))) / 2
    return F.struct(F.when(n >= 2, middle).alias("median"), F.when(n >= 2, F.array_max(v) - F.array_min(v) >= 2).otherwise(F.lit(False)).alias("disputed"))


def range_disputed(labels: Column, order: list[str]) -> Column:
    ranks = F.array_compact(F.transform(labels, lambda x: ordinal(x, order)))
    return (F.size(ranks) >= 2) & (F.array_max(ranks) - F.array_min(ranks) >= 2)


def disagreement(flags: dict[str, Column], assessable: Column) -> Column:
    """Names of the disputed dimensions joined by pipes; null if none could be assessed."""
    return F.when(assessable, F.concat_ws("|", *(F.when(f, F.lit(name)) for name, f in flags.items())))


def cohen_kappa(df: DataFrame, a: str, b: str, *, by: Sequence[str] = (), scale: tuple[int, int] | None = None) -> DataFrame:
    """(n, kappa): agreement of two ratings beyond chance; with a scale (least, largest) disagreements weigh by their square. Null where chance leaves no disagreement."""
    keys = list(by)
    pairs = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(*keys, F.col(a).alias("x"), F.col(b).alias("y")).agg(F.count("*").alias("n"))
    n = F.sum("n")
    if scale:
        # both sums of squares in closed form, so that ratings are never paired
        sides = [(F.sum(F.col("n") * F.col(c).cast("double")), F.sum(F.col("n") * F.col(c).cast("double") * F.col(c).cast("double"))) for c in "xy"]
        (sx, sxx), (sy, syy) = sides
        gap = F.col("x").cast("double") - F.col("y").cast("double")
        out = pairs.groupBy(*keys).agg(n.alias("n"), F.sum(gap * gap * F.col("n")).alias("o"), (n * (sxx + syy) - 2 * sx * sy).alias("e"))
    else:
        observed = pairs.groupBy(*keys).agg(n.alias("n"), F.sum(F.when(F.col("x") == F.col("y"), 0).otherwise(F.col("n"))).cast("double").alias("o"))
        same = [pairs.groupBy(*keys, F.col(c).alias("v")).agg(F.sum("n").alias(f"n{c}")) for c in "xy"]
        same = same[0].join(same[1], [*keys, "v"]).groupBy(*keys).agg(F.sum(F.col("nx").cast("double") * F.col("ny")).alias("s"))
        # without keys both sides of the product are one row
        out = (observed.join(same, keys, "left") if keys else observed.crossJoin(same)).withColumn("e", F.col("n").cast("double") * F.col("n") - F.coalesce("s", F.lit(0.0)))
    return out.select(*keys, "n", F.when(F.col("e") > 0, 1 - F.col("o") * F.col("n") / F.col("e")).alias("kappa"))


def krippendorff(df: DataFrame, unit: str, rating: str, metric: str = "interval") -> DataFrame:
    """(n, alpha) of ratings in long form, for nominal, ordinal or interval differences; units with one rating take no part. Null where no difference is expected.

    Differences of a unit's ratings, and of all ratings, are sums of squares in closed form, so ratings are never paired. Ordinal differences are those of mid-ranks; their ranks run over the distinct ratings alone, a scale's few steps.
    """
    rows = df.where(F.col(rating).isNotNull()).select(F.col(unit).alias("u"), F.col(rating).cast("double").alias("v"))
    cells = rows.groupBy("u", "v").agg(F.count("*").alias("k"))
    cells = cells.withColumn("m", F.sum("k").over(Window.partitionBy("u"))).where("m > 1")
    values = cells.groupBy("v").agg(F.sum("k").alias("n"))
    k, x, m = F.col("k"), F.col("x"), F.col("m")
    if metric == "nominal":
        units = cells.groupBy("u", "m").agg(F.sum(k * k).alias("q"))
        within = units.agg(F.sum((m * m - F.col("q")) / (m - 1)).alias("do"))
        expected = values.agg(F.sum("n").alias("n"), F.sum(F.col("n").cast("double") * F.col("n")).alias("q")).select("n", (F.col("n").cast("double") * F.col("n") - F.col("q")).alias("de"))
    else:
        if metric == "ordinal":
            ranks = values.select("v", (F.sum("n").over(Window.orderBy("v")) - F.col("n") / 2).alias("x"))
            placed = cells.join(ranks, "v")
        else:
            # around the mean, so that large ratings lose no digits
            placed = cells.crossJoin(cells.agg((F.sum(k * F.col("v")) / F.sum("k")).alias("mean"))).withColumn("x", F.col("v") - F.col("mean"))
        units = placed.groupBy("u", "m").agg(F.sum(k * x).alias("s"), F.sum(k * x * x).alias("q"))
        within = units.agg(F.sum(2 * (m * F.col("q") - F.col("s") * F.col("s")) / (m - 1)).alias("do"))
        expected = units.agg(F.sum("m").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).select("n", (2 * (F.col("n") * F.col("q") - F.col("s") * F.col("s"))).alias("de"))
    # what is left of equal ratings is rounding
    real = F.col("de") > 1e-9 * F.col("n")
    return expected.crossJoin(within).select("n", F.when((F.col("n") > 1) & real, 1 - (F.col("n") - 1) * F.col("do") / F.col("de")).alias("alpha"))


def summarize_cells(df: DataFrame, by: Sequence[str], consensus: str, labels: Sequence[str], *, label_column: str | None = None, score: str | None = None) -> DataFrame:
    """Counts and shares of consensus labels in each cell, over all rows and over scored ones; null groups stay. Rows with null consensus are insufficient, with an empty one without consensus."""
    c = F.col(consensus)
    scored = F.count_if(c.isNotNull() & (c != ""))
    out = [F.count("*").alias("n"), scored.alias("n_scored"), F.count_if(c.isNull()).alias("n_insufficient"), F.count_if(c == "").alias("n_no_consensus")]
    for x in labels:
        k = F.count_if(c == x)
        out += [k.alias(f"n_{x}"), F.round(k / F.count("*"), 6).alias(f"share_{x}"), F.round(F.when(scored > 0, k / scored), 6).alias(f"share_{x}_of_scored")]
    if label_column:
        out.append(F.min(F.nullif(F.trim(label_column), F.lit(""))).alias("label"))
    if score:
        out.append(F.median(score).alias("median_score"))
    return df.groupBy(*by).agg(*out)
