"""Windows and statistics over tables."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.functions.numbers import erfc


def benjamini_hochberg(df: DataFrame, p: str, by: Sequence[str] = (), out: str = "q") -> DataFrame:
    """Adds the adjusted p-value within each family: p * m / rank, made monotone from the largest p down, in 0..1. Null and NaN p are no part of the family and get null."""
    ok = F.col(p).isNotNull() & ~F.isnan(p)
    family = Window.partitionBy(*by, "__ok")
    up = family.orderBy(F.col(p).asc())
    down = family.orderBy(F.col(p).desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    # of equal p the last rank counts; its value is the least
    raw = F.col(p) * F.count("*").over(family) / F.max("__rank").over(Window.partitionBy(*by, "__ok", p))
    done = df.withColumn("__ok", ok).withColumn("__rank", F.row_number().over(up)).withColumn("__raw", raw)
    return done.withColumn(out, F.when(F.col("__ok"), F.least(F.lit(1.0), F.min("__raw").over(down)))).drop("__ok", "__rank", "__raw")


def wls_slope(df: DataFrame, x: str, y: str, w: str, by: Sequence[str] = ()) -> DataFrame:
    """Slope of the weighted least squares line of y on x; null if x does not vary."""
    sums = df.groupBy(*by).agg(F.sum(w).alias("sw"), F.sum(F.col(w) * F.col(x)).alias("swx"), F.sum(F.col(w) * F.col(y)).alias("swy"), F.sum(F.col(w) * F.col(x) * F.col(x)).alias("swxx"), F.sum(F.col(w) * F.col(x) * F.col(y)).alias("swxy"))
    below = F.col("sw") * F.col("swxx") - F.col("swx") * F.col("swx")
    return sums.select(*by, F.when(below > 0, (F.col("sw") * F.col("swxy") - F.col("swx") * F.col("swy")) / below).alias("slope"))


def mann_kendall(df: DataFrame, time: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """(n, s, variance, z, p) of each series: trend by the signs of all differences, variance corrected for ties, two-sided p; null with fewer than four points or no variance."""
    keys = list(by)
    # a series is as long as its calendar: its points meet in one array, not in a self-join
    points = F.collect_list(F.struct(F.col(time).alias("t"), F.col(value).cast("double").alias("v")))
    series = df.groupBy(*keys).agg(F.count("*").alias("n"), points.alias("x"))
    sign = lambda x, y: F.when(y["t"] > x["t"], F.coalesce(F.signum(y["v"] - x["v"]), F.lit(0.0))).otherwise(0.0)
    total = F.aggregate("x", F.lit(0.0), lambda s, x: s + F.aggregate("x", F.lit(0.0), lambda r, y: r + sign(x, y)))
    sizes = F.transform(F.array_distinct(F.transform("x", lambda p: p["v"])), lambda v: F.size(F.filter("x", lambda p: p["v"].eqNullSafe(v))))
    ties = F.aggregate(sizes, F.lit(0).cast("long"), lambda s, t: s + (t * (t - 1) * (2 * t + 5)).cast("long"))
    out = series.select(*keys, "n", total.cast("long").alias("s"), ties.alias("ties")).where("n > 0")
    k = F.col("n")
    variance = (k * (k - 1) * (2 * k + 5) - F.col("ties")) / 18
    out = out.withColumn("s", F.coalesce("s", F.lit(0))).withColumn("variance", variance)
    ok = (k >= 4) & (F.col("variance") > 0)
    z = F.when(ok, F.when(F.col("s") > 0, F.col("s") - 1).when(F.col("s") < 0, F.col("s") + 1).otherwise(0) / F.sqrt("variance"))
    return out.withColumn("z", z).withColumn("p", F.when(ok, F.least(F.lit(1.0), erfc(F.abs(F.col("z")) / F.sqrt(F.lit(2.0)))))).drop("ties")


def centred_mean(value: Column, by: Sequence[Column | str], order: Column | str, reach: int = 1) -> Column:
    """Mean of a row and its neighbours on both sides; shorter at the ends."""
    return F.avg(value).over(Window.partitionBy(*by).orderBy(order).rowsBetween(-reach, reach))


def peaks(df: DataFrame, time: str, value: str, by: Sequence[str], reach: int = 1) -> DataFrame:
    """(time, smoothed) at which the centred mean is largest, the earliest of equals."""
    smooth = df.withColumn("smoothed", centred_mean(F.col(value), by, time, reach))
    order = Window.partitionBy(*by).orderBy(F.col("smoothed").desc(), F.col(time))
    return smooth.withColumn("__r", F.row_number().over(order)).where("__r = 1").select(*by, F.col(time).alias(f"peak_{time}"), F.col("smoothed").alias("peak_value"))


def contiguous(df: DataFrame, time: str, by: Sequence[str] = ()) -> DataFrame:
    """Every whole number from the least to the largest of `time`, for each group."""
    ends = df.groupBy(*by).agg(F.min(time).alias("a"), F.max(time).alias("b")).where(F.col("a").isNotNull())
    return ends.select(*by, F.explode(F.sequence("a", "b")).alias(time))


def zero_filled(counts: DataFrame, time: str, values: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Counts on the contiguous calendar that all groups share, 0 where a group has none."""
    ends = counts.agg(F.min(time).alias("__a"), F.max(time).alias("__b")).where("__a is not null")
    # the product's one side is a single row, the calendar's ends
    calendar = counts.select(*by).distinct().crossJoin(F.broadcast(ends)).select(*by, F.explode(F.sequence("__a", "__b")).alias(time)) if by else contiguous(counts, time)
    return calendar.join(counts, [time, *by], "left").select(time, *by, *(F.coalesce(v, F.lit(0)).alias(v) for v in values))


def standardized(df: DataFrame, period: str, stratum: str, value: str) -> DataFrame:
    """(period, standardized, coverage): means by stratum under fixed weights, the strata's shares of all rows; null where a period lacks a stratum."""
    shares = df.where(F.col(stratum).isNotNull()).groupBy(stratum).agg(F.count("*").alias("n"))
    total = shares.agg(F.sum("n").alias("all"))
    weights = shares.crossJoin(F.broadcast(total)).select(stratum, (F.col("n") / F.col("all")).alias("w"))
    cells = df.groupBy(period, stratum).agg(F.avg(value).alias("m")).join(weights, stratum)
    out = cells.groupBy(period).agg(F.sum(F.col("w") * F.col("m")).alias("v"), F.sum("w").alias("c"))
    return out.select(period, F.when(F.col("c") >= 1 - 1e-9, F.col("v")).alias("standardized"), F.col("c").alias("coverage"))


def bootstrap_mean(df: DataFrame, value: str, key: str, by: Sequence[str], *, cluster: str | None = None, n_boot: int = 200, seed: int = 42, low: float = 2.5, high: float = 97.5, least: int = 10) -> DataFrame:
    """(n, n_clusters, mean, low, high, status) of each group: percentile bootstrap over rows, or over whole clusters; under `least` clusters there is no interval. One seed a call, rows in the order of their keys."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*by).schema) + (", " if by else "") + "n long, n_clusters long, mean double, low double, high double, status string"

    # rows of a cluster are summed before any group is gathered
    unit = F.col(cluster) if cluster else F.col(key)
    sums = df.where(F.col(value).isNotNull()).groupBy(*by, unit.alias("__unit")).agg(F.sum(F.col(value).cast("double")).alias("__sum"), F.count("*").alias("__n"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__unit")
        total, sizes = pdf["__sum"].to_numpy(float), pdf["__n"].to_numpy(np.int64)
        k, n = len(pdf), int(sizes.sum())
        head = {c: [pdf[c].iloc[0]] for c in by} | {"n": [n], "n_clusters": [k], "mean": [total.sum() / n]}
        if n_boot <= 0 or k < least:
            return pd.DataFrame(head | {"low": [np.nan], "high": [np.nan], "status": ["disabled" if n_boot <= 0 else "insufficient_clusters"]})
        rng, means = np.random.default_rng(seed), np.empty(n_boot)
        for i in range(n_boot):  # one draw at a time: memory grows with the clusters alone
            picks = rng.integers(0, k, k)
            means[i] = total[picks].sum() / sizes[picks].sum()
        a, b = np.percentile(means, [low, high])
        return pd.DataFrame(head | {"low": [a], "high": [b], "status": ["ok"]})

    return sums.groupBy(*by).applyInPandas(run, schema)
