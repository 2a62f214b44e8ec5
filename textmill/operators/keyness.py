"""Words that mark a slice of a corpus against the rest, and bursts in time."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmill.functions.text import counted
from textmill.functions.numbers import chi2_p, g2, log_ratio, log_ratio_error
from textmill.operators.stats import benjamini_hochberg


def eligible(df: DataFrame, stages: Sequence[tuple[str, object]]) -> tuple[DataFrame, DataFrame]:
    """(rows that pass all stages, one row of counts: what each stage takes out of what the ones before it left)."""
    passed, counts, before = F.lit(True), [F.count("*").alias("n")], F.lit(True)
    for name, condition in stages:
        ok = F.coalesce(condition, F.lit(False))
        counts.append(F.count_if(before & ~ok).alias(f"excluded_{name}"))
        before = before & ok
        passed = passed & ok
    return df.where(passed), df.agg(*counts, F.count_if(passed).alias("kept"))


def slice_counts(df: DataFrame, slice_: str, tokens: str, outlet: str | None = None) -> DataFrame:
    """(slice, token, a, docs, outlets): occurrences, documents and outlets of a token in each slice; a row of df is a document.

    A document's tokens are counted inside its row, so nothing is shuffled for it and documents need no distinct count. Two steps of sums follow, by outlet and over outlets, each combined on the map side.
    """
    rows = df.where(F.col(slice_).isNotNull() & (F.size(tokens) > 0))
    one = rows.select(F.col(slice_).alias("slice"), (F.col(outlet) if outlet else F.lit(None).cast("string")).alias("outlet"), F.explode(counted(F.col(tokens))).alias("t"))
    by_outlet = one.groupBy("slice", F.col("t.member").alias("token"), "outlet").agg(F.sum("t.k").alias("a"), F.count("*").alias("docs"))
    return by_outlet.groupBy("slice", "token").agg(F.sum("a").alias("a"), F.sum("docs").alias("docs"), F.count("outlet").alias("outlets"))


def keyness(counts: DataFrame, *, top: int = 25, min_count: int = 10, min_docs: int = 5, min_outlets: int = 2, alpha: float = 0.05) -> DataFrame:
    """The tokens that each slice uses more than the rest: signed log-likelihood, adjusted p-values over all tokens that pass the gates, log ratio with its 95 % interval; ranked by the interval's lower end, then log-likelihood, then token, as rounded. min_outlets 0: outlets are not known."""
    token = Window.partitionBy("token")
    totals = counts.groupBy("slice").agg(F.sum("a").alias("ta"))
    grand = totals.agg(F.sum("ta").alias("all"))
    sized = totals.crossJoin(F.broadcast(grand)).withColumn("tb", F.col("all") - F.col("ta")).where("ta > 0 and tb > 0").drop("all")
    rows = counts.withColumn("b", F.sum("a").over(token) - F.col("a")).join(sized, "slice")
    rows = rows.where((F.col("a") >= min_count) & (F.col("docs") >= min_docs) & (F.col("outlets") >= min_outlets))
    a, b, ta, tb = (F.col(x) for x in ("a", "b", "ta", "tb"))
    rows = rows.withColumn("g2", g2(a, b, ta, tb)).withColumn("p", chi2_p(F.abs("g2")))
    rows = benjamini_hochberg(rows, "p", ["slice"])
    r, e = log_ratio(a, b, ta, tb), log_ratio_error(a, b)
    z = 1.959963984540054
    rows = rows.where((F.col("g2") > 0) & (F.col("q") < alpha)).select(
        "slice", "token", "a", "b", "docs", "outlets", F.round("g2", 3).alias("g2"), F.round(r, 2).alias("log_ratio"), F.round(r - z * e, 2).alias("ci_low"), F.round(r + z * e, 2).alias("ci_high"),
        F.when(b > 0, F.round((a / ta) / (b / tb), 2)).alias("rate_ratio"),
    )
    order = Window.partitionBy("slice").orderBy(F.col("ci_low").desc(), F.col("g2").desc(), F.col("token"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def viterbi_bursts(r: np.ndarray, d: np.ndarray, s: float = 2.0, gamma: float = 1.0) -> list[tuple[int, int, float]]:
    """(first, last, weight) of the intervals in which a two-state automaton emits r of d events at the raised rate. Entering the upper state costs gamma ln T, leaving is free; ties stay, and the last one goes to the base state."""
    r, d = np.asarray(r, float), np.asarray(d, float)
    if r.ndim != 1 or r.shape != d.shape:
        raise ValueError("counts and exposure must be vectors of one length")
    if not (np.isfinite(r).all() and np.isfinite(d).all()) or (r < 0).any() or (d < r).any():
        raise ValueError("counts must be finite, and 0 <= counts <= exposure")
    if s <= 1 or gamma < 0:
        raise ValueError("s must be over 1 and gamma at least 0")
    n, hits, total = len(r), float(r.sum()), float(d.sum())
    if n < 2 or hits <= 0 or total <= 0:
        return []
    p = np.array([hits / total, min(s * hits / total, 0.9999)])
    if p[1] <= p[0]:
        return []
    cost = np.where(d[:, None] > 0, -(r[:, None] * np.log(p) + (d - r)[:, None] * np.log(1 - p)), 0.0)
    enter = gamma * np.log(n)
    best, back = np.zeros((n, 2)), np.zeros((n, 2), int)
    best[0] = cost[0, 0], cost[0, 1] + enter
    for t in range(1, n):
        low, high = best[t - 1]
        back[t, 0] = 1 if high < low else 0
        best[t, 0] = min(low, high) + cost[t, 0]
        back[t, 1] = 1 if high <= low + enter else 0
        best[t, 1] = min(high, low + enter) + cost[t, 1]
    state = np.zeros(n, int)
    state[-1] = 1 if best[-1, 1] < best[-1, 0] else 0
    for t in range(n - 1, 0, -1):
        state[t - 1] = back[t, state[t]]
    out, t = [], 0
    while t < n:
        if state[t]:
            end = t
            while end + 1 < n and state[end + 1]:
                end += 1
            out.append((t, end, round(float((cost[t : end + 1, 0] - cost[t : end + 1, 1]).sum()), 2)))
            t = end
        t += 1
    return out


def bursts(series: DataFrame, time: str, r: str, d: str, by: Sequence[str], *, min_total: int = 30, s: float = 2.0, gamma: float = 1.0) -> DataFrame:
    """(by, start, end, weight, mentions, exposure) from contiguous series, one a group; a series is as long as its calendar, so a group is small."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in series.select(*by).schema) + ", start long, end long, weight double, mentions long, exposure long"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(time)
        hits, total, at = pdf[r].to_numpy(float), pdf[d].to_numpy(float), pdf[time].to_numpy()
        if (np.diff(at) != 1).any():
            raise ValueError("times must be a contiguous calendar")
        rows = [(*(pdf[c].iloc[0] for c in by), int(at[a]), int(at[b]), w, int(hits[a : b + 1].sum()), int(total[a : b + 1].sum())) for a, b, w in (viterbi_bursts(hits, total, s, gamma) if hits.sum() >= min_total else [])]
        return pd.DataFrame(rows, columns=[*by, "start", "end", "weight", "mentions", "exposure"])

    return series.groupBy(*by).applyInPandas(run, schema)


def exposure(df: DataFrame, time: str, subjects: str, doc: str, *, tagged_only: bool = False, min_total: int = 0) -> DataFrame:
    """(time, subject, r, d): documents that bear a subject and documents at all, or tagged ones, on the contiguous calendar, zero-filled. min_total: subjects of fewer documents are left out before the calendar is filled, which is what a burst needs at least."""
    rows = df.where(F.col(time).isNotNull()).select(F.col(time).cast("long").alias("time"), F.col(doc).alias("doc"), F.array_distinct(subjects).alias("subjects"))
    base = rows.where(F.size("subjects") > 0) if tagged_only else rows
    d = base.groupBy("time").agg(F.count_distinct("doc").alias("d"))
    r = rows.select("time", "doc", F.explode("subjects").alias("subject")).groupBy("time", "subject").agg(F.count_distinct("doc").alias("r"))
    if min_total:
        r = r.join(r.groupBy("subject").agg(F.sum("r").alias("total")).where(F.col("total") >= min_total).select("subject"), "subject", "left_semi")
    ends = d.agg(F.min("time").alias("a"), F.max("time").alias("b")).where("a is not null")
    # the product's one side is a single row, the calendar's ends
    grid = r.select("subject").distinct().crossJoin(F.broadcast(ends)).select("subject", F.explode(F.sequence("a", "b")).alias("time"))
    return grid.join(d, "time", "left").join(r, ["time", "subject"], "left").select("time", "subject", F.coalesce("r", F.lit(0)).alias("r"), F.coalesce("d", F.lit(0)).alias("d"))
