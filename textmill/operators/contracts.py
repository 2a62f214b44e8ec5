"""Contracts of tables: keys, types, vectors, allowed columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ContractError(ValueError):
    """Data that a contract does not allow."""


def key_violations(df: DataFrame, key: str) -> DataFrame:
    """One row: n, nulls, blanks, duplicates of a key."""
    c = F.col(f"`{key}`").cast("string")
    return df.groupBy(c.alias("k")).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("n"))), F.lit(0)).alias("nulls"), F.coalesce(F.sum(F.when(F.trim("k") == "", F.col("n"))), F.lit(0)).alias("blanks"), F.coalesce(F.sum(F.when(F.col("k").isNotNull(), F.col("n") - 1)), F.lit(0)).alias("duplicates"))


def require_keys(df: DataFrame, key: str, label: str = "table") -> DataFrame:
    v = key_violations(df, key).first()
    if v.nulls or v.blanks or v.duplicates:
        raise ContractError(f"{label}: {v.nulls} null, {v.blanks} blank and {v.duplicates} repeated keys in {key}")
    return df


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that stand in more than one row."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def vector_violations(df: DataFrame, vector: str, size: int) -> DataFrame:
    """One row: n, missing, wrong_size, not_finite, zero."""
    v = F.col(vector)
    bad = F.coalesce(F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(False))
    have = v.isNotNull() & (F.size(v) > 0)
    return df.agg(F.count("*").alias("n"), F.count_if(~have).alias("missing"), F.count_if(have & (F.size(v) != size)).alias("wrong_size"), F.count_if(bad).alias("not_finite"), F.count_if(have & ~bad & F.forall(v, lambda x: x == 0)).alias("zero"))


def to_long(c: Column) -> Column:
    """A whole number as a long: null and NaN give null, a fraction raises."""
    d = c.cast("double")
    return F.when(d.isNull() | F.isnan(d), F.lit(None).cast("long")).when(d == F.floor(d), d.cast("long")).otherwise(F.raise_error(F.concat(F.lit("not a whole number: "), d.cast("string"))).cast("long"))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Declared columns cast to their types, long ones without loss; undeclared columns stay behind them. Missing declared columns raise."""
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ContractError(f"missing columns: {', '.join(missing)}")
    declared = [(to_long(F.col(f"`{f.name}`")) if isinstance(f.dataType, T.LongType) and not isinstance(df.schema[f.name].dataType, (T.LongType, T.IntegerType)) else F.col(f"`{f.name}`").cast(f.dataType)).alias(f.name) for f in schema]
    return df.select(*declared, *(F.col(f"`{c}`") for c in df.columns if c not in schema.names))


def check_allowed(df: DataFrame, allowed: Sequence[str]) -> DataFrame:
    unknown = sorted(set(df.columns) - set(allowed))
    if unknown:
        raise ContractError(f"columns that are not allowed: {', '.join(unknown)}")
    return df


def suspect_columns(df: DataFrame, handled: Sequence[str] = (), mean: float = 3000, largest: int = 30000) -> DataFrame:
    """(column, mean_length, max_length, suspect) of text columns that nobody has ruled on, from one pass over the table."""
    names = [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in handled]
    text = lambda c: F.nullif(F.col(f"`{c}`"), F.lit(""))
    one = df.agg(*(F.struct(F.lit(c).alias("column"), F.coalesce(F.avg(F.length(text(c))), F.lit(0.0)).alias("mean_length"), F.coalesce(F.max(F.length(text(c))), F.lit(0)).alias("max_length")).alias(f"c{i}") for i, c in enumerate(names)))
    rows = one.select(F.explode(F.array(*(F.col(f"c{i}") for i in range(len(names))))).alias("x")).select("x.*")
    return rows.withColumn("suspect", (F.col("mean_length") > mean) | (F.col("max_length") > largest))


def column_order(new: Sequence[str], stored: Sequence[str]) -> list[str]:
    """Stored order, new columns right after the one before them."""
    out = [c for c in stored if c in new]
    before = None
    for c in new:
        if c not in out:
            out.insert(out.index(before) + 1 if before in out else 0, c)
        before = c
    return out


def reorder_after(df: DataFrame, columns: Sequence[str], anchor: str) -> DataFrame:
    rest = [c for c in df.columns if c not in columns]
    at = rest.index(anchor) + 1
    return df.select(*(F.col(f"`{c}`") for c in [*rest[:at], *columns, *rest[at:]]))


def last(df: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    """Columns of the given prefixes behind all others."""
    tail = [c for c in df.columns if c.startswith(tuple(prefixes))]
    return df.select(*(F.col(f"`{c}`") for c in [*(c for c in df.columns if c not in tail), *tail]))


def same_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys that only one of the tables has; empty if the sets agree."""
    x, y = a.select(key).distinct(), b.select(key).distinct()
    return x.join(y, key, "left_anti").withColumn("side", F.lit("left")).unionAll(y.join(x, key, "left_anti").withColumn("side", F.lit("right")))
