"""Upsert merges, change detection and invalidation by lineage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.text import squeeze
from textmill.operators.contracts import ContractError, column_order


def check_shrink(new: int, preserved: int, old: int, ratio: float = 0.95, allow: bool = False) -> None:
    if old and new + preserved < ratio * old and not allow:
        raise ContractError(f"{new} new and {preserved} preserved rows are under {ratio:g} of {old}")


def merge(new: DataFrame, old: DataFrame, key: str, *, exclude: Sequence[str] = (), keep_missing: bool = False, public: str | None = None, preserve: DataFrame | None = None) -> DataFrame:
    """Fresh rows with the columns that only the stored table has. keep_missing: stored rows without a fresh one stay, whole and marked not public. preserve: keys whose stored rows are kept in the same way even if others are dropped."""
    extra = [c for c in old.columns if c not in new.columns and c not in exclude and c != key]
    joined = new.join(old.select(key, *extra), key, "left")
    order = column_order([*new.columns, *extra], [c for c in old.columns if c not in exclude])
    out = joined.select(*order)
    gone = old.join(new.select(key), key, "left_anti")
    if not keep_missing:
        if preserve is None:
            return out
        gone = gone.join(preserve.select(key).distinct(), key, "left_semi")
    if public:
        gone = gone.withColumn(public, F.lit(False))
    return out.unionByName(gone.select(*(c for c in gone.columns if c in order or c == public)), allowMissingColumns=True)


def changed_sources(new: DataFrame, old: DataFrame, key: str, sources: Sequence[str]) -> DataFrame:
    """(key, source): rows whose text differs apart from white space; a column that the stored table lacks counts as empty."""
    o = old.select(key, *((F.col(c) if c in old.columns else F.lit("")).alias(f"__{c}") for c in sources))
    both = new.select(key, *sources).join(o, key)
    differ = [F.when(squeeze(F.col(c).cast("string")) != squeeze(F.col(f"__{c}").cast("string")), F.lit(c)) for c in sources]
    return both.select(key, F.explode(F.array_compact(F.array(*differ))).alias("source"))


def stale_cells(changes: DataFrame, lineage: Mapping[str, Sequence[str]], key: str) -> DataFrame:
    """(key, column): computed columns of the changed sources, by a lineage table that is small by its nature."""
    table = changes.sparkSession.createDataFrame([(s, c) for s, cs in lineage.items() for c in cs], "source string, column string")
    return changes.join(F.broadcast(table), "source").select(key, "column").distinct()


def invalidate(df: DataFrame, stale: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """The listed cells set to null, types kept."""
    flags = stale.groupBy(key).agg(F.collect_set("column").alias("__stale"))
    out = df.join(flags, key, "left")
    gone = lambda c: F.coalesce(F.array_contains("__stale", c), F.lit(False))
    return out.select(*(F.when(gone(c), F.lit(None).cast(df.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns))


def restore_failed(new: DataFrame, old: DataFrame, failures: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Stored values in the cells (key, column) whose reading failed."""
    flags = failures.groupBy(key).agg(F.collect_set("column").alias("__failed"))
    base = old.select(key, *(F.col(c).alias(f"__{c}") for c in columns))
    out = new.join(flags, key, "left").join(base, key, "left")
    failed = lambda c: F.coalesce(F.array_contains("__failed", c), F.lit(False))
    return out.select(*(F.when(failed(c), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in new.columns))


def carry_private(new: Column, stored: Column, kept: Sequence[str]) -> Column:
    """Private columns of both tables, of the stored ones those that are still kept."""
    empty = F.array().cast("array<string>")
    return F.array_sort(F.array_union(F.coalesce(new, empty), F.array_intersect(F.coalesce(stored, empty), F.array(*map(F.lit, kept)) if kept else empty)))


def visibility_changed(new: DataFrame, old: DataFrame, key: str, flags: Sequence[str]) -> DataFrame:
    """One row: whether any row came, went or changed a visibility flag, so that columns across rows are stale."""
    a, b = new.select(key, *flags), old.select(key, *(F.col(f).alias(f"__{f}") for f in flags))
    full = a.withColumn("__n", F.lit(1)).join(b.withColumn("__o", F.lit(1)), key, "full")
    differ = F.col("__n").isNull() | F.col("__o").isNull()
    for f in flags:
        differ = differ | ~F.coalesce(F.col(f), F.lit(False)).eqNullSafe(F.coalesce(F.col(f"__{f}"), F.lit(False)))
    return full.agg(F.coalesce(F.bool_or(differ), F.lit(False)).alias("changed"))


def changed_rows(before: DataFrame, after: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row: how many rows differ in any of the columns, NaN equal to NaN, and in each of them."""
    b = before.select(key, *(F.col(c).alias(f"__{c}") for c in columns))
    both = after.join(b, key)
    differ = {c: ~F.col(c).eqNullSafe(F.col(f"__{c}")) for c in columns}
    anywhere = F.lit(False)
    for d in differ.values():
        anywhere = anywhere | d
    return both.agg(F.count_if(anywhere).alias("rows"), *(F.count_if(d).alias(c) for c, d in differ.items()))


def add_columns(df: DataFrame, values: DataFrame, key: str) -> DataFrame:
    """Computed columns by key; both tables must hold the same keys, each once."""
    n = df.select(key).join(values.select(key).withColumn("__v", F.lit(1)), key, "full").agg(F.count("*").alias("all"), F.count("__v").alias("v")).first()
    if not (n["all"] == n.v == df.count()) or values.count() != n.v:
        raise ContractError("the tables do not hold the same keys")
    return df.join(values, key)


def compatible(input_hash: Column, config_hash: Column, stored_input: Column, stored_config: Column) -> Column:
    """Whether a computed cell still fits its inputs and settings."""
    return stored_input.eqNullSafe(input_hash) & stored_config.eqNullSafe(config_hash) & stored_input.isNotNull()


def incremental(df: DataFrame, state: DataFrame, key: str, hash_: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a stored result for their hash, rows to be computed)."""
    return df.join(state, [key, hash_]), df.join(state.select(key, hash_), [key, hash_], "left_anti")


def replay_stale(df: DataFrame, worklist: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    return invalidate(df, worklist, key, columns)
