"""Co-occurrence networks and connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.functions.hashing import half
from textmill.functions.numbers import pmi
from textmill.session import checkpoint_folder


def members(df: DataFrame, doc: str, entities: str) -> DataFrame:
    """(doc, m, e): distinct entities of each document and how many it has."""
    return df.select(F.col(doc).alias("doc"), F.array_compact(F.array_distinct(entities)).alias("es")).where(F.size("es") > 0).select("doc", F.size("es").alias("m"), F.explode("es").alias("e"))


def node_counts(df: DataFrame, doc: str, entities: str) -> DataFrame:
    return members(df, doc, entities).groupBy("e").agg(F.count("*").alias("n"))


def pair_counts(df: DataFrame, doc: str, entities: str) -> DataFrame:
    """(source, target, co, weight): documents that hold both entities, and the sum of 1 / (m - 1) over them. Pairs are made within a document's own set, combined before the shuffle."""
    sets = df.select(F.array_sort(F.array_compact(F.array_distinct(entities))).alias("es")).where(F.size("es") > 1)
    first = sets.select(F.size("es").alias("m"), "es", F.posexplode("es").alias("i", "source"))
    pairs = first.select("m", "source", F.explode(F.slice("es", F.col("i") + 2, F.col("m"))).alias("target"))
    return pairs.groupBy("source", "target").agg(F.count("*").alias("co"), F.sum(1 / (F.col("m") - 1)).alias("weight"))


def network(df: DataFrame, doc: str, entities: str, *, min_node: int = 10, min_edge: int = 3) -> DataFrame:
    """Edges between entities that min_node documents hold, of which min_edge hold both: co, weight to 6 places, PMI over documents with entities to 3."""
    nodes = node_counts(df, doc, entities).where(F.col("n") >= min_node)
    total = members(df, doc, entities).agg(F.count_distinct("doc").alias("tagged"))
    edges = pair_counts(df, doc, entities).where(F.col("co") >= min_edge)
    edges = edges.join(nodes.select(F.col("e").alias("source"), F.col("n").alias("n_source")), "source").join(nodes.select(F.col("e").alias("target"), F.col("n").alias("n_target")), "target").crossJoin(F.broadcast(total))
    return edges.select("source", "target", "co", F.round("weight", 6).alias("weight"), F.round(pmi(F.col("co"), F.col("n_source"), F.col("n_target"), F.col("tagged")), 3).alias("pmi"), "n_source", "n_target")


def network_nodes(df: DataFrame, doc: str, entities: str, year: str, *, min_node: int = 10) -> DataFrame:
    """(node, docs, first_year, last_year) of entities that min_node documents hold; documents without a year count and bound nothing."""
    rows = df.select(F.col(year).cast("int").alias("y"), F.explode(F.array_compact(F.array_distinct(entities))).alias("node"))
    return rows.groupBy("node").agg(F.count("*").alias("docs"), F.min("y").alias("first_year"), F.max("y").alias("last_year")).where(F.col("docs") >= min_node)


def weighted_degree(edges: DataFrame, weight: str = "weight") -> DataFrame:
    """(node, degree, strength) from edges (source, target, weight)."""
    both = edges.select(F.col("source").alias("node"), F.col(weight).alias("w")).unionAll(edges.select(F.col("target").alias("node"), F.col(weight).alias("w")))
    return both.groupBy("node").agg(F.count("*").alias("degree"), F.sum("w").alias("strength"))


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that each one reaches. Rounds of pointer halving; each is checkpointed, so plans stay short and nothing is collected; more than `rounds` raise an error."""
    checkpoint_folder(edges.sparkSession)
    e = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null")
    e = e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().checkpoint()
    label = e.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("l")).withColumnRenamed("a", "node").checkpoint()
    for _ in range(rounds):
        near = e.join(label.select(F.col("node").alias("b"), "l"), "b").groupBy(F.col("a").alias("node")).agg(F.min("l").alias("m"))
        step = label.join(near, "node").select("node", F.least("l", "m").alias("l"), F.col("l").alias("was"))
        jump = step.join(step.select(F.col("node").alias("l"), F.col("l").alias("top")), "l", "left").select("node", F.least("l", F.coalesce("top", "l")).alias("l"), "was").checkpoint()
        moved = jump.where("l <> was").limit(1).count()
        label = jump.select("node", "l")
        if not moved:
            break
    else:
        raise RuntimeError(f"components have not settled after {rounds} rounds")
    return label.withColumnRenamed("l", "component")


def component_halves(found: DataFrame, seed: int | str = 42) -> DataFrame:
    """Adds half (0 or 1) by the component's hash, so that no component is split."""
    return found.withColumn("half", half(seed, F.col("component")))
