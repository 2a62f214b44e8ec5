"""Time-varying curriculum over sources, with built-in functions only: each source's weight schedule is integrated over training time, its cumulative token demand is inverted to give every document a training position, and documents are range-sorted by position."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm.common import n_words, stored

#: Documents of one source in a bucket of its hash order: what one task sorts at once.
BUCKET_DOCS = 5_000
#: Base weights by the source's place in code point order.
WEIGHTS = (3, 1, 2)


def targets(sources: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, repeat: float = 2.0) -> DataFrame:
    """Adds weight and target to a table (source, source_size) with one row a source.

    Water filling in closed form: with the sources in order of repeat * size / weight, the first k are full where the level that the rest would share exceeds their ratio. One row a source: its windows run over that small table alone.
    """
    w = F.get(F.array(*(F.lit(float(x)) for x in weights)), ((F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)).cast("int"))
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = Window.orderBy(F.col("__r").asc(), F.col("source").asc_nulls_last())
    before, here_on = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    cap = F.col("source_size") * F.lit(repeat)
    one = sources.withColumn("weight", w).withColumn("__r", cap / F.col("weight"))
    # whole numbers until the one division, so that reruns agree to the last bit
    level = (F.sum("source_size").over(every) * F.lit(share) - F.lit(repeat) * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("weight").over(here_on)
    # the level rises while sources are full and falls from the first that is not: its maximum holds for all
    one = one.withColumn("__level", level).withColumn("__level", F.max("__level").over(every))
    return one.withColumn("target", F.least(cap, F.col("__level") * F.col("weight")).cast("double")).drop("__r", "__level")


def place_documents(
    docs: DataFrame, *, text: str = "text", source: str = "source", doc_id: str = "doc_id", weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, repeat: float = 2.0, tilt: float = 0.5, keep: bool = False
) -> DataFrame:
    """The rows of mix_sources in no order; keep: with a struct `row` of all columns of docs, which goes through the same shuffle."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        F.col(f"`{source}`").cast("string").alias("source"),
        n_words(body).alias("size"),
        F.xxhash64(body).alias("__t"),
        *([F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")] if keep else []),
    )
    sizes = stored(rows.drop("row"), "mix-sizes")
    rows = rows if keep else sizes
    sums = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"), F.count("*").alias("__n"))
    n = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    per_source = targets(sums, weights=weights, share=share, repeat=repeat)
    per_source = per_source.withColumn("__at", F.row_number().over(by_name) - 1).withColumn("__count", F.count("*").over(n))
    per_source = per_source.withColumn("__tilt", F.when(F.col("__count") > 1, F.lit(tilt) * (1 - 2 * F.col("__at") / (F.col("__count") - 1))).otherwise(F.lit(0.0)))
    per_source = per_source.withColumn("__buckets", F.ceil(F.col("__n") / BUCKET_DOCS).cast("int")).drop("__n", "__at", "__count").withColumn("__key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("null")))
    per_source = stored(per_source, "mix-sources")

    def bucketed(table: DataFrame) -> DataFrame:
        h = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null "), F.col("__t").cast("string"))).cast("binary"))
        keyed = table.withColumn("__key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("null"))).drop("source").join(per_source, "__key").withColumn("__h", h)
        return keyed.withColumn("__b", F.floor(F.conv(F.substring("__h", 1, 8), 16, 10).cast("long") / F.lit(float(2**32)) * F.col("__buckets")).cast("int"))

    bucket = bucketed(sizes).groupBy("__key", "__b").agg(F.sum("size").alias("__sum"))
    bucket = bucket.withColumn("__before", F.coalesce(F.sum("__sum").over(Window.partitionBy("__key").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__sum")
    inside = Window.partitionBy("__key", "__b").orderBy("__h", "doc_id", "size", "__t").rowsBetween(Window.unboundedPreceding, -1)
    placed = bucketed(rows).withColumn("__c", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(bucket, ["__key", "__b"])
    c, size, goal = F.col("__before") + F.col("__c"), F.col("size"), F.floor(F.col("target")).cast("long")
    passes = range(int(repeat) + (repeat % 1 > 0))
    taken = [F.greatest(F.lit(0), F.least(size, goal - c - k * F.col("source_size"))) for k in passes]
    # inverse of t + a (t - t^2) = u, the stable form of the quadratic's root
    a = F.col("__tilt")

    def due(at):
        u = F.least(F.lit(1.0), at / F.col("target"))
        return F.when(F.col("target") <= 0, F.lit(1.0)).otherwise(2 * u / ((1 + a) + F.sqrt(F.greatest(F.lit(0.0), (1 + a) * (1 + a) - 4 * a * u))))

    whole = [(2 * x >= size) & (x > 0) for x in taken]
    positions = F.filter(F.array(*(F.when(y, due(c + k * F.col("source_size"))) for k, y in zip(passes, whole, strict=True))), lambda x: x.isNotNull())
    taken = sum(taken[1:], taken[0]).cast("long").alias("taken")
    return placed.select("doc_id", "source", "size", "source_size", "target", taken, positions.alias("positions"), due(c).alias("position"), *(["row"] if keep else []))


def mix_sources(docs: DataFrame, **settings) -> DataFrame:
    """One row a document: doc_id, source, size, source_size, target, taken, positions, position; sorted by position. Settings: text, source and doc_id name columns; weights, share, repeat, tilt.

    Schedule: source s has weight target * (1 + tilt_s * (1 - 2 t)) at time t in 0..1, where tilt_s runs from tilt for the source that comes first by name to -tilt for the last; its integral, target * (t + tilt_s * (t - t^2)), is inverted in closed form. Documents of a source come in the order of a hash of their ids; a document whose place in that stream is c is due when the integral reaches c. The stream repeats up to repeat times; what lies before the target is taken, so taken is a part of a document only at the stream's end, and each source's sum differs from its target by less than a word. positions: one for each pass of which at least half of the document is taken; position: the first pass's.

    Null texts have size 0; null sources are one source, ordered last; rows with equal ids are rows of their own, ordered by size and a hash of their text too; rows with a null id are dealt out by that hash; texts may be of any length; other columns of docs, whatever their names, are not read; empty tables give none. A hot source is cut into buckets of BUCKET_DOCS documents of its hash order: bucket sums are added up first, and only then the rows inside each bucket. Windows without a key run over one row a source, those of a source over one row a bucket.
    """
    return place_documents(docs, **settings).orderBy("position", "doc_id", "source", "size")


def mixed_rows(docs: DataFrame, **settings) -> DataFrame:
    """A row of docs, with its columns as they are, for every position that the mix gives it, in the order of positions; rows without a position are left out."""
    due = place_documents(docs, keep=True, **settings).select("row", "doc_id", "size", F.explode("positions").alias("at"))
    return due.orderBy("at", "doc_id", "size").select("row.*")
