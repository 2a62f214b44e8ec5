"""Similarity join of documents on sets of word n-grams by vertical partitioning.

The global order of n-grams is cut into fragments. First every document's n-grams go to the tasks of their fragments, packed; there n-grams of one document only fall out, and the others get their document frequency. Documents of which too few n-grams are left cannot link and fall out too. Equal sets become one class. A document's rarest n-grams (its prefix) must hold one of every partner's: documents that share them, directly or through others, form blocks, outside of which no link can be. In a block, each task counts the partial overlaps of all pairs in one fragment, as one packed matrix; matrices are summed per pair, pairs over the threshold are the links, and only a spanning forest and link counts leave the task. Blocks of more than TILE classes or TILE_NGRAMS n-grams are cut into tiles of two chunks each.

How many fragments, buckets and groups of tiles there are follows from the data alone, so what a task holds at once does not grow with the input: a group has about FRAGMENT_NGRAMS n-grams, and a shuffle partition takes one group after the other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import discard, prepare, resting, resting_group, shingle_hashes, stored
from textmill.llm.graph import connected_components

#: n-grams that a fragment's task holds at once, about.
FRAGMENT_NGRAMS = 1_200_000
#: n-grams that a reading task gathers before it sends them on.
BUFFER_NGRAMS = 1_500_000
#: Classes in a chunk of a block.
TILE = 1_500
#: N-grams of the classes in a chunk of a block, about.
TILE_NGRAMS = 4_000_000
#: Fragments of the order in which a block's overlaps are counted.
FRAGMENTS = 4


#: A stored table of at most so many short rows (some 10 MB) may be broadcast; larger ones are joined by shuffles.
BROADCAST_ROWS = 150_000


def broadcast_if_small(table: DataFrame) -> DataFrame:
    """The table with a broadcast hint if its counted rows are few. Its rows are ids and numbers, or a key of 40 characters."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        y = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (y ^ (y >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(20)


def pack(a: np.ndarray) -> bytes:
    """Integers by planes of their bytes, compressed."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() if len(a) else b""
    return zstandard.ZstdCompressor(level=1).compress(planes)


def unpack(raw: bytes, kind: str) -> np.ndarray:
    planes = zstandard.ZstdDecompressor().decompress(raw)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, -1).T).view(kind).ravel() if planes else np.empty(0, kind)


def runs(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs of equal values."""
    if not len(sorted_keys):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))
    return at, np.diff(np.append(at, len(sorted_keys)))


def ngram_segments(rows: DataFrame, n: int, fragments: int) -> DataFrame:
    """(fragment, kind, ids, counts, ngrams): kind 0 holds the n-grams of many documents in one fragment, kind 1 the sizes of documents' sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["fragment", "kind", "ids", "counts", "ngrams"]
        held: list[tuple[int, np.ndarray]] = []
        size = 0

        def send() -> pa.RecordBatch:
            ids, sizes = np.array([d for d, _ in held], np.int64), np.array([len(h) for _, h in held], np.int64)
            every, owner = np.concatenate([h for _, h in held]), np.repeat(np.arange(len(held)), sizes)
            place = (every >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)
            order = np.argsort(place, kind="stable")
            every, owner, place = every[order], owner[order], place[order]
            out = [(int(ids[0] % fragments), 1, pack(ids), pack(sizes.astype(np.uint32)), b"")]
            for at, count in zip(*runs(place), strict=True):
                own_at, own_n = runs(owner[at : at + count])
                out.append((int(place[at]), 0, pack(ids[owner[at + own_at]]), pack(own_n.astype(np.uint32)), pack(every[at : at + count])))
            kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

        for b in batches:
            for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                h = shingle_hashes(t, n)
                held.append((d, h))
                size += len(h) + 1
                if size >= BUFFER_NGRAMS:
                    yield send()
                    held, size = [], 0
        if held:
            yield send()

    return rows.mapInArrow(resting(run), "fragment int, kind int, ids binary, counts binary, ngrams binary")


def shared_ngrams(segments: DataFrame, buckets: int) -> DataFrame:
    """(bucket, kind, ids, counts, ngrams, freq): of each fragment the n-grams that two documents or more have, by bucket of documents; and the sizes of sets."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        sizes = pdf[pdf.kind == 1]
        if len(sizes):
            ids, n = np.concatenate([unpack(x, "i8") for x in sizes.ids]), np.concatenate([unpack(x, "u4") for x in sizes.counts])
            bucket = (mix(ids) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            for at, count in zip(*runs(bucket[order]), strict=True):
                some = order[at : at + count]
                out.append((int(bucket[some[0]]), 1, pack(ids[some]), pack(n[some]), b"", b""))
        blobs = pdf[pdf.kind == 0]
        if len(blobs):
            ngrams = np.concatenate([unpack(x, "u8") for x in blobs.ngrams])
            owner = np.concatenate([np.repeat(unpack(i, "i8"), unpack(c, "u4")) for i, c in zip(blobs.ids, blobs.counts, strict=True)])
            order = np.argsort(ngrams, kind="stable")
            ngrams, owner = ngrams[order], owner[order]
            at, count = runs(ngrams)
            freq = np.repeat(count, count).astype(np.uint32)
            keep = freq > 1
            ngrams, owner, freq = ngrams[keep], owner[keep], freq[keep]
            bucket = (mix(owner) % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((owner, bucket))
            ngrams, owner, freq, bucket = ngrams[order], owner[order], freq[order], bucket[order]
            for at, count in zip(*runs(bucket), strict=True):
                part = slice(at, at + count)
                own_at, own_n = runs(owner[part])
                out.append((int(bucket[at]), 0, pack(owner[part][own_at]), pack(own_n.astype(np.uint32)), pack(ngrams[part]), pack(freq[part])))
        return pd.DataFrame(out, columns=["bucket", "kind", "ids", "counts", "ngrams", "freq"])

    return segments.groupBy("fragment").applyInPandas(resting_group(run), "bucket int, kind int, ids binary, counts binary, ngrams binary, freq binary")


def surviving_sets(shared: DataFrame, percent: int) -> DataFrame:
    """(doc_id, n, n_shared, class_key, ngrams): every document; ngrams, in the order of frequency and hash, only where enough of them are shared for a link. Equal sets, and no others, have equal keys."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sizes, blobs = pdf[pdf.kind == 1], pdf[pdf.kind == 0]
        ids, n = np.concatenate([unpack(x, "i8") for x in sizes.ids]), np.concatenate([unpack(x, "u4") for x in sizes.counts]).astype(np.int64)
        order = np.lexsort((-n, ids))  # of repeated ids the largest set speaks
        ids, n = ids[order], n[order]
        first, _ = runs(ids)
        ids, n = ids[first], n[first]
        shared = np.zeros(len(ids), np.int64)
        packed: list = [None] * len(ids)
        keys: list = [None] * len(ids)
        if len(blobs):
            owner = np.concatenate([np.repeat(unpack(i, "i8"), unpack(c, "u4")) for i, c in zip(blobs.ids, blobs.counts, strict=True)])
            ngrams, freq = np.concatenate([unpack(x, "u8") for x in blobs.ngrams]), np.concatenate([unpack(x, "u4") for x in blobs.freq])
            order = np.lexsort((ngrams, freq, owner))
            owner, ngrams = owner[order], ngrams[order]
            new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (ngrams[1:] != ngrams[:-1])])
            owner, ngrams = owner[new], ngrams[new]
            for at, count in zip(*runs(owner), strict=True):
                i = int(np.searchsorted(ids, owner[at]))
                shared[i] = count
                if 100 * count >= percent * n[i]:
                    body = ngrams[at : at + count].astype("<u8").tobytes()
                    packed[i] = body
                    keys[i] = f"{n[i]}-{xxhash.xxh3_128_hexdigest(body)}" if count >= n[i] else f"id-{ids[i]}"
        return pd.DataFrame({"doc_id": ids, "n": n, "n_shared": shared, "class_key": keys, "ngrams": packed})

    return shared.groupBy("bucket").applyInPandas(resting_group(run), "doc_id long, n long, n_shared long, class_key string, ngrams binary")


def prefix_ngrams(classes: DataFrame, percent: int) -> DataFrame:
    """(doc_id, ngram) of each set's prefix, less the n-grams that no other set has: those are the first in the order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs, grams = [], []
            for d, n, shared, body in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                length = n - (percent * n + 99) // 100 + 1 - (n - shared)
                some = np.frombuffer(body, "<u8")[: max(0, length)]
                docs.append(np.full(len(some), d, np.int64))
                grams.append(some.astype(np.uint64).view(np.int64))
            if docs:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(docs)), pa.array(np.concatenate(grams))], ["doc_id", "ngram"])

    return classes.select("doc_id", "n", "n_shared", "ngrams").mapInArrow(resting(run), "doc_id long, ngram long")


def overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets left x right (indices of sets). N-grams with the same documents count together."""
    out = np.zeros((len(left), len(right)), np.float32)
    sizes = np.array([len(s) for s in sets])
    if len(sets) == 2 and len(left) == 1 == len(right):
        return np.array([[len(np.intersect1d(sets[left[0]], sets[right[0]], assume_unique=True))]], np.uint32)
    if not sizes.sum():
        return out.astype(np.uint32)
    row = np.repeat(np.arange(len(sets)), sizes)
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    number = np.bincount(column)
    live = number[column] > 1
    row, column = row[live], column[live]
    if not len(row):
        return out.astype(np.uint32)
    _, column = np.unique(column, return_inverse=True)
    mark = mix(np.arange(1, len(sets) + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))
    mark = (mark << np.uint64(22)) ^ mix(mark + np.uint64(77))
    signature = np.zeros(column.max() + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.add.at(signature, column, mark[row])
    _, first, kind, weight = np.unique(signature, return_index=True, return_inverse=True, return_counts=True)
    chosen = np.zeros(len(signature), bool)
    chosen[first] = True
    live = chosen[column]
    row, column = row[live], kind[column[live]]
    step = max(64, 8_000_000 // len(sets))
    for k in range(0, len(weight), step):
        part = (column >= k) & (column < k + step)
        m = np.zeros((len(sets), min(step, len(weight) - k)), np.float32)
        m[row[part], column[part] - k] = 1
        out += (m[left] * weight[k : k + step].astype(np.float32)) @ m[right].T
    return out.astype(np.uint32)


def count_tiles(tiles: DataFrame, percent: int, groups: int) -> DataFrame:
    """tiles: tile, side (0: both, 1: left, 2: right), doc_id, n, copies, ngrams. Returns (tile, doc_id, root, links): links of each document in its tile, and the smallest document that it reaches there."""

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = ["tile", "side", "doc_id", "n", "copies", "ngrams"]
            fixed = [b.column(x) for x in names[:5]]
            cut = [np.sort(np.frombuffer(x, "<u8")) for x in b.column("ngrams").to_pylist()]
            for f in range(FRAGMENTS):
                low, high = f * (2**64 // FRAGMENTS), (f + 1) * (2**64 // FRAGMENTS) - 1 if f + 1 < FRAGMENTS else 2**64 - 1
                part = [x[np.searchsorted(x, np.uint64(low)) : np.searchsorted(x, np.uint64(high), "right")].tobytes() for x in cut]
                yield pa.RecordBatch.from_arrays([*fixed, pa.array(part, pa.binary()), pa.array(np.full(len(part), f, np.int32))], [*names, "fragment"])

    def partial(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        codec = zstandard.ZstdCompressor(level=1)
        for tile, part in pdf.sort_values(["tile", "doc_id"]).groupby("tile", sort=False):
            side = part.side.to_numpy()
            left, right = np.flatnonzero(side < 2), np.flatnonzero(side != 1)
            counts = overlaps([np.frombuffer(x, "<u8") for x in part.ngrams], left, right)
            out.append((tile, int(part.fragment.iloc[0]), part.doc_id.to_numpy("<i8").tobytes(), part.n.to_numpy("<i8").tobytes(), part.copies.to_numpy("<i8").tobytes(), side.astype("u1").tobytes(), codec.compress(counts.tobytes())))
        return pd.DataFrame(out, columns=["tile", "fragment", "ids", "sizes", "copies", "sides", "counts"])

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        docs, roots, links, names = [], [], [], []
        for tile, part in pdf.groupby("tile", sort=True):
            ids, n, copies, side = (np.frombuffer(part[c].iloc[0], k) for c, k in (("ids", "<i8"), ("sizes", "<i8"), ("copies", "<i8"), ("sides", "u1")))
            left, right = np.flatnonzero(side < 2), np.flatnonzero(side != 1)
            both = sum(np.frombuffer(zstandard.ZstdDecompressor().decompress(x), np.uint32).reshape(len(left), len(right)).astype(np.int64) for x in part.counts)
            linked = 100 * both >= percent * (n[left][:, None] + n[right][None, :] - both)
            linked &= left[:, None] != right[None, :]
            degree = np.zeros(len(ids), np.int64)
            np.add.at(degree, left, linked @ copies[right])
            if not np.array_equal(left, right):
                np.add.at(degree, right, copies[left] @ linked)
            label = np.arange(len(ids))  # ids ascend, so the smallest index is the smallest id
            a, b = np.nonzero(linked)
            a, b = left[a], right[b]
            while len(a):
                low = np.minimum(label[a], label[b])
                new = label.copy()
                np.minimum.at(new, a, low)
                np.minimum.at(new, b, low)
                new = np.minimum(new, new[new])
                if (new == label).all():
                    break
                label = new
            docs.append(ids)
            roots.append(ids[label])
            links.append(degree)
            names.append(np.full(len(ids), tile, object))
        if not docs:
            return pd.DataFrame({"tile": [], "doc_id": [], "root": [], "links": []})
        return pd.DataFrame({"tile": np.concatenate(names), "doc_id": np.concatenate(docs), "root": np.concatenate(roots), "links": np.concatenate(links)})

    cut = tiles.mapInArrow(resting(segments), "tile string, side int, doc_id long, n long, copies long, ngrams binary, fragment int")
    group = F.pmod(F.xxhash64("tile"), F.lit(groups)).alias("part")
    counted = cut.groupBy("fragment", group).applyInPandas(resting_group(partial), "tile string, fragment int, ids binary, sizes binary, copies binary, sides binary, counts binary")
    return counted.groupBy(group).applyInPandas(resting_group(total), "tile string, doc_id long, root long, links long")


def ngram_join(docs: DataFrame, *, n: int = 5, percent: int = 80, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id, n_links, class_id.

    A document's set: distinct n-word shingles after lower-casing A-Z; with fewer words, the whole sequence as one; without words or text, empty and linked with nothing. Two documents link when 100 * intersection >= percent * union. component_id: the smallest doc_id reachable by links, its own included; class_id: the smallest doc_id with an equal set; n_links: its partners, copies among them.
    All links count; equal sets and large groups are never expanded into pairs of rows. Rows with one doc_id are one document (the largest of its sets counts); rows with a null doc_id have n_shingles and null ids; an empty table gives none. Texts are read whole, however long; ties need no order, as components and classes go by the smallest id. Other columns of docs, whatever their names, are not read. Shingles are compared by 64-bit hashes.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.selectExpr(f"cast(`{doc_id}` as bigint) as doc_id", f"cast(`{text}` as string) as text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(size / 6 / FRAGMENT_NGRAMS) + 1
    known = rows.where(F.col("doc_id").isNotNull())
    sets = stored(surviving_sets(shared_ngrams(ngram_segments(known, n, parts), parts), percent), "ngram-sets")
    live = sets.where(F.col("ngrams").isNotNull())
    keys = live.groupBy("class_key").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("copies"), F.max("n").alias("n"))
    keys = stored(keys, "ngram-classes")
    prefixes = stored(prefix_ngrams(live, percent), "ngram-prefixes")
    first = prefixes.groupBy("ngram").agg(F.min("doc_id").alias("b"), F.count("*").alias("k")).where("k > 1")
    # written, so that both sides of the join are plain reads: adaptive execution then splits an n-gram that very many documents have
    first = stored(first.drop("k"), "ngram-firsts")
    blocks = connected_components(prefixes.join(first, "ngram").where("doc_id <> b").select(F.col("doc_id").alias("a"), "b"))
    # only one document of each class is compared; blocks of one class have no pairs
    firsts = keys.select(F.col("class_id").alias("doc_id"), "copies", F.col("n").alias("class_n"))
    blocks = stored(blocks.withColumnsRenamed({"node": "doc_id", "component": "block"}).join(firsts, "doc_id"), "ngram-blocks")
    cut = F.greatest(F.ceil(F.col("k") / TILE), F.ceil(F.col("total") / TILE_NGRAMS)).cast("int")
    chunks = blocks.groupBy("block").agg(F.count("*").alias("k"), F.sum("class_n").alias("total")).where("k > 1").select("block", cut.alias("chunks"))
    places = stored(blocks.join(chunks, "block").withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.col("chunks")).cast("int")), "ngram-places")
    groups = int((places.agg(F.sum(F.col("class_n") * F.col("chunks"))).first()[0] or 0) / FRAGMENT_NGRAMS) + 1
    placed = live.select("doc_id", "n", "ngrams").join(broadcast_if_small(places.drop("class_n")), "doc_id")
    # a class of chunk c stands left in tiles (c, j) with j > c, right in (i, c) with i < c, and on both sides in (c, c)
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    tiles = placed.select("block", "doc_id", "n", "copies", "ngrams", "chunk", "chunks", other).select(
        F.concat_ws("/", "block", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("tile"),
        F.when(F.col("chunk") == F.col("other"), 0).when(F.col("chunk") < F.col("other"), 1).otherwise(2).alias("side"),
        "doc_id", "n", "copies", "ngrams",
    )
    found = stored(count_tiles(tiles, percent, groups), "ngram-links")
    links = found.groupBy("doc_id").agg(F.sum("links").alias("links"), F.min("root").alias("root"), F.max("root").alias("last"), F.count("*").alias("tiles"))
    if links.where("tiles > 1").limit(1).count():  # blocks of several tiles are joined up
        joined = connected_components(found.select(F.col("doc_id").alias("a"), F.col("root").alias("b")))
        links = links.join(joined.withColumnsRenamed({"node": "doc_id"}), "doc_id", "left").select("doc_id", "links", F.coalesce("component", "doc_id").alias("root"))
    per_class = stored(keys.drop("n").join(links.select(F.col("doc_id").alias("class_id"), "links", "root"), "class_id", "left"), "ngram-results")
    discard(keys, prefixes, first, blocks, places, found)
    out = sets.select("doc_id", "n", "class_key").join(broadcast_if_small(per_class), "class_key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "class_id", "doc_id").alias("component_id"),
        (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).alias("n_links"), F.coalesce("class_id", "doc_id").alias("class_id"),
    )
    if not rows.where(F.col("doc_id").isNull()).limit(1).count():
        return out

    def lone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k = b.num_rows
            none = pa.nulls(k, pa.int64())
            yield pa.RecordBatch.from_arrays([none, pa.array([len(shingle_hashes(t, n)) for t in b.column(0).to_pylist()], pa.int64()), none, pa.array([0] * k, pa.int64()), none], ["doc_id", "n_shingles", "component_id", "n_links", "class_id"])

    nulls = rows.where(F.col("doc_id").isNull()).select("text").mapInArrow(resting(lone), "doc_id long, n_shingles long, component_id long, n_links long, class_id long")
    return out.unionByName(nulls)
