"""Approximate nearest neighbours by cosine: NN-descent builds a neighbour graph through iterative joins of neighbours of neighbours, and queries walk it greedily.

Equal vectors are one node of the graph. Its first edges come from a few orders of the nodes: each order sorts them by the sides of random hyperplanes on which they lie and then along a random direction, and compares all pairs in stretches of CELL consecutive nodes. That is a range sort, so stretches have one size whatever the data. Each round of NN-descent then brings the vectors of every node's neighbours, forward and reverse, together and compares them with each other, until few lists change. Queries start from their own node's neighbours and expand the best nodes of their beam round by round, until all of the beam is expanded. Graph and search compare squared distances of 32-bit unit vectors, which tell near copies apart where cosines round to one; the whole beam is ranked again by exact cosines of the original vectors.

Python groups are sized in bytes: GROUP_BYTES of vectors, whatever the number of nodes or of shuffle partitions.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm.common import discard, prepare, stored

#: Nodes that hyperplanes are laid through, at most; every node is placed by them.
MAX_SAMPLE = 4_000
#: Hyperplanes of an order.
PLANES = 32
#: Nodes of a stretch in which all pairs are compared.
CELL = 320
#: Bytes of vectors in a Python group, about.
GROUP_BYTES = 48 << 20


class Order:
    """Hyperplanes in the middle of two sample points each, at the sample's median, and a direction."""

    def __init__(self, sample: np.ndarray, seed: int):
        rng = np.random.default_rng(seed)
        n, dim = sample.shape
        a, b = sample[rng.integers(0, n, PLANES)], sample[rng.integers(0, n, PLANES)]
        same = ~np.any(a != b, axis=1)
        self.planes = np.where(same[:, None], rng.standard_normal((PLANES, dim)), a - b).astype(np.float32)
        self.offsets = np.median(sample @ self.planes.T, axis=0)
        self.direction = rng.standard_normal(dim).astype(np.float32)

    def keys(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sides of the hyperplanes as bits, the first in front; place along the direction)."""
        sides = vectors @ self.planes.T > self.offsets
        return sides @ (1 << np.arange(PLANES - 1, -1, -1, dtype=np.int64)), (vectors @ self.direction).astype(np.float64)


def group_size(dim: int, rows: int) -> int:
    """How many owners of so many vectors each make up a Python group."""
    return max(1, GROUP_BYTES // (rows * (4 * dim + 64)))


def as_matrix(raw: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(raw), np.float32).reshape(len(raw), -1)


def closeness(m: np.ndarray) -> np.ndarray:
    """Minus the squared distances of all pairs of rows, -9 on the diagonal."""
    m = m.astype(np.float64)
    own = (m * m).sum(1)
    out = 2 * (m @ m.T) - own[:, None] - own[None, :]
    np.fill_diagonal(out, -9)
    return out


def flat(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, owner, id, sim) of packed lists."""
    n = np.array([len(x) // 8 for x in pdf.ids], np.int64)
    return np.repeat(np.arange(len(pdf)), n), np.repeat(pdf.id.to_numpy(np.int64), n), np.frombuffer(b"".join(pdf.ids), "<i8"), np.frombuffer(b"".join(pdf.sims), "<f4")


def runs(sorted_keys: np.ndarray) -> list[tuple[int, int]]:
    at = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])) if len(sorted_keys) else np.empty(0, np.int64)
    return list(zip(at.tolist(), [*at[1:].tolist(), len(sorted_keys)], strict=True))


def first_edges(nodes: DataFrame, count: int, sample: np.ndarray, *, k: int, orders: int, seed: int) -> DataFrame:
    """(id, ids, sims): for each order of the nodes the k nearest of each node in its stretch. Nodes of one stretch have all their pairs compared at once."""
    fitted = [Order(sample, seed + t) for t in range(orders if count > CELL else 1)]

    def place(batches):
        for pdf in batches:
            if len(pdf):
                v = as_matrix(pdf.v)
                for t, order in enumerate(fitted):
                    code, along = order.keys(v)
                    yield pd.DataFrame({"tree": np.full(len(pdf), t, np.int32), "code": code, "along": along, "id": pdf.id, "v": pdf.v})

    def compare(batches):
        def lists(own: pd.DataFrame):
            m, ids = as_matrix(own.v), own.id.to_numpy(np.int64)
            n = min(k, len(ids) - 1)
            if n < 1:
                return
            sims = closeness(m)
            top = np.argpartition(-sims, n - 1, axis=1)[:, :n]
            near = np.take_along_axis(sims, top, 1).astype("<f4")
            yield pd.DataFrame({"id": ids, "ids": [ids[x].astype("<i8").tobytes() for x in top], "sims": [x.tobytes() for x in near]})

        held = None
        for pdf in batches:
            held = pdf if held is None or not len(held) else pd.concat([held, pdf], ignore_index=True)
            while len(held):
                tree = held.tree.to_numpy()
                last = int(np.searchsorted(tree, tree[0], "right"))  # stretches end with their order
                if last == len(held) and last < CELL:
                    break
                yield from lists(held[: min(CELL, last)])
                held = held[min(CELL, last) :].reset_index(drop=True)
        if held is not None and len(held):
            yield from lists(held)

    keys = ["tree", "code", "along", "id"]
    placed = nodes.mapInPandas(place, "tree int, code long, along double, id long, v binary")
    dealt = placed.repartitionByRange(*keys) if count > CELL else placed.coalesce(1)  # CELL rows at most
    return dealt.sortWithinPartitions(*keys).mapInPandas(compare, "id long, ids binary, sims binary")


def neighbour_graph(nodes: DataFrame, *, k: int = 32, orders: int = 5, rounds: int = 6, settled: float = 0.05, seed: int = 11) -> DataFrame:
    """nodes: id, v (32-bit unit vector). (id, ids, sims): about the k nearest of each node and minus their squared distances, nearest first, packed. Rounds of NN-descent end when less than `settled` of the entries are new; of up to CELL nodes the first edges are exact, and none is needed."""
    count = nodes.count()
    if count == 0:
        return nodes.selectExpr("id", "v as ids", "v as sims").limit(0)
    sample = as_matrix(nodes.orderBy(F.xxhash64("id"), "id").limit(MAX_SAMPLE).select("v").toPandas().v)
    buckets = count // group_size(sample.shape[1], 2 * k) + 1
    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(buckets)).alias("bucket")
    found = first_edges(nodes, count, sample, k=k, orders=orders, seed=seed)
    packed = "id long, ids binary, sims binary"

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        """The k nearest of all lists of a node, each id once, ties to the smaller id; fresh: not in the list of kind 0."""
        row, owner, ids, sims = flat(pdf)
        known = pdf.kind.to_numpy()[row] == 0
        order = np.lexsort((~known, ids, owner))  # a known entry stands before its repeats
        owner, ids, sims, known = owner[order], ids[order], sims[order], known[order]
        first = np.concatenate([[True], (owner[1:] != owner[:-1]) | (ids[1:] != ids[:-1])]) if len(owner) else np.empty(0, bool)
        first &= owner != ids
        owner, ids, sims, known = owner[first], ids[first], sims[first], known[first]
        order = np.lexsort((ids, -sims, owner))
        owner, ids, sims, known = owner[order], ids[order], sims[order], known[order]
        out = []
        for at, end in runs(owner):
            end = min(end, at + k)
            out.append((owner[at], ids[at:end].tobytes(), sims[at:end].tobytes(), (~known[at:end]).astype("u1").tobytes()))
        return pd.DataFrame(out, columns=["id", "ids", "sims", "fresh"])

    full = packed + ", fresh binary"
    graph = stored(found.withColumn("kind", F.lit(1)).groupBy(bucket("id")).applyInPandas(merge, full), "ann-graph")
    every = nodes.select("id").join(graph.select("id"), "id", "left_anti") if count <= 1 else None
    for _ in range(rounds if count > CELL else 0):

        def edges(batches):
            for pdf in batches:
                n = np.array([len(x) // 8 for x in pdf.ids])
                yield pd.DataFrame({"u": np.repeat(pdf.id.to_numpy(), n), "w": np.frombuffer(b"".join(pdf.ids), "<i8"), "s": np.frombuffer(b"".join(pdf.sims), "<f4"), "fresh": np.frombuffer(b"".join(pdf.fresh), "u1").astype(np.int32)})

        forward = graph.mapInPandas(edges, "u long, w long, s float, fresh int")
        # NN-descent's own sampling of reverse neighbours: hubs keep k of them
        order = Window.partitionBy("u").orderBy(F.col("fresh").desc(), F.xxhash64("w"), "w")
        back = forward.select(F.col("w").alias("u"), F.col("u").alias("w"), "s", "fresh").withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).drop("r")
        both = forward.unionByName(back).groupBy("u", "w").agg(F.max("fresh").alias("fresh"))
        near = both.join(nodes.select(F.col("id").alias("w"), "v"), "w")

        def local(pdf: pd.DataFrame) -> pd.DataFrame:
            out = []
            pdf = pdf.sort_values("u")
            every, names, new = as_matrix(pdf.v), pdf.w.to_numpy(np.int64), pdf.fresh.to_numpy() > 0
            for at, end in runs(pdf.u.to_numpy()):
                fresh = new[at:end]
                if not fresh.any() or end - at < 2:
                    continue
                m, ids = every[at:end], names[at:end]
                sims = closeness(m)
                sims[~(fresh[:, None] | fresh[None, :])] = -9
                n = min(6, len(ids) - 1)
                top = np.argpartition(-sims, n - 1, axis=1)[:, :n]
                value = np.take_along_axis(sims, top, 1)
                for i in range(len(ids)):
                    live = value[i] > -5
                    if live.any():
                        out.append((ids[i], ids[top[i][live]].astype("<i8").tobytes(), value[i][live].astype("<f4").tobytes()))
            return pd.DataFrame(out, columns=["id", "ids", "sims"])

        more = near.groupBy(bucket("u")).applyInPandas(local, packed)
        both = graph.select("id", "ids", "sims").withColumn("kind", F.lit(0)).unionByName(more.withColumn("kind", F.lit(1)))
        new = stored(both.groupBy(bucket("id")).applyInPandas(merge, full), "ann-graph")
        discard(graph)
        graph = new
        share = graph.agg(F.sum(F.length(F.replace(F.hex("fresh"), F.lit("00"), F.lit("")))) / 2 / F.sum(F.length("fresh"))).first()[0]
        if (share or 0) < settled:
            break
    return graph if every is None else graph.unionByName(every.select("id", F.lit(b"").alias("ids"), F.lit(b"").alias("sims"), F.lit(b"").alias("fresh")))


def search(graph: DataFrame, nodes: DataFrame, queries: DataFrame, *, beam: int = 192, width: int = 32, k: int = 32) -> DataFrame:
    """queries: id of a node. (id, ids): the beam of each query after its greedy walk, nearest first, packed; the node itself is left out."""
    spark = nodes.sparkSession
    prepare(spark)
    vectors = nodes.select("id", "v")
    asked = stored(queries.select("id").distinct(), "ann-queries")
    dim = nodes.select(F.length("v") / 4).limit(1).collect()
    buckets = asked.count() // group_size(int(dim[0][0]) if dim else 1, width * k) + 1
    start = asked.join(vectors, "id").join(graph.select("id", "ids", "sims"), "id")

    def begin(batches):
        for pdf in batches:
            yield pdf.assign(done=[bytes(len(x) // 8) for x in pdf.ids], open=True)

    state_schema = "id long, v binary, ids binary, sims binary, done binary, open boolean"
    state = stored(start.mapInPandas(begin, state_schema), "ann-beam")

    while True:  # every round expands nodes of the beam, which only gets better: the walk ends

        def frontier(batches):
            for pdf in batches:
                q, node = [], []
                for own, ids, done in zip(pdf.id, pdf.ids, pdf.done, strict=True):
                    todo = np.frombuffer(ids, "<i8")[np.frombuffer(done, "u1") == 0][:width]
                    q.append(np.full(len(todo), own))
                    node.append(todo)
                yield pd.DataFrame({"q": np.concatenate(q or [np.empty(0, np.int64)]), "node": np.concatenate(node or [np.empty(0, np.int64)])})

        steps = state.mapInPandas(frontier, "q long, node long").join(graph.select(F.col("id").alias("node"), "ids"), "node")

        def spread(batches):
            for pdf in batches:
                n = np.array([len(x) // 8 for x in pdf.ids], np.int64)
                yield pd.DataFrame({"q": np.repeat(pdf.q.to_numpy(), n), "c": np.frombuffer(b"".join(pdf.ids), "<i8")})

        reached = steps.select("q", "ids").mapInPandas(spread, "q long, c long").distinct().where("q <> c")
        reached = reached.join(vectors.select(F.col("id").alias("c"), "v"), "c").select(F.pmod(F.xxhash64("q"), F.lit(buckets)).alias("b"), "q", "c", "v")

        def advance(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            out = []
            by_query = dict(list(right.groupby("q", sort=False)))
            for row in left.itertuples():
                ids, sims, done = np.frombuffer(row.ids, "<i8"), np.frombuffer(row.sims, "<f4"), np.frombuffer(row.done, "u1").copy()
                done[np.flatnonzero(done == 0)[:width]] = 1
                part = by_query.get(row.id)
                if part is not None:
                    cand = part.c.to_numpy()
                    unseen = ~np.isin(cand, ids)
                    cand = cand[unseen]
                    if len(cand):
                        s = -((as_matrix(part.v[unseen]) - np.frombuffer(row.v, np.float32)) ** 2).sum(1)
                        ids, sims, done = np.concatenate([ids, cand]), np.concatenate([sims, s]), np.concatenate([done, np.zeros(len(cand), "u1")])
                        order = np.lexsort((ids, -sims))[:beam]
                        ids, sims, done = ids[order], sims[order], done[order]
                out.append((row.id, row.v, ids.astype("<i8").tobytes(), sims.astype("<f4").tobytes(), done.tobytes(), bool((done == 0).any())))
            return pd.DataFrame(out, columns=["id", "v", "ids", "sims", "done", "open"])

        keyed = state.withColumn("b", F.pmod(F.xxhash64("id"), F.lit(buckets)))
        new = stored(keyed.groupBy("b").cogroup(reached.groupBy("b")).applyInPandas(advance, state_schema), "ann-beam")
        discard(state)
        state = new
        if not state.where("open").limit(1).count():
            break
    discard(asked)
    return state.select("id", "ids")


def usable(vectors: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, e): vectors that take part: no null, zero or non-finite ones, and of several sizes the one that most have."""
    e = F.col("e")
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("e")).where("vec_id is not null and e is not null")
    rows = rows.where(F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0))
    size = rows.groupBy(F.size("e").alias("n")).count().orderBy(F.col("count").desc(), F.col("n").desc()).first()
    return rows.where(F.size("e") == (size.n if size else -1))


def nearest(vectors: DataFrame, *, every: int = 50, top: int = 5, k: int = 32, orders: int = 5, rounds: int = 6, beam: int = 192, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose vec_id is divisible by `every` its `top` nearest other rows by cosine.

    Vectors that are null, zero or hold null or non-finite components take no part, nor do rows with a null vec_id or of another size than most. Of fewer candidates all are returned. Ties go to the smaller vec_id; equal vectors, however many, are one node and give their smallest ids. Rows that repeat a vec_id with one vector count once; a vec_id with several vectors is as near as the nearest two of theirs. Other columns, whatever their names, are not read. An empty table gives none.
    """
    spark = vectors.sparkSession
    prepare(spark)
    rows = stored(usable(vectors, vec_id=vec_id, embedding=embedding).distinct(), "ann-rows")
    order = Window.partitionBy("e").orderBy("vec_id")
    members = stored(rows.withColumn("r", F.row_number().over(order)).where(F.col("r") <= top + 1), "ann-members")
    firsts = members.where("r = 1").select(F.col("vec_id").alias("id"), "e")

    def unit(batches):
        for pdf in batches:
            m = np.array(pdf.e.tolist(), np.float64) if len(pdf) else np.empty((0, 1))
            m = m / np.maximum(np.abs(m).max(1, keepdims=True), 1e-300) if len(m) else m
            m = (m / np.linalg.norm(m, axis=1, keepdims=True)).astype(np.float32) if len(m) else m
            yield pd.DataFrame({"id": pdf.id, "v": [x.tobytes() for x in m]})

    nodes = stored(firsts.mapInPandas(unit, "id long, v binary"), "ann-nodes")
    graph = neighbour_graph(nodes, k=k, orders=orders, rounds=rounds)
    asked = rows.where(F.col("vec_id") % every == 0)
    asked = stored(asked.join(firsts, "e").select(F.col("vec_id").alias("query_id"), "id", F.col("e").alias("q")), "ann-asked")
    beams = search(graph, nodes, asked.select("id"), beam=beam, k=k)

    def unpack(batches):
        for pdf in batches:
            ids = [np.concatenate([[own], np.frombuffer(x, "<i8")]) for own, x in zip(pdf.id, pdf.ids, strict=True)]
            n = [len(x) for x in ids]
            yield pd.DataFrame({"id": np.repeat(pdf.id.to_numpy(), n), "node": np.concatenate(ids) if ids else np.empty(0, np.int64)})

    pairs = beams.mapInPandas(unpack, "id long, node long")
    # members of the nodes found, by their nodes
    own_node = members.join(firsts, "e").select(F.col("id").alias("node"), "vec_id", "e")
    found = asked.join(pairs, "id").join(own_node, "node").where("query_id <> vec_id")
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    scored = found.select("query_id", "vec_id", (dot("q", "e") / (F.sqrt(dot("q", "q")) * F.sqrt(dot("e", "e")))).alias("score"))
    scored = scored.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")))
    return ranked.where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
