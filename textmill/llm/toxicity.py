"""Toxicity by weak supervision: lexicon and pattern voters, a generative model of their accuracies and correlations, and a linear classifier on its posterior labels.

Gold labels serve for one thing: lexicons are mined from them, each from its own shard of the labelled rows, so that chance words of one shard are not those of the other. The label model sees votes alone, of all rows that are not held out, labelled or not; the classifier's targets are its posteriors alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import discard, prepare, stored
from textmill.llm.label_model import LabelModel, feature_scores, fit_linear

BINS = 1 << 18
#: Labelled rows that the lexicons are mined from, at most.
MAX_LABELLED = 12_000
#: Rows that the classifier is fitted on, at most.
MAX_FIT = 12_000
#: Entries of a mined lexicon, at most: those in the most toxic rows.
MAX_LEXICON = 5_000
#: Hashed features that the classifier uses, at most: those that part the classes best.
MAX_FEATURES = 2_000
#: A feature counts so many times in a text, at most, in training and in scoring.
MOST = 3
#: Texts of fewer distinct tokens give no vote for clean.
LEAST_TOKENS = 20
LETTERS = re.compile(r"[^\W\d_]+")
#: Insults of common use.
INSULTS = frozenset(
    "idiot idiots moron morons stupid dumb fool loser losers pathetic scum trash garbage worthless disgusting clown vermin filth imbecile cretin jerk bastard "
    "idiota estúpido estúpida imbécil basura asqueroso idiote stupide connard débile ordure dégoûtant dummkopf trottel abschaum widerlich dumm".split()
)
#: Words that point at somebody before an insult.
POINTERS = frozenset("you your are is was such a an the they he she so tu eres son un una es vous êtes est des sont du bist ist sind ein eine".split())
#: Kinds of mined lexicons: whole words, and beginnings of four and five letters; one of each kind a shard.
KINDS, SHARDS = "w45", 2
LEXICONS = tuple(f"{k}{s}" for k in KINDS for s in range(SHARDS))
VOTERS = (*LEXICONS, "insults", "pointed at", "several", "dense")


def token_features(token: str) -> set[str]:
    """Features of a lower-cased token: its letter runs and their beginnings."""
    out = set()
    for run in LETTERS.findall(token):
        out.add("w" + run)
        for k in (4, 5, 6):
            if len(run) > k:
                out.add(f"{k}{run[:k]}")
    return out


def bin_of(feature: str) -> int:
    return xxhash.xxh3_64_intdigest(feature.encode("utf-8", "surrogatepass")) % BINS


def tokens_of(text: str | None) -> set[str]:
    return set(text.lower().split()) if text else set()


class TokenMemo(dict):
    """What a function says of a token, kept for a bounded number of short tokens."""

    LIMIT, LONGEST = 200_000, 48

    def __init__(self, f):
        self.f = f

    def __missing__(self, token: str):
        out = self.f(token)
        if len(token) <= self.LONGEST:
            if len(self) >= self.LIMIT:
                self.clear()
            self[token] = out
        return out


def bin_counts(tokens: set[str], bins: TokenMemo) -> dict[int, int]:
    """In how many distinct tokens each bin's features stand, MOST at most: the features that training and scoring share."""
    counts: dict[int, int] = {}
    for found in filter(None, map(bins.__getitem__, tokens)):
        for i in found:
            counts[i] = min(MOST, counts.get(i, 0) + 1)
    return counts


class Voters:
    def __init__(self, lexicons: dict[str, set[str]]):
        self.lexicons = [lexicons[name] for name in LEXICONS]
        self.masks = TokenMemo(self.mask)

    def mask(self, token: str) -> int:
        """A bit for each lexicon that the token hits, and one for the fixed insults."""
        found = token_features(token)
        out = sum(1 << i for i, lexicon in enumerate(self.lexicons) if not found.isdisjoint(lexicon))
        return out | (1 << len(LEXICONS) if any(f[1:] in INSULTS for f in found if f[0] == "w") else 0)

    def vote(self, text: str | None) -> list[int]:
        """One vote for each of VOTERS: 1 toxic, 0 clean, -1 abstains."""
        tokens = tokens_of(text)
        masks = list(filter(None, map(self.masks.__getitem__, tokens)))
        all_hits = 0
        for m in masks:
            all_hits |= m
        silent = 0 if len(tokens) >= LEAST_TOKENS else -1
        votes = [1 if all_hits >> i & 1 else silent for i in range(len(LEXICONS) + 1)]
        pointed = -1
        if masks:
            before = ""
            for token in text.lower().split():
                if before in POINTERS and self.masks[token]:
                    pointed = 1
                    break
                before = token
        return [*votes, pointed, 1 if len(masks) > 1 else -1, 1 if masks and len(masks) * 100 >= len(tokens) else -1]


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0


def mine_lexicons(docs: DataFrame, labels: DataFrame, *, max_labelled: int, least: int = 3) -> dict[str, set[str]]:
    """A lexicon for each of LEXICONS: features in four times as many toxic as clean rows of a shard, so many that chance would make about one such feature among all of them. Counted on the executors; the driver gets MAX_LEXICON entries of each at most."""
    train = labels.selectExpr("cast(doc_id as bigint) as doc_id", "cast(toxic as int) as toxic").where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    # of several labels of one id the toxic one counts
    train = train.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id")
    train = train.where("toxic = 1").limit(max_labelled // 2).unionByName(train.where("toxic = 0").limit(max_labelled // 2))
    chosen = stored(train, "toxic-train")
    # at most max_labelled rows of two numbers; of rows that repeat an id the least text speaks
    rows = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for t in b.column("text").to_pylist():
                own: set[str] = set()
                for token in tokens_of(t):
                    own |= {f for f in token_features(token) if f[0] in KINDS}
                found.append(sorted(own))
            yield pa.RecordBatch.from_arrays([b.column("shard"), b.column("toxic"), pa.array(found, pa.list_(pa.string()))], ["shard", "toxic", "features"])

    shard = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(SHARDS)).cast("int").alias("shard")
    features = rows.select(shard, "toxic", "text").mapInArrow(run, "shard int, toxic int, features array<string>")
    counts = features.select("shard", "toxic", F.explode("features").alias("f")).groupBy("shard", "f").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    counts = stored(counts.where(F.col("a") + F.col("b") >= least), "toxic-counts")
    sizes = chosen.groupBy(shard).agg(F.count("*").alias("rows"), F.sum("toxic").alias("toxic"))
    sizes = sizes.join(counts.groupBy("shard").agg(F.count("*").alias("kinds")), "shard")
    # evidence against chance: twice the log-likelihood ratio of the feature's share of toxic rows and the shard's
    share, n = F.col("toxic") / F.col("rows"), F.col("a") + F.col("b")
    part = lambda k, p: F.when(k > 0, k * F.log(k / (n * p))).otherwise(0.0)
    g2 = 2 * (part(F.col("a"), share) + part(F.col("b"), 1 - share))
    good = counts.join(F.broadcast(sizes), "shard").where((F.col("a") >= 4 * F.col("b")) & (g2 >= 2 * F.log(F.col("kinds") + 1)))
    good = stored(good.select("shard", "f", "a"), "toxic-lexicons")
    out = {}
    for name in LEXICONS:
        own = good.where((F.col("shard") == int(name[1])) & F.col("f").startswith(name[0]))
        out[name] = {r.f for r in own.orderBy(F.col("a").desc(), "f").limit(MAX_LEXICON).collect()}
    discard(chosen, counts, good)
    return out


def fit_label_model(votes: DataFrame) -> tuple[LabelModel, list[str], np.ndarray] | None:
    """votes: pattern, one a row of a text. (model, the patterns, their posteriors); the number of patterns is bounded by the voters."""
    seen = sorted((r.pattern, r.n) for r in votes.groupBy("pattern").agg(F.count("*").alias("n")).collect())
    if not seen:
        return None
    patterns, counts = np.array([[int(x) for x in p.split(",")] for p, _ in seen]), np.array([n for _, n in seen])
    hits = (patterns[:, : len(LEXICONS) + 1] == 1).mean(1)
    model = LabelModel(len(VOTERS), floor=0.0).fit(patterns, counts, start=0.02 + 0.96 * np.minimum(1, 2 * hits))
    if model.accuracies().mean() < 0.5:  # classes changed places
        model.flip()
    return model, [p for p, _ in seen], model.posterior(patterns)


def fit(docs: DataFrame, labels: DataFrame, *, max_labelled: int = MAX_LABELLED, max_fit: int = MAX_FIT) -> tuple[dict[int, float], float, dict]:
    """docs: doc_id, text. (weights by bin, bias, report). Lexicons come from labelled rows; votes from every row that is not held out; the classifier from at most max_fit of those, half of them toxic by the label model if there are so many, the first by a hash of their ids."""
    lexicons = mine_lexicons(docs, labels, max_labelled=max_labelled)
    if not any(lexicons.values()):
        return {}, -4.0, {"lexicons": dict.fromkeys(LEXICONS, 0), "rows": 0}
    seen = docs.where(~F.coalesce(held_out(F.col("doc_id")), F.lit(False)))

    def cast_votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = Voters(lexicons)
        for b in batches:
            out = [",".join(map(str, voters.vote(t))) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], ["doc_id", "pattern"])

    votes = stored(seen.mapInArrow(cast_votes, "doc_id long, pattern string"), "toxic-votes")
    fitted = fit_label_model(votes)
    if fitted is None:
        discard(votes)
        return {}, -4.0, {"lexicons": {k: len(v) for k, v in lexicons.items()}, "rows": 0}
    model, patterns, soft = fitted
    table = docs.sparkSession.createDataFrame(list(zip(patterns, soft.tolist(), strict=True)), "pattern string, soft double")
    judged = votes.where("doc_id is not null").join(F.broadcast(table), "pattern").groupBy("doc_id").agg(F.max("soft").alias("soft"))
    first = judged.orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = stored(first.where("soft >= 0.5").limit(max_fit // 2).unionByName(first.where("soft < 0.5").limit(max_fit // 2)), "toxic-fit")
    rows = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "soft").agg(F.min("text").alias("text"))  # max_fit rows

    def featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = TokenMemo(lambda t: tuple({bin_of(f) for f in token_features(t)}))
        for b in batches:
            found = [bin_counts(tokens_of(t), bins) for t in b.column("text").to_pylist()]
            at = [np.fromiter(c, np.int32, len(c)).tobytes() for c in found]
            value = [np.fromiter(c.values(), np.uint8, len(c)).tobytes() for c in found]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("soft"), pa.array(at, pa.binary()), pa.array(value, pa.binary())], ["doc_id", "soft", "at", "value"])

    features = stored(rows.mapInArrow(featurize, "doc_id long, soft double, at binary, value binary"), "toxic-features")

    def presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((3, BINS))
        for b in batches:
            for y, raw in zip(b.column("soft").to_pylist(), b.column("at").to_pylist(), strict=True):
                at = np.frombuffer(raw, np.int32)
                n[0, at] += 1 - y
                n[1, at] += y
                n[2, at] += 1
        some = np.flatnonzero(n[2])
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[0, some]), pa.array(n[1, some])], ["bin", "a", "b"])

    # at most BINS rows of three numbers
    counts = features.mapInArrow(presence, "bin long, a double, b double").groupBy("bin").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).toPandas()
    target = features.agg(F.count("*").alias("n"), F.sum("soft").alias("y")).first()
    scores = feature_scores(counts.a.to_numpy(), counts.b.to_numpy(), target.n - target.y, target.y)
    order = np.lexsort((counts.bin.to_numpy(), -np.abs(scores)))
    kept = [int(i) for i in counts.bin.to_numpy()[order][: min(MAX_FEATURES, int((np.abs(scores) >= 3).sum()))]]
    place = {b: i for i, b in enumerate(sorted(kept))}

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.array(sorted(kept), np.int32)
        for b in batches:
            at, value = [], []
            for x, v in zip(b.column("at").to_pylist(), b.column("value").to_pylist(), strict=True):
                x, v = np.frombuffer(x, np.int32), np.frombuffer(v, np.uint8)
                live = np.isin(x, wanted)
                at.append(np.searchsorted(wanted, x[live]).astype("<u2").tobytes())
                value.append(v[live].tobytes())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("soft"), pa.array(at, pa.binary()), pa.array(value, pa.binary())], ["doc_id", "soft", "at", "value"])

    # max_fit rows of at most MAX_FEATURES entries of three bytes: 72 MB at the very most, one or two in practice
    got = sorted(map(tuple, features.mapInArrow(narrow, "doc_id long, soft double, at binary, value binary").collect()))
    discard(votes, chosen, features)
    data = [(np.frombuffer(a, "<u2").astype(np.int64), np.frombuffer(v, np.uint8).astype(float)) for _, _, a, v in got]
    y = np.array([r[1] for r in got])
    w, bias = fit_linear(data, y, len(place), balance=False)
    # the sample holds more toxic rows than the table: the bias goes back to the label model's prior
    share = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    prior = min(max(model.prior, 1e-3), 1 - 1e-3)
    bias += np.log(prior / (1 - prior)) - np.log(share / (1 - share))
    report = {"lexicons": {k: len(v) for k, v in lexicons.items()}, "rows": len(got), "prior": model.prior, "accuracies": dict(zip(VOTERS, model.accuracies().round(4).tolist(), strict=True)), "correlations": model.correlations, "features": len(place)}
    return {b: float(w[i]) for b, i in place.items() if w[i]}, float(bias), report


class Scorer:
    def __init__(self, weights: dict[int, float], bias: float):
        self.weights, self.bias = weights, bias
        self.bins = TokenMemo(lambda t: tuple({i for f in token_features(t) if (i := bin_of(f)) in weights}))

    def score(self, text: str | None) -> float:
        total = self.bias
        for i, n in bin_counts(tokens_of(text), self.bins).items():
            total += self.weights[i] * n
        return float(1 / (1 + np.exp(-min(30.0, max(-30.0, total)))))


def score_toxicity(docs: DataFrame, labels: DataFrame, *, max_labelled: int = MAX_LABELLED, max_fit: int = MAX_FIT, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row a document: doc_id, held_out, score, predicted.

    Scores depend on the text alone; null and empty texts get the score of no evidence. Labels of rows with crc32(doc_id) mod 5 = 0 are never read; without any labels the bias alone scores. Of several labels of one id the toxic one counts, of several rows of one id one is fitted on. Rows are scored alone, whole, however long; repeated rows agree, ties at 0.5 are predicted toxic, an empty table gives none; a null doc_id is not held out and never sampled. Other columns of docs, whatever their names, are not read.
    """
    prepare(docs.sparkSession)
    rows = docs.selectExpr(f"cast(`{doc_id}` as bigint) as doc_id", f"cast(`{text}` as string) as text")
    weights, bias, _ = fit(rows, labels, max_labelled=max_labelled, max_fit=max_fit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(weights, bias)
        for b in batches:
            s = np.array([scorer.score(t) for t in b.column(2).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return rows.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
