"""Quality by weak labels: expectation-maximisation estimates the accuracies of overlapping heuristic labellers from the votes of all documents, and its posterior labels train a hashed linear scorer."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import MEMOS, discard, prepare, resting, stored
from textmill.llm.label_model import LabelModel, fit_linear

BINS = 1 << 14
#: Documents that the scorer is fitted on, at most.
MAX_FIT = 6_000
#: Shorter texts carry no evidence: no labeller votes on them, and they are scored 0.5.
LEAST_WORDS = 5
UPPER = bytes(range(65, 91))
LETTERS = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])
SYMBOLS = b"#*$%&<>{}~^=+@\\"
SHAPE = re.compile(r"([A-ZÀ-ÖØ-Þ]+)|([a-zß-öø-ÿ]+)|([0-9]+)|([^\W_]+)|(\s+)|((.)\7*)", re.S)
LABELLERS = ("shouting", "exclamations", "pipes", "symbols", "repeated pairs", "few kinds of words", "letters", "length of words", "plain punctuation", "sentence ends")


def measure(text: str) -> list[float]:
    """Plain measures of a text: what the labellers look at."""
    raw, words = text.encode("utf-8", "surrogatepass"), text.split()
    n = max(1, len(words))
    letters = len(raw) - len(raw.translate(None, LETTERS))
    upper = len(raw) - len(raw.translate(None, UPPER))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    pairs = len(set(zip(words, words[1:], strict=False))) / max(1, n - 1)
    kinds = len(set(words))
    bytes_in_words = len(raw) - (len(words) - 1 if words else 0)
    return [
        len(words), upper / max(1, letters), text.count("!") / n, text.count("|") / n, symbols / max(1, len(raw)), pairs if n > 1 else 1.0,
        kinds / n**0.8, letters / max(1, bytes_in_words), bytes_in_words / n, (text.count(".") + text.count("?")) / n, text.count(",") / n,
    ]


def vote(m: list[float]) -> list[int]:
    """One vote for each of LABELLERS: 1 good, 0 bad, -1 abstains."""
    n, upper, marks, pipes, symbols, pairs, kinds, letters, length, stops, commas = m
    pick = lambda bad, good: 0 if bad else 1 if good else -1
    return [
        pick(upper > 0.5, upper < 0.15), pick(marks > 0.2, marks < 0.05), pick(pipes > 0.15, pipes == 0), pick(symbols > 0.05, symbols < 0.01), pick(pairs < 0.6, pairs > 0.85),
        pick(kinds < 0.25, kinds > 0.6), pick(letters < 0.6, letters > 0.9), pick(length > 15 or length < 2.5, 3 <= length <= 10), pick(pipes + symbols * 10 + marks > 0.4, commas > 0.02 and marks < 0.1), pick(stops < 0.005 and n > 60, stops > 0.02),
    ]


class Shapes(dict):
    """The shape of a token, kept for a bounded number of short tokens.

    Kinds of characters run by run: upper, lower, digits, other letters, marks with the size of their run by powers of two. A token of more than eight runs is described by the kinds in it, their shares in quarters and the number of runs by powers of two: all of it is read, and like tokens of any length have one shape.
    """

    LIMIT, LONGEST = 150_000, 48

    def __missing__(self, token: str) -> str:
        out, sizes = [], {}
        for m in SHAPE.finditer(token):
            kind = "A" if m[1] else "a" if m[2] else "9" if m[3] else "x" if m[4] else " " if m[5] else m[6][0]
            n = m.end() - m.start()
            out.append(kind if kind in "Aa9x " else f"{kind}{n.bit_length()}")
            sizes[kind] = sizes.get(kind, 0) + n
        shape = "".join(out)
        if len(out) > 8:
            shape = f"{len(out).bit_length()}:" + "".join(f"{k}{4 * v // len(token)}" for k, v in sorted(sizes.items()))
        if len(token) <= self.LONGEST:
            if len(self) >= self.LIMIT:
                self.clear()
            self[token] = shape
        return shape


_SHAPES = MEMOS["shapes"] = Shapes()


def features(text: str, m: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features: shares of token shapes, and bins of the measures, in tenths up to two and quarters of a power of two beyond."""
    shapes: dict[str, int] = {}
    words = text.split()
    for s in map(_SHAPES.__getitem__, words):
        shapes[s] = shapes.get(s, 0) + 1
    found: dict[int, float] = {}
    for s, c in shapes.items():
        k = xxhash.xxh3_64_intdigest("s" + s) % BINS
        found[k] = found.get(k, 0.0) + c / len(words)
    for i, x in enumerate(m[1:], 1):
        k = xxhash.xxh3_64_intdigest(f"m{i}:{round(x * 10) if x < 2 else 20 + round(4 * math.log2(x / 2))}") % BINS
        found[k] = found.get(k, 0.0) + 0.3
    return np.fromiter(found, np.int64, len(found)), np.fromiter(found.values(), float, len(found))


def fit(docs: DataFrame, *, max_fit: int = MAX_FIT) -> tuple[np.ndarray, float, LabelModel | None]:
    """docs: doc_id, text. The label model is fitted on the vote patterns of all documents, whose number is bounded by the labellers; the scorer on at most max_fit documents, the first by a hash of their ids."""

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            measures = [m for t in b.column(0).to_pylist() if (m := measure(t or ""))[0] >= LEAST_WORDS]
            out = [",".join(map(str, vote(m))) for m in measures]
            once, n = np.unique(np.array(out, object).astype(str), return_counts=True) if out else ([], [])
            yield pa.RecordBatch.from_arrays([pa.array(list(once), pa.string()), pa.array(list(map(int, n)), pa.int64())], ["pattern", "n"])

    seen = docs.select("text").mapInArrow(resting(votes, "shapes"), "pattern string, n long").groupBy("pattern").agg(F.sum("n").alias("n")).collect()
    if not seen:
        return np.zeros(BINS), 2.0, None
    seen = sorted((r.pattern, r.n) for r in seen)
    patterns, counts = np.array([[int(x) for x in p.split(",")] for p, _ in seen]), np.array([n for _, n in seen])
    good, bad = (patterns == 1).sum(1), (patterns == 0).sum(1)
    model = LabelModel(len(LABELLERS), smoothing=2.0, floor=0.0).fit(patterns, counts, start=(good + 0.5) / (good + 4 * bad + 1))
    if model.accuracies().mean() < 0.5:  # classes changed places
        model.flip()
    ids = docs.select("doc_id").where(F.col("doc_id").isNotNull()).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_fit)
    chosen = stored(ids, "quality-fit")  # at most max_fit ids

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.filter(pa.array([len((t or "").split()) >= LEAST_WORDS for t in b.column(1).to_pylist()], pa.bool_()))
            ms = [measure(t or "") for t in b.column(1).to_pylist()]
            found = [features(t or "", m) for t, m in zip(b.column(1).to_pylist(), ms, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([vote(m) for m in ms], pa.list_(pa.int32())), pa.array([a.astype("<i4").tobytes() for a, _ in found], pa.binary()), pa.array([v.tobytes() for _, v in found], pa.binary())], ["doc_id", "votes", "at", "value"])

    # of rows that repeat an id the least text speaks, so that a hot id adds one row
    once = docs.join(F.broadcast(chosen), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    rows = sorted(map(tuple, once.mapInArrow(resting(sampled, "shapes"), "doc_id long, votes array<int>, at binary, value binary").collect()))
    discard(chosen)
    if not rows:
        return np.zeros(BINS), 2.0, model
    soft = model.posterior(np.array([r[1] for r in rows]))
    w, bias = fit_linear([(np.frombuffer(r[2], "<i4").astype(np.int64), np.frombuffer(r[3])) for r in rows], soft, BINS, balance=False)
    return w, bias, model


class Scorer:
    def __init__(self, used: dict[int, float], bias: float):
        self.weights, self.bias = np.zeros(BINS), bias
        for i, x in used.items():
            self.weights[i] = x

    def scores(self, texts: list[str | None]) -> np.ndarray:
        s = np.zeros(len(texts))
        for i, t in enumerate(texts):
            if t and not t.isspace():
                m = measure(t)
                if m[0] < LEAST_WORDS:
                    s[i] = 0.5
                    continue
                at, v = features(t, m)
                s[i] = 1 / (1 + np.exp(-np.clip(self.bias + self.weights[at] @ v, -30, 30)))
        return s


def keep_good(docs: DataFrame, *, threshold: float = 0.3, max_fit: int = MAX_FIT, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of docs, with all their columns, whose score reaches the threshold; the scorer is that of classify_quality. Blank texts go, rows with a null doc_id are judged like others, repeated rows share their fate; columns of docs keep their names and values, whatever they are."""
    prepare(docs.sparkSession)
    w, bias, _ = fit(docs.selectExpr(f"cast(`{doc_id}` as bigint) as doc_id", f"cast(`{text}` as string) as text"), max_fit=max_fit)
    used, at = {int(i): float(w[i]) for i in np.flatnonzero(w)}, docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(used, bias)
        for b in batches:
            yield b.filter(pa.array(scorer.scores(b.column(at).to_pylist()) >= threshold))

    return docs.mapInArrow(resting(run, "shapes"), docs.schema)


def classify_quality(docs: DataFrame, *, threshold: float = 0.3, max_fit: int = MAX_FIT, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row a document: doc_id, score (0 to 1, higher: better), kept (score >= threshold).

    Scores depend on the text alone; null and blank texts are scored 0, texts of one to four words 0.5. Texts go through whole; repeated rows agree; an empty table gives none; a null doc_id is scored like any other and never fitted on; of rows that repeat an id one is. Texts are read whole, however long. Other columns of docs, whatever their names, are not read.
    """
    prepare(docs.sparkSession)
    rows = docs.selectExpr(f"cast(`{doc_id}` as bigint) as doc_id", f"cast(`{text}` as string) as text")
    w, bias, _ = fit(rows, max_fit=max_fit)
    used = {int(i): float(w[i]) for i in np.flatnonzero(w)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(used, bias)
        for b in batches:
            s = scorer.scores(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s), pa.array(s >= threshold)], ["doc_id", "score", "kept"])

    return rows.mapInArrow(resting(run, "shapes"), "doc_id long, score double, kept boolean")
