"""What the operators of this subpackage share: work folders, columns, words, hashing."""

from __future__ import annotations

import ctypes
import functools
import re
import tempfile
import uuid
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.session import ship

#: Words of the contracts: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)
#: Lower-cases A-Z alone.
ASCII_LOWER = {i: i + 32 for i in range(65, 91)}
#: Rows in an Arrow batch: some thousand words each, so that a batch stays at a few MB.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Gives executors the package, and lowers the session's bound of rows in an Arrow batch for good, as plans are made later than the call: with texts of 100 kB the default of 10,000 rows would be a GB. Operators then work on slices bounded by bytes."""
    ship(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir that all executors share. Where it is unset, a local session gets a temporary one, and any other is refused."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"spark.checkpoint.dir is not set: with master {master} it must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="checkpoint-")
        spark.sparkContext.setCheckpointDir(base)
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def fresh(spark: SparkSession, name: str) -> str:
    """A path of its own for one table or folder of files."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cuts the lineage: writes df to the shared folder as Parquet and reads it again. Only committed task output is read, so retries and lost executors do no harm."""
    path = fresh(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes what stored() wrote."""
    for df in tables:
        if path := getattr(df, "_stored_at", None):
            remove(df.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def only(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns as the named types, whatever else the table has; columns=type."""
    return df.select(*(df[c].cast(t).alias(c) for c, t in columns.items()))


def n_words(text: Column) -> Column:
    """Words of a text, null: 0; built-in functions only."""
    body = F.regexp_replace(F.coalesce(text, F.lit("")), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return F.when(body == "", F.lit(0)).otherwise(F.size(F.split(body, r"[\x20\x09-\x0D]+"))).cast("long")


#: Memos that last longer than a call, by name.
MEMOS: dict[str, dict] = {}


def hand_back(keep: str | None = None) -> None:
    """Empties the memos but one, and gives freed memory back to the system, which C libraries keep otherwise."""
    for name, memo in MEMOS.items():
        if name != keep:
            memo.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def resting(run: Callable, keep: str | None = None) -> Callable:
    """run, over an iterator of batches, with hand_back() at its end: Spark keeps the worker for later stages, beside the executor's heap."""

    def rested(batches):
        try:
            yield from run(batches)
        finally:
            hand_back(keep)

    return rested


def resting_group(run: Callable) -> Callable:
    """run, over a group, with hand_back() at its end."""

    def rested(group):
        try:
            return run(group)
        finally:
            hand_back()

    return rested


@functools.cache
def word_hashes() -> WordHashes:
    return MEMOS.setdefault("words", WordHashes())


class WordHashes(dict):
    """64-bit hashes of words, kept in a bounded memo."""

    LIMIT = 300_000

    def __missing__(self, word: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        out = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return out


def split_words(text: str) -> list[str]:
    """WORD_RE.findall, by the faster str.split where the text has no white space beyond ASCII's."""
    if text.isascii() and not re.search(r"[\x1c-\x1f]", text):
        return text.split()
    return WORD_RE.findall(text)


def shingle_hashes(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles of a text in which A-Z are lower-cased; fewer words: the whole sequence as one; none: empty."""
    words = split_words((text or "").translate(ASCII_LOWER)) if text else []
    if not words:
        return np.empty(0, np.uint64)
    memo = word_hashes()
    h = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    n = max(1, len(words) - k + 1)
    size = min(k, len(words))
    out = np.full(n, np.uint64(0x9E3779B97F4A7C15 + size))
    with np.errstate(over="ignore"):
        for j in range(size):
            out ^= h[j : j + n]
            out *= np.uint64(0xD6E8FEB86659FD93)
            out ^= out >> np.uint64(32)
        out *= np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def arrow_schema(fields: Iterable[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])
