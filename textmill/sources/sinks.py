"""Verified writes: staged files, one pointer that moves last, reports with their manifests."""

from __future__ import annotations

import json
import math
import os
import socket
import time
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.operators.contracts import ContractError, require_keys, same_keys
from textmill.sources.catalog import exists, file_hashes, hadoop_path, read_text, write_text


@contextmanager
def write_lock(path: str) -> Iterator[None]:
    """One writer a repository: a lock file that only one process can create; that of a dead process of this host is taken over."""
    mine = {"pid": os.getpid(), "host": socket.gethostname(), "token": uuid.uuid4().hex}
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    for _ in range(2):
        try:
            fd = os.open(path, os.O_CREAT | os.O_EXCL | os.O_WRONLY)
        except FileExistsError:
            try:
                owner = json.loads(Path(path).read_text())
                if owner["host"] == mine["host"]:
                    os.kill(owner["pid"], 0)
            except ProcessLookupError:
                stale = f"{path}.{mine['token']}"
                os.rename(path, stale)  # only one of several takers succeeds
                os.unlink(stale)
                continue
            except (ValueError, KeyError, FileNotFoundError, PermissionError):
                pass
            raise ContractError(f"{path} is held by another writer") from None
        os.write(fd, json.dumps(mine).encode())
        os.close(fd)
        break
    else:
        raise ContractError(f"{path} is held by another writer")
    try:
        yield
    finally:
        if json.loads(Path(path).read_text()).get("token") == mine["token"]:
            os.unlink(path)


def check_destination(name: str, mode: str) -> None:
    """Full tables go to private places only; public ones only through a projection."""
    if mode == "full" and "public" in name.lower():
        raise ContractError("full tables cannot go to a public place")
    if mode not in ("full", "projection"):
        raise ContractError(f"unknown mode {mode}")


def commit(tables: Mapping[str, DataFrame], path: str, key: str, *, expected: str | None = None, mode: str = "full", rows_per_file: int = 1_000_000) -> str:
    """Writes tables as a new revision and returns its id. Files are staged in a folder of their own; after keys and schemas have been read back, one small file that names the revision is replaced. expected: the revision that must still be current."""
    spark = next(iter(tables.values())).sparkSession
    check_destination(path, mode)
    pointer = f"{path}/CURRENT"
    now = read_text(spark, pointer).strip() if exists(spark, pointer) else None
    if expected is not None and now != expected:
        raise ContractError(f"revision {expected} was expected, {now} is current")
    revision = f"{int(time.time() * 1000):x}-{uuid.uuid4().hex[:8]}"
    root = f"{path}/revisions/{revision}"
    for name, df in tables.items():
        require_keys(df, key, name)
        df.write.option("maxRecordsPerFile", rows_per_file).parquet(f"{root}/{name}")
        back = spark.read.parquet(f"{root}/{name}")
        if not same_schema(back.schema, df.schema):
            raise ContractError(f"{name}: the schema changed on the way")
        if same_keys(df, back, key).limit(1).count() or back.count() != df.count():
            raise ContractError(f"{name}: the keys changed on the way")
        write_text(spark, f"{root}/{name}/_schema.json", df.schema.json())
    again = read_text(spark, pointer).strip() if exists(spark, pointer) else None
    if again != now:
        raise ContractError("another writer was faster")
    write_text(spark, f"{pointer}.{revision}", revision)
    replace_file(spark, f"{pointer}.{revision}", pointer)
    return revision


def replace_file(spark, source: str, target: str) -> None:
    """Moves a file over another in one step: readers see the old one or the new one, and a crash leaves one of them."""
    jvm = spark.sparkContext._jvm
    p, fs = hadoop_path(spark, source)
    t, _ = hadoop_path(spark, target)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(p).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fs.makeQualified(p), fs.makeQualified(t), options)


def same_schema(a: T.StructType, b: T.StructType) -> bool:
    """Names and types in order; whether a field may be null is left aside."""

    def plain(t: T.DataType):
        if isinstance(t, T.StructType):
            return [(f.name, plain(f.dataType)) for f in t]
        if isinstance(t, T.ArrayType):
            return ["array", plain(t.elementType)]
        if isinstance(t, T.MapType):
            return ["map", plain(t.keyType), plain(t.valueType)]
        return t.simpleString()

    return plain(a) == plain(b)


def declared_schema(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))


def write_mirror(df: DataFrame, path: str, *, repository: str, revision: str, fmt: str = "parquet") -> dict:
    """A table as Parquet, or as CSV with arrays as JSON; data first, the manifest last."""
    spark = df.sparkSession
    if fmt == "csv":
        flat = df.select(*(F.to_json(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)) else F.col(f"`{f.name}`") for f in df.schema))
        flat.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    else:
        df.write.mode("overwrite").parquet(path)
    files = {r.path.rsplit("/", 1)[-1]: r.sha256 for r in file_hashes(spark, f"{path}/*.{fmt}").collect()}
    m = {"schema": 1, "repository": repository, "revision": revision, "format": fmt, "rows": df.count(), "files": files}
    write_text(spark, f"{path}/manifest.json", json.dumps(m, indent=1, sort_keys=True))
    return m


def json_safe(x):
    if isinstance(x, dict):
        return {str(k): json_safe(v) for k, v in x.items()}
    if isinstance(x, (list, tuple, set)):
        return [json_safe(v) for v in x]
    if isinstance(x, float) and not math.isfinite(x):
        return None
    return x if isinstance(x, (str, int, float, bool, type(None))) else str(x)


def write_reports(reports: Mapping[str, DataFrame], summary: dict, path: str, *, repository: str, revision: str, settings: dict | None = None) -> dict:
    """Report tables as CSV with their source, a summary, and a manifest with the hash of every file."""
    for name, df in reports.items():
        flat = df.select(F.lit(repository).alias("source_repository"), F.lit(revision).alias("source_revision"), *(F.to_json(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)) else F.col(f"`{f.name}`") for f in df.schema))
        flat.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{path}/{name}")
    spark = next(iter(reports.values())).sparkSession
    write_text(spark, f"{path}/summary.json", json.dumps(json_safe(summary), indent=1, sort_keys=True))
    files = {r.path.split(path, 1)[-1].lstrip("/"): r.sha256 for name in reports for r in file_hashes(spark, f"{path}/{name}/*.csv").collect()}
    m = json_safe({"schema": 1, "repository": repository, "revision": revision, "settings": settings or {}, "outputs": files})
    write_text(spark, f"{path}/manifest.json", json.dumps(m, indent=1, sort_keys=True))
    return m


def wide_theta(df: DataFrame, key: str, theta: str, k: int, text: str) -> DataFrame:
    """A topic mixture as columns topic_0 ... with the hash of the text that it is of."""
    return df.select(key, *(F.get(theta, F.lit(i)).alias(f"topic_{i}") for i in range(k)), F.sha2(F.coalesce(text, F.lit("")), 256).alias("text_sha256"), F.col(theta).isNotNull().alias("has_evidence"))


def append_checkpoint(df: DataFrame, path: str) -> None:
    """Finished units; rows of a unit that stands there twice agree, as they are keyed by their inputs' hash."""
    df.write.mode("append").parquet(path)


def topic_table(words: Sequence[Sequence[str]], counts: DataFrame) -> DataFrame:
    """(topic, label, docs, share) of a model's topics."""
    spark = counts.sparkSession
    labels = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(words)], "topic int, label string")
    total = counts.agg(F.sum("docs").alias("all"))
    return labels.join(counts, "topic", "left").crossJoin(F.broadcast(total)).select("topic", "label", F.coalesce("docs", F.lit(0)).alias("docs"), F.round(F.coalesce("docs", F.lit(0)) / F.col("all"), 6).alias("share"))
