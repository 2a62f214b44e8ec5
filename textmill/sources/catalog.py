"""Snapshots of tables: pinned reads, verified mirrors, id lists."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.operators.contracts import ContractError


def hadoop_path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = hadoop_path(spark, path)
    return fs.exists(p)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, such as a manifest, from any store that Spark reads."""
    return "\n".join(r.value for r in spark.read.text(path).collect())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    p, fs = hadoop_path(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


@dataclass(frozen=True)
class Catalog:
    """Tables below one path, of one revision. Every read comes from it, so companions agree."""

    spark: SparkSession
    path: str
    revision: str | None = None

    @property
    def root(self) -> str:
        return f"{self.path}/revisions/{self.revision}" if self.revision else self.path

    def tables(self) -> list[str]:
        p, fs = hadoop_path(self.spark, self.root)
        return sorted({s.getPath().getName().removesuffix(".parquet") for s in fs.listStatus(p) if not s.getPath().getName().startswith(("_", "."))})

    def read(self, table: str, columns: Sequence[str] | None = None, key: str | None = None) -> DataFrame:
        """A table with only the named columns that it has; shards of different schemas are joined up by name; a key column comes as text."""
        path = f"{self.root}/{table}"
        path = path if exists(self.spark, path) else f"{path}.parquet"
        df = self.spark.read.option("mergeSchema", True).parquet(path)
        if columns is not None:
            df = df.select(*(F.col(f"`{c}`") for c in columns if c in df.columns))
        return df.withColumn(key, F.col(f"`{key}`").cast("string")) if key else df

    def pinned(self) -> Catalog:
        """This catalog at the revision that is current now."""
        return Catalog(self.spark, self.path, read_text(self.spark, f"{self.path}/CURRENT").strip())


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, sha256) of files, hashed on the executors."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))


def read_mirror(spark: SparkSession, path: str, *, repository: str, revision: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """A table of a mirror whose manifest names the repository, the revision, the files' hashes and the rows, all of which must hold."""
    m = json.loads(read_text(spark, f"{path}/manifest.json"))
    if m.get("schema") != 1 or m.get("repository") != repository or revision not in (None, m.get("revision")):
        raise ContractError(f"{path}: the manifest is of another schema, repository or revision")
    names = m["files"]
    if any("/" in n or n.startswith(".") for n in names):
        raise ContractError(f"{path}: a file lies outside the mirror")
    got = {r.path.rsplit("/", 1)[-1]: r.sha256 for r in file_hashes(spark, f"{path}/*.{m['format']}").collect()}
    if got != names:
        raise ContractError(f"{path}: files differ from the manifest")
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"') if m["format"] == "csv" else spark.read
    df = reader.csv(f"{path}/*.csv") if m["format"] == "csv" else reader.parquet(f"{path}/*.parquet")
    if df.count() != m["rows"]:
        raise ContractError(f"{path}: {m['rows']} rows were expected")
    return df.select(*(c for c in columns if c in df.columns)) if columns else df


def read_ids(spark: SparkSession, path: str, key: str = "id", where: str | None = None) -> DataFrame:
    """(key) of a cohort: a CSV with the column, rows of which a true/false column may choose, or text with one id a line and # comments."""
    if path.endswith(".csv"):
        df = spark.read.option("header", True).csv(path)
        df = df.where(F.lower(F.trim(where)).isin("true", "1", "yes")) if where else df
        ids = df.select(F.trim(F.col(f"`{key}`").cast("string")).alias(key))
    else:
        ids = spark.read.text(path).select(F.trim(F.regexp_replace("value", "#.*$", "")).alias(key))
    return ids.where(F.col(key) != "").distinct()


def read_checkpoint(spark: SparkSession, path: str, inputs: DataFrame, key: str, hash_: str) -> DataFrame:
    """Stored results whose input hash is that of the row now; a missing checkpoint has none."""
    if not exists(spark, path):
        return inputs.select(key, hash_).limit(0)
    return spark.read.parquet(path).join(inputs.select(key, hash_), [key, hash_], "left_semi")


def reuse_vectors(stored: DataFrame, rows: DataFrame, key: str, text: str, vector: str, tolerance: float = 1e-5) -> DataFrame:
    """Stored mixtures of rows whose text has not changed; one that does not sum to 1 raises."""
    now = rows.select(key, F.sha2(F.coalesce(text, F.lit("")), 256).alias("text_sha256"))
    total = F.aggregate(vector, F.lit(0.0), lambda s, x: s + x)
    sure = F.when(F.abs(total - 1) <= tolerance, F.col(vector)).otherwise(F.raise_error(F.lit("a mixture does not sum to 1")).cast(dict(stored.dtypes)[vector]))
    return stored.join(now, [key, "text_sha256"]).withColumn(vector, sure)


def snapshot_id(parts: Sequence[str]) -> str:
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()[:16]
