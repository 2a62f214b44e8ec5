"""A training corpus from documents, in stages: rules for quality, a classifier for quality, near-duplicate removal, mixing of sources, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of docs. run() writes each stage's result as Parquet to the folder in spark.checkpoint.dir and reads it again as the next one's docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm.bpe import encode_decode
from textmill.llm.common import discard, stored
from textmill.llm.mixing import mixed_rows
from textmill.llm.ngram_join import ngram_join
from textmill.llm.quality_classifier import keep_good
from textmill.llm.quality_rules import quality_rules


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, with the columns of docs as they are, whatever their names.

    Null, empty and short texts go; texts are judged whole, however long, and each row alone, so repeated rows and ids share their fate and a null doc_id does not matter. An empty table gives an empty one.
    """
    return quality_rules(docs, append=False)


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on its own input, scores 0.3 or more: what is not clearly bad stays.

    Null and blank texts go, texts of one to four words stay; texts are read whole, however long; rows with a null or repeated doc_id are judged like others; a score of exactly 0.3 stays. Columns of docs stay as they are, whatever their names; an empty table gives an empty one.
    """
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by five-word shingles with a similarity of 0.8 or more, the one with the smallest doc_id.

    Null, empty and blank texts are linked with nothing and stay. Where doc_ids are null or repeated every row is a document of its own: of a group the row with the smallest id stays, null last, of equal ids the one with the least hash of its text, of equal texts any one. Texts are compared whole, however long. Columns of docs stay as they are, whatever their names; an empty table gives an empty one.
    """
    ids = F.col("doc_id").cast("long")
    odd = docs.groupBy(ids.alias("k")).agg(F.count("*").alias("n")).where("k is null or n > 1").limit(1).count()
    if not odd:
        gone = ngram_join(docs, n=5, percent=80).where("doc_id <> component_id").select(F.col("doc_id").alias("__gone"))
        return docs.join(gone, ids == F.col("__gone"), "left_anti").select(*docs.columns)
    # rows get a number of their own; written, so that all that follows sees the same one
    rows = docs.select(F.monotonically_increasing_id().alias("__row"), F.struct(*docs.columns).alias("__doc"), F.col("doc_id").cast("long").alias("__id"), F.col("text").cast("string").alias("__text"))
    rows = stored(rows, "numbered-rows")
    groups = ngram_join(rows, n=5, percent=80, text="__text", doc_id="__row").select(F.col("doc_id").alias("__row"), F.col("component_id").alias("__group"))
    rank = F.struct(F.col("__id").isNull(), "__id", F.xxhash64("__text"), "__row")
    best = rows.join(groups, "__row").groupBy("__group").agg(F.min_by("__row", rank).alias("__row")).select("__row")
    return rows.join(best, "__row", "left_semi").select("__doc.*")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for every time that the mix takes a document, in the order of training positions; documents that it does not take are left out.

    Every row has positions of its own, also where doc_ids are null or repeated, so each source comes near its target; null sources are one source; documents without words, null texts among them, are taken no times. Texts may be of any length. Columns of docs stay as they are, whatever their names; an empty table gives an empty one.
    """
    return mixed_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of each row, encoded and decoded: doc_id, n_tokens, ids_sha256, decoded_sha256, n_bytes, exact.

    Null texts count as empty; texts go through whole, however long; repeated rows and ids give repeated results, a null doc_id stays null, other columns of docs are not read, and an empty table gives none.
    """
    return encode_decode(docs, ranks=public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern=public_tokenizers.PATTERN)


STAGES = [("quality rules", rules), ("quality classifier", classifier), ("n-gram Jaccard join", near_duplicates), ("mixing", mixing), ("byte-level BPE", tokens)]
#: The classifier, the links' components and the tokens can't be expressed in SQL; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; a stage's files are removed once the next one's are written, the last one's stay."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        done = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
        discard(docs)
        docs = done
    return docs
