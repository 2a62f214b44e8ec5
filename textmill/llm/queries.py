"""One query opN_<name> for each operator, over its whole table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm.ann import nearest
from textmill.llm.bpe import encode_decode
from textmill.llm.html_text import extract_main_text
from textmill.llm.licenses import scan_licenses
from textmill.llm.mixing import mix_sources
from textmill.llm.ngram_join import ngram_join
from textmill.llm.quality_classifier import classify_quality
from textmill.llm.quality_rules import BOILERPLATE, quality_rules
from textmill.llm.token_files import token_files
from textmill.llm.toxicity import score_toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"), tokenizer_file=public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"), n=4, percent=85)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), every=50, top=5)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_kept_words")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix_sources(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "source", "size", "source_size", "target", "taken", F.round("position", 9).alias("position"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"), ranks=public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern=public_tokenizers.PATTERN)


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": op1_token_files,
    "op2_ngram_join": op2_ngram_join,
    "op3_toxicity": op3_toxicity,
    "op5_ann": op5_ann,
    "op6_quality_classifier": op6_quality_classifier,
    "op4_quality_rules": op4_quality_rules,
    "op7_mixing": op7_mixing,
    "op8_bpe": op8_bpe,
    "op9_licenses": op9_licenses,
    "op10_html_text": op10_html_text,
}
_SPACE = r"[\x20\x09-\x0D]+"
_COUNT = "(length(l) - length(translate(l, '{}', '')))"
ORACLE_SQL: dict[str, str] = {
    "op4_quality_rules": rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, [l for l in string_split(t, chr(10)) if regexp_matches(l, '[^\x20\x09-\x0D]')] AS ls FROM d),
g AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 1), lambda i: {{'i': i, 'g': w[i] || chr(31) || w[i + 1] || chr(31) || w[i + 2]}})) AS x FROM w WHERE len(w) > 3),
r AS (SELECT doc_id, count(DISTINCT p) AS k FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM (SELECT doc_id, x.i AS i, count(*) OVER (PARTITION BY doc_id, x.g) AS c FROM g) WHERE c > 1) GROUP BY 1),
l AS (SELECT doc_id, x.l AS l, x.i AS i FROM (SELECT doc_id, unnest(list_transform(ls, lambda l, i: {{'l': l, 'i': i}})) AS x FROM w)),
m AS (SELECT *, len(string_split_regex(trim(l, ' '), '{_SPACE}')) AS n, length(l) AS chars, length(l) - length(regexp_replace(l, '\p{{L}}+', '', 'g')) AS letters, length(l) - length(regexp_replace(l, '\p{{Lu}}+', '', 'g')) AS upper, {_COUNT.format("|»›•·")} AS nav, {_COUNT.format("!")} AS marks, {_COUNT.format("#*$%&|<>{}~^=+@\\")} AS symbols FROM l),
k AS (SELECT doc_id, string_agg(l, chr(10) ORDER BY i) AS clean FROM m WHERE NOT ((nav >= 3 AND nav * 4 >= n) OR (marks * 4 >= n AND marks >= 3) OR (letters >= 40 AND upper * 10 >= letters * 8) OR symbols * 10 > chars OR (chars >= 20 AND letters * 2 < chars) OR (n <= 12 AND regexp_matches(lower(l), '{"|".join(BOILERPLATE)}'))) GROUP BY 1),
o AS (SELECT w.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '{_SPACE}', '', 'g'))::BIGINT AS word_chars, (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(r.k, 0)::BIGINT AS n_repeat_words, (CASE WHEN coalesce(clean, '') = '' THEN 0 ELSE len(string_split_regex(trim(clean, ' '), '{_SPACE}')) END)::BIGINT AS n_kept_words FROM w LEFT JOIN r USING (doc_id) LEFT JOIN k USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND (n_words - n_kept_words) <= 0.4 * n_words AS kept FROM o""",
    "op2_ngram_join": r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
z AS (SELECT d.doc_id, count(s.g) AS n FROM d LEFT JOIN s USING (doc_id) GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT p.a, p.b, k = x.n AND k = y.n AS same FROM p JOIN z x ON x.doc_id = p.a JOIN z y ON y.doc_id = p.b WHERE 100 * k >= 85 * (x.n + y.n - k)),
r AS (SELECT doc_id, doc_id AS c FROM z UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.c),
c AS (SELECT doc_id, min(c) AS component_id FROM r GROUP BY 1),
g AS (SELECT a AS doc_id, count(*) AS n_links, min(CASE WHEN same THEN b END) AS twin FROM l GROUP BY 1)
SELECT z.doc_id, z.n AS n_shingles, c.component_id, coalesce(g.n_links, 0) AS n_links, least(z.doc_id, coalesce(g.twin, z.doc_id)) AS class_id FROM z JOIN c USING (doc_id) LEFT JOIN g USING (doc_id)""",
    "op7_mixing": r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5(doc_id::VARCHAR) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k, count(*) OVER () AS c FROM d GROUP BY 1), w AS (SELECT *, [3, 1, 2][k % 3 + 1]::DOUBLE AS weight FROM s), r AS (SELECT *, source_size * 2.0::DOUBLE / weight AS r FROM w),
l AS (SELECT *, (sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE - 2.0::DOUBLE * coalesce(sum(source_size) OVER (ORDER BY r, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE) / sum(weight) OVER (ORDER BY r, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS v FROM r),
t AS (SELECT source, source_size, least(source_size * 2.0::DOUBLE, max(v) OVER () * weight) AS target, CASE WHEN c > 1 THEN 0.5::DOUBLE * (1 - 2 * k / (c - 1)) ELSE 0 END AS a FROM l),
p AS (SELECT doc_id, d.source, size, source_size, target, a, (sum(size) OVER (PARTITION BY d.source ORDER BY h NULLS FIRST, doc_id, size ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS x FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, source, size, source_size, target, (greatest(0, least(size, floor(target)::BIGINT - x)) + greatest(0, least(size, floor(target)::BIGINT - x - source_size)))::BIGINT AS taken,
CASE WHEN target <= 0 THEN 1 ELSE round(2 * least(1, x / target) / ((1 + a) + sqrt(greatest(0, (1 + a) * (1 + a) - 4 * a * least(1, x / target)))), 9) END AS position FROM p""",
}
