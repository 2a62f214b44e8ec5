"""Queries over texts: words, keyness, coverage, phrases, samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions import text as tx
from textmill.operators import coverage as cv
from textmill.operators import keyness as kn
from textmill.operators import sampling as sm
from textmill.operators import topics as tp
from textmill.operators.contracts import duplicates, suspect_columns
from textmill.session import ship

QUERIES = {}
ORACLE_SQL = {}
TOKENS = r"list_filter(string_split(trim(regexp_replace(lower(coalesce(text,'')), '\s+', ' ', 'g')), ' '), lambda x: length(x) >= 2)"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tokens(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "documents").select("doc_id", "lang", "source", tx.simple_tokens(F.col("text")).alias("tokens"))


def keyness_sql(slice_: str, outlet: str, min_outlets: int) -> str:
    return f"""
WITH t AS (SELECT doc_id, {slice_} AS slice, {outlet} AS outlet, unnest({TOKENS}) AS token FROM documents),
c AS (SELECT slice, token, count(*) AS a, count(DISTINCT doc_id) AS docs, count(DISTINCT outlet) AS outlets FROM t WHERE slice IS NOT NULL GROUP BY 1, 2),
n AS (SELECT slice, sum(a) AS ta, (SELECT sum(a) FROM c) - sum(a) AS tb FROM c GROUP BY 1),
w AS (SELECT c.*, sum(a) OVER (PARTITION BY token) - a AS b FROM c),
g AS (SELECT w.slice, token, a::BIGINT AS a, b::BIGINT AS b, docs, outlets, ta::DOUBLE AS ta, tb::DOUBLE AS tb, ta::DOUBLE + tb AS n, (a + b)::DOUBLE AS w FROM w JOIN n USING (slice) WHERE ta > 0 AND tb > 0 AND a >= 10 AND docs >= 5 AND outlets >= {min_outlets}),
s AS (SELECT *, 2 * ((CASE WHEN a > 0 THEN a * ln(a / (ta * w / n)) ELSE 0 END) + (CASE WHEN ta - a > 0 THEN (ta - a) * ln((ta - a) / (ta * (n - w) / n)) ELSE 0 END) + (CASE WHEN b > 0 THEN b * ln(b / (tb * w / n)) ELSE 0 END) + (CASE WHEN tb - b > 0 THEN (tb - b) * ln((tb - b) / (tb * (n - w) / n)) ELSE 0 END)) AS raw FROM g),
v AS (SELECT *, CASE WHEN a / ta > b / tb THEN raw ELSE -raw END AS g2x, sqrt(greatest(abs(raw), 0) / 2) AS x FROM s),
p AS (SELECT *, 1 / (1 + 0.3275911 * x) AS t FROM v),
q0 AS (SELECT *, t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))) * exp(-x * x) AS p FROM p),
q1 AS (SELECT *, p * count(*) OVER (PARTITION BY slice) / rank_last AS raw_q FROM (SELECT *, count(*) OVER (PARTITION BY slice ORDER BY p RANGE UNBOUNDED PRECEDING) AS rank_last FROM q0)),
q2 AS (SELECT *, least(1.0, min(raw_q) OVER (PARTITION BY slice ORDER BY p DESC RANGE UNBOUNDED PRECEDING)) AS q FROM q1),
r AS (SELECT slice, token, a, b, docs, outlets, round(g2x, 3) AS g2, log2(((a + 0.5) / ta) / ((b + 0.5) / tb)) AS lr, sqrt(1 / (a + 0.5) + 1 / (b + 0.5)) / 0.6931471805599453 AS e, CASE WHEN b > 0 THEN round((a / ta) / (b / tb), 2) END AS rate_ratio FROM q2 WHERE g2x > 0 AND q < 0.05),
o AS (SELECT slice, token, a, b, docs, outlets, g2, round(lr, 2) AS log_ratio, round(lr - 1.959963984540054 * e, 2) AS ci_low, round(lr + 1.959963984540054 * e, 2) AS ci_high, rate_ratio FROM r)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY slice ORDER BY ci_low DESC, g2 DESC, token)::INT AS rank FROM o) WHERE rank <= 25"""


@query(keyness_sql("lang", "source", 2))
def keyness_lang(spark: SparkSession, sf: str) -> DataFrame:
    return kn.keyness(kn.slice_counts(tokens(spark, sf), "lang", "tokens", "source"), min_outlets=2)


@query(keyness_sql("source", "lang", 1))
def keyness_source(spark: SparkSession, sf: str) -> DataFrame:
    return kn.keyness(kn.slice_counts(tokens(spark, sf), "source", "tokens", "lang"), min_outlets=1)


@query(f"SELECT lang AS slice, token, count(*) AS a, count(DISTINCT doc_id) AS docs, count(DISTINCT source) AS outlets FROM (SELECT doc_id, lang, source, unnest({TOKENS}) AS token FROM documents) GROUP BY 1, 2")
def slice_counts(spark: SparkSession, sf: str) -> DataFrame:
    return kn.slice_counts(tokens(spark, sf), "lang", "tokens", "source")


@query("""
WITH d AS (SELECT doc_id, lang, source, n_chars >= 500 AS inc, l.doc_id IS NOT NULL AS labelled FROM documents LEFT JOIN labels l USING (doc_id))
SELECT CASE grouping(lang, source) WHEN 0 THEN 'lang+source' WHEN 1 THEN 'lang' WHEN 2 THEN 'source' ELSE 'all' END AS dimension, lang, source, count(*) AS n, count(*) FILTER (inc) AS n_included, count(*) FILTER (labelled) AS labelled_n, round(count(*) FILTER (labelled) / count(*), 6) AS labelled_share
FROM d GROUP BY GROUPING SETS ((lang, source), (lang), (source), ())""")
def coverage_cells(spark: SparkSession, sf: str) -> DataFrame:
    labels = read(spark, sf, "labels").select("doc_id", F.lit(True).alias("labelled"))
    d = read(spark, sf, "documents").join(labels, "doc_id", "left").select("lang", "source", (F.col("n_chars") >= 500).alias("inc"), F.coalesce("labelled", F.lit(False)).alias("labelled"))
    return cv.coverage(d, [["lang", "source"], ["lang"], ["source"], []], "inc", ["labelled"])


@query("SELECT doc_id, concat_ws('|', CASE WHEN n_chars < 500 THEN 'short' END, CASE WHEN lang NOT IN ('en', 'fr') THEN 'language' END, CASE WHEN l.doc_id IS NULL THEN 'no_label' END) AS reasons FROM documents LEFT JOIN labels l USING (doc_id)")
def exclusion_ledger(spark: SparkSession, sf: str) -> DataFrame:
    labels = read(spark, sf, "labels").select("doc_id", F.lit(True).alias("labelled"))
    d = read(spark, sf, "documents").join(labels, "doc_id", "left")
    return d.select("doc_id", cv.reasons({"short": F.col("n_chars") < 500, "language": ~cv.language_is(F.col("lang"), ["en", "fr"]), "no_label": F.col("labelled").isNull()}).alias("reasons"))


@query("""
SELECT count(*) AS n, count(*) FILTER (NOT (n_chars >= 500)) AS excluded_short, count(*) FILTER (n_chars >= 500 AND lang <> 'en') AS excluded_language,
count(*) FILTER (n_chars >= 500 AND lang = 'en' AND source = 'src0') AS excluded_source, count(*) FILTER (n_chars >= 500 AND lang = 'en' AND source <> 'src0') AS kept FROM documents""")
def eligibility(spark: SparkSession, sf: str) -> DataFrame:
    return kn.eligible(read(spark, sf, "documents"), [("short", F.col("n_chars") >= 500), ("language", cv.language_is(F.col("lang"), ["en"])), ("source", F.col("source") != "src0")])[1]


@query("SELECT lang AS label, count(*) AS n FROM documents WHERE lang NOT IN ('en') GROUP BY 1")
def excluded_languages(spark: SparkSession, sf: str) -> DataFrame:
    return cv.excluded_labels(read(spark, sf, "documents"), "lang", cv.language_is(F.col("lang"), ["en"]))


@query("SELECT count(*) AS n, count(nullif(text, '')) AS non_empty, round(avg(length(nullif(text, ''))), 4) AS mean_length, max(length(nullif(text, '')))::INT AS max_length FROM documents")
def text_stats(spark: SparkSession, sf: str) -> DataFrame:
    return cv.text_stats(read(spark, sf, "documents"), "text")


@query("SELECT source AS value, count(*) AS n, round(count(*) / (SELECT count(*) FROM documents), 6) AS share FROM documents GROUP BY 1")
def value_shares(spark: SparkSession, sf: str) -> DataFrame:
    return cv.value_shares(read(spark, sf, "documents"), "source")


@query(rf"SELECT doc_id, len({TOKENS})::INT AS n_tokens, len(regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}]+'))::INT AS n_words FROM documents")
def word_counts(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "documents").select("doc_id", F.size(tx.simple_tokens(F.col("text"))).alias("n_tokens"), F.size(tx.words(F.col("text"))).alias("n_words"))


@query(f"""
WITH t AS (SELECT doc_id, {TOKENS} AS w FROM documents), p AS (SELECT doc_id, w, len(w) AS n FROM t),
x AS (SELECT doc_id, list_sum(list_transform(range(1, n - 48), lambda i: len(list_distinct(w[i:i + 49])))) / 50 / (n - 49) AS m FROM p WHERE n >= 50)
SELECT p.doc_id, round(m, 6) AS mattr FROM p LEFT JOIN x USING (doc_id)""")
def lexical_richness(spark: SparkSession, sf: str) -> DataFrame:
    ship(spark)
    return tokens(spark, sf).select("doc_id", F.round(tx.mattr_udf("tokens", F.lit(50)), 6).alias("mattr"))


@query(f"""
WITH t AS (SELECT doc_id, {TOKENS} AS w FROM documents), n AS (SELECT doc_id, len(w) AS n FROM t),
k AS (SELECT doc_id, n, greatest(n // 100 + CASE WHEN n % 100 > 0 AND ((n % 100) * 4 >= 100 OR n < 100) THEN 1 ELSE 0 END, 1) AS c FROM n WHERE n > 0)
SELECT doc_id, i::INT AS chunk, (CASE WHEN i = c - 1 THEN n - i * 100 ELSE 100 END)::INT AS size FROM (SELECT doc_id, n, c, unnest(range(c)) AS i FROM k)""")
def token_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return tokens(spark, sf).select("doc_id", F.posexplode(tx.token_chunks(F.col("tokens"), 100)).alias("chunk", "c")).select("doc_id", "chunk", F.size("c").alias("size"))


@query(f"SELECT token, n, n / sum(n) OVER () AS p FROM (SELECT token, count(*) AS n FROM (SELECT unnest({TOKENS}) AS token FROM documents) GROUP BY 1)")
def word_probabilities(spark: SparkSession, sf: str) -> DataFrame:
    return tp.word_probabilities(tokens(spark, sf), "tokens")


@query(f"""
WITH f AS (SELECT token, count(DISTINCT source) AS docs FROM (SELECT source, unnest({TOKENS}) AS token FROM documents) GROUP BY 1),
k AS (SELECT * FROM f WHERE docs >= 3 AND docs <= floor((SELECT count(DISTINCT source) FROM documents) * 0.6))
SELECT token, docs, (row_number() OVER (ORDER BY docs DESC, token))::INT AS place FROM k ORDER BY docs DESC, token LIMIT 100000""")
def vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return tp.vocabulary(tokens(spark, sf), "tokens", "source", no_below=3, no_above=0.6)


@query(f"""
WITH t AS (SELECT doc_id, {TOKENS} AS w FROM documents),
s AS (SELECT w, count(*) AS n FROM (SELECT unnest(w) AS w FROM t) GROUP BY 1),
p AS (SELECT a, b, count(*) AS n, count(DISTINCT doc_id) AS docs FROM (SELECT doc_id, p[1] AS a, p[2] AS b FROM (SELECT doc_id, unnest(list_zip(w[1:len(w) - 1], w[2:])) AS p FROM t WHERE len(w) > 1)) GROUP BY 1, 2 HAVING count(*) >= 5)
SELECT a, b, p.n, docs, round((p.n - 5) * (SELECT count(*) FROM s) / (x.n * y.n), 6) AS score FROM p JOIN s x ON x.w = a JOIN s y ON y.w = b WHERE (p.n - 5) * (SELECT count(*) FROM s) / (x.n * y.n) > 1""")
def phrases(spark: SparkSession, sf: str) -> DataFrame:
    return tp.phrase_scores(tokens(spark, sf), "tokens", "doc_id", min_count=5, threshold=1.0).withColumn("score", F.round("score", 6))


@query()
def lda_topics(spark: SparkSession, sf: str) -> DataFrame:
    """Rows only: the numbers of a topic model depend on its random numbers."""
    t = tokens(spark, sf)
    bag, model = tp.fit_lda(t, "tokens", 30, min_df=10, max_df=0.4)
    theta = tp.infer(t, "tokens", "doc_id", bag, model)
    return theta.select("doc", F.transform(tp.top_topics(F.col("theta")), lambda x: x["topic"]).alias("topics"))


@query("SELECT text, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def repeated_texts(spark: SparkSession, sf: str) -> DataFrame:
    return duplicates(read(spark, sf, "documents"), "text")


@query("""
WITH r AS (SELECT *, sha256('42' || chr(0) || doc_id::VARCHAR) AS h FROM documents),
k AS (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY h, doc_id) AS r, count(*) OVER (PARTITION BY lang, source) AS population FROM r)
SELECT doc_id, lang, source, population, least(population, 3)::BIGINT AS sampled, round(least(population, 3) / population, 6) AS probability, round(population / least(population, 3), 6) AS weight FROM k WHERE r <= 3""")
def stratified_sample(spark: SparkSession, sf: str) -> DataFrame:
    return sm.stratified(read(spark, sf, "documents").select("doc_id", "lang", "source"), "doc_id", ["lang", "source"])


@query("""
WITH r AS (SELECT doc_id, lang, source, sha256('42' || chr(0) || doc_id::VARCHAR) AS h FROM documents),
k AS (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY h, doc_id) AS r FROM r)
SELECT doc_id FROM (SELECT k.doc_id, k.h, l.toxic FROM k JOIN labels l USING (doc_id) WHERE r > 3 AND (l.toxic = 1 OR l.quality = 0) ORDER BY CASE WHEN l.toxic = 1 THEN 0 ELSE 1 END, h, doc_id LIMIT 30)""")
def challenge_sample(spark: SparkSession, sf: str) -> DataFrame:
    d = read(spark, sf, "documents").select("doc_id", "lang", "source")
    chosen = sm.stratified(d, "doc_id", ["lang", "source"])
    rows = d.join(read(spark, sf, "labels"), "doc_id")
    return sm.challenge(rows, chosen, "doc_id", F.col("toxic") == 1, F.col("quality") == 0).select("doc_id")


@query("""
WITH g AS (SELECT source, row_number() OVER (ORDER BY sha256('42' || chr(0) || source), source) AS r FROM (SELECT DISTINCT source FROM documents)), n AS (SELECT count(*) AS n FROM g)
SELECT doc_id, r <= greatest(1, least(n - 1, round(n * 0.3))) AS held_out FROM documents JOIN g USING (source) CROSS JOIN n""")
def held_out_split(spark: SparkSession, sf: str) -> DataFrame:
    return sm.hash_split(read(spark, sf, "documents").select("doc_id", "source"), "source", 0.3).select("doc_id", "held_out")


@query("""
SELECT * FROM (SELECT 'lang' AS column, round(avg(length(nullif(lang, ''))), 6) AS mean_length, max(length(nullif(lang, '')))::INT AS max_length FROM documents UNION ALL SELECT 'source', round(avg(length(nullif(source, ''))), 6), max(length(nullif(source, '')))::INT FROM documents UNION ALL SELECT 'text', round(avg(length(nullif(text, ''))), 6), max(length(nullif(text, '')))::INT FROM documents) CROSS JOIN (SELECT 1) WHERE mean_length > 3000 OR max_length > 30000""".replace("SELECT * FROM", "SELECT \"column\", mean_length, max_length FROM"))
def suspect_text_columns(spark: SparkSession, sf: str) -> DataFrame:
    return suspect_columns(read(spark, sf, "documents")).where("suspect").select("column", F.round("mean_length", 6).alias("mean_length"), "max_length")


@query("""
WITH k AS (SELECT doc_id, lang, n_chars, (doc_id * 37 % 101) / 101 AS prob, (doc_id * 53 % 97) / 97 AS margin FROM documents WHERE n_chars >= 300),
a AS (SELECT doc_id, lang, 'representative' AS role, row_number() OVER (PARTITION BY lang ORDER BY prob DESC, doc_id)::INT AS place FROM k),
b AS (SELECT doc_id, lang, 'borderline' AS role, row_number() OVER (PARTITION BY lang ORDER BY margin, doc_id)::INT AS place FROM k WHERE doc_id NOT IN (SELECT doc_id FROM a WHERE place <= 5))
SELECT * FROM a WHERE place <= 5 UNION ALL SELECT * FROM b WHERE place <= 5""")
def review_rows(spark: SparkSession, sf: str) -> DataFrame:
    d = read(spark, sf, "documents").select("doc_id", "lang", "n_chars", (F.col("doc_id") * 37 % 101 / 101).alias("prob"), (F.col("doc_id") * 53 % 97 / 97).alias("margin"))
    return sm.representatives(d, "lang", "doc_id", "prob", "margin", "n_chars", least=300).select("doc_id", "lang", "role", "place")


@query(r"""
WITH w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents), b AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark),
ds AS (SELECT doc_id, unnest(list_distinct(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' ')))) AS g FROM w), bs AS (SELECT item_id, unnest(list_distinct(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' ')))) AS g FROM b)
SELECT doc_id, item_id, count(*) AS shared FROM ds JOIN bs USING (g) GROUP BY 1, 2""")
def shared_shingles(spark: SparkSession, sf: str) -> DataFrame:
    """8-word shingles that documents share with benchmark items: the items' side is built once, and documents meet it by the shingle's own key."""
    d = read(spark, sf, "documents").select("doc_id", F.explode(tx.shingles(tx.words(F.col("text")), 8)).alias("g"))
    b = read(spark, sf, "benchmark").select("item_id", F.explode(tx.shingles(tx.words(F.col("text")), 8)).alias("g"))
    return d.join(b, "g").groupBy("doc_id", "item_id").agg(F.count("*").alias("shared"))
