"""Queries over computed columns: provenance, eligibility, topics over time, contracts, review sheets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions import text as tx
from textmill.functions.hashing import config_fingerprint, config_json
from textmill.operators import agreement as ag
from textmill.operators import authority as au
from textmill.operators import contracts as ct
from textmill.operators import coverage as cv
from textmill.operators import enrichment as en
from textmill.operators import merging as mg
from textmill.operators import privacy as pv
from textmill.operators import sampling as sm
from textmill.operators import similarity as si
from textmill.plans.corpus import read
from textmill.sources import sinks

QUERIES = {}
ORACLE_SQL = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


SETTINGS = {"unit": "characters", "version": 2}


@query(f"""
WITH d AS (SELECT doc_id, source, length(source)::INT AS v, substring(sha256(source || chr(31)), 1, 32) AS h FROM documents),
o AS (SELECT *, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE -1 END AS old, CASE WHEN doc_id % 3 = 1 THEN h ELSE 'x' END AS old_h FROM d)
SELECT doc_id, CASE WHEN doc_id % 3 = 1 THEN -1 ELSE v END AS size, h AS size_input_hash, '{config_fingerprint(SETTINGS)}' AS size_config_hash, '{config_json(SETTINGS)}' AS size_config_json FROM o""")
def enriched_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Cells that are missing, or whose inputs have changed, are made anew; those that still fit stay."""
    k = F.col("doc_id")
    d = read(spark, sf, "documents").select("doc_id", "source")
    fits = en.enrich(d, "size", F.lit(-1), [F.col("source")], SETTINGS)
    stale = fits.withColumns({"size": F.when(k % 3 > 0, F.col("size")), "size_input_hash": F.when(k % 3 == 1, F.col("size_input_hash")).otherwise("x")})
    return en.enrich(stale, "size", F.length("source"), [F.col("source")], SETTINGS, mode="incompatible").drop("source")


@query("""
SELECT doc_id::VARCHAR AS doc_id, CASE WHEN doc_id % 4 > 0 THEN 'exact_date_required' WHEN e.vec_id IS NULL OR doc_id % 5 = 0 THEN 'missing_or_invalid_vector' WHEN doc_id % 7 = 0 THEN 'text_shorter_than_shingle' ELSE '' END AS reason
FROM documents LEFT JOIN embeddings e ON vec_id = doc_id""")
def pair_eligibility(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("doc_id")
    e = read(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), F.when(F.col("vec_id") % 5 > 0, F.col("embedding")).alias("v"))
    d = read(spark, sf, "documents").join(e, "doc_id", "left").withColumn("t", F.when(k % 7 == 0, F.lit("two words")).otherwise(F.lit("here are three words")))
    d = d.withColumn("date", F.when(k % 4 == 0, F.lit("1999-05-06")).when(k % 4 == 1, F.lit("1999-05")).when(k % 4 == 2, F.lit("1999/2000")))
    return en.pair_eligibility(d, "doc_id", "v", "t", "date", shingle_size=3, max_days=30)


@query("SELECT doc_id, (doc_id % 6)::INT AS topic, 'm' || (doc_id % 2) AS model FROM documents WHERE doc_id % 6 NOT IN (0, 1)")
def whole_topics(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("doc_id")
    d = read(spark, sf, "documents").select("doc_id", F.when(k % 6 == 0, F.lit(-1.0)).when(k % 6 == 1, F.lit(2.5)).otherwise((k % 6).cast("double")).alias("topic"), F.concat(F.lit("m"), k % 2).alias("model"))
    return en.with_topic(d, "topic", "model")


@query(r"SELECT doc_id, source FROM documents WHERE lang = 'en' AND len(list_filter(string_split_regex(coalesce(text, ''), '\s+'), lambda w: w <> '')) >= 50 AND source <> ''")
def training_rows(spark: SparkSession, sf: str) -> DataFrame:
    return en.training_rows(read(spark, sf, "documents"), "text", "lang", "en", "source", least=50).select("doc_id", "source")


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'name,phone' WHEN c_custkey % 3 = 1 THEN 'phone' ELSE '' END AS restricted FROM customer WHERE c_custkey % 5 NOT IN (0, 1)")
def row_restrictions(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    lists = F.when(k % 3 == 0, F.array(F.lit("phone"), F.lit("name"), F.lit("phone"))).when(k % 3 == 1, F.array(F.lit("phone"))).otherwise(F.array().cast("array<string>"))
    c = read(spark, sf, "customer").select("c_custkey", F.when(k % 5 > 0, k % 5 != 1).alias("public"), lists.alias("private"))
    return en.row_restrictions(c, "c_custkey", "public", "private").withColumn("restricted", F.array_join("restricted", ","))


THETA = "(doc_id % 5 + 1) / 20.0, (doc_id % 7 + 1) / 20.0"


def mixtures(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("doc_id")
    theta = F.array((k % 5 + 1) / 20.0, (k % 7 + 1) / 20.0)
    return read(spark, sf, "documents").select("doc_id", "lang", "source", (k % 9 + 1990).cast("int").alias("year"), F.when(k % 11 > 0, theta).alias("theta"))


@query(f"""
WITH d AS (SELECT doc_id, lang, source, (doc_id % 9 + 1990)::INT AS year, unnest([{{'t': 0, 'p': (doc_id % 5 + 1) / 20.0}}, {{'t': 1, 'p': (doc_id % 7 + 1) / 20.0}}]) AS x FROM documents WHERE doc_id % 11 > 0)
SELECT year, lang, x.t::INT AS topic, round(avg(x.p), 8) AS prevalence, count(*) AS n_docs, count(DISTINCT source) AS n_clusters FROM d GROUP BY 1, 2, 3 HAVING count(*) >= 3""")
def topic_prevalence(spark: SparkSession, sf: str) -> DataFrame:
    return en.prevalence(mixtures(spark, sf), "theta", ["year", "lang"], cluster="source", least=3).withColumn("prevalence", F.round("prevalence", 8))


@query()
def topic_intervals(spark: SparkSession, sf: str) -> DataFrame:
    """Rows only: random resampling; tests hold its means against topic_prevalence."""
    return en.prevalence_intervals(mixtures(spark, sf), "theta", "year", "doc_id", cluster="source")


@query("""
WITH d AS (SELECT *, doc_id % 4 AS topic, (doc_id % 10) / 10.0 AS prob, CASE WHEN doc_id % 3 = 0 THEN 'old' WHEN doc_id % 3 = 1 THEN 'new' END AS model FROM documents)
SELECT topic::INT AS topic, count(*) AS docs, round(count(*) / (SELECT count(*) FROM d WHERE model = 'new'), 6) AS share, round(avg(prob), 6) AS mean_prob, (SELECT count(*) FROM d WHERE model IS DISTINCT FROM 'new') AS suppressed FROM d WHERE model = 'new' GROUP BY 1""")
def prediction_report(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("doc_id")
    d = read(spark, sf, "documents").select((k % 4).cast("int").alias("topic"), ((k % 10) / 10.0).alias("prob"), F.when(k % 3 == 0, "old").when(k % 3 == 1, "new").alias("model"))
    return en.prediction_report(d, "topic", "prob", "model", "new")


@query("""
WITH s AS (SELECT c_nationkey AS k, year(o_orderdate) AS y, avg(o_totalprice)::DOUBLE AS v, count(*)::DOUBLE AS w FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
l AS (SELECT k, CASE WHEN sum(w) * sum(w * y * y) - sum(w * y) ** 2 > 0 THEN (sum(w) * sum(w * y * v) - sum(w * y) * sum(w * v)) / (sum(w) * sum(w * y * y) - sum(w * y) ** 2) END AS slope FROM s GROUP BY 1),
m AS (SELECT a.k, sum(sign(b.v - a.v))::BIGINT AS s FROM s a JOIN s b ON a.k = b.k AND a.y < b.y GROUP BY 1), n AS (SELECT k, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT k, y, avg(v) OVER (PARTITION BY k ORDER BY y ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS v FROM s), t AS (SELECT k, y AS peak_y, v, row_number() OVER (PARTITION BY k ORDER BY v DESC, y) AS r FROM p)
SELECT k, n, s, round(slope, 4) AS slope, peak_y, round(v, 4) AS peak_value FROM n JOIN m USING (k) JOIN l USING (k) JOIN t USING (k) WHERE r = 1""")
def trend_report(spark: SparkSession, sf: str) -> DataFrame:
    o = read(spark, sf, "orders").join(read(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    s = o.groupBy(F.col("c_nationkey").alias("k"), F.year("o_orderdate").alias("y")).agg(F.avg("o_totalprice").cast("double").alias("v"), F.count("*").cast("double").alias("w"))
    return en.trend_report(s, "y", "v", "w", ["k"]).select("k", "n", "s", F.round("slope", 4).alias("slope"), "peak_y", F.round("peak_value", 4).alias("peak_value"))


@query("SELECT doc_id, CASE WHEN source = 'src1' AND doc_id % 2 = 0 THEN 'near_duplicate' ELSE 'uncalibrated_similarity' END AS label, doc_id || '#' || (doc_id % 3) AS chunk FROM documents")
def similarity_labels(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("doc_id")
    space = F.concat(F.lit("s"), k % 2)
    return read(spark, sf, "documents").select("doc_id", en.near_duplicate_label(F.col("source"), space, {"src1": "s0"}).alias("label"), en.chunk_key(k, k % 3).alias("chunk"))


@query("SELECT count(*) AS n, count(*) FILTER (vec_id % 7 = 0) AS missing, count(*) FILTER (vec_id % 7 = 1) AS wrong_size, count(*) FILTER (vec_id % 7 = 2) AS not_finite, count(*) FILTER (vec_id % 7 = 3) AS zero FROM embeddings")
def vector_violations(spark: SparkSession, sf: str) -> DataFrame:
    k, v = F.col("vec_id") % 7, F.col("embedding")
    odd = F.when(k == 0, F.lit(None)).when(k == 1, F.slice(v, 1, 63)).when(k == 2, F.concat(F.slice(v, 1, 63), F.array(F.lit(float("nan")).cast("float")))).when(k == 3, F.transform(v, lambda x: x * 0)).otherwise(v)
    return ct.vector_violations(read(spark, sf, "embeddings").select(odd.alias("v")), "v", 64)


@query("SELECT doc_id, CASE WHEN doc_id % 3 > 0 THEN doc_id END AS whole FROM documents")
def whole_numbers(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("doc_id")
    return read(spark, sf, "documents").select("doc_id", ct.to_long(F.when(k % 3 == 0, F.lit(float("nan"))).otherwise(k.cast("double"))).alias("whole"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 4 > 0 AND c_custkey % 3 = 0 THEN c_name ELSE '' END AS c_name FROM customer")
def masked_content(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    c = read(spark, sf, "customer").select("c_custkey", "c_name", F.when(k % 4 > 0, k % 3 == 0).alias("open"))
    return pv.mask_content(c, ["c_name"], "open").drop("open")


@query("SELECT count(*) FILTER (c_custkey % 4 = 0) AS private_rows, count(*) FILTER (c_custkey % 3 = 0)::BIGINT AS open_cells, 1 AS unknown_columns FROM customer")
def projection_violations(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    c = read(spark, sf, "customer").select("c_custkey", "c_name", "c_phone" if "c_phone" in read(spark, sf, "customer").columns else "c_mktsegment", (k % 4 > 0).alias("public"))
    withheld = F.when(k % 3 == 0, F.array(F.lit("c_name"))).otherwise(F.array().cast("array<string>"))
    return pv.projection_violations(c, public="public", withheld=withheld, columns=["c_name"], allowed=["c_custkey", "c_name", "public"])


@query("SELECT doc_id, lang, substring(text, 1, 80) AS excerpt, '' AS verdict, '' AS note FROM documents")
def blinded_sheet(spark: SparkSession, sf: str) -> DataFrame:
    return sm.blinded(read(spark, sf, "documents"), ["doc_id", "lang"], ["verdict", "note"], text="text", excerpt=80)


@query("SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'no_estimate' WHEN 1 THEN 'missing_identity' WHEN 2 THEN 'unverified_name' WHEN 3 THEN 'unverified_name' ELSE '' END AS reason FROM documents")
def review_reasons(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("doc_id")
    m = k % 5
    estimate, model, verified = F.when(m != 0, F.lit(1.0)), F.when(m == 1, F.lit(None).cast("string")).otherwise(F.lit("m")), F.when(m == 2, F.lit(False)).when(m != 3, F.lit(True))
    return read(spark, sf, "documents").select("doc_id", sm.review_validity(estimate, model, verified).alias("reason"))


@query("SELECT 'up' AS side, * FROM (SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0 ORDER BY c_acctbal DESC, c_custkey LIMIT 5) UNION ALL SELECT 'down', * FROM (SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0 ORDER BY c_acctbal, c_custkey LIMIT 5)")
def directional_rows(spark: SparkSession, sf: str) -> DataFrame:
    c = read(spark, sf, "customer").select("c_custkey", "c_acctbal")
    up, down = sm.directional(c, "c_acctbal", "c_custkey", 1), sm.directional(c, "c_acctbal", "c_custkey", -1)
    return up.select(F.lit("up").alias("side"), "*").unionByName(down.select(F.lit("down").alias("side"), "*"))


@query("SELECT doc_id, CASE WHEN doc_id % 4 > 0 THEN CASE WHEN doc_id % 3 = 0 THEN 'tone' || CASE WHEN doc_id % 2 = 0 THEN '|weight' ELSE '' END WHEN doc_id % 2 = 0 THEN 'weight' ELSE '' END END AS disputed, doc_id % 5 IN (0, 1) AS ranged FROM documents")
def disputed_dimensions(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("doc_id")
    ranged = ag.range_disputed(F.array(F.lit("low"), F.when(k % 5 < 2, F.lit("high")).otherwise(F.lit("middle")), F.lit("unknown")), ["low", "middle", "high"])
    return read(spark, sf, "documents").select("doc_id", ag.disagreement({"tone": k % 3 == 0, "weight": k % 2 == 0}, k % 4 > 0).alias("disputed"), ranged.alias("ranged"))


@query("SELECT source AS value, count(*) AS n FROM documents WHERE doc_id % 3 = 0 GROUP BY 1")
def unmapped_sources(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("doc_id")
    return au.unmapped(read(spark, sf, "documents").withColumn("country", F.when(k % 3 > 0, F.lit("X")).otherwise(F.lit(" "))), "source", "country")


@query("SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN doc_id::VARCHAR WHEN 1 THEN lang || '|' || source END AS outlet FROM documents")
def outlet_keys(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("doc_id")
    d = read(spark, sf, "documents").select("doc_id", F.when(k % 3 == 0, k.cast("string")).otherwise(F.lit(" ")).alias("ids"), F.when(k % 3 < 2, F.col("lang")).alias("country"), F.when(k % 3 == 1, F.col("source")).alias("title"))
    return d.select("doc_id", au.outlet_key(F.col("ids"), F.col("country"), F.col("title")).alias("outlet"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 > 0 THEN doc_id || ':0.' || (1250 + doc_id % 7) || '|9:0.5000' END AS neighbours FROM documents")
def neighbour_texts(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("doc_id")
    lists = F.array(F.struct(k.cast("string").alias("id"), (0.125 + (k % 7) / 10000).alias("score")), F.struct(F.lit("9").alias("id"), F.lit(0.5).alias("score")))
    return read(spark, sf, "documents").select("doc_id", tx.format_neighbours(F.when(k % 3 > 0, lists)).alias("neighbours"))


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 0.25 END AS topic_0, CASE WHEN doc_id % 2 = 0 THEN 0.75 END AS topic_1, sha256(coalesce(text, '')) AS text_sha256, doc_id % 2 = 0 AS has_evidence FROM documents")
def topic_columns(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("doc_id")
    d = read(spark, sf, "documents").select("doc_id", "text", F.when(k % 2 == 0, F.array(F.lit(0.25), F.lit(0.75))).alias("theta"))
    return sinks.wide_theta(d, "doc_id", "theta", 2, "text")


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE 'new' END AS c_name, CASE WHEN c_custkey % 5 = 0 THEN c_acctbal::DOUBLE ELSE 1.0 END AS c_acctbal FROM customer")
def restored_cells(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    old = read(spark, sf, "customer").select("c_custkey", "c_name", F.col("c_acctbal").cast("double").alias("c_acctbal"))
    failed = old.where(k % 3 == 0).select("c_custkey", F.lit("c_name").alias("column")).union(old.where(k % 5 == 0).select("c_custkey", F.lit("c_acctbal").alias("column")))
    return mg.restore_failed(old.select("c_custkey", F.lit("new").alias("c_name"), F.lit(1.0).alias("c_acctbal")), old, failed, "c_custkey", ["c_name", "c_acctbal"])


@query("SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'a,kept' WHEN 1 THEN 'a' ELSE 'kept' END AS private FROM documents")
def carried_private(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("doc_id")
    new, old = F.when(k % 3 < 2, F.array(F.lit("a"))), F.when(k % 3 != 1, F.array(F.lit("kept"), F.lit("gone")))
    return read(spark, sf, "documents").select("doc_id", F.array_join(mg.carry_private(new, old, ["kept"]), ",").alias("private"))


@query(r"""
WITH e AS (SELECT d.doc_id AS id, e.embedding::DOUBLE[] AS v, regexp_extract_all(lower(d.text), '[\p{L}\p{N}]+') AS w FROM documents d JOIN embeddings e ON e.vec_id = d.doc_id),
p AS (SELECT a.id AS i, b.id AS o, list_cosine_similarity(a.v, b.v) AS s FROM e a JOIN e b ON a.id <> b.id),
t AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY s DESC, o) AS r FROM p WHERE s >= 0.3), u AS (SELECT least(i, o) AS a, greatest(i, o) AS b, max(s) AS score FROM t WHERE r <= 20 GROUP BY 1, 2),
g AS (SELECT id, list_distinct(list_transform(range(1, len(w) - 1), lambda k: array_to_string(w[k:k + 2], ' '))) AS g FROM e),
j AS (SELECT a, b, score, len(list_intersect(x.g, y.g)) / len(list_distinct(list_concat(x.g, y.g))) AS jaccard FROM u JOIN g x ON x.id = a JOIN g y ON y.id = b WHERE len(x.g) > 0 AND len(y.g) > 0)
SELECT a, b, round(score, 6) AS score, round(jaccard, 6) AS jaccard FROM j WHERE jaccard >= 0.001""")
def reprint_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Thresholds far below those of an archive, as vectors and texts of the test tables have nothing to do with each other."""
    e = read(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    d = read(spark, sf, "documents").join(e, "doc_id").select("doc_id", "embedding", tx.words(F.col("text")).alias("words"))
    out = si.reprint_candidates(d, "doc_id", "embedding", "words", min_cosine=0.3, min_jaccard=0.001)
    return out.select("a", "b", F.round("score", 6).alias("score"), F.round("jaccard", 6).alias("jaccard"))


@query("SELECT 'other' AS precision, count(*) AS n FROM documents WHERE doc_id % 4 = 3")
def date_precisions(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("doc_id")
    d = read(spark, sf, "documents").select(F.element_at(F.array(*map(F.lit, ("day", "month", "year", "other"))), (k % 4 + 1).cast("int")).alias("precision"))
    return cv.precision_counts(d, "precision")


@query("SELECT doc_id, trim(regexp_replace(lower(replace(strip_accents(lang || '_' || source), '_', ' ')), '\\s+', ' ', 'g')) AS plain FROM documents")
def plain_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "documents").select("doc_id", tx.normalize_token(F.concat_ws("_", "lang", "source")).alias("plain"))
