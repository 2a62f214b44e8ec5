"""Queries over records: authority files, networks, calendars, panels, trends, merges, projections, dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions import dates as dt
from textmill.operators import agreement as ag
from textmill.operators import authority as au
from textmill.operators import coverage as cv
from textmill.operators import graphs as gr
from textmill.operators import keyness as kn
from textmill.operators import merging as mg
from textmill.operators import privacy as pv
from textmill.operators import stats as st
from textmill.plans.corpus import read
from textmill.session import ship

QUERIES = {}
ORACLE_SQL = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def brands(spark: SparkSession, sf: str) -> DataFrame:
    """(o_orderkey, es): brands of each order."""
    li, part = read(spark, sf, "lineitem").select("l_orderkey", "l_partkey"), read(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return li.join(part, "l_partkey").groupBy("l_orderkey").agg(F.collect_set("p_brand").alias("es"))


@query("""
WITH y AS (SELECT n_name, year(o_orderdate) AS y, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE year(o_orderdate) BETWEEN 1996 AND 2000 GROUP BY 1, 2)
SELECT n_name, count(*) AS years, min(n) AS least, sum(n)::BIGINT AS rows FROM y GROUP BY 1 HAVING count(*) = 5 AND min(n) >= 10""")
def stable_outlets(spark: SparkSession, sf: str) -> DataFrame:
    o = read(spark, sf, "orders").join(read(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(read(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return cv.stable(o.select("n_name", F.year("o_orderdate").alias("y")), ["n_name"], "y", 1996, 2000, 10)


@query("""
WITH m AS (SELECT DISTINCT l_orderkey AS item, p_brand AS id FROM lineitem JOIN part ON l_partkey = p_partkey),
f AS (SELECT o_orderkey AS item, strftime(o_orderdate, '%Y-%m-%d') AS d, n_name AS c FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
SELECT id, count(DISTINCT item) AS frequency, min(d) AS first, max(d) AS last, array_to_string(list_sort(list(DISTINCT c)), '|') AS countries FROM m JOIN f USING (item) GROUP BY 1""")
def authority_frequency(spark: SparkSession, sf: str) -> DataFrame:
    li, part = read(spark, sf, "lineitem"), read(spark, sf, "part")
    mentions = li.join(part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").alias("item"), F.col("p_brand").alias("id"))
    o = read(spark, sf, "orders").join(read(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(read(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return au.frequencies(mentions, o.select(F.col("o_orderkey").alias("item"), day.alias("low"), day.alias("high"), F.array("n_name").alias("countries")))


@query("""
WITH p AS (SELECT p_partkey AS id, p_name AS title FROM part), i AS (SELECT l_orderkey AS item, array_to_string(list_sort(list(DISTINCT CASE WHEN l_orderkey % 3 = 0 THEN l_partkey::VARCHAR END)), '|') AS ids, array_to_string(list_sort(list(DISTINCT p_name)), '|') AS names FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1),
u AS (SELECT title, min(id) AS id FROM p GROUP BY 1 HAVING count(*) = 1),
a AS (SELECT item, unnest(string_split(ids, '|')) AS id FROM i WHERE ids <> '' AND ids IS NOT NULL), b AS (SELECT item, unnest(string_split(names, '|')) AS title FROM i WHERE coalesce(ids, '') = '')
SELECT DISTINCT item, id FROM (SELECT item, a.id FROM a WHERE a.id IN (SELECT id::VARCHAR FROM p) UNION ALL SELECT item, u.id::VARCHAR FROM b JOIN u USING (title))""")
def resolved_entities(spark: SparkSession, sf: str) -> DataFrame:
    li, part = read(spark, sf, "lineitem"), read(spark, sf, "part")
    rows = li.join(part, F.col("l_partkey") == F.col("p_partkey"))
    items = rows.groupBy(F.col("l_orderkey").alias("item")).agg(F.array_join(F.collect_set(F.when(F.col("l_orderkey") % 3 == 0, F.col("l_partkey").cast("string"))), "|").alias("ids"), F.array_join(F.collect_set("p_name"), "|").alias("names"))
    return au.resolve(items, part, "item", "ids", "names", "p_partkey", "p_name", homonyms="none")


COOC = """
WITH s AS (SELECT l_orderkey AS d, list_sort(list(DISTINCT p_brand)) AS es FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1),
e AS (SELECT d, len(es) AS m, unnest(es) AS e FROM s), n AS (SELECT e, count(*) AS n FROM e GROUP BY 1 HAVING count(*) >= 10), t AS (SELECT count(*) AS t FROM s),
p AS (SELECT a.e AS source, b.e AS target, count(*) AS co, sum(1 / (a.m - 1)) AS w FROM e a JOIN e b ON a.d = b.d AND a.e < b.e GROUP BY 1, 2 HAVING count(*) >= 3),
k AS (SELECT source, target, co, round(w, 6) AS weight, round(log2((co / t) / ((x.n / t) * (y.n / t))), 3) AS pmi, x.n AS n_source, y.n AS n_target FROM p JOIN n x ON x.e = source JOIN n y ON y.e = target CROSS JOIN t)
"""


@query(COOC + "SELECT * FROM k")
def cooccurrence_pmi(spark: SparkSession, sf: str) -> DataFrame:
    return gr.network(brands(spark, sf), "l_orderkey", "es")


@query("SELECT e AS node, count(*) AS docs, min(y)::INT AS first_year, max(y)::INT AS last_year FROM (SELECT DISTINCT p_brand AS e, o_orderkey, year(o_orderdate) AS y FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey) GROUP BY 1 HAVING count(*) >= 10")
def network_nodes(spark: SparkSession, sf: str) -> DataFrame:
    orders = read(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.year("o_orderdate").alias("y"))
    return gr.network_nodes(brands(spark, sf).join(orders, "l_orderkey"), "l_orderkey", "es", "y")


@query(COOC + "SELECT node, count(*) AS degree, round(sum(co)::DOUBLE, 6) AS strength FROM (SELECT source AS node, co FROM k UNION ALL SELECT target, co FROM k) GROUP BY 1")
def node_strength(spark: SparkSession, sf: str) -> DataFrame:
    return gr.weighted_degree(gr.network(brands(spark, sf), "l_orderkey", "es"), "co").withColumn("strength", F.round(F.col("strength").cast("double"), 6))


@query("""
WITH d AS (SELECT datediff('day', DATE '1970-01-01', ts::DATE)::BIGINT AS time, count(DISTINCT event_id) AS d FROM events GROUP BY 1), s AS (SELECT DISTINCT event_type AS subject FROM events),
r AS (SELECT datediff('day', DATE '1970-01-01', ts::DATE)::BIGINT AS time, event_type AS subject, count(DISTINCT event_id) AS r FROM events GROUP BY 1, 2), c AS (SELECT unnest(range((SELECT min(time) FROM d), (SELECT max(time) FROM d) + 1)) AS time)
SELECT c.time, s.subject, coalesce(r, 0) AS r, coalesce(d, 0) AS d FROM c CROSS JOIN s LEFT JOIN d USING (time) LEFT JOIN r ON r.time = c.time AND r.subject = s.subject""")
def exposure_calendar(spark: SparkSession, sf: str) -> DataFrame:
    e = read(spark, sf, "events").select("event_id", F.datediff(F.to_date("ts"), F.lit("1970-01-01").cast("date")).alias("day"), F.array("event_type").alias("types"))
    return kn.exposure(e, "day", "types", "event_id")


@query()
def burst_intervals(spark: SparkSession, sf: str) -> DataFrame:
    """Rows only: the best path of an automaton is no SQL; tests hold it against worked cases."""
    ship(spark)
    return kn.bursts(exposure_calendar(spark, sf), "time", "r", "d", ["subject"], min_total=30, s=1.2, gamma=0.5)


PANEL = "(SELECT doc_id, CASE WHEN (doc_id * 7 + 3) % 11 < 9 THEN (doc_id * 7 + 3) % 11 % 5 + 1 END AS a, CASE WHEN (doc_id * 5 + 1) % 13 < 11 THEN (doc_id * 5 + 1) % 13 % 5 + 1 END AS b, CASE WHEN doc_id % 4 > 0 THEN doc_id % 9 % 5 + 1 END AS c FROM documents)"


def panel(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("doc_id")
    x, y = (i * 7 + 3) % 11, (i * 5 + 1) % 13
    return read(spark, sf, "documents").select("doc_id", F.when(x < 9, x % 5 + 1).alias("a"), F.when(y < 11, y % 5 + 1).alias("b"), F.when(i % 4 > 0, i % 9 % 5 + 1).alias("c"))


@query(f"""
WITH v AS (SELECT doc_id, list_filter([a, b, c], lambda x: x IS NOT NULL) AS v FROM {PANEL})
SELECT doc_id, CASE WHEN len(v) >= 2 THEN coalesce(list_filter(list_distinct(v), lambda x: 2 * len(list_filter(v, lambda y: y = x)) > len(v))[1]::VARCHAR, '') END AS label,
CASE WHEN len(v) >= 2 THEN list_median(v)::DOUBLE END AS median, len(v) >= 2 AND list_max(v) - list_min(v) >= 2 AS disputed FROM v""")
def consensus_panel(spark: SparkSession, sf: str) -> DataFrame:
    votes = F.array("a", "b", "c")
    s = ag.score_consensus(votes)
    return panel(spark, sf).select("doc_id", ag.label_consensus(F.transform(votes, lambda x: x.cast("string"))).alias("label"), s["median"].alias("median"), s["disputed"].alias("disputed"))


def kappa_sql(weight: str) -> str:
    return f"""(WITH p AS (SELECT a AS x, b AS y, count(*) AS n FROM {PANEL} WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY 1, 2), mx AS (SELECT x, sum(n) AS nx FROM p GROUP BY 1), my AS (SELECT y, sum(n) AS ny FROM p GROUP BY 1)
SELECT (SELECT sum(n) FROM p)::BIGINT AS n, round(1 - (SELECT sum({weight} * n) FROM p) * (SELECT sum(n) FROM p) / (SELECT sum({weight} * nx * ny) FROM mx CROSS JOIN my), 6) AS kappa)"""


@query(f"SELECT 'plain' AS kind, * FROM {kappa_sql('(CASE WHEN x = y THEN 0 ELSE 1 END)')} UNION ALL SELECT 'squared', * FROM {kappa_sql('power((x - y) / 4.0, 2)')}")
def rater_kappa(spark: SparkSession, sf: str) -> DataFrame:
    p = panel(spark, sf)
    plain, squared = ag.cohen_kappa(p, "a", "b"), ag.cohen_kappa(p, "a", "b", scale=(1, 5))
    return plain.withColumn("kind", F.lit("plain")).unionAll(squared.withColumn("kind", F.lit("squared"))).select("kind", "n", F.round("kappa", 6).alias("kappa"))


def alpha_sql(metric: str) -> str:
    delta = {"nominal": "CASE WHEN c = d THEN 0 ELSE 1 END", "interval": "(c - d) * (c - d)", "ordinal": "CASE WHEN c = d THEN 0 ELSE power(greatest(uc, ud) - CASE WHEN uc < ud THEN uc - nc ELSE ud - nd END - (nc + nd) / 2, 2) END"}[metric]
    return f"""SELECT '{metric}' AS metric, max(n)::BIGINT AS n, round(1 - (max(n) - 1) * sum(coalesce(o, 0) * ({delta})) / sum(nc * nd * ({delta})), 6) AS alpha FROM g"""


@query(f"""
WITH r AS (SELECT doc_id AS u, unnest([a, b, c]) AS v FROM {PANEL}), k AS (SELECT u, v, count(*) AS k FROM r WHERE v IS NOT NULL GROUP BY 1, 2), m AS (SELECT *, sum(k) OVER (PARTITION BY u) AS m FROM k),
l AS (SELECT * FROM m WHERE m > 1), o AS (SELECT x.v AS c, y.v AS d, sum(CASE WHEN x.v = y.v THEN x.k * (x.k - 1) ELSE x.k * y.k END / (x.m - 1)) AS o FROM l x JOIN l y USING (u) GROUP BY 1, 2),
v AS (SELECT v, sum(k) AS n FROM l GROUP BY 1), w AS (SELECT v, n, sum(n) OVER (ORDER BY v) AS u, sum(n) OVER () AS t FROM v),
g AS (SELECT x.v AS c, x.n AS nc, x.u AS uc, y.v AS d, y.n AS nd, y.u AS ud, x.t AS n, o FROM w x CROSS JOIN w y LEFT JOIN o ON o.c = x.v AND o.d = y.v)
{alpha_sql("nominal")} UNION ALL {alpha_sql("ordinal")} UNION ALL {alpha_sql("interval")}""")
def rater_alpha(spark: SparkSession, sf: str) -> DataFrame:
    rows = ag.long_form(panel(spark, sf), "doc_id", ["a", "b", "c"])
    out = [ag.krippendorff(rows, "doc_id", "rating", m).select(F.lit(m).alias("metric"), F.col("n").cast("long").alias("n"), F.round("alpha", 6).alias("alpha")) for m in ("nominal", "ordinal", "interval")]
    return out[0].unionAll(out[1]).unionAll(out[2])


CELLS = " ".join(f"count(*) FILTER (f = '{x}') AS \"n_{x}\", round(count(*) FILTER (f = '{x}') / count(*), 6) AS \"share_{x}\", round(count(*) FILTER (f = '{x}') / nullif(count(*) FILTER (f <> ''), 0), 6) AS \"share_{x}_of_scored\"," for x in ("A", "N", "R"))


@query(f"""
WITH l AS (SELECT p_brand, year(l_shipdate) AS y, CASE WHEN l_linenumber % 5 = 0 THEN NULL WHEN l_linenumber % 7 = 0 THEN '' ELSE l_returnflag END AS f, l_quantity FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT p_brand, y, count(*) AS n, count(*) FILTER (f <> '') AS n_scored, count(*) FILTER (f IS NULL) AS n_insufficient, count(*) FILTER (f = '') AS n_no_consensus, {CELLS} median(l_quantity) AS median_score FROM l GROUP BY 1, 2""")
def consensus_cells(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("l_linenumber")
    flag = F.when(n % 5 == 0, F.lit(None).cast("string")).when(n % 7 == 0, "").otherwise(F.col("l_returnflag"))
    rows = read(spark, sf, "lineitem").join(read(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).select("p_brand", F.year("l_shipdate").alias("y"), flag.alias("f"), "l_quantity")
    return ag.summarize_cells(rows, ["p_brand", "y"], "f", ["A", "N", "R"], score="l_quantity")


YEARLY = "y AS (SELECT n_name, year(o_orderdate)::BIGINT AS y, count(*) AS w, count(*) FILTER (o_orderstatus = 'F') / count(*) AS v FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)"


def yearly(spark: SparkSession, sf: str) -> DataFrame:
    o = read(spark, sf, "orders").join(read(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(read(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return o.groupBy("n_name", F.year("o_orderdate").cast("long").alias("y")).agg(F.count("*").alias("w"), (F.count_if(F.col("o_orderstatus") == "F") / F.count("*")).alias("v"))


@query(f"WITH {YEARLY} SELECT n_name, round((sum(w) * sum(w * y * v) - sum(w * y) * sum(w * v)) / (sum(w) * sum(w * y * y) - sum(w * y) * sum(w * y)), 8) AS slope FROM y GROUP BY 1")
def trend_slopes(spark: SparkSession, sf: str) -> DataFrame:
    return st.wls_slope(yearly(spark, sf), "y", "v", "w", ["n_name"]).withColumn("slope", F.round("slope", 8))


@query(f"""
WITH {YEARLY}, s AS (SELECT n_name, y, avg(v) OVER (PARTITION BY n_name ORDER BY y ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS m FROM y)
SELECT n_name, y AS peak_y, round(m, 6) AS peak_value FROM (SELECT *, row_number() OVER (PARTITION BY n_name ORDER BY m DESC, y) AS r FROM s) WHERE r = 1""")
def trend_peaks(spark: SparkSession, sf: str) -> DataFrame:
    return st.peaks(yearly(spark, sf), "y", "v", ["n_name"]).withColumn("peak_value", F.round("peak_value", 6))


@query(f"""
WITH {YEARLY}, s AS (SELECT a.n_name, sum(sign(b.v - a.v))::BIGINT AS s FROM y a JOIN y b ON a.n_name = b.n_name AND a.y < b.y GROUP BY 1),
t AS (SELECT n_name, sum(t * (t - 1) * (2 * t + 5)) AS t FROM (SELECT n_name, v, count(*) AS t FROM y GROUP BY 1, 2) GROUP BY 1), n AS (SELECT n_name, count(*) AS n FROM y GROUP BY 1),
z AS (SELECT n_name, n, s, (n * (n - 1) * (2 * n + 5) - t) / 18 AS variance FROM n JOIN s USING (n_name) JOIN t USING (n_name))
SELECT n_name, n, s, round(variance, 6) AS variance, round(CASE WHEN n >= 4 AND variance > 0 THEN (CASE WHEN s > 0 THEN s - 1 WHEN s < 0 THEN s + 1 ELSE 0 END) / sqrt(variance) END, 6) AS z FROM z""")
def trend_tests(spark: SparkSession, sf: str) -> DataFrame:
    return st.mann_kendall(yearly(spark, sf), "y", "v", ["n_name"]).select("n_name", "n", "s", F.round("variance", 6).alias("variance"), F.round("z", 6).alias("z"))


@query("""
WITH p AS (SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderkey % 10 < 9 THEN (o_orderkey * 37 % 1000) / 1000 END AS p FROM orders), k AS (SELECT * FROM p WHERE p IS NOT NULL),
r AS (SELECT *, p * count(*) OVER (PARTITION BY o_orderpriority) / count(*) OVER (PARTITION BY o_orderpriority ORDER BY p RANGE UNBOUNDED PRECEDING) AS raw FROM k),
q AS (SELECT o_orderkey, least(1.0, min(raw) OVER (PARTITION BY o_orderpriority ORDER BY p DESC RANGE UNBOUNDED PRECEDING)) AS q FROM r)
SELECT p.o_orderkey, round(q, 8) AS q FROM p LEFT JOIN q USING (o_orderkey)""")
def adjusted_p(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    o = read(spark, sf, "orders").select("o_orderkey", "o_orderpriority", F.when(k % 10 < 9, k * 37 % 1000 / 1000).alias("p"))
    return st.benjamini_hochberg(o, "p", ["o_orderpriority"]).select("o_orderkey", F.round("q", 8).alias("q"))


@query("""
WITH l AS (SELECT year(l_shipdate) AS y, l_linestatus AS s, (l_returnflag = 'A')::INT::DOUBLE AS v FROM lineitem), w AS (SELECT s, count(*) / (SELECT count(*) FROM l) AS w FROM l GROUP BY 1), c AS (SELECT y, s, avg(v) AS m FROM l GROUP BY 1, 2)
SELECT y, round(CASE WHEN sum(w) >= 1 - 1e-9 THEN sum(w * m) END, 6) AS standardized, round(sum(w), 6) AS coverage FROM c JOIN w USING (s) GROUP BY 1""")
def standardized_share(spark: SparkSession, sf: str) -> DataFrame:
    rows = read(spark, sf, "lineitem").select(F.year("l_shipdate").alias("y"), F.col("l_linestatus").alias("s"), (F.col("l_returnflag") == "A").cast("double").alias("v"))
    return st.standardized(rows, "y", "s", "v").select("y", F.round("standardized", 6).alias("standardized"), F.round("coverage", 6).alias("coverage"))


@query()
def bootstrap_intervals(spark: SparkSession, sf: str) -> DataFrame:
    """Rows only: random resampling."""
    ship(spark)
    return st.bootstrap_mean(read(spark, sf, "orders"), "o_totalprice", "o_orderkey", ["o_orderpriority"], cluster="o_custkey")


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_name END AS c_name, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal, c_mktsegment
FROM customer WHERE NOT (c_custkey % 7 = 0) AND NOT (c_custkey % 11 = 0)""")
def public_projection(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    c = read(spark, sf, "customer").withColumn("public", F.when(k % 11 == 0, F.lit(None).cast("boolean")).otherwise(k % 7 != 0)).withColumn("content", k % 3 != 0).withColumn("private", F.when(k % 5 == 0, F.array(F.lit("c_name"))))
    out = pv.public_projection(c, public="public", withheld=pv.restricted(F.col("private"), F.col("content"), ["c_acctbal"]), dropped=["public", "content", "private", "c_nationkey"], control=["c_custkey"])
    return out


OLD = "old AS (SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN c_name || '  old' ELSE ' ' || c_name || ' ' END AS c_name, c_mktsegment AS segment, c_acctbal * 2 AS score FROM customer WHERE c_custkey % 10 < 8), new AS (SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_custkey % 10 > 0)"


def old_new(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    c, k = read(spark, sf, "customer"), F.col("c_custkey")
    old = c.where(k % 10 < 8).select("c_custkey", F.when(k % 4 == 0, F.concat("c_name", F.lit("  old"))).otherwise(F.concat(F.lit(" "), "c_name", F.lit(" "))).alias("c_name"), F.col("c_mktsegment").alias("segment"), (F.col("c_acctbal") * 2).alias("score"))
    return old, c.where(k % 10 > 0).select("c_custkey", "c_name", "c_nationkey")


@query(f"""WITH {OLD} SELECT n.c_custkey, n.c_name, n.c_nationkey, segment, score FROM new n LEFT JOIN old o USING (c_custkey) UNION ALL SELECT c_custkey, c_name, NULL, segment, score FROM old WHERE c_custkey NOT IN (SELECT c_custkey FROM new)""")
def merge_upsert(spark: SparkSession, sf: str) -> DataFrame:
    old, new = old_new(spark, sf)
    return mg.merge(new, old, "c_custkey", keep_missing=True)


@query(f"WITH {OLD} SELECT c_custkey, 'c_name' AS source FROM new n JOIN old o USING (c_custkey) WHERE trim(n.c_name) <> trim(regexp_replace(o.c_name, '\\s+', ' ', 'g'))")
def changed_sources(spark: SparkSession, sf: str) -> DataFrame:
    old, new = old_new(spark, sf)
    return mg.changed_sources(new, old, "c_custkey", ["c_name"])


@query(f"""WITH {OLD} SELECT n.c_custkey, n.c_name, c_nationkey, segment, CASE WHEN trim(n.c_name) <> trim(regexp_replace(o.c_name, '\\s+', ' ', 'g')) THEN NULL ELSE score END AS score FROM new n LEFT JOIN old o USING (c_custkey)""")
def lineage_invalidation(spark: SparkSession, sf: str) -> DataFrame:
    old, new = old_new(spark, sf)
    stale = mg.stale_cells(mg.changed_sources(new, old, "c_custkey", ["c_name"]), {"c_name": ["score"]}, "c_custkey")
    return mg.invalidate(mg.merge(new, old, "c_custkey"), stale, "c_custkey", ["score"])


@query("WITH a AS (SELECT c_custkey, c_name, c_acctbal FROM customer), b AS (SELECT c_custkey, CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_name END AS c_name, CASE WHEN c_custkey % 9 = 0 THEN 0 ELSE c_acctbal END AS c_acctbal FROM customer) SELECT count(*) FILTER (a.c_name IS DISTINCT FROM b.c_name OR a.c_acctbal IS DISTINCT FROM b.c_acctbal) AS rows, count(*) FILTER (a.c_name IS DISTINCT FROM b.c_name) AS c_name, count(*) FILTER (a.c_acctbal IS DISTINCT FROM b.c_acctbal) AS c_acctbal FROM a JOIN b USING (c_custkey)")
def changed_rows(spark: SparkSession, sf: str) -> DataFrame:
    c, k = read(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal"), F.col("c_custkey")
    after = c.select("c_custkey", F.when(k % 6 == 0, F.lit(None).cast("string")).otherwise(F.col("c_name")).alias("c_name"), F.when(k % 9 == 0, 0.0).otherwise(F.col("c_acctbal")).alias("c_acctbal"))
    return mg.changed_rows(c, after, "c_custkey", ["c_name", "c_acctbal"])


DATE_TEXT = "(SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN strftime(o_orderdate, '%Y') WHEN 1 THEN strftime(o_orderdate, '%Y-%m') WHEN 2 THEN strftime(o_orderdate, '%Y-%m') || '/' || strftime(o_orderdate, '%Y') WHEN 3 THEN strftime(o_orderdate, '%Y') || '-02-30' WHEN 4 THEN ' ' WHEN 5 THEN 'c. ' || strftime(o_orderdate, '%Y') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS d FROM orders)"


@query(f"""
SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN 'year' WHEN 1 THEN 'month' WHEN 2 THEN 'range' WHEN 3 THEN 'other' WHEN 4 THEN '' WHEN 5 THEN 'other' ELSE 'day' END AS precision,
CASE WHEN o_orderkey % 7 IN (0, 1, 2, 6) THEN d[1:4]::INT END AS year, CASE WHEN o_orderkey % 7 IN (0, 1, 6) THEN d[1:4]::INT END AS point_year FROM {DATE_TEXT}""")
def partial_dates(spark: SparkSession, sf: str) -> DataFrame:
    k, f = F.col("o_orderkey") % 7, lambda p: F.date_format("o_orderdate", p)
    d = F.when(k == 0, f("yyyy")).when(k == 1, f("yyyy-MM")).when(k == 2, F.concat_ws("/", f("yyyy-MM"), f("yyyy"))).when(k == 3, F.concat(f("yyyy"), F.lit("-02-30"))).when(k == 4, " ").when(k == 5, F.concat(F.lit("c. "), f("yyyy"))).otherwise(f("yyyy-MM-dd"))
    o = read(spark, sf, "orders").select("o_orderkey", d.alias("d"))
    p = dt.parse_partial(F.col("d"))
    return o.select("o_orderkey", p["precision"].alias("precision"), p["year"].alias("year"), dt.point_year(F.col("d")).alias("point_year"))


@query("SELECT event_id, (event_id % 3) * 86400 + (event_id % 24) * 3600 + (event_id % 60) * 60 + event_id % 50 AS seconds FROM events")
def durations(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("event_id")
    s = F.concat(F.lit("P"), k % 3, F.lit("DT"), k % 24, F.lit("H"), k % 60, F.lit("M"), k % 50, F.lit("S"))
    return read(spark, sf, "events").select("event_id", dt.duration_seconds(s).alias("seconds"))


@query("SELECT event_id, CASE WHEN event_id % 120 <= 90 AND event_id % 4 > 0 THEN (event_id % 120)::DOUBLE END AS lat, CASE WHEN event_id % 120 <= 90 AND event_id % 4 > 0 THEN -(event_id % 180)::DOUBLE END AS lng FROM events")
def coordinate_pairs(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("event_id")
    c = dt.coordinates(F.when(k % 4 > 0, F.concat(k % 120, F.lit(", "), -(k % 180))).otherwise(F.lit("1, 2, 3")))
    return read(spark, sf, "events").select("event_id", c["lat"].alias("lat"), F.when(c["lng"] == 0, F.lit(-0.0)).otherwise(c["lng"]).alias("lng")).withColumn("lng", F.col("lng") + 0.0)


@query("""
WITH n AS (SELECT o_orderkey, date_diff('day', DATE '0622-07-19', o_orderdate::DATE) AS n FROM orders), y AS (SELECT *, (30 * n + 10646) // 10631 AS y FROM n),
i AS (SELECT *, n - (354 * (y - 1) + (3 + 11 * y) // 30) AS i FROM y),
m AS (SELECT *, list_filter(range(1, 13), lambda m: (59 * (m - 1) + 1) // 2 <= i) AS ms FROM i)
SELECT o_orderkey, y::INT AS y, len(ms)::INT AS m, (i - (59 * (len(ms) - 1) + 1) // 2 + 1)::INT AS d FROM m""")
def hijri_days(spark: SparkSession, sf: str) -> DataFrame:
    """The arithmetic civil calendar."""
    return read(spark, sf, "orders").select("o_orderkey", dt.tabular_hijri(F.to_date("o_orderdate")).alias("h")).select("o_orderkey", F.col("h.hijri_year").alias("y"), F.col("h.hijri_month").alias("m"), F.col("h.hijri_day").alias("d"))


@query()
def hijri_table_days(spark: SparkSession, sf: str) -> DataFrame:
    """Rows only: an as-of join with the Umm al-Qura months of the Java runtime; tests hold it against the runtime's own conversion."""
    days = read(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return dt.to_hijri(days, dt.umm_al_qura(spark))


@query("SELECT k, in_customer, in_supplier FROM (SELECT c_nationkey AS k, true AS in_customer FROM customer GROUP BY 1) FULL JOIN (SELECT s_nationkey AS k, true AS in_supplier FROM supplier GROUP BY 1) USING (k)")
def key_sets(spark: SparkSession, sf: str) -> DataFrame:
    c = read(spark, sf, "customer").select(F.col("c_nationkey").alias("k")).distinct().withColumn("in_customer", F.lit(True))
    s = read(spark, sf, "supplier").select(F.col("s_nationkey").alias("k")).distinct().withColumn("in_supplier", F.lit(True))
    return c.join(s, "k", "full")
