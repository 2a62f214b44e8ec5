"""Operators against worked cases."""

import json
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.operators import agreement as ag
from textmill.operators import authority as au
from textmill.operators import contracts as ct
from textmill.operators import coverage as cv
from textmill.operators import graphs as gr
from textmill.operators import keyness as kn
from textmill.operators import merging as mg
from textmill.operators import privacy as pv
from textmill.operators import sampling as sm
from textmill.operators import similarity as si
from textmill.operators import stats as st
from textmill.operators import topics as tp


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*(cols or df.columns)).collect())


def test_cooccurrence(spark):
    df = spark.createDataFrame([(1, list("abcde")), (2, list("ab")), (3, ["a"]), (4, None)], "d int, es array<string>")
    p = {(r.source, r.target): (r.co, r.weight) for r in gr.pair_counts(df, "d", "es").collect()}
    assert p["a", "b"] == (2, 1.25) and p["c", "d"] == (1, 0.25) and len(p) == 10
    assert dict(rows(gr.node_counts(df, "d", "es")))["a"] == 3
    df = spark.createDataFrame([(i, ["a", "b"]) for i in range(2)] + [(i, ["c"]) for i in (2, 3)] + [(i, []) for i in range(4, 8)], "d int, es array<string>")
    assert rows(gr.network(df, "d", "es", min_node=1, min_edge=1), "co", "weight", "pmi") == [(2, 2.0, 1.0)]


def test_components_follow_edges_alone(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7)]
    got = dict(rows(gr.components(spark.createDataFrame(edges, "a int, b int").repartition(3))))
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in (100, 101, 102)} == {100}
    halves = gr.component_halves(gr.components(spark.createDataFrame(edges, "a int, b int")))
    assert halves.groupBy("component").agg(F.count_distinct("half").alias("n")).where("n > 1").count() == 0


def test_bursts():
    r, d = np.array([2, 2, 2, 2, 40, 45, 2, 2, 2, 2.0]), np.full(10, 100.0)
    ((a, b, w),) = kn.viterbi_bursts(r, d)
    assert (a, b) == (4, 5) and w > 0
    assert kn.viterbi_bursts(np.full(10, 5.0), d) == [] and kn.viterbi_bursts(r[:1], d[:1]) == [] and kn.viterbi_bursts(np.zeros(10), d) == []


def test_keyness_gates(spark):
    data = [("B", "rare", 12, 1, 1), ("B", "frequent", 200, 50, 3), ("B", "filler", 5000, 90, 5), ("T", "frequent", 50, 20, 2), ("T", "filler", 5000, 90, 5)]
    df = spark.createDataFrame(data, "slice string, token string, a long, docs long, outlets long")
    assert {(r.slice, r.token) for r in kn.keyness(df).collect()} == {("B", "frequent"), ("T", "filler")}
    assert ("B", "rare") in {(r.slice, r.token) for r in kn.keyness(df, min_docs=1, min_outlets=0).collect()}


def test_alpha_and_kappa(spark):
    units = [[1, 1, 1], [2, 2, 3, 2], [3, 3, 3, 3], [3, 3, 3, 3], [2, 2, 2, 2], [1, 2, 3, 4], [4, 4, 4, 4], [1, 1, 2, 1], [2, 2, 2, 2], [5, 5, 5], [1, 1], [3]]
    df = spark.createDataFrame([(i, v) for i, u in enumerate(units) for v in u], "u int, v int")
    for metric, alpha in (("nominal", 0.743), ("ordinal", 0.815), ("interval", 0.849)):
        assert ag.krippendorff(df, "u", "v", metric).first().alpha == pytest.approx(alpha, abs=6e-4)
    k = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (2, 2)], "a int, b int")
    assert ag.cohen_kappa(k, "a", "b").first().kappa == pytest.approx(0.5)
    assert ag.cohen_kappa(spark.createDataFrame([(1, 1)], "a int, b int"), "a", "b").first().kappa is None


def test_consensus(spark):
    votes = [["P"], [], ["P", "N"], ["Ne", "Ne", "P"], [None, None]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(votes)], "i int, v array<string>")
    assert rows(df.select("i", ag.label_consensus(F.col("v")).alias("c"))) == [(0, None), (1, None), (2, ""), (3, "Ne"), (4, None)]
    df = spark.createDataFrame([(0, [1, None, None]), (1, [2, 4, 3]), (2, [None])], "i int, v array<int>")
    s = ag.score_consensus(F.col("v"))
    assert rows(df.select("i", s["median"].alias("m"), s["disputed"].alias("d"))) == [(0, None, False), (1, 3.0, True), (2, None, False)]


def test_summarize_cells(spark):
    df = spark.createDataFrame([("t", "Positif"), ("t", "Négatif"), ("t", None), ("t", None)], "t string, c string")
    r = ag.summarize_cells(df, ["t"], "c", ["Positif"]).first()
    assert (r.n, r.n_scored, r.share_Positif, r.share_Positif_of_scored) == (4, 2, 0.25, 0.5)


def test_authority(spark):
    items = spark.createDataFrame([(1, "11", "Moussa Traoré"), (2, None, "Ramadan"), (3, None, "Moussa Traoré"), (4, "99", "Ramadan")], "item int, ids string, names string")
    index = spark.createDataFrame([("10", "Moussa Traoré"), ("11", "Moussa Traoré"), ("12", "Ramadan")], "id string, title string")
    assert rows(au.resolve(items, index, "item", "ids", "names", "id", "title"), "item", "id") == [(1, "11"), (2, "12"), (3, "10"), (3, "11")]
    assert rows(au.resolve(items, index, "item", "ids", "names", "id", "title", homonyms="none"), "item", "id") == [(1, "11"), (2, "12")]
    mentions = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a")], "item int, id string")
    facts = spark.createDataFrame([(1, "1999", "2001", ["Togo", ""]), (2, None, None, ["Bénin"])], "item int, low string, high string, countries array<string>")
    stats = au.frequencies(mentions, facts)
    assert rows(stats) == [("a", 2, "1999", "2001", "Bénin|Togo")]
    assert rows(au.attach(spark.createDataFrame([("a",), ("b",)], "id string"), stats, "id"))[1] == ("b", 0, "", "", "")


def test_merge_and_invalidate(spark):
    old = spark.createDataFrame([("1", "a", 1.0), ("2", "b  c", 2.0), ("9", "z", 9.0)], "id string, t string, s double")
    new = spark.createDataFrame([("1", "A"), ("2", "b c"), ("3", "n")], "id string, t string")
    assert rows(mg.merge(new, old, "id")) == [("1", "A", 1.0), ("2", "b c", 2.0), ("3", "n", None)]
    kept = mg.merge(new, old, "id", keep_missing=True, public="p")
    assert [r.p for r in kept.where("id = '9'").collect()] == [False]
    changes = mg.changed_sources(new, old, "id", ["t"])
    assert rows(changes) == [("1", "t")]
    stale = mg.stale_cells(changes, {"t": ["s"]}, "id")
    assert rows(mg.invalidate(mg.merge(new, old, "id"), stale, "id", ["s"]), "id", "s") == [("1", None), ("2", 2.0), ("3", None)]
    with pytest.raises(ct.ContractError):
        mg.check_shrink(5, 0, 100)
    flags = spark.createDataFrame([("1", True), ("2", None)], "id string, p boolean")
    assert mg.visibility_changed(flags, flags, "id", ["p"]).first().changed is False
    assert mg.visibility_changed(flags, flags.where("id = '1'"), "id", ["p"]).first().changed is True
    with pytest.raises(ct.ContractError):
        mg.add_columns(new, old.select("id", "s"), "id")


def test_masking(spark):
    df = spark.createDataFrame([(1, True, ["author"], "A", "text", [1.0]), (2, None, None, "B", "t", [2.0])], "id int, pub boolean, private array<string>, author string, ocr string, e array<double>")
    out = pv.public_projection(df, public="pub", withheld=pv.restricted(F.col("private"), F.lit(False), ["ocr"], {"author": ["e"]}, reviewed=["e"]), dropped=["private"], control=["id"])
    assert rows(out.select("id", "author", "ocr", "e")) == [(1, "", "", [1.0])]
    n = spark.createDataFrame([("1", [("2", 0.9), ("3", 0.8)]), ("2", [("3", 0.5)])], "id string, n array<struct<id:string,score:double>>")
    got = pv.strip_neighbours(n, "id", "n", spark.createDataFrame([("1",), ("2",)], "id string")).orderBy("id").collect()
    assert [x.id for x in got[0].n] == ["2"] and got[1].n is None


def test_contracts(spark):
    df = spark.createDataFrame([("1",), ("1",), (None,), (" ",)], "id string")
    v = ct.key_violations(df, "id").first()
    assert (v.n, v.nulls, v.blanks, v.duplicates) == (4, 1, 1, 1)
    with pytest.raises(ct.ContractError):
        ct.require_keys(df, "id")
    d = spark.createDataFrame([(3.0,), (None,), (float("nan"),)], "x double")
    schema = T.StructType([T.StructField("x", T.LongType())])
    assert sorted((r.x is None, r.x) for r in ct.conform(d, schema).collect() if r.x is not None) == [(False, 3)]
    with pytest.raises(Exception, match="whole number"):
        ct.conform(spark.createDataFrame([(3.5,)], "x double"), schema).collect()
    assert ct.column_order(["a", "n", "b"], ["b", "a"]) == ["b", "a", "n"]


def test_coverage(spark):
    df = spark.createDataFrame([("B", "x", 1999), ("B", "x", 2000), ("T", "y", 1999)], "c string, o string, y int")
    assert rows(cv.stable(df, ["c", "o"], "y", 1999, 2000)) == [("B", "x", 2, 1, 2)]
    a = spark.createDataFrame([(None, True), (False, True), (True, None), (True, True), (True, False)], "i boolean, t boolean")
    assert [r.a for r in a.select(cv.access(F.col("i"), F.col("t")).alias("a")).collect()] == ["unknown", "restricted_item", "unknown", "public_text", "restricted_text"]
    with pytest.raises(Exception, match="no such key"):
        cv.cohort(df, spark.createDataFrame([("Z",)], "c string"), "c").collect()


def test_neighbours(spark):
    df = spark.createDataFrame([("1", [1.0, 0.0]), ("2", [0.6, 0.8]), ("4", [0.0, 1.0]), ("5", None), ("6", [0.0, 0.0])], "id string, e array<double>")
    got = si.top_neighbours(df, "id", "e", k=2, block=2)
    assert [(r.other, round(r.score, 4)) for r in got.where("id = '1'").orderBy("rank").collect()] == [("2", 0.6), ("4", 0.0)]
    assert got.count() == 6
    rng = np.random.default_rng(0)
    m = rng.standard_normal((60, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "id int, e array<double>")
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -9)
    got = {(r.id, r["rank"]): r.other for r in si.top_neighbours(df, "id", "e", k=5, block=16).collect()}
    assert all(got[i, r + 1] == j for i in range(60) for r, j in enumerate(np.argsort(-s[i])[:5]))


def test_neighbours_tie_by_rounded_scores(spark, tmp_path):
    """Cosines that differ in the seventh decimal alone tie, go to the smaller key, and make the queries' rows those of their SQL."""
    import duckdb

    from textmill.plans import vectors

    rng = np.random.default_rng(5)
    base = rng.standard_normal((6, 8))
    m = [b + (60 - i) * 2e-9 * rng.standard_normal(8) for i in range(12) for b in base] + list(rng.standard_normal((40, 8)))
    df = spark.createDataFrame([(i, v.tolist(), i % 3) for i, v in enumerate(m)], "vec_id long, embedding array<double>, label int")
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    exact = [(r.id, r.other) for r in si.top_neighbours(df, "vec_id", "embedding", block=16).collect()]
    tied = [(r.id, r.other) for r in si.top_neighbours(df, "vec_id", "embedding", block=16, digits=6).collect()]
    assert len(exact) == len(tied) == 1120 and set(exact) != set(tied)
    duck = duckdb.connect()
    duck.execute(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    for name in ("knn_topk", "pair_evaluation", "published_neighbours", "theta_pairs", "threshold_curve"):
        sql = duck.sql(vectors.ORACLE_SQL[name])
        got = vectors.QUERIES[name](spark, str(tmp_path)).select(*sql.columns).collect()
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, sql.fetchall())), name
    # halves go away from 0, as in SQL
    half = spark.createDataFrame([(0, [1.0, 0.0, 0.0, 0.0]), (1, [1.0] * 4), (2, [-1.0] * 4)], "i int, v array<double>")
    assert {(r.id, r.other): r.score for r in si.top_neighbours(half, "i", "v", digits=0).where("id = 0").collect()} == {(0, 1): 1.0, (0, 2): -1.0}


def same_as_sql(spark, folder, name, table):
    """Whether a query over a table of (vec_id, embedding, label) gives the rows of its SQL."""
    import duckdb

    from textmill.plans import vectors

    spark.createDataFrame(table, "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/embeddings.parquet")
    duck = duckdb.connect()
    duck.execute(f"create view embeddings as select * from '{folder}/embeddings.parquet/*.parquet'")
    sql = duck.sql(vectors.ORACLE_SQL[name])
    got = vectors.QUERIES[name](spark, str(folder)).select(*sql.columns).collect()
    want = sql.fetchall()
    return len(want) > 0 and sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def vectors_of(n):
    return [(i, v.tolist(), i % 3) for i, v in enumerate(np.random.default_rng(1).standard_normal((n, 16)))]


def test_published_neighbours_keep_every_row(spark, tmp_path):
    """A row without any other has no neighbour, a row without a key meets none: both stay."""
    assert same_as_sql(spark, tmp_path / "one", "published_neighbours", vectors_of(1))
    assert same_as_sql(spark, tmp_path / "key", "published_neighbours", [(None if i == 5 else i, v, label) for i, v, label in vectors_of(30)])


def test_pair_evaluation_counts_pairs_without_a_label(spark, tmp_path):
    """Such a pair is no hit and no miss, but one of the pairs found."""
    assert same_as_sql(spark, tmp_path, "pair_evaluation", [(i, v, None if i % 7 == 0 else label) for i, v, label in vectors_of(60)])


def test_theta_pairs_of_vectors_without_a_direction(spark, tmp_path):
    """A zero, NaN or infinite vector has NaN with all others, which SQL ranks first."""
    odd = {3: [0.0] * 16, 11: [float("nan")] * 16, 40: [float("inf")] + [0.0] * 15}
    table = [(i, odd.get(i, v), label) for i, v, label in vectors_of(60)]
    assert same_as_sql(spark, tmp_path, "theta_pairs", table)
    df = spark.createDataFrame(table, "id int, v array<float>, label int")
    assert si.top_neighbours(df, "id", "v", k=3).where("isnan(score) or id = 3").count() == 0
    with pytest.raises(ValueError, match="no threshold"):
        si.top_neighbours(df, "id", "v", threshold=0.5, unscored=True)


def test_threshold_curve_counts_rows_without_a_vector(spark, tmp_path):
    """A row without a vector is no one's near neighbour, but its pairs rank last and count as pairs."""
    assert same_as_sql(spark, tmp_path / "two", "threshold_curve", [(i, None if i in (3, 40) else v, label) for i, v, label in vectors_of(60)])
    # few enough rows for all kinds to meet
    few = [(i, {1: None, 4: [0.0] * 16, 5: None}.get(i, v), label) for i, v, label in vectors_of(8)]
    assert same_as_sql(spark, tmp_path / "few", "threshold_curve", few)
    assert same_as_sql(spark, tmp_path / "rows", "knn_topk", few)


def test_thresholds(spark):
    p = spark.createDataFrame(list(zip([0.99, 0.98, 0.96, 0.92, 0.91, 0.85], [True, True, False, True, False, False], strict=True)), "s double, l boolean")
    c = si.threshold_curve(p, "s", "l", [0.85, 0.9, 0.92, 0.95, 0.97])
    assert tuple(si.choose_thresholds(c, target_recall=1.0, target_precision=1.0, min_selected=1).first()) == (0.92, 0.97)
    judged = spark.createDataFrame([(1, 2, True), (3, 2, True), (4, 5, False)], "a int, b int, label boolean")
    r = si.evaluate(spark.createDataFrame([(2, 1), (4, 5)], "a int, b int"), judged).first()
    assert (r.tp, r.fp, r.fn, r.tn, r.precision, r.recall) == (1, 1, 1, 0, 0.5, 0.5)


def test_pooling(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 3), (1, [0.0, 1.0], 1), (2, None, 1), (2, [1.0, 1.0], 1)], "k int, v array<double>, w int")
    assert rows(si.pool_vectors(df, "k", "v", "w")) == [(1, [0.75, 0.25]), (2, None)]


def test_statistics(spark):
    df = spark.createDataFrame([(i, p) for i, p in enumerate([0.01, 0.04, 0.03, None, float("nan")])], "i int, p double")
    q = {r.i: r.q for r in st.benjamini_hochberg(df, "p").collect()}
    assert q[0] == pytest.approx(0.03) and q[1] == q[2] == pytest.approx(0.04) and q[3] is None and q[4] is None
    t = spark.createDataFrame([(i, float(i), 1.0) for i in range(6)], "t int, v double, w double")
    r = st.mann_kendall(t, "t", "v").first()
    assert r.s == 15 and r.p < 0.05
    assert st.wls_slope(t, "t", "v", "w").first().slope == pytest.approx(1)
    b = st.bootstrap_mean(spark.createDataFrame([("g", k, k % 3, float(k)) for k in range(20)], "g string, k int, c int, v double"), "v", "k", ["g"], cluster="c").first()
    assert b.status == "insufficient_clusters"
    b = st.bootstrap_mean(spark.createDataFrame([("g", k, float(k)) for k in range(20)], "g string, k int, v double"), "v", "k", ["g"]).first()
    assert b.status == "ok" and b.low < 9.5 < b.high
    s = spark.createDataFrame([(2000, "B", 1.0), (2000, "T", 0.0), (2001, "B", 1.0), (2001, "T", 0.0)], "y int, c string, v double")
    assert rows(st.standardized(s, "y", "c", "v"))[0] == (2000, 0.5, 1.0)


def test_samples_do_not_depend_on_order(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(50)], "id int, s string")
    a, b = (rows(sm.stratified(d, "id", ["s"]), "id", "weight") for d in (df, df.repartition(5).orderBy(F.rand(1))))
    assert a == b and len(a) == 6
    split = sm.hash_split(df, "s", 0.3)
    assert split.groupBy("s").agg(F.count_distinct("held_out").alias("n")).where("n > 1").count() == 0 and split.where("held_out").count() == 25


def test_sources_and_sinks(spark, tmp_path):
    from textmill.sources import catalog, sinks

    path = f"file://{tmp_path}/store"
    df = spark.createDataFrame([("1", [1.0]), ("2", None)], "id string, v array<double>")
    first = sinks.commit({"t": df}, path, "id")
    with pytest.raises(ct.ContractError):
        sinks.commit({"t": df}, path, "id", expected="other")
    second = sinks.commit({"t": df.where("id = '1'")}, path, "id", expected=first)
    c = catalog.Catalog(spark, path).pinned()
    assert c.revision == second and c.tables() == ["t"] and c.read("t", ["id", "none"]).columns == ["id"]
    with pytest.raises(ct.ContractError):
        sinks.commit({"t": df.unionAll(df)}, path, "id")
    m = f"file://{tmp_path}/mirror"
    sinks.write_mirror(df, m, repository="r", revision=second, fmt="csv")
    assert catalog.read_mirror(spark, m, repository="r").count() == 2
    with pytest.raises(ct.ContractError):
        catalog.read_mirror(spark, m, repository="x")
    out = sinks.write_reports({"a": df}, {"x": float("nan")}, f"file://{tmp_path}/rep", repository="r", revision="1")
    assert out["outputs"] and json.loads((tmp_path / "rep/summary.json").read_text()) == {"x": None}
    (tmp_path / "ids.txt").write_text("1 # one\n\n# none\n2\n")
    assert catalog.read_ids(spark, f"file://{tmp_path}/ids.txt").count() == 2
    with sinks.write_lock(str(tmp_path / "lock")), pytest.raises(ct.ContractError), sinks.write_lock(str(tmp_path / "lock")):
        pass


def test_streams(spark, tmp_path):
    from textmill.streaming import incremental as inc

    src = str(tmp_path / "in")
    spark.createDataFrame([("a", "x"), ("b", "y"), ("a", "x")], "k string, h string").coalesce(1).write.parquet(src)
    s = spark.readStream.schema("k string, h string").parquet(src)
    q = inc.changed_only(s, "k", "h").writeStream.format("memory").queryName("changed").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    assert rows(spark.table("changed")) == [("a", "x", True), ("b", "y", True)]
    ev = str(tmp_path / "ev")
    spark.sql("select timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,id) as ts, 'e' as kind from range(30)").write.parquet(ev)
    s = spark.readStream.schema("ts timestamp, kind string").parquet(ev)
    q = inc.windowed_exposure(s, "ts", "kind").writeStream.format("memory").queryName("exposed").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("exposed").agg(F.sum("n")).first()[0] == 30


@pytest.mark.parametrize("size", [100, 20_001])
def test_topic_words_keep_their_lift_in_large_vocabularies(spark, size):
    words = [f"w{i}" for i in range(size)]
    matrix = np.full((size, 2), 1e-3)
    matrix[:2] = [[500.0, 1.0], [400.0, 1.0]]
    bag, model = SimpleNamespace(vocabulary=words), SimpleNamespace(topicsMatrix=lambda: SimpleNamespace(toArray=lambda: matrix))
    p = spark.createDataFrame([("w0", 0.5), ("w1", 0.001)], "token string, p double")
    assert tp.topic_words(bag, model, p, top=1)[0] == ["w1"]  # rarer elsewhere, so more relevant


def test_lda_topics_runs_the_whole_vocabulary(spark, monkeypatch):
    from textmill.plans import corpus

    asked = {}

    def fit(df, tokens, k, **settings):
        asked.update(settings, k=k)
        raise InterruptedError

    monkeypatch.setattr(corpus.tp, "fit_lda", fit)
    with pytest.raises(InterruptedError):
        corpus.lda_topics(spark, "/root/testdata/sf0.001")
    assert asked.get("vocab", 100_000) >= 100_000 and asked.get("iterations", 20) >= 20 and asked["k"] == 30


@pytest.mark.parametrize(("n", "block"), [(1, 100), (2, 1), (60, 20), (60, 100)])
def test_neighbours_equal_brute_force(spark, n, block):
    """Strips of any size, text keys, ties of equal vectors, rows without a usable vector, a time window."""
    rng = np.random.default_rng(n)
    v = np.round(rng.normal(size=(n, 4)), 1) + 0.05
    v[n // 2 :] = v[: n - n // 2]  # pairs of equal vectors
    rows = [(f"k{i:03d}", [float(x) for x in v[i]], int(i % 9)) for i in range(n)] + [("nil", None, 1), ("zero", [0.0] * 4, 1)]
    df = spark.createDataFrame(rows, "id string, e array<double>, t int")
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    s = np.clip(unit @ unit.T, -1, 1)
    for gap in (None, 2):
        got = {}
        for r in si.top_neighbours(df, "id", "e", k=3, block=block, time="t", max_gap=gap, threshold=0.0).collect():
            got.setdefault(r.id, []).append((r["rank"], r.other, round(r.score, 9)))
        for i in range(n):
            near = [j for j in range(n) if j != i and s[i, j] >= 0 and (gap is None or abs(i % 9 - j % 9) <= gap)]
            near = sorted(near, key=lambda j: (-round(s[i, j], 9), j))[:3]
            mine = sorted(got.get(f"k{i:03d}", []))
            assert [x[2] for x in mine] == [pytest.approx(s[i, j], abs=1e-8) for j in near]
            assert [x[0] for x in mine] == list(range(1, len(near) + 1))
    assert si.top_neighbours(df.limit(0), "id", "e", block=block).count() == 0


def test_agreement_equals_pairing_all_ratings(spark):
    """The closed forms against sums over all pairs, with large and fractional ratings."""
    rng = np.random.default_rng(3)
    rows = [(u, float(1e6 + x / 2)) for u in range(30) for x in rng.integers(0, 5, rng.integers(1, 5))]
    df = spark.createDataFrame(rows, "u int, v double")
    units = {}
    for u, x in rows:
        units.setdefault(u, []).append(x)
    units = {u: x for u, x in units.items() if len(x) > 1}
    flat = [x for xs in units.values() for x in xs]
    below = {x: sum(y < x for y in flat) + sum(y == x for y in flat) / 2 for x in set(flat)}
    for metric, d in (("nominal", lambda a, b: float(a != b)), ("interval", lambda a, b: (a - b) ** 2), ("ordinal", lambda a, b: (below[a] - below[b]) ** 2)):
        observed = sum(sum(d(a, b) for a in xs for b in xs) / (len(xs) - 1) for xs in units.values())
        expected = sum(d(a, b) for a in flat for b in flat)
        r = ag.krippendorff(df, "u", "v", metric).first()
        assert r.n == len(flat) and r.alpha == pytest.approx(1 - (len(flat) - 1) * observed / expected, rel=1e-6)
    same = spark.createDataFrame([(1, 2.5), (1, 2.5)], "u int, v double")
    assert all(ag.krippendorff(same, "u", "v", m).first().alpha is None for m in ("nominal", "interval", "ordinal"))
    pairs = [(int(a), int(b), "g" if i % 3 else "h") for i, (a, b) in enumerate(rng.integers(1, 6, (60, 2)))]
    for scale, d in ((None, lambda a, b: float(a != b)), ((1, 5), lambda a, b: ((a - b) / 4) ** 2)):
        got = {r.g: r.kappa for r in ag.cohen_kappa(spark.createDataFrame(pairs, "a int, b int, g string"), "a", "b", by=["g"], scale=scale).collect()}
        for g in "gh":
            own = [(a, b) for a, b, k in pairs if k == g]
            o, e = sum(d(a, b) for a, b in own), sum(d(a, b) for a, _ in own for _, b in own) / len(own)
            assert got[g] == pytest.approx(1 - o / e)


def test_components_raise_when_rounds_run_out(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)], "a int, b int")
    with pytest.raises(RuntimeError, match="settled"):
        gr.components(chain, rounds=1)
