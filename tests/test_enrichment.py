"""Computed columns, uploads and the small durable files, by worked cases."""

import datetime
import http.server
import json
import threading
import urllib.parse

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from textmill.functions import dates as dt
from textmill.functions import text as tx
from textmill.functions import values as vs
from textmill.operators import enrichment as en
from textmill.operators import mappers as mp
from textmill.operators import sampling as sm
from textmill.operators import similarity as si
from textmill.operators import topics as tp
from textmill.operators.contracts import ContractError
from textmill.sources import catalog as ca
from textmill.sources import paged, sinks
from textmill.sources import upload as up
from textmill.streaming import incremental as inc


def test_words_of_many_scripts():
    assert tx.cut_words("مُحَمَّدٌ رَسُول", french=False) == ["مُحَمَّدٌ", "رَسُول"]
    assert tx.cut_words("Ọ̀yọ́ E’kan 'quoted' snake_case 3.5", french=False) == ["ọ̀yọ́", "e'kan", "quoted", "snake_case", "3", "5"]
    assert tx.cut_words("Jusqu'à M'Bow d'aujourd'hui") == ["jusqu'", "à", "m'bow", "d'", "aujourd'hui"]
    assert tx.cut_words("क्षत्रिय", french=False) == ["क्षत्रिय"]


def test_counted(spark):
    df = spark.createDataFrame([(1, ["b", "a", "b"]), (2, []), (3, None), (4, ["z"])], "id int, t array<string>")
    got = {r.id: r.c and [(x.member, x.k) for x in r.c] for r in df.select("id", tx.counted(F.col("t")).alias("c")).collect()}
    assert got == {1: [("a", 1), ("b", 2)], 2: None, 3: None, 4: [("z", 1)]}


def test_hijri_by_rule_and_by_table(spark):
    days = [datetime.date(2024, 7, 7) + datetime.timedelta(days=17 * i) for i in range(-900, 100)]
    df = spark.createDataFrame([(d,) for d in days], "day date")
    calendar = spark.sparkContext._jvm.java.time.chrono.HijrahDate
    for r in dt.to_hijri(df, dt.umm_al_qura(spark)).collect()[::60]:
        local = spark.sparkContext._jvm.java.time.LocalDate.of(r.day.year, r.day.month, r.day.day)
        h = calendar.__getattr__("from")(local).toString()
        assert str(h).split()[-1] == f"{r.hijri_year}-{r.hijri_month:02d}-{r.hijri_day:02d}"
    got = {r.day: tuple(r.h) for r in df.select("day", dt.tabular_hijri(F.col("day")).alias("h")).collect()}
    assert all(1 <= m <= 12 and 1 <= d <= 30 for _, m, d in got.values())


def test_lemmas():
    t = lambda *xs: [(x[0], x[1] if len(x) > 1 else x[0].lower(), x[2] if len(x) > 2 else True, False) for x in xs]
    assert en.lemma_pairs(t(("L'", "le", False), ("églises", "église"))) == [("église", False)]
    assert en.lemma_pairs(t(("N'", "ne", False), ("Guessan", "guessan"))) == [("n'guessan", False)]
    assert en.lemma_pairs(t(("Jama'", "jama", False), ("at", "at"), ("3", "3"), ("well-known", "well-known"))) == [("jama'at", False), ("well-known", False)]
    assert en.lemma_pairs(t(("it", "it", False), ("'s", "be"), ("x", "#"))) == [("it", False), ("x", False)]
    assert en.lemma_pairs([("The", "the", True, True), ("cat", None, True, False)]) == [("the", True), ("cat", False)]


def test_lemmatise_routes_by_language(spark):
    df = spark.createDataFrame([(1, "Le chat", "Français"), (2, "The cat", "English"), (3, "both", "Français|English"), (4, "", "français"), (5, "x " * 30, "Français")], "id int, t string, l string")
    tag = lambda text: [(w, w.lower(), True, w == "Le") for w in text.split()]
    got = {r.id: (r.lemmas, r.content) for r in en.lemmatise(df, "t", "l", tag, ["Français"], limit=7).collect()}
    assert got == {1: ("le chat", "chat"), 2: (None, None), 3: (None, None), 4: ("", ""), 5: (" ".join(["x"] * 30), " ".join(["x"] * 30))}


def test_enrichment_modes(spark):
    df = spark.createDataFrame([(1, "l'ami est là", "Français"), (2, "l'ami est là", "English"), (3, None, None)], "id int, t string, l string")
    one = en.enrich_words(df, "t", "l")
    assert {r.id: r.n_words for r in one.collect()} == {1: 4, 2: 3, 3: 0}
    marked = one.withColumn("n_words", F.lit(9).cast("long"))
    assert {r.n_words for r in en.enrich_words(marked, "t", "l").collect()} == {9}
    assert {r.n_words for r in en.enrich_words(marked, "t", "l", mode="incompatible").collect()} == {9}
    moved = marked.withColumn("t", F.when(F.col("id") == 1, "un").otherwise(F.col("t")))
    assert {r.id: r.n_words for r in en.enrich_words(moved, "t", "l", mode="incompatible").collect()} == {1: 1, 2: 9, 3: 9}
    assert {r.id: r.n_words for r in en.enrich_words(marked, "t", "l", mode="all").collect()} == {1: 4, 2: 3, 3: 0}
    with pytest.raises(ValueError):
        en.enrich_words(df, "t", "l", mode="some")
    text = "Le chat dort sur la table. Il rêve de la mer. Le soleil brille. " * 12
    r = en.enrich_readability(en.enrich_richness(spark.createDataFrame([(1, text, "fr"), (2, text, "en")], "id int, t string, l string"), "t", "l"), "t", "l").orderBy("id").collect()
    assert r[0].readability > 60 and r[1].readability is None and 0 < r[0].richness < 1
    out = en.map_batches(df.select("id", "t"), lambda p: pd.DataFrame({"n": p.t.fillna("").str.len()}), {"n": "long"})
    assert {x.id: x.n for x in out.collect()} == {1: 12, 2: 12, 3: 0}


def test_vector_space_and_topics(spark):
    df = spark.createDataFrame([("a", [1.0, 2.0], "h"), ("b", [1.0, 0.0], "h"), ("c", None, None)], "id string, v array<double>, h string")
    assert en.require_one_space(df, "v", "h").count() == 3
    for odd in ([("d", [1.0], "h")], [("d", [1.0, 1.0], "g")], [("d", [1.0, 1.0], "")]):
        with pytest.raises(ContractError):
            en.require_one_space(df.union(spark.createDataFrame(odd, df.schema)), "v", "h")
    with pytest.raises(Exception, match="does not name its model"):
        en.with_topic(spark.createDataFrame([(1.0, None)], "t double, m string"), "t", "m").collect()
    with pytest.raises(Exception, match="no list of private columns"):
        en.row_restrictions(spark.createDataFrame([("a", True, None)], "id string, p boolean, x array<string>"), "id", "p", "x").collect()
    rows = spark.createDataFrame([(y, i, f"c{i % 12}", [0.25, 0.75]) for y in (1990, 1991) for i in range(30)], "y int, id int, c string, theta array<double>")
    got = en.prevalence_intervals(rows, "theta", "y", "id", cluster="c", n_boot=50).collect()
    assert len(got) == 4 and all(r.ci_status == "ok" and r.n_clusters == 12 and r.ci_low == pytest.approx(r.prevalence) for r in got)
    assert {r.ci_status for r in en.prevalence_intervals(rows.where("id < 5"), "theta", "y", "id", cluster="c").collect()} == {"insufficient_clusters"}


def test_settings_and_names():
    assert en.resolve_settings({"k": None, "a": 1}, {"k": 5}, {"k": 7, "b": 2}, {"k": 9, "c": 3}) == {"k": 5, "a": 1, "b": 2, "c": 3}
    with pytest.raises(ContractError):
        en.resolve_settings({"k": 4}, {"k": 5}, {}, {})
    assert en.frozen_preprocessing(["b", "a", "c"], ["c"], chunk_words=5)["stop_words"] == ["a", "b"]
    assert en.table_slug("org/name") == "org__name" and en.cache_fingerprint("m/x", 3, None, "t y") == "m-x_3_t-y"
    assert en.versions(["no-such-package"])["no-such-package"] == "not installed"


def test_panel_registry(spark):
    p = mp.Panel((mp.Rater("a", 1, False, False), mp.Rater("b", 2)), ("tone", "weight"))
    assert p.columns() == ["a_tone", "a_weight", "b_tone", "b_weight"] and p.latest() == 2 and [r.prefix for r in p.frozen()] == ["a"]
    assert p.consensus_columns(2) == ["consensus_g2_tone", "consensus_g2_weight"] and p.numeric_columns("weight") == ["a_weight"]
    with pytest.raises(KeyError):
        p.generation(3)
    items = spark.createDataFrame([], mp.ITEM)
    with pytest.raises(ValueError):
        mp.panel_columns(items, mp.Panel((mp.Rater("x", 2, True, False),), ("weight",)), score="weight")
    df = spark.createDataFrame([(1, 2, 3)], "a int, old int, old_config_hash int")
    assert mp.drop_retired(df, ["old"]).columns == ["a"]
    assert all(m(items, mp.Site()).count() == 0 for m in mp.MAPPERS.values())


def test_split_keeps_null_groups_and_copies_together(spark):
    df = spark.createDataFrame([(None, "n")] + [(f"s{i}", f"t{i}") for i in range(8)] + [("s1", "same"), ("s2", "same"), ("s3", "same")], "g string, t string")
    plain = sm.hash_split(df, "g", 0.4)
    assert plain.count() == df.count() and plain.where("held_out").select("g").distinct().count() == 4
    got = sm.hash_split(df, "g", 0.4, text="t").collect()
    assert len({r.held_out for r in got if r.g in ("s1", "s2", "s3")}) == 1 and len(got) == 12


def item(i, content, public=True):
    v = lambda x: Row(value=x, title=None, id=None, label=None, rid=None, lang=None, is_public=True)
    return (i, f"T{i}", "c", "2020-01-01T00:00:00", public, [], None, None, False, {"dcterms:title": [v(f"Title {i}")], "bibo:content": [v(content)]})


def test_upload_lists_and_clears_stale_cells(spark, tmp_path):
    path, state = f"file://{tmp_path}/repo", f"file://{tmp_path}/state"
    spec = up.Upload("images", "id", lambda items: items.select(F.col("id").cast("string").alias("id"), vs.display(F.col("props"), "bibo:content").alias("content")), ["content"], {"content": ["score", "topic"]})
    make = lambda rows: spark.createDataFrame(rows, mp.ITEM)
    with pytest.raises(ContractError):
        up.upload(make([item(1, "a")]), spec, path, repository="r", state=state)
    first = up.upload(make([item(i, f"text {i}") for i in range(1, 5)]), spec, path, repository="r", state=state, allow_initialize=True)
    assert first["rows"] == 4 and first["stale"] == 0
    at = ca.Catalog(spark, path).pinned()
    scored = at.read("images").withColumns({"score": F.lit(1.0), "topic": F.lit(3)})
    revision = sinks.commit({"images": scored, "other": spark.createDataFrame([("x",)], "id string")}, path, "id", expected=at.revision)
    second = up.upload(make([item(1, "text  1"), item(2, "changed"), item(3, "text 3"), item(4, "text 4")]), spec, path, repository="r", state=state)
    assert second["stale"] == 2 and second["cleared"] == 0
    now = ca.Catalog(spark, path).pinned()
    assert now.tables() == ["images", "other"] and now.read("images").where("score is null").count() == 0
    third = up.upload(make([item(1, "text 1"), item(2, "changed"), item(3, "new"), item(4, "text 4")]), spec, path, repository="r", state=state, invalidate=True)
    assert third["cleared"] == 4  # also those of the run before, whose change cannot be seen any more
    got = {r.id: (r.score, r.topic) for r in ca.Catalog(spark, path).pinned().read("images").collect()}
    assert got == {"1": (1.0, 3), "2": (None, None), "3": (None, None), "4": (1.0, 3)}
    assert up.load_worklist(spark, state, "r", "images", "id").count() == 0
    with pytest.raises(ContractError):
        up.upload(make([item(1, "a")]), spec, path, repository="r", state=state)  # shrinks too much
    with pytest.raises(ContractError):
        up.upload(make([item(1, "a"), item(1, "b")]), spec, path, repository="r", state=state, allow_shrink=True)
    with pytest.raises(ContractError):
        up.check_revision(ca.Catalog(spark, path, revision))
    summary = up.mirror_all(ca.Catalog(spark, path), f"file://{tmp_path}/mirror", repository="r")
    assert summary["tables"]["images"]["rows"] == 4 and ca.read_mirror(spark, f"file://{tmp_path}/mirror/other", repository="r").count() == 1
    assert up.load_input(ca.Catalog(spark, path).pinned(), "images", "id", ["id"]).count() == 4


def test_publish_widens_the_allowlist_after_the_commit(spark, tmp_path):
    allow, path = f"file://{tmp_path}/allow.json", f"file://{tmp_path}/open"
    up.write_json(spark, allow, {"t": ["id"]})
    df = spark.createDataFrame([("a", 1)], "id string, n int")
    with pytest.raises(ContractError):
        up.publish({"t": df}, path, "id", allow)
    assert up.load_allowlist(spark, allow) == {"t": ["id"]}
    up.publish({"t": df}, path, "id", allow, approve={"t": ["n"]})
    assert up.load_allowlist(spark, allow) == {"t": ["id", "n"]}
    with pytest.raises(ContractError):
        up.check_rewrite(True, "r")
    up.check_rewrite(False, "r")


def test_topic_models_and_their_bundle(spark, tmp_path):
    rows = [(i, ["sea", "ship", "sail", "wind"] * 3 if i % 2 else ["bread", "oven", "flour", "salt"] * 3) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, tokens array<string>")
    bag, model = tp.fit_lda(df, "tokens", 2, iterations=15)
    words = tp.topic_words(bag, model, tp.word_probabilities(df, "tokens"), top=4)
    assert {frozenset(w) for w in words} == {frozenset(("sea", "ship", "sail", "wind")), frozenset(("bread", "oven", "flour", "salt"))}
    assert tp.stability(words, words[::-1]) == 1 and tp.diversity(words) == 1 and tp.diversity([["a"], ["a"]]) == 0.5
    c = tp.coherence(df, "tokens", words).collect()
    assert all(r.npmi == pytest.approx(1, abs=1e-3) and r.u_mass > 0 for r in c)
    identity = up.write_bundle({"bag": bag, "model": model}, {"k": 2}, f"file://{tmp_path}/models", spark)
    folder, manifest = up.load_bundle(f"file://{tmp_path}/models", spark)
    assert manifest["id"] == identity and manifest["settings"] == {"k": 2}
    ca.write_text(spark, f"{folder}/settings.json", "{}")
    with pytest.raises(ContractError):
        up.load_bundle(f"file://{tmp_path}/models", spark)
    table = sinks.topic_table(words, spark.createDataFrame([(0, 20)], "topic int, docs long")).orderBy("topic").collect()
    assert [(r.docs, r.share) for r in table] == [(20, 1.0), (0, 0.0)]


def test_calibration_on_held_out_components(spark):
    pairs = spark.createDataFrame([(2 * i, 2 * i + 1, 0.9 + (i % 10) / 100, 0.8 if i % 10 >= 5 else 0.1) for i in range(200)], "a long, b long, score double, jaccard double")
    r = si.calibrate(pairs, [0.9, 0.92, 0.95, 0.97]).first()
    assert (r.prefilter, r.near_duplicate) == (0.95, 0.95) and r.held_out_recall == 1 and r.held_out_precision == 1
    assert r.interval_status == "ok" and (r.held_out_recall_low, r.held_out_precision_low) == (1, 1)
    off = si.calibrate(pairs, [0.9, 0.92, 0.95, 0.97], n_boot=0).first()
    assert off.interval_status == "disabled" and off.held_out_recall_low is None


def test_intervals_over_components_equal_drawing_them_one_by_one(spark):
    rng = np.random.default_rng(1)
    rows = [(c, float(s), bool(y)) for c in range(40) for s, y in zip(rng.random(rng.integers(1, 6)), rng.random(9) < 0.5)]
    held = spark.createDataFrame(rows, "component int, score double, label boolean")
    r = si.component_intervals(held, [0.5, None], n_boot=4000).first()
    by = [[x for x in rows if x[0] == c] for c in range(40)]
    draws = []
    for _ in range(4000):
        drawn = [x for c in rng.integers(0, 40, 40) for x in by[c]]
        hit, chosen, positive = (sum(f(x) for x in drawn) for f in (lambda x: x[1] >= 0.5 and x[2], lambda x: x[1] >= 0.5, lambda x: x[2]))
        draws.append((hit / chosen, hit / positive))
    want = np.percentile(draws, [2.5, 97.5], axis=0).T.ravel()
    assert (r.precision_low, r.precision_high, r.recall_low, r.recall_high) == pytest.approx(tuple(want), abs=0.02) and r.n_components == 40
    few = si.component_intervals(held.where("component < 9"), [0.5]).first()
    assert few.status == "insufficient_components" and few.recall_low is None
    assert si.component_intervals(held.limit(0), [0.5]).first().n_components == 0


def test_sliding_windows_and_coherence(spark):
    docs = [("a b c a d e b".split(),), (["a", "b"],), ([],), (None,), (["x"] * 9 + ["a"],)]
    df = spark.createDataFrame(docs, "t array<string>")
    total, got = tp.window_counts(df, "t", ["a", "b", "c", "unseen"], size=3)
    windows = [set(d[0][i : i + 3]) for d in docs if d[0] for i in range(max(1, len(d[0]) - 2))]
    want = {(x, y): sum(x in w and y in w for w in windows) for x in "abc" for y in "abc" if x <= y}
    assert total == len(windows) and got == {k: n for k, n in want.items() if n}
    rows = [("sea ship sail wind".split() * 3 if i % 2 else "bread oven flour salt".split() * 3, f"g{i % 10}") for i in range(60)]
    df = spark.createDataFrame(rows, "tokens array<string>, g string")
    good, mixed, empty = tp.coherence_cv(df, "tokens", [["sea", "ship", "sail"], ["sea", "bread", "nowhere"], []])
    assert good == pytest.approx(1, abs=1e-3) and mixed < 0.7 and empty is None


def test_sweep_holds_groups_out_and_judges_the_gap(spark):
    rows = [((["sea", "ship", "sail", f"n{i}"] if i % 2 else ["bread", "oven", "flour", f"n{i}"]) * 3, f"g{i % 10}") for i in range(80)]
    df = spark.createDataFrame(rows, "tokens array<string>, g string")
    reports = tp.sweep(df, "tokens", [2, 3], [1, 2], group="g", iterations=5)
    assert {r["k"] for r in reports} == {2, 3} and all(r["log_perplexity"] > 0 and r["c_v_sd"] is not None for r in reports)
    v = tp.sweep_verdict(reports)
    assert v["best_k"] == reports[0]["k"] and v["distinguishable"] == (v["gap"] > v["seed_sd"])
    one = tp.sweep_verdict([{"k": 4, "c_v": 0.5, "c_v_sd": None}, {"k": 3, "c_v": 0.5, "c_v_sd": None}])
    assert (one["best_k"], one["runner_up_k"], one["distinguishable"]) == (3, 4, None)


def test_checkpoints_and_reuse(spark, tmp_path):
    path = f"file://{tmp_path}/done"
    now = spark.createDataFrame([(1, "a"), (2, "b")], "id int, h string")
    assert ca.read_checkpoint(spark, path, now, "id", "h").count() == 0
    sinks.append_checkpoint(spark.createDataFrame([(1, "a", 5), (2, "old", 6)], "id int, h string, v int"), path)
    assert [(r.id, r.v) for r in ca.read_checkpoint(spark, path, now, "id", "h").collect()] == [(1, 5)]
    rows = spark.createDataFrame([(1, "x"), (2, "y")], "id int, t string")
    kept = rows.select("id", F.sha2("t", 256).alias("text_sha256"), F.array(F.lit(0.5), F.when(F.col("id") == 1, 0.5).otherwise(0.7)).alias("theta"))
    assert ca.reuse_vectors(kept.where("id = 1"), rows, "id", "t", "theta").count() == 1
    with pytest.raises(Exception, match="does not sum"):
        ca.reuse_vectors(kept, rows, "id", "t", "theta").collect()


def test_paged_source(spark):
    """A local server of 25 items in pages of 10: all come, a shortfall raises, a failure is tried again."""
    state = {"total": 25, "fail": 1}

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            q = urllib.parse.parse_qs(urllib.parse.urlparse(self.path).query)
            if state["fail"]:
                state["fail"] -= 1
                self.send_error(503)
                return
            page, size = int(q["page"][0]), int(q["per_page"][0])
            body = json.dumps([{"o:id": i} for i in range((page - 1) * size, min(25, page * size))]).encode()
            self.send_response(200)
            self.send_header("X-Total-Count", str(state["total"]))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *a):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}/items"
    try:
        spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))
        df = paged.fetch(spark, url, per_page="10")
        assert sorted(json.loads(r.item)["o:id"] for r in df.collect()) == list(range(25))
        state["total"] = 30
        with pytest.raises(ContractError):
            paged.fetch(spark, url, per_page="10")
    finally:
        server.shutdown()
    calls = []

    def call():
        calls.append(1)
        raise paged.urllib.error.HTTPError(url, 404, "no", {}, None)

    with pytest.raises(paged.urllib.error.HTTPError):
        paged.with_retry(call, wait=0)
    assert len(calls) == 1
    items = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    media = spark.createDataFrame([(1, "u", True, None), (2, None, True, "timeout")], "id int, url string, attempted boolean, error string")
    out, ledger = paged.lookup_media(items, media, "id", ["url"])
    assert out.count() == 3 and [(r.id, r.column) for r in ledger.collect()] == [(2, "url")]
    with pytest.raises(ContractError):
        paged.check_failures(10, 1)
    paged.check_failures(10, 1, most=0.2)


def test_landed_and_normalized(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1}\n{broken\n{"id": 2}\n')
    assert paged.landed(spark, f"file://{tmp_path}/a.json", "id int").where("id is not null").count() == 2
    df = spark.createDataFrame([("« œuvre »  l’été – ﬁn",)], "t string")
    assert df.select(tx.normalize_text("t")).first()[0] == '" oeuvre " l\'été - fin'
    assert df.select(tx.normalize_token(F.lit("L'Été_Noir 2"))).first()[0] == "lete noir 2"


def test_streams(spark, tmp_path):
    events = tmp_path / "in"
    spark.createDataFrame([("k", datetime.datetime(2024, 1, 1, 0, m)) for m in (0, 10, 50)], "key string, ts timestamp").write.json(str(events))
    s = spark.readStream.schema("key string, ts timestamp").json(str(events))
    q = inc.sessions(s, "ts", "key").writeStream.format("memory").queryName("held_sessions").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.n for r in spark.table("held_sessions").collect()) == [1, 2]
    seen = []
    q = inc.upsert_stream(s, lambda batch, n: seen.append((n, batch.count())), f"file://{tmp_path}/cp")
    q.awaitTermination()
    assert seen == [(0, 3)]
