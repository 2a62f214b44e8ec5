"""Column functions against worked values."""

import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from textmill.functions import dates as dt
from textmill.functions import hashing as hs
from textmill.functions import numbers as nb
from textmill.functions import text as tx
from textmill.functions import values as vl


def one(spark, *cols):
    return spark.range(1).select(*(c.alias(f"c{i}") for i, c in enumerate(cols))).first()


def test_g2_and_log_ratio(spark):
    lit = lambda *xs: [F.lit(x) for x in xs]
    r = one(spark, nb.g2(*lit(100, 10, 1000, 1000)), nb.g2(*lit(10, 10, 1000, 1000)), nb.g2(*lit(10, 0, 1_000_000, 5_000_000)), nb.log_ratio(*lit(10, 0, 1_000_000, 5_000_000)), nb.log_ratio_interval(*lit(5000, 10000, 1_000_000, 5_000_000)), nb.g2(*lit(10, 100, 1000, 1000)))
    assert r.c0 == pytest.approx(89.7597737585, rel=1e-9)
    assert r.c1 == pytest.approx(0, abs=1e-9)
    assert r.c2 == pytest.approx(35.8353, abs=1e-3)
    assert r.c3 == pytest.approx(math.log2(105))
    assert (r.c4.low, r.c4.high) == (pytest.approx(1.2730, abs=1e-4), pytest.approx(1.3710, abs=1e-4))
    assert r.c5 == pytest.approx(-r.c0)


def test_p_values(spark):
    r = one(spark, nb.chi2_p(F.lit(3.841458820694124)), nb.chi2_p_exact(F.lit(3.841458820694124)))
    assert r.c0 == pytest.approx(0.05, abs=2e-7) and r.c1 == pytest.approx(0.05, abs=1e-12)


def test_ordinals_and_vectors(spark):
    r = one(spark, nb.score_or_label(F.lit("12.0"), ["a", "b"]), nb.score_or_label(F.lit("2.0"), ["a", "b"]), nb.score_or_label(F.lit("b"), ["a", "b"]), nb.whole(F.lit("12.0")), nb.whole(F.lit("12.5")), nb.vector(F.lit("[3,4]")), nb.vector(F.lit("[3,null]")), nb.unit(F.array(F.lit(3.0), F.lit(4.0))), nb.unit(F.array(F.lit(0.0))))
    assert (r.c0, r.c1, r.c2, r.c3, r.c4, r.c5, r.c6, r.c7, r.c8) == (None, 2, 2, 12, None, [3, 4], None, [0.6, 0.8], None)


@pytest.mark.parametrize(("text", "year", "precision"), [("1998", 1998, "year"), ("1998-06", 1998, "month"), ("1998-06-31", None, "other"), ("1981-04/1981-06", 1981, "range"), ("", None, ""), (None, None, ""), (" 2000-02-29 ", 2000, "day"), ("bad", None, "other")])
def test_partial_dates(spark, text, year, precision):
    r = one(spark, dt.parse_partial(F.lit(text).cast("string")), dt.point_year(F.lit(text).cast("string")))
    assert (r.c0.year, r.c0.precision) == (year, precision)
    assert r.c1 == (None if precision == "range" else year)


def test_days_durations_coordinates(spark):
    r = one(spark, dt.strict_day(F.lit("2012-08-19T10:00:00Z")), dt.strict_day(F.lit("1998-06")), dt.duration_seconds(F.lit("PT1H2M3.5S")), dt.duration_seconds(F.lit("")), dt.duration_seconds(F.lit("P1DT1M")), dt.coordinates(F.lit("12.3, -1.5")), dt.coordinates(F.lit("91, 0")), dt.day_status(F.lit("1998")))
    assert (r.c0, r.c1, r.c2, r.c3, r.c4) == (date(2012, 8, 19), None, 3724, None, 86460)
    assert tuple(r.c5) == (12.3, -1.5) and tuple(r.c6) == (None, None) and r.c7 == "imprecise"


def test_hijri(spark):
    """The arithmetic calendar is within a day of published tables; an exact month table gives the exact days."""
    gold = {date(1999, 4, 17): (1420, 1, 1), date(2000, 2, 29): (1420, 11, 23), date(2012, 8, 19): (1433, 10, 1), date(2024, 3, 20): (1445, 9, 10)}
    rows = spark.createDataFrame([(d,) for d in gold], "day date").select("day", dt.tabular_hijri("day").alias("h")).collect()
    for r in rows:
        y, m, d = gold[r.day]
        assert abs((r.h.hijri_year - y) * 354 + (r.h.hijri_month - m) * 29.5 + r.h.hijri_day - d) <= 2
    months = spark.createDataFrame([(date(1999, 4, 17), 1420, 1), (date(1999, 5, 16), 1420, 2)], "start date, hijri_year int, hijri_month int")
    days = spark.createDataFrame([(date(1999, 4, 17),), (date(1999, 5, 15),), (date(1999, 5, 20),), (date(1999, 4, 1),), (None,)], "day date")
    got = {r.day: (r.hijri_year, r.hijri_month, r.hijri_day) for r in dt.to_hijri(days, months).collect()}
    assert got == {date(1999, 4, 17): (1420, 1, 1), date(1999, 5, 15): (1420, 1, 29), date(1999, 5, 20): (1420, 2, 5), date(1999, 4, 1): (None, None, None), None: (None, None, None)}


def test_french_words():
    assert tx.cut_words("L'école n’est qu'aujourd'hui") == ["l'", "école", "n'", "est", "qu'", "aujourd'hui"]
    assert tx.cut_words("N'Guessan") == ["n'guessan"]
    assert tx.cut_words("l'ami", french=False) == ["l'ami"]
    assert tx.cut_words(None) == []


def test_chunks(spark):
    words = F.transform(F.sequence(F.lit(1), F.lit(210)), lambda i: F.concat(F.lit("w"), i))
    df = spark.range(1).select(words.alias("w"))
    sizes = lambda n, k: [len(c) for c in df.select(tx.token_chunks(F.slice("w", 1, n), k).alias("c")).first().c]
    assert sizes(200, 100) == [100, 100] and sizes(210, 100) == [100, 110] and sizes(130, 100) == [100, 30] and sizes(10, 100) == [10]
    assert tx.whitespace_chunks("aaa bbb ccc", 7) == ["aaa bbb", "ccc"]
    text = "mot été " * 40
    parts = tx.byte_chunks(text, 50, 10)
    assert all(len(p.encode()) <= 50 for p in parts) and parts[0] == text[: len(parts[0])]
    at = 0
    for p in parts:
        at = text.index(p, max(0, at - 60)) + len(p) if p != parts[-1] else len(text)
    assert at == len(text)
    assert spark.range(1).select(tx.spread(F.sequence(F.lit(1), F.lit(9)), 3).alias("c")).first().c == [1, 5, 9]


def test_tokens_sets_and_lists(spark):
    r = one(spark, tx.simple_tokens(F.lit("  The cat a\tsat "), ["the"]), tx.terms(F.lit("a | b||c")), tx.jaccard(tx.shingles(F.split(F.lit("a b c d"), " "), 3), tx.shingles(F.split(F.lit("a b c e"), " "), 3)), tx.jaccard(F.array().cast("array<string>"), F.array(F.lit("x"))), tx.parse_topk(F.lit("3:0.5|1:0.2")), tx.parse_topk(F.lit("3:0.5|3:0.2")), tx.parse_topk(F.lit("3:0.9|1:0.2")), tx.slug(F.lit("Très négatif")), tx.redact(F.lit("u?key_credential=abc&x=1")), tx.squeeze(F.lit(" a \n b ")))
    assert (r.c0, r.c1, r.c2, r.c3) == (["cat", "sat"], ["a", "b", "c"], pytest.approx(1 / 3), None)
    assert [(x.topic, x.prob) for x in r.c4] == [(3, 0.5), (1, 0.2)] and r.c5 == [] and r.c6 == []
    assert (r.c7, r.c8, r.c9) == ("tres_negatif", "u?key_credential=***&x=1", "a b")


def test_mattr_forms_agree(spark):
    df = spark.range(1).select(F.split(F.lit("a b a c d a b e f a b c"), " ").alias("t"))
    r = df.select(tx.mean_ttr(F.col("t"), 5).alias("x"), tx.mattr_udf("t", F.lit(5)).alias("y"), tx.mean_ttr(F.col("t"), 50).alias("z")).first()
    assert r.x == pytest.approx(r.y) and r.z is None


def test_collocations_and_reading():
    assert tx.join_collocations("a b c d".split(), [("b", "c"), ("b", "c", "d")]) == ["a", "b_c_d"]
    assert tx.french_reading_ease("mot " * 50) is None
    assert tx.french_reading_ease(("Le chat dort sur le lit blanc. " * 20)) is not None
    assert list(tx.batches_by_budget([3, 1, 2], 4)) == [[1, 2], [0]]


def test_values(spark):
    schema = f"p {vl.PROPERTIES}"
    v = lambda **k: {"value": None, "title": None, "id": None, "label": None, "rid": None, "lang": None, "is_public": True} | k
    item = {"s": [v(title="A", rid=3), v(value="B", rid=3)], "a": [v(value="un", lang="fr"), v(value="one", lang="en")], "x": [v(value="q", is_public=None)]}
    r = spark.createDataFrame([(item,)], schema).select(vl.display(F.col("p"), "s").alias("c0"), vl.resource_ids(F.col("p"), "s").alias("c1"), vl.by_language(F.col("p"), "a", "en").alias("c2"), vl.split_by_language(F.col("p"), "a").alias("c3"), vl.is_public(F.col("p"), "x").alias("c4"), vl.private_columns(F.col("p"), {"x": ["b", "a"], "s": ["c"]}).alias("c5"), vl.display(F.col("p"), "none").alias("c6")).first()
    assert (r.c0, r.c1, r.c2, tuple(r.c3), r.c4, r.c5, r.c6) == ("A|B", "3", "one", ("un", "one"), False, ["a", "b"], "")
    d = one(spark, vl.split_dois(F.array(F.lit("https://doi.org/10.1234/ab"), F.lit("http://x.org"), F.lit("note"))))
    assert tuple(d.c0) == ("10.1234/ab", "http://x.org")


def test_hashes(spark):
    import hashlib

    r = one(spark, hs.stable_rank(42, F.lit("x")), hs.input_fingerprint(F.lit("a"), F.lit(None).cast("string")))
    assert r.c0 == hashlib.sha256(b"42\0x").hexdigest() and r.c1 == hashlib.sha256(b"a\x1f\x1f").hexdigest()[:32]
    assert hs.config_fingerprint({"b": 1, "a": 2}) == hs.config_fingerprint({"a": 2, "b": 1})
