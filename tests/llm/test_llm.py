"""Each operator against brute force, round trips or held-out accuracy, and on awkward tables."""

import base64
import hashlib
import re
import struct
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from textmill.llm import ann, bpe, html_text, label_model, licenses, mixing, ngram_join, pieces, quality_classifier, quality_rules, token_files, toxicity
from textmill.llm.common import shingle_hashes

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "word " * 30_000
#: Awkward rows: null and empty texts, white space alone, repeats, ties, a very long text, odd characters; columns whose names operators use themselves.
AWKWARD = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "Same text here for two of them to be equal"), (6, "Same text here for two of them to be equal"), (7, LONG),
    (8, "naïve café ☃   x²  double  spaces\n\n\nlines end   "), (9, "<|endoftext|> it's we'll \x1c\x1d end"), (10, "ﬁ 日本語テキスト 🙂🙂 ﻿"),
]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame([(i, t, "s" if i % 2 else None, i) for i, t in AWKWARD], "doc_id long, text string, source string, n long").select("*", *(F.lit("x").alias(c) for c in ("n_words", "kept", "score", "size", "position", "ids", "component_id", "labels")))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def ids_of(n):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    e = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return e.encode_ordinary(n)


def brute_bpe(texts):
    out = {}
    for i, t in texts:
        ids = ids_of(t or "")
        out[i] = (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    return out


BPE = {"ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"), "pattern": public_tokenizers.PATTERN}


def test_bpe_matches_the_library(spark, awkward, docs):
    texts = [*AWKWARD, *((r.doc_id + 1000, r.text) for r in docs.limit(60).collect()), (500, "a" * 5000), (501, "\n" * 300 + " " * 301 + "x"), (502, "ab" * 900 + " " + "!?" * 400)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode_decode(df, **BPE).collect()}
    assert got == brute_bpe(texts)
    assert bpe.encode_decode(awkward.limit(0), **BPE).count() == 0
    assert all(r.exact for r in bpe.encode_decode(awkward, **BPE, keep_ids=True).collect())


def test_bpe_merges_leftmost_lowest_pair():
    m = bpe.bpe(BPE["ranks"], BPE["pattern"])
    rng = np.random.default_rng(3)
    for _ in range(60):
        raw = bytes(rng.choice(np.frombuffer(b"abcdeth in", np.uint8), rng.integers(2, 60)))
        ids = [m.ranks[bytes([b])] for b in raw]
        while True:
            pairs = [(m.ranks.get(m.tokens[a] + m.tokens[b], 1 << 30), i) for i, (a, b) in enumerate(zip(ids, ids[1:]))]
            best = min(pairs, default=(1 << 30, 0))
            if best[0] == 1 << 30:
                break
            ids[best[1] : best[1] + 2] = [best[0]]
        if m.ranks.get(raw) is None:
            assert m.encode_matches([raw])[0].tolist() == ids
            assert m.merge_long(raw).tolist() == ids  # the heap takes the same merges


def test_bpe_of_very_long_matches():
    m = bpe.bpe(BPE["ranks"], BPE["pattern"])
    begin = time.monotonic()
    for text in ("a" * 200_000, "abc" * 66_000, "é" * 50_000):
        assert m.encode_matches([text.encode()])[0].tolist() == ids_of(text)
    assert time.monotonic() - begin < 20


def test_pieces_are_cut_between_matches():
    """Every place at which texts are cut is a border of two matches of the pattern, also beside odd white space, marks and apostrophes."""
    import regex

    rng = np.random.default_rng(5)
    alphabet = list("ab Z9.,'\"\n\t\r-é日’\x1c\x1f") + [" ", "  ", "\u00a0", "\u2003", "\u3000", "\u0085", "'s", "'ll", "🙂"]
    for _ in range(3000):
        text = "".join(rng.choice(alphabet, rng.integers(1, 14)))
        raw = text.encode()
        borders = {0}
        for x in regex.findall(public_tokenizers.PATTERN, text):
            borders.add(max(borders) + len(x.encode()))
        assert set(pieces.cuts(np.frombuffer(raw, np.uint8)).tolist()) <= borders, repr(text)


def test_memo_stays_bounded_and_right():
    import pyarrow as pa

    m = pieces.PieceMemo(lambda p: (np.frombuffer(b"".join(p), np.uint8).astype(np.uint32), np.array([len(x) for x in p])), most=3000)
    for k in range(30):
        texts = [f"w{k}x{i} same, words" * (i % 3) for i in range(20)] + [None, "", "x" * 500]
        got = [bytes(ids[a:b].astype(np.uint8)).decode() for _, _, ids, ends in m.encode_column(pa.array(texts)) for a, b in zip([0, *ends[:-1]], ends)]
        assert got == [t or "" for t in texts]
        assert m.held < 30_000 and all(len(p) <= pieces.LONGEST for p in m.place)


def test_token_files(spark, awkward, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.token_files(awkward.repartition(3), tokenizer_file=path).collect()}
    start = 0
    for i, text in AWKWARD:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        assert got[i] == (start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)
    assert token_files.token_files(awkward.limit(0), tokenizer_file=path).count() == 0
    files = token_files.write_token_files(awkward.unionAll(awkward).coalesce(1), f"file://{tmp_path}/t", tokenizer_file=path)
    assert sum(n for *_, n in files) == 2 * len(AWKWARD)
    r = token_files.FrameReader(files[0][0])
    some = next(iter(set(r.keys[~r.null].tolist())))
    assert len(r.documents([some])[some]) == got[some][1]
    place = files[0][0].removeprefix("file://")
    raw = bytearray(open(place, "rb").read())
    import zstandard

    assert len(zstandard.ZstdDecompressor().stream_reader(bytes(raw), read_across_frames=True).read()) == 4 * files[0][2]
    raw[8] ^= 1
    open(place, "wb").write(raw)
    with pytest.raises(Exception):  # noqa: B017
        broken = token_files.FrameReader(files[0][0])
        list(broken.parts(len(broken.keys) - 1)), list(broken.parts(0)), [broken.frame(i) for i in range(len(broken.packed))]


def links(texts, n, percent):
    sets = {}
    for i, t in texts:
        w = WORD.findall((t or "").translate({k: k + 32 for k in range(65, 91)}))
        sets[i] = ({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)}) if w else set()
    top, degree = {i: i for i in sets}, Counter()

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    keys = sorted(sets)
    for k, a in enumerate(keys):
        for b in keys[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                degree[a] += 1
                degree[b] += 1
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), degree[i]) for i in sets}


def near_copies(seed, groups=6, size=9, words=60):
    rng = np.random.default_rng(seed)
    out = []
    for g in range(groups):
        base = [f"w{rng.integers(400)}" for _ in range(words)]
        for _ in range(size):
            t = list(base)
            for _ in range(rng.integers(0, 3)):
                t[rng.integers(words)] = f"w{rng.integers(400)}"
            out.append(" ".join(t))
    order = rng.permutation(len(out))
    return [(int(i), out[k]) for i, k in enumerate(order)]


@pytest.mark.parametrize(("n", "percent", "tile"), [(4, 85, 1500), (5, 80, 1500), (3, 50, 4), (1, 70, 3)])
def test_ngram_join_finds_every_link(spark, monkeypatch, n, percent, tile):
    monkeypatch.setattr(ngram_join, "TILE", tile)
    texts = [*near_copies(n), *((1000 + i, t) for i, t in AWKWARD)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in ngram_join.ngram_join(df, n=n, percent=percent).collect()}
    assert got == links(texts, n, percent)


def test_ngram_join_edges(spark, awkward):
    assert ngram_join.ngram_join(awkward.limit(0)).count() == 0
    df = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f")], "doc_id long, text string")
    got = sorted((r.doc_id is None, r.n_shingles, r.component_id) for r in ngram_join.ngram_join(df).collect())
    assert got == [(False, 2, 1), (True, 2, None)]
    assert len(shingle_hashes("a b c", 4)) == 1 and len(shingle_hashes(None, 4)) == 0 and len(shingle_hashes("A b c d", 4)) == 1


def test_quality_rules(spark, awkward, docs):
    df = awkward.select("doc_id", "text").unionAll(docs.select(F.col("doc_id") + 1000, "text"))
    for r in quality_rules.quality_rules(df).collect():
        x = r.text or ""
        w = WORD.findall(x)
        c = Counter(zip(w, w[1:], w[2:]))
        at = {k for j in range(len(w) - 2) if c[tuple(w[j : j + 3])] > 1 for k in (j, j + 1, j + 2)}
        lines = [s for s in x.split("\n") if WORD.search(s)]
        bad = len(w) < 50 or 100 * len(at) > 50 * len(w)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", x)), len(lines) - len(set(lines)), len(at), bad), r.doc_id
        assert not (r.kept and bad)
    assert quality_rules.quality_rules(awkward.limit(0)).count() == 0
    assert "source" in quality_rules.quality_rules(awkward).columns
    text = "\n".join([" ".join(f"word{i} other{i * 7} plain{i * 3}." for i in range(40)), "Home | About | Contact | Help | More"])
    r = quality_rules.quality_rules(spark.createDataFrame([(1, text), (2, "\n".join(f"Home{i} | About{i} | Contact{i} | Help{i}" for i in range(30)))], "doc_id int, text string")).orderBy("doc_id").collect()
    assert r[0].kept and not r[1].kept and "Home |" not in r[0].clean_text


def test_mixing(spark, awkward, docs):
    rows = mixing.mix_sources(docs).collect()
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append(r)
    total = sum(r.size for r in rows)
    names = sorted(by, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    size = {s: sum(r.size for r in v) for s, v in by.items()}
    full, left = set(), 1.5 * total
    while True:
        free = [s for s in names if s not in full]
        level = (1.5 * total - sum(2 * size[s] for s in full)) / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if level * weight[s] > 2 * size[s]}
        if not over:
            break
        full |= over
    del left
    for s, v in by.items():
        goal = 2 * size[s] if s in full else level * weight[s]
        assert v[0].target == pytest.approx(goal) and v[0].source_size == size[s]
        assert abs(sum(r.taken for r in v) - goal) < 1
        assert all(r.taken <= 2 * r.size for r in v)
    assert [r.position for r in rows] == sorted(r.position for r in rows)
    assert rows == mixing.mix_sources(docs.repartition(7)).collect()
    odd = mixing.mix_sources(awkward.unionAll(awkward)).collect()
    assert len(odd) == 2 * len(AWKWARD) and {r.size for r in odd if r.doc_id < 4} == {0}
    assert mixing.mix_sources(awkward.limit(0)).count() == 0


def test_mixing_splits_hot_sources(docs, monkeypatch):
    whole = {r.doc_id: r.taken for r in mixing.mix_sources(docs).collect()}
    monkeypatch.setattr(mixing, "BUCKET_DOCS", 3)
    parts = {r.doc_id: r.taken for r in mixing.mix_sources(docs).collect()}
    assert whole == parts


def test_mixing_follows_the_schedule(spark):
    df = spark.createDataFrame([(i, " ".join(["w"] * 10), "ab"[i % 2]) for i in range(400)], "doc_id long, text string, source string")
    rows = mixing.mix_sources(df, weights=(1, 1), share=1.0, tilt=0.5).collect()
    early = Counter(r.source for r in rows if r.position < 0.25)
    assert early["a"] > early["b"] * 1.5  # the first source's weight falls, the last one's rises


def test_licenses(spark, awkward):
    text = "Released under the MIT License. Under the MIT license!\nSPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0\nApache License, Version 2.0; CC BY-NC 4.0"
    r = licenses.scan_licenses(spark.createDataFrame([(1, text, "x")], "doc_id long, text string, labels string")).first()
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())
    places = sorted(i for p in licenses.BASE for i in range(len(words)) if words[i : i + len(p.split())] == p.split())
    assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(words), len(places), places[0], places[-1])
    assert r.base_labels == "apache-2,cc-by-nc,mit" and set(r.labels.split(",")) >= {"apache-2", "cc-by-nc", "mit", "gpl-2"} and r.permissive is False and r.score > 0.9
    odd = licenses.scan_licenses(awkward).collect()
    assert len(odd) == len(AWKWARD) and odd[0].labels == "" and odd[0].first_word is None and odd[0].score == 0
    assert licenses.scan_licenses(awkward.limit(0)).count() == 0


@pytest.mark.parametrize(("text", "labels", "free"), [("MIT", ("mit",), True), ("MIT OR GPL-3.0", ("gpl-3", "mit"), True), ("MIT AND GPL-3.0", ("gpl-3", "mit"), False), ("GPL-2.0+ WITH x", ("gpl-2",), False), ("GPL-3.0 AND MIT OR ISC", ("gpl-3", "isc", "mit"), True), ("GPL-3.0 AND (MIT OR ISC)", ("gpl-3", "isc", "mit"), False), ("MIT and here is prose", ("mit",), True), ("(MIT", (), None), ("none", (), None), ("MIT OR", ("mit",), True)])
def test_licence_expressions(text, labels, free):
    assert licenses.parse_expression(text) == (labels, free)


@pytest.mark.parametrize(("text", "labels", "free"), [("MIT AND SSPL-1.0", ("mit", "sspl-1.0"), False), ("OFL-1.1", ("ofl-1.1",), False), ("(MIT AND Foo) OR GPL-3.0", ("foo", "gpl-3", "mit"), False), ("MIT OR Foo-2.0", ("foo-2.0", "mit"), True), ("NONE", (), None), ("LicenseRef-Own AND 0BSD", ("0bsd", "licenseref-own"), False), ("see the file", (), None), ("Apache-2.0 WITH LLVM-exception", ("apache-2",), True), ("MIT and more of it", ("mit",), True)])
def test_licence_expressions_with_unknown_operands(text, labels, free):
    assert licenses.parse_expression(text) == (labels, free)


def test_licenses_base_columns_on_the_whole_table(spark, docs):
    for r in docs.join(licenses.scan_licenses(docs), "doc_id").collect():
        low = (r.text or "").translate({k: k + 32 for k in range(65, 91)})
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        found = [(i, licenses.BASE[p]) for p in licenses.BASE for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        places = [i for i, _ in found]
        want = (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in found})))
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == want
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_html_takes_linear_time():
    begin = time.monotonic()
    for page in ("<b>x</p>" * 200_000, "<div></i>" * 160_000, "<p><b>" * 100_000, "<li><p>" * 100_000, "<div>" * 100_000 + "</p>" * 100_000):
        html_text.extract(page)
    assert time.monotonic() - begin < 25


def test_html_keeps_what_stands_in_an_article():
    story = "The story of the town is told here, and it was the one that all of them had heard of before the war was over and done. "
    page = f"<body><article><p>{story}</p><div class='legal search related share'><p>{story}</p></div><p><a href=x>Read it</a></p><p>Let <math>x = 1</math> be.</p><p>{story}</p></article></body>"
    assert html_text.extract(page).split("\n") == [story.strip(), story.strip(), "Read it", "Let x = 1 be.", story.strip()]
    assert html_text.extract(f"<ul><li><p>{story}<li><p>{story}</ul><p>{story}").split("\n") == [story.strip()] * 3


PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a = "<p>no</p>";</script></head><body>
<header class="site-header"><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies and that is the way of it.</div>
<article><h1>A title &mdash; of &#233;t&eacute;</h1><p>The first of the paragraphs is here, and it is as long as it has to be to be one of the good ones of this page.<br>With more &lt;b&gt;.
<p>Short one.</p><div class="advert">Buy this and that of the best.</div><aside>Side of the page.</aside><p><b>The last</b> of the paragraphs, in which all of the words are plain and there is nothing of note at all.</p></article>
<section id="comments"><p>I am of the opinion that this is the best of the pages that there are.</p></section><form><p>Name of the user</p></form><footer>&copy; all of it</footer></body>"""


def test_html_text(spark):
    lines = html_text.extract(PAGE).split("\n")
    assert lines == ["A title — of été", "The first of the paragraphs is here, and it is as long as it has to be to be one of the good ones of this page. With more <b>.", "Short one.", "The last of the paragraphs, in which all of the words are plain and there is nothing of note at all."]
    rows = [(1, "u", None), (2, "u", ""), (3, "u", PAGE), (3, "u", PAGE), (4, None, "<p>unclosed <b>the text of this is cut off in the middle of a ta"), (5, "u", "<div>" * 3000 + "x"), (6, "u", "<article><p>" + "the word is of " * 50_000), (7, "u", "<<< > & &bogus; <p")]
    got = html_text.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x"))).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert {r.page_id: r.text for r in got}[1] == ""


def test_html_without_article():
    body = "The house of the people is in the middle of the town, and it was built by the ones that were there before the war was over. "
    page = f"<body><ul>{'<li><a href=x>Link of it</a></li>' * 5}</ul><div><p>{body}</p><p>Short one.</p><p>{body * 2}</p></div><div>{'<a href=y>more of the links that are here</a> ' * 4}</div></body>"
    assert html_text.extract(page).split("\n") == [body.strip(), "Short one.", (body * 2).strip()]


def test_html_labels_decide_inside_and_outside_an_article():
    story = "The story of the town is told here, and it was the one that all of them had heard of before the war was over and done. " * 2
    page = f"<body><article><h2>Teaser</h2><p>Read more</p></article><div>{story}</div><div>{story}</div></body>"
    assert html_text.extract(page).split("\n").count(story.strip()) == 2
    links = "<ul><li><a href=x>One more</a></li><li><a href=y>Another</a></li></ul>"
    page = f"<body><article><p>{story}</p>{links}<p>More of it</p>{links}<p>{story}</p></article></body>"
    assert html_text.extract(page).split("\n") == [story.strip(), story.strip()]
    page = "<body><div><a href=x>One more</a></div><article><p>Krótki tekst.</p></article><div><a href=y>Another</a></div></body>"
    assert html_text.extract(page) == "Krótki tekst."


def test_html_tables(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for r in pages.join(html_text.extract_main_text(pages).select("page_id", "text"), "page_id").collect():
        inside = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        from html import unescape

        parts = [re.sub(r"\s+", " ", unescape(re.sub(r"</?b>", "", re.sub("<br>", " ", x)))).strip() for x in re.split(r"</?(?:p|h1)>", inside)]
        assert r.text == "\n".join(p for p in parts if p)


def test_label_model_finds_accuracies_and_correlations():
    rng = np.random.default_rng(0)
    y = (rng.random(20_000) < 0.3).astype(int)
    right = lambda p: np.where(rng.random(len(y)) < p, y, 1 - y)
    v = np.stack([right(0.9), right(0.8), right(0.75), right(0.7)], 1)
    v = np.concatenate([v, v[:, 3:], v[:, 3:]], 1)  # three copies of the weakest voter
    v[rng.random(v.shape[0]) < 0.2, 1] = -1
    patterns, counts = np.unique(v, axis=0, return_counts=True)
    m = label_model.LabelModel(6).fit(patterns, counts, start=(patterns == 1).mean(1))
    a = m.accuracies()
    assert a[0] > a[1] > a[3] and m.correlations[3, 4] > 0.9 > 0.3 > m.correlations[0, 1]
    assert ((m.posterior(v) > 0.5) == y).mean() > 0.87


def test_label_model_against_brute_force():
    """With independent voters the rounds are those of plain expectation-maximisation, row by row."""
    rng = np.random.default_rng(4)
    y = rng.random(400) < 0.4
    v = np.stack([np.where(rng.random(400) < p, y, ~y) for p in (0.9, 0.8, 0.7)], 1).astype(int)
    v[rng.random(v.shape) < 0.2] = -1
    patterns, counts = np.unique(v, axis=0, return_counts=True)
    m = label_model.LabelModel(3, floor=0.999).fit(patterns, counts, start=0.1 + 0.8 * (patterns == 1).mean(1), rounds=7)
    q = np.clip(0.1 + 0.8 * (v == 1).mean(1), 0.02, 0.98)
    for _ in range(7):
        prior = (q.sum() + 1) / (len(v) + 2)
        table = np.array([[[1 + sum((q[i] if c else 1 - q[i]) for i in range(len(v)) if v[i, j] == x) for x in (-1, 0, 1)] for c in (0, 1)] for j in range(3)])
        table /= table.sum(2, keepdims=True)
        odds = [np.log(prior / (1 - prior)) + sum(np.log(table[j, 1, v[i, j] + 1] / table[j, 0, v[i, j] + 1]) for j in range(3)) for i in range(len(v))]
        q = 1 / (1 + np.exp(-np.array(odds)))
    assert np.abs(m.posterior(v) - q).max() < 1e-9
    assert (m.accuracies()[0] > m.accuracies()[2]) and m.prior == pytest.approx(prior)


def test_toxicity_counts_are_those_of_brute_force(spark, docs):
    """Scores equal the sum over a text's features, counted by hand, of weight times count, MOST at most; votes say what the lexicons hit."""
    weights = {toxicity.bin_of(f): w for f, w in (("widiot", 1.5), ("4clow", 0.25), ("wthe", -0.5))}
    scorer = toxicity.Scorer(weights, -1.0)
    for r in docs.limit(40).collect() + [type("R", (), {"text": "idiot! (idiot) idiot, idiot; idiot. Clown clowns THE the"})]:
        total = -1.0
        for f, w in (("widiot", 1.5), ("4clow", 0.25), ("wthe", -0.5)):
            n = sum(f in toxicity.token_features(t) for t in set((r.text or "").lower().split()))
            total += w * min(n, toxicity.MOST)
        assert scorer.score(r.text) == pytest.approx(1 / (1 + np.exp(-total)))
    v = toxicity.Voters({k: {"wfoo"} if k == "w0" else set() for k in toxicity.LEXICONS})
    assert v.vote("You are a foo")[: len(toxicity.LEXICONS)] == [1, -1, -1, -1, -1, -1] and v.vote("You are a foo")[7] == 1
    assert v.vote(" ".join(f"w{i}" for i in range(30)))[:7] == [0] * 7 and v.vote(None) == [-1] * 10


def test_toxicity_with_conflicting_labels_and_repeated_rows(spark):
    d, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    odd = labels.unionAll(labels.limit(50).withColumn("toxic", 1 - F.col("toxic")))
    twice = d.unionAll(d)
    a = toxicity.score_toxicity(twice, odd).collect()
    b = toxicity.score_toxicity(twice.repartition(5), odd.repartition(3)).collect()
    key = lambda rows: sorted((r.doc_id, r.score) for r in rows)
    assert key(a) == key(b) and len(a) == 2 * d.count()


def test_toxicity(spark, docs, awkward):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    big = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = toxicity.score_toxicity(big, spark.read.parquet("/root/testdata/sf0.01/labels.parquet")).collect()
    truth = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.93
    got = toxicity.score_toxicity(awkward, labels).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert toxicity.score_toxicity(awkward.limit(0), labels).count() == 0
    assert toxicity.score_toxicity(docs, labels.limit(0)).where("predicted = 1").count() == 0
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    same = lambda t: sorted((r.doc_id, round(r.score, 9)) for r in toxicity.score_toxicity(docs, t).collect())
    assert same(labels) == same(flipped)  # held-out labels are never read


def test_quality_classifier(spark, awkward):
    d, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_classifier.classify_quality(d).join(labels, "doc_id").collect()
    good, bad = [r.kept for r in rows if r.quality], [r.kept for r in rows if not r.quality]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.05
    odd = quality_classifier.classify_quality(awkward).collect()
    assert len(odd) == len(AWKWARD) and [r.score for r in odd if r.doc_id < 4] == [0, 0, 0]
    assert quality_classifier.classify_quality(awkward.limit(0)).count() == 0
    assert quality_classifier.keep_good(awkward).columns == awkward.columns


def brute_nearest(rows, every, top):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and np.any(np.array(v, float))]
    out = {}
    for q, a in good:
        if q % every == 0:
            s = sorted((-float(a @ b) / (np.sqrt(a @ a) * np.sqrt(b @ b)), i) for i, b in good if i != q)
            out[q] = [(i, round(-x, 9)) for x, i in s[:top]]
    return out


def test_ann(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((300, 12)).astype(np.float32)
    rows = [(int(i), v.tolist()) for i, v in enumerate(base)]
    rows += [(1000 + k, base[7].tolist()) for k in range(400)]  # copies of one vector
    rows += [(5000, None), (5001, [0.0] * 12), (5002, [None] * 12), (5003, [float("nan")] * 12), (5004, [float("inf")] * 12), (5005, [1.0]), (None, base[0].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("x"))
    want = brute_nearest([r for r in rows if r[1] is None or len(r[1]) == 12], 50, 5)
    got = {}
    for r in ann.nearest(df, every=50).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, round(r.score, 9))
    assert set(got) == set(want)
    hits = [len({i for i, _ in want[q]} & {i for i, _ in got[q].values()}) / len(want[q]) for q in want]
    assert np.mean(hits) >= 0.9
    assert [got[1000][k] for k in range(1, 6)] == want[1000]  # ties to the smaller ids
    assert ann.nearest(df.limit(0)).count() == 0
    assert ann.nearest(df.where("vec_id = 50")).count() == 0
    few = ann.nearest(df.where("vec_id in (50, 51, 52)")).collect()
    assert sorted(r["rank"] for r in few) == [1, 2]


def test_ann_tells_near_copies_apart(spark):
    rng = np.random.default_rng(3)
    v = np.concatenate([rng.standard_normal(64) + 0.01 * rng.standard_normal((2000, 64)), rng.standard_normal((200, 64))]).astype(np.float32)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    got = {}
    for r in ann.nearest(df, every=50).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    u = v.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    hits = []
    for q in range(0, 2000, 50):
        near = u @ u[q]
        near[q] = -9
        hits.append(len(set(np.argsort(-near)[:5].tolist()) & got[q]) / 5)
    assert np.mean(hits) >= 0.9


def test_ann_descent_improves_on_the_first_edges(spark, monkeypatch):
    """Small stretches and groups: recall of the graph rises with the rounds, and nearest() still finds nine of ten."""
    monkeypatch.setattr(ann, "CELL", 40)
    monkeypatch.setattr(ann, "GROUP_BYTES", 200_000)
    rng = np.random.default_rng(9)
    v = rng.standard_normal((1500, 16)).astype(np.float32)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    u = (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)
    nodes = spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in enumerate(u)], "id long, v binary")
    near = u @ u.T
    np.fill_diagonal(near, -9)
    true = np.argsort(-near, axis=1)[:, :8]

    def recall(rounds):
        graph = {r.id: set(np.frombuffer(r.ids, "<i8")[:8].tolist()) for r in ann.neighbour_graph(nodes, k=12, orders=2, rounds=rounds).collect()}
        return np.mean([len(graph[i] & set(true[i].tolist())) / 8 for i in range(len(u))])

    first, last = recall(0), recall(4)
    assert first < 0.5 and last > first + 0.3
    got = {}
    for r in ann.nearest(df, every=50).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert np.mean([len(got[q] & set(true[q][:5].tolist())) / 5 for q in range(0, 1500, 50)]) >= 0.9


def test_ann_on_the_table(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in d.collect()]
    want = brute_nearest(rows, 50, 5)
    got = {}
    for r in ann.nearest(d).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = r.vec_id
    assert np.mean([len({i for i, _ in want[q]} & set(got[q].values())) / len(want[q]) for q in want]) >= 0.9


def test_ann_takes_the_nearest_of_several_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 0.1]), (2, [0.1, 1.0]), (2, [-1.0, 0.0])], "vec_id long, embedding array<double>")
    got = [(r.vec_id, round(r.score, 6)) for r in sorted(ann.nearest(df, every=50).collect(), key=lambda r: r["rank"])]
    assert got == [(1, round(1 / np.sqrt(1.01), 6)), (2, round(1 / np.sqrt(1.01), 6))]


def test_ngram_join_with_many_small_groups(spark, monkeypatch):
    """Groups far smaller than a shuffle partition: the links are the same."""
    monkeypatch.setattr(ngram_join, "FRAGMENT_NGRAMS", 60)
    monkeypatch.setattr(ngram_join, "BUFFER_NGRAMS", 300)
    monkeypatch.setattr(ngram_join, "TILE_NGRAMS", 200)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    texts = near_copies(8, groups=4)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in ngram_join.ngram_join(spark.createDataFrame(texts, "doc_id long, text string"), n=4, percent=70).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == links(texts, 4, 70)


def test_quality_rules_keep_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, "a b", 5, "x", "y")], "doc_id int, text string, w int, lines string, row string").withColumn("__w", F.lit(1))
    r = quality_rules.quality_rules(df).first()
    assert (r.w, r.lines, r["row"], r["__w"], r.n_words) == (5, "x", "y", 1, 2)


def test_pipeline_stages_on_awkward_tables(spark, awkward):
    """Nulls, empty and long texts, repeated rows and ids, clashing names and empty tables, stage by stage."""
    import corpus_pipeline as p

    good = " ".join(f"word{i} other{i * 7} and plain{i * 3}." for i in range(40))
    more = spark.createDataFrame([(None, good, "a", 1), (None, good, "b", 2), (50, good + " end", "a", 3), (50, good, None, 4), (51, LONG + good, "a", 5)], "doc_id long, text string, source string, n long")
    clash = awkward.columns[4:]
    table = awkward.unionAll(more.select("*", *(F.lit("x").alias(c) for c in clash))).withColumn("__row", F.lit("kept"))
    for name, stage in p.STAGES:
        empty = stage(spark, table.limit(0), SF)
        out = stage(spark, table, SF).collect()
        assert empty.count() == 0, name
        if name != "byte-level BPE":
            assert empty.columns == table.columns, name
            assert all(r["__row"] == "kept" and r.score == "x" for r in out), name
    kept = p.rules(spark, table, SF).collect()
    assert sorted((r.doc_id is None, r.n) for r in kept if r.text.startswith("word0")) == [(False, 3), (False, 4), (True, 1), (True, 2)]
    once = p.near_duplicates(spark, table, SF).collect()
    assert sum((r.text or "").startswith("word0") for r in once) == 1 and {r.doc_id for r in once if not (r.text or "").strip()} == {1, 2, 3}
    assert next(r for r in once if (r.text or "").startswith("word0")).doc_id == 50
    mixed = Counter((r.doc_id, r.source, r.n) for r in p.mixing(spark, table, SF).collect())
    want = Counter()
    for r in mixing.place_documents(table, keep=True).collect():
        want[(r["row"].doc_id, r["row"].source, r["row"].n)] += len(r.positions)
    assert mixed == +want and not any(k[0] in (1, 2, 3) for k in mixed)
    assert sum(len(r.positions) for r in mixing.mix_sources(table).collect()) == sum(mixed.values())


def test_pipeline(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in p.STAGES[:3]:
        before, kept = kept, stage(spark, kept, SF)
        assert kept.columns == docs.columns, name
        kept = spark.createDataFrame(kept.collect(), docs.schema)
        assert kept.count() <= before.count()
    texts = [(r.doc_id, r.text) for r in kept.collect()]
    assert all(i == c for i, (_, c, _) in links(texts, 5, 80).items())
    mixed = p.STAGES[3][1](spark, kept, SF)
    assert mixed.columns == docs.columns
    want = {r.doc_id: len(r.positions) for r in mixing.mix_sources(kept).collect()}
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({k: v for k, v in want.items() if v})
    final = p.run(spark, SF).collect()
    expect = brute_bpe(texts)
    assert Counter(r.doc_id for r in final) == Counter({k: v for k, v in want.items() if v})
    assert all((r.n_tokens, r.ids_sha256, r.decoded_sha256) == expect[r.doc_id] for r in final)


def test_bpe_memory_of_a_large_batch():
    """Arrays over 12 MB of text in one batch stay small, and memos go when a worker is done."""
    import tracemalloc
    from types import SimpleNamespace

    import numpy as np
    import pyarrow as pa
    import public_tokenizers

    from textmill.llm import bpe, common, quality_classifier

    held = []
    docs = SimpleNamespace(sparkSession=None, selectExpr=lambda *a: SimpleNamespace(mapInArrow=lambda f, schema: held.append(f)))
    prepare, bpe.prepare = bpe.prepare, lambda spark: None
    try:
        bpe.encode_decode(docs, ranks=public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern=public_tokenizers.PATTERN)
    finally:
        bpe.prepare = prepare
    rng = np.random.default_rng(0)
    words = np.array(["the", "river", "was", "cold", "snowfall", "a", "of", "meanings", "zqxv"])
    texts = [" ".join(words[rng.integers(0, len(words), 20_000)]) for _ in range(120)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(120), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    first = list(held[0](iter([batch.slice(0, 1)])))  # the model is loaded
    tracemalloc.start()
    out = list(held[0](iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(b.num_rows for b in out) == 120 and all(all(b.column("exact").to_pylist()) for b in out)
    assert out[0].slice(0, 1).to_pylist() == first[0].to_pylist()
    assert sum(map(len, texts)) > 11_000_000 and peak < 100e6, peak
    common.shingle_hashes("one two three", 2)
    quality_classifier._SHAPES["Abc"]
    assert common.word_hashes() and quality_classifier._SHAPES
    assert list(common.resting(iter, "shapes")([1, 2])) == [1, 2]
    assert not common.word_hashes() and quality_classifier._SHAPES
    assert common.resting_group(len)([1]) == 1 and not quality_classifier._SHAPES
