"""Text functions. Column functions use built-in expressions; those that need Unicode rules of Python are Arrow-batched pandas functions and say so."""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACES = r"\s+"


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value evaluated once a row; within a lambda it would be evaluated for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    """All white space off both ends; trim() takes spaces alone."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    """White space runs become one space, ends are stripped, null becomes empty."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), SPACES, " "))


def present(c: Column) -> Column:
    """Not null and not blank."""
    return F.coalesce(strip(c) != "", F.lit(False))


def or_default(c: Column, default: str = "") -> Column:
    """Stripped text, or the default for null and blank."""
    s = strip(c)
    return F.when(F.coalesce(s, F.lit("")) == "", F.lit(default)).otherwise(s)


def simple_tokens(c: Column, stop_words: Sequence[str] = (), min_len: int = 2) -> Column:
    """Lower-cased words between white space of at least min_len characters that are not stop words."""
    tokens = F.split(F.lower(squeeze(c)), " ")
    keep = lambda t: (F.length(t) >= max(1, min_len)) & (~t.isin(list(stop_words)) if stop_words else F.lit(True))
    return F.filter(tokens, keep)


def words(c: Column) -> Column:
    """Runs of letters and digits of the lower-cased text."""
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"([\p{L}\p{N}]+)"), 1)


def counted(members: Column) -> Column:
    """(member, k) of each distinct member of an array and how often it stands there, by sorting: n log n in a row, without a shuffle."""

    def runs(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        return once(starts, lambda at: F.transform(at, lambda b, j: F.struct(F.get(s, b).alias("member"), (F.coalesce(F.get(at, j + 1), F.size(s)) - b).alias("k"))))

    return F.when(F.size(members) > 0, once(F.array_sort(members), runs))


def shingles(tokens: Column, size: int = 3) -> Column:
    """Distinct n-grams of a token array, as strings; empty if there are fewer tokens."""
    grams = lambda t: F.transform(F.sequence(F.lit(1), F.size(t) - size + 1), lambda i: F.array_join(F.slice(t, i, size), " "))
    return once(tokens, lambda t: F.when(F.size(t) >= size, F.array_distinct(grams(t))).otherwise(F.array().cast("array<string>")))


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all members of two sets; null if either is empty."""
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def terms(c: Column, separator: str = "|") -> Column:
    """Members of a multi-valued text, trimmed, blanks dropped; null gives an empty array."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), re.escape(separator)), strip), lambda x: x != "")


def term_set(c: Column) -> Column:
    return F.array_distinct(terms(c))


def join_terms(c: Column, separator: str = "|") -> Column:
    return F.array_join(c, separator)


FRENCH = ("français", "fr", "fra")


def applies_elision(language: Column) -> Column:
    """Whether a pipe list of languages names French."""
    return F.arrays_overlap(F.transform(terms(language), lambda x: F.lower(x)), F.array(*map(F.lit, FRENCH)))


def slug(c: Column) -> Column:
    """Lower-case ASCII with underscores; accents of Latin letters are dropped."""
    plain = F.translate(F.lower(c), "àâäáãåçèéêëìíîïñòóôöõùúûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy")
    return F.regexp_replace(F.regexp_replace(plain, r"[^a-z0-9]+", "_"), r"^_+|_+$", "")


def redact(c: Column, parameters: Sequence[str] = ("key_identity", "key_credential", "token", "api_key")) -> Column:
    """Hides the values of credential parameters in texts and URLs, plain or percent-encoded."""
    return F.regexp_replace(c, rf"(?i)((?:{'|'.join(parameters)})(?:=|%3[dD]))[^&\s\"']+", "$1***")


def mean_ttr(tokens: Column, window: int = 50) -> Column:
    """Moving-average type-token ratio: mean share of distinct tokens over all windows; null if there are fewer tokens than the window. For long texts use mattr_udf, whose work does not grow with the window."""

    def mean(t: Column) -> Column:
        n = F.size(t)
        parts = F.transform(F.sequence(F.lit(1), n - window + 1), lambda i: F.size(F.array_distinct(F.slice(t, i, window))) / F.lit(window))
        return F.when(n >= window, F.aggregate(parts, F.lit(0.0), lambda s, x: s + x) / (n - window + 1))

    return once(tokens, mean)


@F.pandas_udf(T.DoubleType())
def mattr_udf(tokens: pd.Series, window: pd.Series) -> pd.Series:
    """As mean_ttr, with counts kept up from window to window."""

    def one(ts, w) -> float | None:
        if ts is None or len(ts) < w or w < 1:
            return None
        counts: dict[str, int] = {}
        total = 0
        for i, t in enumerate(ts):
            counts[t] = counts.get(t, 0) + 1
            if i >= w:
                old = ts[i - w]
                counts[old] -= 1
                if not counts[old]:
                    del counts[old]
            if i >= w - 1:
                total += len(counts)
        return total / w / (len(ts) - w + 1)

    return pd.Series([one(t, w) for t, w in zip(tokens, window, strict=True)], dtype="float64")


#: Clitics that French elides, and words in which an apostrophe is no elision.
ELIDED = frozenset("l d j m n s t c qu jusqu lorsqu puisqu quoiqu".split())
WHOLE = frozenset("aujourd'hui quelqu'un quelqu'une".split())
APOSTROPHES = str.maketrans({"’": "'", "ʼ": "'", "‘": "'", "`": "'", "´": "'"})
#: Capital N or M before a capital: names such as N'Guessan, in which the apostrophe is no elision.
NAME = re.compile(r"(?<!\w)[NM]'[^\W\d_a-zà-ÿ][^\W\d_]*")


def _marks() -> str:
    """All combining marks, of every script, as ranges for a character class."""
    spans: list[list[int]] = []
    for c in range(0x300, 0x110000):
        if unicodedata.category(chr(c))[0] == "M":
            if spans and spans[-1][1] == c - 1:
                spans[-1][1] = c
            else:
                spans.append([c, c])
    return "".join(chr(a) if a == b else f"{chr(a)}-{chr(b)}" for a, b in spans)


@functools.cache
def _word() -> re.Pattern:
    inside = rf"(?:\w|[{_marks()}])"
    return re.compile(rf"\w{inside}*(?:'(?=[^\W_]){inside}+)*")


def cut_words(text: str | None, french: bool = True) -> list[str]:
    """Lower-cased words after NFC and straightened apostrophes: runs of letters, digits and _, with the combining marks of any script inside; an apostrophe before a letter or digit is inside too. With French rules an elided clitic is a word of its own, unless a name (N' or M' before a capital) or a fixed word holds it."""
    if not text:
        return []
    plain = unicodedata.normalize("NFC", text).translate(APOSTROPHES)
    found = _word().findall(plain.lower())
    if not french:
        return found
    names = {m.lower() for m in NAME.findall(plain)}
    out: list[str] = []
    for w in found:
        while w not in names and w not in WHOLE:
            head, mark, tail = w.partition("'")
            if not (mark and tail and head in ELIDED):
                break
            out.append(head + mark)
            w = tail
        out.append(w)
    return out


@F.pandas_udf(T.ArrayType(T.StringType()))
def tokenize_words(text: pd.Series, french: pd.Series) -> pd.Series:
    return pd.Series([cut_words(t, bool(f)) for t, f in zip(text, french, strict=True)])


@F.pandas_udf(T.LongType())
def count_words(text: pd.Series, french: pd.Series) -> pd.Series:
    """Words of a text, 0 for null and empty ones."""
    return pd.Series([len(cut_words(t, bool(f))) for t, f in zip(text, french, strict=True)], dtype="int64")


#: Characters that are written in another way.
REPLACED = str.maketrans({"“": '"', "”": '"', "„": '"', "«": '"', "»": '"', "’": "'", "‘": "'", "‚": "'", "–": "-", "—": "-", " ": " ", " ": " ", "ﬁ": "fi", "ﬂ": "fl", "œ": "oe", "æ": "ae"})


@F.pandas_udf(T.StringType())
def normalize_text(text: pd.Series) -> pd.Series:
    """NFC, plain quotes, dashes, ligatures and spaces."""
    return text.map(lambda t: None if t is None else re.sub(r"[ \t]+", " ", unicodedata.normalize("NFC", t).translate(REPLACED)).strip())


@F.pandas_udf(T.StringType())
def normalize_token(token: pd.Series) -> pd.Series:
    """Lower case, underscores to spaces, accents dropped, letters, digits, spaces and hyphens kept."""

    def one(t: str | None) -> str | None:
        if t is None:
            return None
        plain = "".join(c for c in unicodedata.normalize("NFKD", t.lower().replace("_", " ")) if not unicodedata.combining(c))
        return " ".join("".join(c for c in plain if c.isalnum() or c in " -").split())

    return token.map(one)


def whitespace_chunks(text: str | None, limit: int) -> list[str]:
    """Pieces of at most limit characters that end at the last space, if there is one."""
    out, rest = [], text or ""
    while len(rest) > limit:
        at = rest.rfind(" ", 1, limit + 1)
        at = at if at > 0 else limit
        out.append(rest[:at])
        rest = rest[at:].lstrip(" ")
    return [*out, rest] if rest else out


@F.pandas_udf(T.ArrayType(T.StringType()))
def chunk_on_whitespace(text: pd.Series, limit: pd.Series) -> pd.Series:
    return pd.Series([whitespace_chunks(t, int(n)) for t, n in zip(text, limit, strict=True)])


def byte_chunks(text: str | None, size: int, overlap: int) -> list[str]:
    """Chunks of at most size UTF-8 bytes, cut at a space in their second half where there is one; each begins up to overlap bytes (a quarter of size at most) before the last one's end. Together they hold all of the text."""
    out, start, n = [], 0, len(text or "")
    overlap = min(overlap, size // 4)
    widths = [len(c.encode("utf-8", "surrogatepass")) for c in text or ""]
    while start < n:
        end, used = start, 0
        while end < n and used + widths[end] <= size:
            used += widths[end]
            end += 1
        end = max(end, start + 1)
        if end < n:
            half = start + (end - start) // 2
            space = text.rfind(" ", half, end)
            end = space + 1 if space > half else end
        out.append(text[start:end])
        if end >= n:
            break
        back, place = 0, end
        while place > start + 1 and back + widths[place - 1] <= overlap:
            place -= 1
            back += widths[place]
        start = place
    return out


@F.pandas_udf(T.ArrayType(T.StringType()))
def chunk_bytes(text: pd.Series, size: pd.Series, overlap: pd.Series) -> pd.Series:
    return pd.Series([byte_chunks(t, int(s), int(o)) for t, s, o in zip(text, size, overlap, strict=True)])


def token_chunks(tokens: Column, size: int) -> Column:
    """Chunks of size tokens; a last chunk of under a quarter of size joins the one before."""
    return once(tokens, lambda t: _token_chunks(t, size))


def _token_chunks(tokens: Column, size: int) -> Column:
    n = F.size(tokens)
    whole, tail = F.floor(n / size).cast("int"), n % size
    count = F.greatest(F.when((tail > 0) & ((tail * 4 >= size) | (whole == 0)), whole + 1).otherwise(whole), F.lit(1))
    part = lambda i: F.slice(tokens, i * size + 1, F.when(i == count - 1, n).otherwise(F.lit(size)))
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), count - 1), part)).otherwise(F.array().cast("array<array<string>>"))


def spread(chunks: Column, most: int) -> Column:
    """At most `most` chunks, evenly spaced over the array, first and last included."""
    n = F.size(chunks)
    if most == 1:
        return F.slice(chunks, 1, 1)
    places = F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda i: F.bround(i * (n - 1) / F.lit(most - 1)).cast("int")))
    return F.when(n <= most, chunks).otherwise(F.transform(places, lambda i: F.get(chunks, i)))


def join_collocations(tokens: Sequence[str], phrases: Sequence[tuple[str, ...]]) -> list[str]:
    """Longest phrases first, their tokens joined by underscores."""
    by_first: dict[str, list[tuple[str, ...]]] = {}
    for p in sorted(phrases, key=len, reverse=True):
        by_first.setdefault(p[0], []).append(p)
    out, i = [], 0
    while i < len(tokens):
        hit = next((p for p in by_first.get(tokens[i], ()) if tuple(tokens[i : i + len(p)]) == p), None)
        out.append("_".join(hit) if hit else tokens[i])
        i += len(hit) if hit else 1
    return out


def collocations_udf(phrases: Sequence[tuple[str, ...]]):
    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(tokens: pd.Series) -> pd.Series:
        return tokens.map(lambda t: join_collocations(list(t), phrases) if t is not None else None)

    return run


def without(tokens: Column, dropped: Sequence[str]) -> Column:
    """Tokens that are not in the list; repeats stay."""
    return F.filter(tokens, lambda t: ~t.isin(list(dropped))) if dropped else tokens


VOWELS = re.compile(r"[aeiouyàâäéèêëîïôöùûüÿœæ]+")


def french_reading_ease(text: str | None, least_words: int = 100, least_sentences: int = 3, longest: int = 100) -> float | None:
    """Kandel-Moles: 207 - 1.015 words per sentence - 73.6 syllables per word; null without enough words and sentences, or with sentences too long to be sentences."""
    ws = cut_words(text)
    sentences = [s for s in re.split(r"[.!?…]+", text or "") if cut_words(s)]
    if len(ws) < least_words or len(sentences) < least_sentences or len(ws) > longest * len(sentences):
        return None
    syllables = 0
    for w in ws:
        low = w.lower()
        k = len(VOWELS.findall(low))
        syllables += max(1, k - (k > 1 and low.endswith(("e", "es", "ent"))))
    return round(207 - 1.015 * len(ws) / len(sentences) - 73.6 * syllables / len(ws), 4)


@F.pandas_udf(T.DoubleType())
def reading_ease(text: pd.Series) -> pd.Series:
    return pd.Series([french_reading_ease(t) for t in text], dtype="float64")


def parse_topk(c: Column) -> Column:
    """'id:prob|...' as an array of (topic, prob), largest first; empty if any part is malformed, out of 0..1, repeated, or the sum passes 1.001."""
    parts = F.transform(terms(c), lambda x: F.struct(F.get(F.split(x, ":"), F.lit(0)).try_cast("int").alias("topic"), F.get(F.split(x, ":"), F.lit(1)).try_cast("double").alias("prob")))
    ok = F.forall(parts, lambda p: p["topic"].isNotNull() & (p["topic"] >= 0) & p["prob"].isNotNull() & p["prob"].between(0, 1))
    ok = ok & (F.size(F.array_distinct(F.transform(parts, lambda p: p["topic"]))) == F.size(parts)) & (F.aggregate(parts, F.lit(0.0), lambda s, p: s + F.coalesce(p["prob"], F.lit(9.0))) <= 1.001)
    order = lambda a, b: F.when(a["prob"] > b["prob"], -1).when(a["prob"] < b["prob"], 1).when(a["topic"] < b["topic"], -1).when(a["topic"] > b["topic"], 1).otherwise(0)
    empty = F.array().cast("array<struct<topic:int,prob:double>>")
    return F.when(F.coalesce(ok, F.lit(False)), F.array_sort(parts, order)).otherwise(empty)


def format_neighbours(c: Column) -> Column:
    """Array of (id, score) as 'id:0.1234|...'; null if empty."""
    return F.when(F.size(c) > 0, F.array_join(F.transform(c, lambda x: F.concat(x["id"], F.lit(":"), F.format_string("%.4f", x["score"]))), "|"))


def parse_neighbours(c: Column) -> Column:
    """'id:score|...' as an array of (id, score); malformed parts raise."""
    return F.transform(terms(c), lambda x: F.struct(F.regexp_extract(x, r"^(.*):[^:]*$", 1).alias("id"), F.regexp_extract(x, r"^.*:([^:]*)$", 1).cast("double").alias("score")))


def document_prompt(text: Column, title: Column | None = None) -> Column:
    """Prompt of a document for an encoder of texts."""
    return F.concat(F.lit("title: "), F.coalesce(title, F.lit("none")) if title is not None else F.lit("none"), F.lit(" | text: "), F.coalesce(text, F.lit("")))


def query_prompt(query: Column) -> Column:
    return F.concat(F.lit("task: search result | query: "), F.coalesce(query, F.lit("")))


def batches_by_budget(lengths: Sequence[int], budget: int) -> Iterator[list[int]]:
    """Places of items in batches, shortest first, so that size times longest stays in the budget; an item over the budget is alone."""
    batch: list[int] = []
    for i in sorted(range(len(lengths)), key=lambda k: (lengths[k], k)):
        if batch and (len(batch) + 1) * lengths[i] > budget:
            yield batch
            batch = []
        batch.append(i)
    if batch:
        yield batch
