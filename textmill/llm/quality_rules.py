"""Line-first cleaning with built-in functions only: each line is judged by its punctuation, navigation marks and boilerplate phrases; failing lines are removed; documents that lose too much text, or that were too short or too repetitive to begin with, are rejected."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"\x20\x09-\x0D"
#: Phrases of site furniture, in lower case, that condemn a short line.
BOILERPLATE = (
    "all rights reserved", "cookie policy", "accept cookies", "privacy policy", "terms of use", "terms of service", "terms and conditions",
    "subscribe to our newsletter", "sign up for our newsletter", "click here", "read more", "share this", "follow us", "log in", "sign in",
    "skip to content", "back to top", "powered by", "javascript is disabled", "lorem ipsum",
)
#: A line of at most so many words may be condemned by a phrase.
SHORT_LINE = 12


def words(text: Column) -> Column:
    """Runs of anything but ASCII white space."""
    return F.filter(F.split(text, rf"[{SPACE}]+"), lambda w: w != "")


def n_repeat_words(w: Column) -> Column:
    """Words that stand in a 3-word window found twice or more in w, counted once each, the first finding included.

    Windows are compared by 64-bit hashes. Without a repeated window, as in most texts, one distinct count decides; else hash and place are sorted together and neighbours compared, so that the work stays n log n in one row.
    """

    def windows(x: Column) -> Column:
        return F.transform(F.slice(x, 1, F.greatest(F.size(x) - 2, F.lit(0))), lambda a, i: F.xxhash64(a, F.get(x, i + 1), F.get(x, i + 2)))

    def places(v: Column) -> Column:
        at = F.array_sort(F.transform(v, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

        def starts(s: Column) -> Column:
            pairs = F.zip_with(F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s)), lambda a, b: F.when(a["x"] == b["x"], F.array(a["i"], b["i"])))
            return F.flatten(F.filter(pairs, lambda p: p.isNotNull()))

        return let(at, lambda s: F.size(F.array_distinct(F.flatten(F.transform(F.array_distinct(starts(s)), lambda p: F.array(p, p + 1, p + 2))))))

    hashed = F.transform(w, lambda x: F.xxhash64(x))
    return F.when(F.size(w) < 4, F.lit(0)).otherwise(let(hashed, lambda h: let(windows(h), lambda v: F.when(F.size(F.array_distinct(v)) == F.size(v), F.lit(0)).otherwise(places(v)))))


def let(value: Column, body) -> Column:
    """body(value), with value evaluated once a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: Marks that the rules on navigation, exclamations and symbols count.
NAVIGATION, SYMBOLS = "|»›•·", "#*$%&|<>{}~^=+@\\"
_CLASS = "[" + re.escape(NAVIGATION + SYMBOLS + "!") + "]"
#: At most SHORT_LINE runs of anything but white space; it gives up after them.
_SHORT = rf"^[{SPACE}]*+(?:[^{SPACE}]++[{SPACE}]++){{0,{SHORT_LINE - 1}}}+[^{SPACE}]*+$"


def failing_line(line: Column) -> Column:
    """True if a line's punctuation, navigation marks or boilerplate condemn it. Cheap conditions that every failing line meets stand before dear ones, so plain prose is scanned few times."""
    n = F.size(F.split(F.trim(line), rf"[{SPACE}]+"))
    chars = F.length(line)
    rest = lambda marks: chars - F.length(F.translate(line, marks, ""))
    upper = chars - F.length(F.regexp_replace(line, r"\p{Lu}+", ""))
    navigation = let(rest(NAVIGATION), lambda k: (k >= 3) & (k * 4 >= n))
    exclaims = let(rest("!"), lambda k: (k >= 3) & (k * 4 >= n))
    marked = line.rlike(_CLASS) & (navigation | exclaims | (rest(SYMBOLS) * 10 > chars))
    # four of five letters in capitals means four capitals in a row somewhere
    loud = lambda letters: (letters >= 40) & line.rlike(r"(?:\p{Lu}\P{L}*+){4}") & (upper * 10 >= letters * 8)
    letters = chars - F.length(F.regexp_replace(line, r"\p{L}+", ""))
    lettered = (chars >= 20) & let(letters, lambda k: (k * 2 < chars) | loud(k))
    furniture = line.rlike(_SHORT) & F.lower(line).rlike("|".join(BOILERPLATE)) & (n <= SHORT_LINE)
    return marked | lettered | furniture


RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_kept_words", "clean_text", "base_failed", "kept")


def quality_rules(docs: DataFrame, *, text: str = "text", min_words: int = 50, max_repeat: float = 0.5, max_lost: float = 0.4, append: bool = True) -> DataFrame:
    """Adds to each row n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_kept_words, clean_text, base_failed and kept; other columns stay, and columns of these names in docs are replaced. Without append: the rows of docs that are kept, with all columns as they are.

    Null and empty texts have no words and are rejected. kept needs min_words, at most max_repeat of the words in repeated windows, and at most max_lost of the words in lines that fail; exactly so many are allowed. Texts are judged whole, however long. Rows are judged alone, so repeated rows and ids get the same result; an empty table gives an empty one. The columns of docs travel in a struct, so no name of theirs can clash with a helper's.
    """
    t = F.col("t")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(rf"[^{SPACE}]"))
    n = F.col("n_words")
    out = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("t"))
    # CSE does not reach into lambdas: arrays that several columns need are made once, in a projection of their own
    out = out.withColumns({"w": words(t), "lines": lines})
    repeats = n_repeat_words(F.col("w")).cast("long")
    out = out.withColumns({"n_words": F.size("w").cast("long"), "n_repeat_words": repeats})
    out = out.withColumn("base_failed", (n < min_words) | (F.col("n_repeat_words") > F.lit(max_repeat) * n))
    clean = F.array_join(F.filter(F.col("lines"), lambda x: ~failing_line(x)), "\n")
    if append:
        out = out.withColumns({
            "word_chars": F.length(F.regexp_replace(t, rf"[{SPACE}]+", "")).cast("long"),
            "n_symbols": (F.length(t) - F.length(F.translate(t, "#*$%&|<>", ""))).cast("long"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
            "clean_text": clean,
        })
    else:  # lines are judged only where the verdict hangs on them
        out = out.where(~F.col("base_failed")).withColumn("clean_text", clean)
    kept_words = F.when(F.col("clean_text") == "", F.lit(0)).otherwise(F.size(F.split(F.trim(F.col("clean_text")), rf"[{SPACE}]+"))).cast("long")
    out = out.withColumn("n_kept_words", kept_words)
    kept = ~F.col("base_failed") & (n - F.col("n_kept_words") <= F.lit(max_lost) * n)
    if not append:
        return out.where(kept).select("row.*")
    old = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in RESULTS]
    return out.withColumn("kept", kept).select(*old, *RESULTS)
