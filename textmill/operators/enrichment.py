"""Computed columns with their provenance, and the rules by which rows take part in them."""

from __future__ import annotations

import importlib.metadata
import platform
import re
import unicodedata
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
import pyspark
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.functions import dates as dt
from textmill.functions import text as tx
from textmill.functions.hashing import config_fingerprint, input_fingerprint, provenance
from textmill.functions.numbers import valid_vector
from textmill.operators.contracts import ContractError

MODES = ("missing", "all", "incompatible")


def needs_update(column: str, inputs: Sequence[Column], settings: Mapping, mode: str) -> Column:
    """Rows whose computed column is to be made anew: missing: it is null; incompatible: it is null or its inputs or settings have changed; all."""
    if mode not in MODES:
        raise ValueError(f"mode {mode} is none of {', '.join(MODES)}")
    if mode == "all":
        return F.lit(True)
    if mode == "missing":
        return F.col(column).isNull()
    fits = F.col(f"{column}_input_hash").eqNullSafe(input_fingerprint(*inputs)) & F.col(f"{column}_config_hash").eqNullSafe(F.lit(config_fingerprint(dict(settings))))
    return F.col(column).isNull() | ~fits


def enrich(df: DataFrame, column: str, value: Column, inputs: Sequence[Column], settings: Mapping, *, mode: str = "missing") -> DataFrame:
    """Sets a computed column and its three provenance columns where `mode` asks for it; other rows keep what they have. Columns that the table lacks are added."""
    names = [f"{column}_input_hash", f"{column}_config_hash", f"{column}_config_json"]
    kind = df.select(value.alias("v")).schema["v"].dataType
    base = df.withColumns({column: F.lit(None).cast(kind)}) if column not in df.columns else df
    base = base.withColumns({n: F.lit(None).cast("string") for n in names if n not in base.columns})
    due = base.withColumn("__due", needs_update(column, inputs, settings, mode))
    fresh = {column: value} | provenance(column, list(inputs), dict(settings), F.lit(True))
    done = due.withColumn("__value", F.struct(*(c.alias(n) for n, c in fresh.items())))
    return done.withColumns({n: F.when(F.col("__due"), F.col(f"__value.{n}")).otherwise(F.col(n)) for n in fresh}).drop("__due", "__value")


def enrich_words(df: DataFrame, text: str, language: str, *, column: str = "n_words", mode: str = "missing") -> DataFrame:
    """Word counts with provenance; null and blank texts count 0."""
    value = tx.count_words(F.col(text), tx.applies_elision(F.col(language)))
    return enrich(df, column, value, [F.col(text), F.col(language)], {"tokenizer": 3, "column": text}, mode=mode)


def enrich_richness(df: DataFrame, text: str, language: str, *, window: int = 50, column: str = "richness", mode: str = "missing") -> DataFrame:
    """Moving-average type-token ratio with provenance; null for texts of under a window."""
    words = tx.tokenize_words(F.col(text), tx.applies_elision(F.col(language)))
    return enrich(df, column, F.round(tx.mattr_udf(words, F.lit(window)), 4), [F.col(text), F.col(language)], {"tokenizer": 3, "window": window}, mode=mode)


def enrich_readability(df: DataFrame, text: str, language: str, *, column: str = "readability", mode: str = "missing") -> DataFrame:
    """Reading ease of French texts with provenance; null for other languages and for texts without enough words and sentences."""
    value = F.when(tx.applies_elision(F.col(language)), tx.reading_ease(F.col(text)))
    return enrich(df, column, value, [F.col(text), F.col(language)], {"formula": "kandel-moles"}, mode=mode)


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], types: Mapping[str, str]) -> DataFrame:
    """fn over batches of rows; the columns that it returns are declared, all others go through as they are. A batch that comes back with other rows or lacks a declared column raises."""
    kept = [f for f in df.schema if f.name not in types]
    schema = T.StructType([*kept, *T._parse_datatype_string(", ".join(f"`{n}` {t}" for n, t in types.items()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = fn(pdf)
            if len(out) != len(pdf) or any(n not in out for n in types):
                raise ValueError("a batch came back with other rows or without a declared column")
            yield pd.concat([pdf[[f.name for f in kept]].reset_index(drop=True), out[list(types)].reset_index(drop=True)], axis=1)

    return df.mapInPandas(run, schema)


# lemmas ---------------------------------------------------------------------------------------------------------------

#: Clitics that a tokenizer cuts off English words.
ENGLISH_CLITICS = frozenset("'s 're 've 'll 'd 'm n't".split())
TOKEN = "array<struct<text:string,lemma:string,space:boolean,stop:boolean>>"


def is_lemma_word(text: str) -> bool:
    """Letters, with their marks, joined by single inner hyphens or apostrophes."""
    parts = re.split(r"[-']", text)
    kinds = [[unicodedata.category(c)[0] for c in p] for p in parts]
    return bool(text) and all(k and "L" in k and set(k) <= {"L", "M"} for k in kinds)


def lemma_pairs(tokens: Sequence[tuple[str, str | None, bool, bool]]) -> list[tuple[str, bool]]:
    """(lemma, is a stop word) of the tokens (text, lemma, whether space follows, is a stop word) that are words: clitics fall out, transliterations and names that the tokenizer cut at an apostrophe are put together again, a missing or odd lemma gives way to the text."""
    straight = [((t or lemma or "").translate(tx.APOSTROPHES), (lemma or "").translate(tx.APOSTROPHES).lower(), space, stop) for t, lemma, space, stop in tokens]
    out, i = [], 0
    while i < len(straight):
        text, lemma, space, stop = straight[i]
        after = straight[i + 1][0] if i + 1 < len(straight) and not space else None
        low, head = text.lower(), text[:-1]
        if after == "'" and low in tx.ELIDED:
            i += 2
            continue
        if after and text.endswith("'") and is_lemma_word(head) and is_lemma_word(after):
            name = head in ("N", "M") and after[:1].isupper()
            if name or head.lower() not in tx.ELIDED:
                out.append((f"{text}{after}".lower(), False))
                i += 2
                continue
        i += 1
        clitic = low in ENGLISH_CLITICS or low.endswith("'") and low[:-1] in tx.ELIDED
        if not clitic and is_lemma_word(text):
            out.append((lemma if is_lemma_word(lemma) else low, bool(stop)))
    return out


#: What a row's lemmas come as.
LEMMAS = T.StructType([T.StructField("lemmas", T.StringType()), T.StructField("content", T.StringType())])


@F.pandas_udf(LEMMAS)
def join_lemmas(tokens: pd.Series) -> pd.DataFrame:
    """Lemmas of a row's tokens, all of them and those that are no stop words, joined by spaces; null without tokens."""
    rows = []
    for ts in tokens:
        pairs = None if ts is None else lemma_pairs([(t["text"], t["lemma"], t["space"], t["stop"]) for t in ts])
        rows.append((None, None) if pairs is None else (" ".join(p for p, _ in pairs), " ".join(p for p, stop in pairs if not stop)))
    return pd.DataFrame(rows, columns=["lemmas", "content"])


def lemmatise(df: DataFrame, text: str, language: str, tag: Callable[[str], Sequence[tuple[str, str | None, bool, bool]]], languages: Sequence[str], *, limit: int = 100_000) -> DataFrame:
    """Adds lemmas and content of rows whose one language is among `languages`, by a tagger that the caller has; rows of several or of unknown languages get null, blank texts empty strings. Long texts go to the tagger in pieces that end at white space, and give what one piece would."""

    @F.pandas_udf(LEMMAS)
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            pairs = [p for part in tx.whitespace_chunks(t, limit) for p in lemma_pairs(tag(part))]
            rows.append((" ".join(p for p, _ in pairs), " ".join(p for p, stop in pairs if not stop)))
        return pd.DataFrame(rows, columns=["lemmas", "content"])

    labels = F.transform(tx.terms(F.col(language)), lambda x: F.lower(x))
    mine = (F.size(labels) == 1) & F.get(labels, F.lit(0)).isin([x.lower() for x in languages])
    out = df.withColumn("__l", F.when(mine, run(F.coalesce(F.col(text), F.lit("")))))
    return out.withColumns({"lemmas": F.col("__l.lemmas"), "content": F.col("__l.content")}).drop("__l")


# who takes part --------------------------------------------------------------------------------------------------------


def pair_eligibility(df: DataFrame, key: str, vector: str, text: str, date: str, *, shingle_size: int = 3, max_days: int | None = None) -> DataFrame:
    """(key, reason): why a row cannot be compared with others, the last reason that applies; empty if it can. A day is needed only if pairs are bounded in days."""
    few = F.size(tx.words(F.col(text))) < shingle_size
    day = dt.parse_partial(F.col(date))["precision"] == "day"
    reason = F.when(~valid_vector(F.col(vector)), "missing_or_invalid_vector").when(few, "text_shorter_than_shingle").otherwise("")
    if max_days is not None:
        reason = F.when(~F.coalesce(day, F.lit(False)), "exact_date_required").otherwise(reason)
    return df.select(F.col(key).cast("string").alias(key), reason.alias("reason"))


def require_one_space(df: DataFrame, vector: str, config_hash: str, *, allow_unverified: bool = False) -> DataFrame:
    """df, if its vectors have one size and one provenance; rows without provenance need leave."""
    known = F.nullif(F.col(config_hash), F.lit(""))
    s = df.where(valid_vector(F.col(vector))).agg(F.count_distinct(F.size(vector)).alias("sizes"), F.count_distinct(known).alias("spaces"), F.count_if(known.isNull()).alias("unverified")).first()
    if s.sizes > 1 or s.spaces > 1:
        raise ContractError(f"{s.sizes} sizes and {s.spaces} provenances of vectors: they cannot be compared")
    if s.unverified and not allow_unverified:
        raise ContractError(f"{s.unverified} vectors without provenance")
    return df


def near_duplicate_label(table: Column, space: Column, calibrated: Mapping[str, str]) -> Column:
    """near_duplicate where thresholds were calibrated for the table's vector space, else uncalibrated_similarity."""
    known = F.lit(False)
    for name, config in calibrated.items():
        known = known | ((table == name) & (space == config))
    return F.when(F.coalesce(known, F.lit(False)), "near_duplicate").otherwise("uncalibrated_similarity")


def with_topic(df: DataFrame, topic: str, model: str) -> DataFrame:
    """Rows with a whole topic number of 0 and over; each of them must name its model."""
    t = F.col(topic).cast("double")
    named = F.when(tx.present(F.col(model)), F.col(model)).otherwise(F.raise_error(F.lit("a row with a topic does not name its model")).cast("string"))
    return df.where((t >= 0) & (t == F.floor(t))).withColumn(topic, t.cast("int")).withColumn(model, named)


def training_rows(df: DataFrame, text: str, language: str, wanted: str, group: str, *, least: int = 20, limit: int | None = None, key: str | None = None) -> DataFrame:
    """Rows that a topic model learns from: of the one language, with a text of `least` words between white space and a group. limit: the first rows by key, where a smaller model is asked for."""
    n = F.size(F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"\s+"), lambda w: w != ""))
    rows = df.where((F.trim(F.col(language)) == wanted) & (n >= least) & tx.present(F.col(group)))
    return rows.orderBy(key).limit(limit) if limit else rows


def require_rows(df: DataFrame, columns: Sequence[str], label: str = "table") -> DataFrame:
    """df, if it has the columns and a row."""
    missing = [c for c in columns if c not in df.columns]
    if missing or not df.limit(1).count():
        raise ContractError(f"{label}: no rows" if not missing else f"{label}: missing {', '.join(missing)}")
    return df


def row_restrictions(df: DataFrame, key: str, public: str, private: str) -> DataFrame:
    """(key, restricted): the private columns of rows that are public, sorted; rows whose flag is null or false are left out, and a public row without a list of its private columns raises."""
    listed = F.when(F.col(private).isNotNull() & F.forall(private, lambda x: x.isNotNull()), F.array_sort(F.array_distinct(private))).otherwise(F.raise_error(F.concat(F.lit("no list of private columns: "), F.col(key).cast("string"))).cast("array<string>"))
    return df.where(F.coalesce(F.col(public), F.lit(False))).select(key, listed.alias("restricted"))


# topics over time -------------------------------------------------------------------------------------------------------


def prevalence(df: DataFrame, theta: str, by: Sequence[str], *, cluster: str | None = None, least: int = 1) -> DataFrame:
    """(by, topic, prevalence, n_docs, n_clusters): mean mixture of each cell of at least `least` rows; rows with a null or blank cell key, or without a mixture, are left out."""
    rows = df.where(F.col(theta).isNotNull())
    for b in by:
        rows = rows.where(F.trim(F.col(b).cast("string")) != "")
    cells = rows.groupBy(*by).agg(F.count("*").alias("n_docs"), F.count_distinct(F.col(cluster) if cluster else F.lit(1)).alias("n_clusters")).where(F.col("n_docs") >= least)
    if not cluster:
        cells = cells.withColumn("n_clusters", F.col("n_docs"))
    means = rows.select(*by, F.posexplode(theta).alias("topic", "p")).groupBy(*by, "topic").agg(F.avg("p").alias("prevalence"))
    return means.join(cells, [*by]).select(*by, "topic", "prevalence", "n_docs", "n_clusters")


def prevalence_intervals(df: DataFrame, theta: str, time: str, key: str, *, cluster: str | None = None, n_boot: int = 200, seed: int = 42) -> DataFrame:
    """(time, topic, prevalence, n_docs, n_clusters, ci_low, ci_high, ci_status): yearly means with percentile intervals over rows or whole clusters; too few clusters give a status in place of an interval."""
    from textmill.operators.stats import bootstrap_mean

    rows = df.where(F.col(theta).isNotNull() & F.col(time).isNotNull()).select(time, key, *([cluster] if cluster else []), F.posexplode(theta).alias("topic", "p"))
    out = bootstrap_mean(rows, "p", key, [time, "topic"], cluster=cluster, n_boot=n_boot, seed=seed)
    return out.select(time, "topic", F.col("mean").alias("prevalence"), F.col("n").alias("n_docs"), "n_clusters", F.col("low").alias("ci_low"), F.col("high").alias("ci_high"), F.col("status").alias("ci_status"))


def trend_report(series: DataFrame, time: str, value: str, weight: str, by: Sequence[str], *, alpha: float = 0.05, reach: int = 1) -> DataFrame:
    """One row a series: weighted slope, Mann-Kendall test with p adjusted over all series, the smoothed peak, and a direction where the adjusted p is under alpha."""
    from textmill.operators import stats as st

    slopes = st.wls_slope(series, time, value, weight, by)
    tests = st.benjamini_hochberg(st.mann_kendall(series, time, value, by), "p")
    tops = st.peaks(series.select(*by, time, value), time, value, by, reach)
    out = tests.join(slopes, [*by]).join(tops, [*by])
    sure = F.coalesce(F.col("q") < alpha, F.lit(False))
    return out.withColumn("direction", F.when(sure & (F.col("s") > 0), "rising").when(sure & (F.col("s") < 0), "falling").otherwise("none"))


def prediction_report(df: DataFrame, topic: str, prob: str, model: str, wanted: str) -> DataFrame:
    """(topic, docs, share, mean_prob, suppressed): topics of the rows that this model has predicted; suppressed: rows of the table that another model or none has."""
    mine = F.coalesce(F.col(model) == wanted, F.lit(False)) & F.col(topic).isNotNull()
    total = df.agg(F.count_if(mine).alias("all"), F.count_if(~mine).alias("suppressed"))
    return df.where(mine).groupBy(topic).agg(F.count("*").alias("docs"), F.avg(prob).alias("mean_prob")).crossJoin(F.broadcast(total)).select(F.col(topic).alias("topic"), "docs", F.round(F.col("docs") / F.col("all"), 6).alias("share"), F.round("mean_prob", 6).alias("mean_prob"), "suppressed")


# settings and names -----------------------------------------------------------------------------------------------------


def resolve_settings(given: Mapping, frozen: Mapping | None, preset: Mapping, default: Mapping) -> dict:
    """What is given counts before a frozen model's settings, those before a preset, that before the defaults. None is not given; what contradicts a frozen setting raises."""
    given = {k: v for k, v in given.items() if v is not None}
    clash = sorted(k for k in given.keys() & (frozen or {}).keys() if given[k] != frozen[k])
    if clash:
        raise ContractError(f"settings differ from the frozen model's: {', '.join(clash)}")
    return {**default, **preset, **(frozen or {}), **given}


def frozen_preprocessing(stop_words: Sequence[str], exempt: Sequence[str], *, chunk_words: int, max_chunks: int | None = None, phrase_min_docs: int | None = None) -> dict:
    """What a fitted model keeps of its preprocessing: sorted stop words without the language's exemptions, and how documents are cut."""
    return {"stop_words": sorted(set(stop_words) - set(exempt)), "chunk_words": chunk_words, "max_chunks": max_chunks, "phrase_min_docs": phrase_min_docs}


def table_slug(name: str) -> str:
    """A table's name as one path segment."""
    return re.sub(r"[^A-Za-z0-9._-]+", "__", name.strip("/"))


def cache_fingerprint(model: str, *parts) -> str:
    """Names a model and what its results hang on."""
    return "_".join(re.sub(r"[^A-Za-z0-9.-]+", "-", str(p)) for p in (model, *parts) if p not in (None, ""))


def chunk_key(row_id: Column, index: Column) -> Column:
    return F.concat_ws("#", row_id.cast("string"), index.cast("string"))


def cache_entry(value: Column, fingerprint: str) -> Column:
    return F.struct(value.alias("value"), F.lit(fingerprint).alias("fingerprint"))


def versions(packages: Sequence[str] = ("pyarrow", "pandas", "numpy")) -> dict[str, str]:
    """Versions for provenance; packages that are not installed are named so."""

    def one(name: str) -> str:
        try:
            return importlib.metadata.version(name)
        except importlib.metadata.PackageNotFoundError:
            return "not installed"

    return {"python": platform.python_version(), "pyspark": pyspark.__version__, **{p: one(p) for p in packages}}
