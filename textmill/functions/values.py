"""Readers of nested items: a property is an array of values with value, title, id, label, rid, lang and is_public."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

VALUE = "struct<value:string,title:string,id:string,label:string,rid:long,lang:string,is_public:boolean>"
PROPERTIES = f"map<string,array<{VALUE}>>"


def values(item: Column, name: str) -> Column:
    """Values of a property; none: an empty array."""
    return F.coalesce(F.try_element_at(item, F.lit(name)), F.array().cast(f"array<{VALUE}>"))


def _some(*options: Column) -> Column:
    return F.coalesce(*(F.nullif(F.trim(o), F.lit("")) for o in options))


def _joined(parts: Column, distinct: bool = False) -> Column:
    parts = F.filter(parts, lambda x: x.isNotNull())
    return F.array_join(F.array_distinct(parts) if distinct else parts, "|")


def display(item: Column, name: str) -> Column:
    """Titles, or else values, or else ids, joined by pipes."""
    return _joined(F.transform(values(item, name), lambda v: _some(v["title"], v["value"], v["id"])))


def literals(item: Column, name: str) -> Column:
    return _joined(F.transform(values(item, name), lambda v: _some(v["value"])))


def titles(item: Column, name: str) -> Column:
    return _joined(F.transform(values(item, name), lambda v: _some(v["title"])))


def uri(item: Column, name: str) -> Column:
    """The first value's id, or its literal if that is a web address."""
    return F.get(F.filter(F.transform(values(item, name), lambda v: F.coalesce(_some(v["id"]), F.when(v["value"].rlike("^https?://"), v["value"]))), lambda x: x.isNotNull()), F.lit(0))


def rights_label(item: Column, name: str = "dcterms:rights") -> Column:
    return F.get(F.filter(F.transform(values(item, name), lambda v: _some(v["label"], v["title"], v["value"], v["id"])), lambda x: x.isNotNull()), F.lit(0))


def resource_ids(item: Column, name: str) -> Column:
    """Linked resources' ids, each once, in order, joined by pipes."""
    return _joined(F.transform(F.filter(values(item, name), lambda v: v["rid"].isNotNull()), lambda v: v["rid"].cast("string")), distinct=True)


def by_language(item: Column, name: str, lang: str, *, untagged: bool = False, fallback: bool = False) -> Column:
    """The first literal in a language; with untagged, one without a tag counts; with fallback, any."""
    have = F.filter(values(item, name), lambda v: _some(v["value"]).isNotNull())
    tagged = F.get(F.filter(have, lambda v: F.lower(v["lang"]) == lang), F.lit(0))["value"]
    options = [tagged]
    if untagged:
        options.append(F.get(F.filter(have, lambda v: _some(v["lang"]).isNull()), F.lit(0))["value"])
    if fallback:
        options.append(F.get(have, F.lit(0))["value"])
    return F.coalesce(*options)


def split_by_language(item: Column, name: str, lang: str = "en") -> Column:
    """(others, tagged): literals without and with the language, each joined by pipes."""
    have = F.filter(values(item, name), lambda v: _some(v["value"]).isNotNull())
    is_lang = lambda v: F.coalesce(F.lower(v["lang"]) == lang, F.lit(False))
    take = lambda vs: F.array_join(F.transform(vs, lambda v: F.trim(v["value"])), "|")
    return F.struct(take(F.filter(have, lambda v: ~is_lang(v))).alias("others"), take(F.filter(have, is_lang)).alias("tagged"))


DOI = r"^10\.\d{4,9}/\S+$"


def split_dois(raw: Column) -> Column:
    """(doi, url): of an array of texts, identifiers after their prefixes are taken off, and what else is a web address."""
    bare = lambda x: F.regexp_replace(F.trim(x), r"(?i)^(https?://(dx\.)?doi\.org/|doi:\s*)", "")
    doi = F.array_distinct(F.filter(F.transform(raw, bare), lambda x: x.rlike(DOI)))
    url = F.filter(F.transform(raw, lambda x: F.trim(x)), lambda x: x.rlike("(?i)^https?://") & ~bare(x).rlike(DOI))
    return F.struct(F.array_join(doi, "|").alias("doi"), F.array_join(F.array_distinct(url), "|").alias("url"))


def first_with_prefix(raw: Column, prefix: str) -> Column:
    return F.get(F.filter(F.transform(raw, lambda x: F.trim(x)), lambda x: x.startswith(prefix)), F.lit(0))


def is_public(item: Column, name: str) -> Column:
    """True if the property has values that are not empty and all of them are explicitly public."""
    have = F.filter(values(item, name), lambda v: _some(v["value"], v["title"], v["id"]).isNotNull())
    return (F.size(have) > 0) & F.forall(have, lambda v: F.coalesce(v["is_public"], F.lit(False)))


def private_columns(item: Column, columns_of: dict[str, list[str]]) -> Column:
    """Sorted columns fed by properties of which any value is not explicitly public."""
    parts = [F.when(F.exists(values(item, p), lambda v: ~F.coalesce(v["is_public"], F.lit(False))), F.array(*map(F.lit, cs))).otherwise(F.array().cast("array<string>")) for p, cs in columns_of.items()]
    return F.array_sort(F.array_distinct(F.flatten(F.array(*parts))))


def lookup(key: Column, table: dict) -> Column:
    """Label of a key; null if the table has none."""
    return F.try_element_at(F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in table.items())), key)


def first_known(keys: Column, table: dict) -> Column:
    """Label of the first key of an array that the table has, or empty."""
    return F.coalesce(F.get(F.filter(F.transform(keys, lambda k: lookup(k, table)), lambda x: x.isNotNull()), F.lit(0)), F.lit(""))


def all_known(keys: Column, table: dict) -> Column:
    """Distinct labels in order, joined by pipes."""
    return F.array_join(F.array_distinct(F.filter(F.transform(keys, lambda k: lookup(k, table)), lambda x: x.isNotNull())), "|")


def by_precedence(*labels: Column) -> Column:
    """The first label that is not empty, else empty."""
    return F.coalesce(*(F.nullif(x, F.lit("")) for x in labels), F.lit(""))
