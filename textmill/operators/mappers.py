"""Nested items to flat rows: one projection a kind of item, as column expressions over its properties.

An item row has id, title, resource_class, created, is_public, item_sets (ids), media_file, media_thumbnail, has_media and props, a map of property names to arrays of values (see functions.values). What a site knows and no item says (its address, outlets' countries, item sets' countries, class names) comes as a Site.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions import dates as dt
from textmill.functions import text as tx
from textmill.functions import values as vs
from textmill.functions.numbers import whole

ITEM = f"id long, title string, resource_class string, created string, is_public boolean, item_sets array<string>, media_file string, media_thumbnail string, has_media boolean, props {vs.PROPERTIES}"


@dataclass(frozen=True)
class Site:
    """What mappers need besides the items."""

    address: str = "https://example.org"
    language: str = "fr"
    outlet_countries: Mapping[str, str] = field(default_factory=dict)
    item_set_countries: Mapping[str, str] = field(default_factory=dict)
    class_names: Mapping[str, str] = field(default_factory=dict)
    identifier_prefix: str = ""
    #: Columns that each property feeds, for the list of private ones.
    columns_of: Mapping[str, Sequence[str]] = field(default_factory=dict)


def page_url(site: Site) -> Column:
    return F.concat(F.lit(f"{site.address.rstrip('/')}/item/"), F.col("id").cast("string"))


def manifest_url(site: Site) -> Column:
    return F.concat(F.lit(f"{site.address.rstrip('/')}/iiif/"), F.col("id").cast("string"), F.lit("/manifest"))


def _date(name: str = "dcterms:date") -> dict[str, Column]:
    raw = vs.display(F.col("props"), name)
    parsed = dt.parse_partial(raw)
    return {"pub_date": raw, "pub_year": parsed["year"], "pub_date_precision": parsed["precision"]}


def _linked(column: str, name: str) -> dict[str, Column]:
    """A column and the ids of what it links to."""
    return {column: vs.display(F.col("props"), name), f"{column}_ids": vs.resource_ids(F.col("props"), name)}


def _content() -> dict[str, Column]:
    return {"content": vs.display(F.col("props"), "bibo:content"), "content_is_public": vs.is_public(F.col("props"), "bibo:content")}


def _head(site: Site, identifier: Column | None = None) -> dict[str, Column]:
    p = F.col("props")
    return {
        "id": F.col("id").cast("string"),
        "item_is_public": F.coalesce(F.col("is_public"), F.lit(False)),
        "private_fields": vs.private_columns(p, {k: list(v) for k, v in site.columns_of.items()}) if site.columns_of else F.array().cast("array<string>"),
        "identifier": vs.display(p, "dcterms:identifier") if identifier is None else identifier,
        "added_date": F.coalesce(dt.added_date(F.col("created")), F.lit("")),
        "page_url": page_url(site),
    }


def _media(site: Site, file_column: str = "file", *, needs_file: bool = True) -> dict[str, Column]:
    """Addresses of the file, of a thumbnail, and of a manifest, which stands only where there is a file to show; needs_file: so does the thumbnail."""
    have = tx.present(F.col("media_file"))
    thumb = F.coalesce(F.col("media_thumbnail"), F.lit(""))
    return {
        "manifest": F.when(have, manifest_url(site)).otherwise(F.lit("")),
        file_column: F.coalesce(F.col("media_file"), F.lit("")),
        "thumbnail": F.when(have, thumb).otherwise(F.lit("")) if needs_file else F.when(F.coalesce("has_media", F.lit(False)), thumb).otherwise(F.lit("")),
    }


def _subjects() -> dict[str, Column]:
    return _linked("subject", "dcterms:subject") | _linked("spatial", "dcterms:spatial")


def _summaries(site: Site) -> dict[str, Column]:
    p = F.col("props")
    summary = lambda lang, **kw: F.coalesce(vs.by_language(p, "bibo:shortDescription", lang, **kw), F.lit(""))
    return {"summary": summary(site.language, untagged=True), "summary_en": summary("en")}


def _outlet_country(site: Site, outlet: Column) -> Column:
    """The country of the first outlet of a pipe list that the site knows; names are compared without case and outer space."""
    table = {k.strip().lower(): v for k, v in site.outlet_countries.items()}
    return vs.first_known(F.transform(tx.terms(outlet), lambda x: F.lower(x)), table) if table else F.lit("")


def _set_countries(site: Site, *, first: bool = True) -> Column:
    if not site.item_set_countries:
        return F.lit("")
    sets = F.coalesce(F.col("item_sets"), F.array().cast("array<string>"))
    return (vs.first_known if first else vs.all_known)(sets, dict(site.item_set_countries))


def _project(items: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    return items.select(*(c.alias(name) for name, c in columns.items()))


def map_articles(items: DataFrame, site: Site) -> DataFrame:
    p = F.col("props")
    outlet = vs.display(p, "dcterms:publisher")
    return _project(items, {
        **_head(site), **_media(site), "title": vs.display(p, "dcterms:title"), **_linked("author", "dcterms:creator"), **_linked("newspaper", "dcterms:publisher"),
        "country": _outlet_country(site, outlet), **_date(), **_summaries(site), **_subjects(), "language": vs.display(p, "dcterms:language"),
        "nb_pages": whole(vs.display(p, "bibo:numPages")), "url": F.coalesce(vs.uri(p, "fabio:hasURL"), F.lit("")), "source": vs.display(p, "dcterms:source"), **_content(),
    })


def map_publications(items: DataFrame, site: Site) -> DataFrame:
    p = F.col("props")
    outlet = vs.display(p, "dcterms:publisher")
    return _project(items, {
        **_head(site), **_media(site), "title": vs.display(p, "dcterms:title"), **_linked("author", "dcterms:creator"), **_linked("newspaper", "dcterms:publisher"),
        "country": _outlet_country(site, outlet), **_date(), "issue": vs.display(p, "bibo:issue"), "contents": vs.display(p, "dcterms:tableOfContents"), **_subjects(),
        "language": vs.display(p, "dcterms:language"), "nb_pages": whole(vs.display(p, "bibo:numPages")), "url": F.coalesce(vs.uri(p, "fabio:hasURL"), F.lit("")),
        "source": vs.display(p, "dcterms:source"), **_content(),
    })


def map_documents(items: DataFrame, site: Site) -> DataFrame:
    p = F.col("props")
    return _project(items, {
        **_head(site), **_media(site), "title": vs.display(p, "dcterms:title"), **_linked("author", "dcterms:creator"), "contributor": vs.display(p, "dcterms:contributor"),
        "country": _set_countries(site), **_date(), **_summaries(site), **_subjects(), "language": vs.display(p, "dcterms:language"), "type": vs.display(p, "dcterms:type"),
        "nb_pages": whole(vs.display(p, "bibo:numPages")), "source": vs.display(p, "dcterms:source"), "rights": F.coalesce(vs.rights_label(p), F.lit("")), **_content(),
    })


def map_references(items: DataFrame, site: Site) -> DataFrame:
    """Addresses that stand where an identifier belongs join the other addresses; numbers stay texts, as they may be ranges."""
    p = F.col("props")
    dois = vs.split_dois(F.transform(vs.values(p, "bibo:doi"), lambda v: F.coalesce(F.nullif(v["id"], F.lit("")), v["value"], F.lit(""))))
    urls = F.array_distinct(F.concat(tx.terms(vs.uri(p, "fabio:hasURL")), tx.terms(dois["url"])))
    abstract = vs.split_by_language(p, "dcterms:abstract")
    numbers = {n: vs.display(p, f"bibo:{prop}") for n, prop in (("chapter", "chapter"), ("volume", "volume"), ("issue", "issue"), ("edition", "edition"), ("nb_pages", "numPages"), ("page_start", "pageStart"), ("page_end", "pageEnd"))}
    identifiers = F.transform(vs.values(p, "dcterms:identifier"), lambda v: F.coalesce(v["value"], F.lit("")))
    return _project(items, {
        **_head(site, F.coalesce(vs.first_with_prefix(identifiers, site.identifier_prefix), F.lit(""))), "resource_class": vs.lookup(F.col("resource_class"), dict(site.class_names)) if site.class_names else F.col("resource_class"),
        "title": vs.display(p, "dcterms:title"), **_linked("author", "bibo:authorList"), **_linked("editor", "bibo:editorList"), "review_of": vs.display(p, "bibo:reviewOf"),
        **_linked("publisher", "dcterms:publisher"), **_date(), "type": vs.display(p, "dcterms:type"), "book_title": vs.display(p, "dcterms:alternative"), **numbers,
        "abstract": F.when(abstract["others"] != "", abstract["others"]).otherwise(abstract["tagged"]), "abstract_en": abstract["tagged"], "extent": vs.display(p, "dcterms:extent"),
        "is_part_of": vs.display(p, "dcterms:isPartOf"), "provenance": vs.display(p, "dcterms:provenance"), **_subjects(), "language": vs.display(p, "dcterms:language"),
        "doi": dois["doi"], "url": F.array_join(urls, "|"), **_content(), "country": _set_countries(site, first=False),
    })


def map_authorities(items: DataFrame, site: Site) -> DataFrame:
    p = F.col("props")
    point = vs.display(p, "curation:coordinates")
    place = dt.coordinates(point)
    return _project(items, {
        **_head(site, vs.literals(p, "dcterms:identifier")), "thumbnail": F.when(F.coalesce("has_media", F.lit(False)), F.coalesce("media_thumbnail", F.lit(""))).otherwise(F.lit("")),
        "title": F.coalesce("title", F.lit("")), "other_title": vs.display(p, "dcterms:alternative"), "type": F.coalesce(vs.lookup(F.col("resource_class"), dict(site.class_names)), F.lit("")) if site.class_names else F.col("resource_class"),
        "description": F.coalesce(vs.by_language(p, "dcterms:description", site.language, fallback=True), F.lit("")), "created": vs.display(p, "dcterms:created"), "date": vs.display(p, "dcterms:date"),
        "relation": vs.titles(p, "dcterms:relation"), "replaced_by": vs.display(p, "dcterms:isReplacedBy"), "part_of": vs.titles(p, "dcterms:isPartOf"), "spatial": vs.display(p, "dcterms:spatial"),
        "has_part": vs.titles(p, "dcterms:hasPart"), "first_name": vs.display(p, "foaf:firstName"), "last_name": vs.display(p, "foaf:lastName"), "gender": vs.titles(p, "foaf:gender"),
        "birth": vs.display(p, "foaf:birthday"), "coordinates": point, "latitude": place["lat"], "longitude": place["lng"],
    })


def map_audiovisual(items: DataFrame, site: Site) -> DataFrame:
    """The publisher is the linked authority alone; the country is that of the publisher, else of the item set."""
    p = F.col("props")
    publisher, extent = vs.titles(p, "dcterms:publisher"), vs.literals(p, "dcterms:extent")
    return _project(items, {
        **_head(site), **_media(site, needs_file=False), "url": F.coalesce(vs.uri(p, "fabio:hasURL"), F.lit("")), "title": vs.display(p, "dcterms:title"), **_linked("creator", "dcterms:creator"),
        "publisher": publisher, "publisher_ids": vs.resource_ids(p, "dcterms:publisher"), "country": vs.by_precedence(_outlet_country(site, publisher), _set_countries(site)), **_date(),
        "description": vs.display(p, "dcterms:description"), **_summaries(site), "volume": vs.literals(p, "bibo:volume"), "issue": vs.literals(p, "bibo:issue"), "is_part_of": vs.literals(p, "dcterms:isPartOf"),
        "extent": extent, "duration_seconds": dt.duration_seconds(extent), "medium": vs.titles(p, "dcterms:medium"), "type": vs.titles(p, "dcterms:type"), "rights": F.coalesce(vs.rights_label(p), F.lit("")),
        "contributor": vs.titles(p, "dcterms:contributor"), **_subjects(), "language": vs.display(p, "dcterms:language"), "source": vs.display(p, "dcterms:source"), **_content(),
    })


def map_images(items: DataFrame, site: Site) -> DataFrame:
    p = F.col("props")
    point = vs.literals(p, "curation:coordinates")
    place = dt.coordinates(point)
    return _project(items, {
        **_head(site), **_media(site, "image_url"), "title": vs.display(p, "dcterms:title"), "type": vs.titles(p, "dcterms:type"), **_linked("creator", "dcterms:creator"), **_date(),
        "description": vs.display(p, "dcterms:description"), "rights": F.coalesce(vs.rights_label(p), F.lit("")), **_subjects(), "coordinates": point, "latitude": place["lat"], "longitude": place["lng"],
        "country": _set_countries(site),
    })


MAPPERS = {
    "articles": map_articles, "publications": map_publications, "documents": map_documents, "references": map_references,
    "index": map_authorities, "audiovisual": map_audiovisual, "images": map_images,
}


@dataclass(frozen=True)
class Rater:
    """A rater of the panel: its columns are prefix_dimension, its properties ns:prefixDimension. Frozen raters are read no more."""

    prefix: str
    generation: int
    active: bool = True
    labels: bool = True

    def columns(self, dimensions: Sequence[str]) -> list[str]:
        return [f"{self.prefix}_{d}" for d in dimensions]


@dataclass(frozen=True)
class Panel:
    raters: tuple[Rater, ...]
    dimensions: tuple[str, ...]

    def active(self) -> list[Rater]:
        return [r for r in self.raters if r.active]

    def frozen(self) -> list[Rater]:
        return [r for r in self.raters if not r.active]

    def generation(self, n: int) -> list[Rater]:
        found = [r for r in self.raters if r.generation == n]
        if not found:
            raise KeyError(f"no rater of generation {n}")
        return found

    def latest(self) -> int:
        return max(r.generation for r in self.raters)

    def columns(self) -> list[str]:
        return [c for r in self.raters for c in r.columns(self.dimensions)]

    def numeric_columns(self, dimension: str) -> list[str]:
        return [f"{r.prefix}_{dimension}" for r in self.raters if not r.labels]

    def consensus_columns(self, n: int) -> list[str]:
        self.generation(n)
        return [f"consensus_g{n}_{d}" for d in self.dimensions]


def panel_columns(items: DataFrame, panel: Panel, *, namespace: str = "panel", score: str | None = None) -> DataFrame:
    """id and, for every active rater and dimension, what its property shows; an active rater that gives numbers for the scored dimension raises."""
    bad = [r.prefix for r in panel.active() if score and not r.labels]
    if bad:
        raise ValueError(f"active raters with numeric {score}: {', '.join(bad)}")
    cols = [vs.display(F.col("props"), f"{namespace}:{r.prefix}{d.title()}").alias(f"{r.prefix}_{d}") for r in panel.active() for d in panel.dimensions]
    return items.select(F.col("id").cast("string").alias("id"), *cols)


def drop_retired(df: DataFrame, retired: Sequence[str], suffixes: Sequence[str] = ("input_hash", "config_hash", "config_json")) -> DataFrame:
    """Without superseded columns and their provenance."""
    return df.drop(*retired, *(f"{c}_{s}" for c in retired for s in suffixes))
