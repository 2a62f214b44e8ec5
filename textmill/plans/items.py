"""Queries over nested items, built from the documents: every mapper, the panel's columns, and what a mapped table must keep to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions.values import VALUE
from textmill.operators import mappers as mp
from textmill.plans.corpus import read

QUERIES = {}
ORACLE_SQL = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def val(**parts: Column) -> Column:
    """A value of a property."""
    kinds = [x.split(":") for x in VALUE.removeprefix("struct<").removesuffix(">").split(",")]
    return F.struct(*((parts[n] if n in parts else F.lit(None)).cast("bigint" if t == "long" else t).alias(n) for n, t in kinds))


def items(spark: SparkSession, sf: str) -> DataFrame:
    """Nested items from documents: literals, links, repeated links, language tags, private values, addresses, partial dates."""
    k, s = F.col("doc_id"), F.col("doc_id").cast("string")
    yes, no = F.lit(True), F.lit(False)
    day = F.date_add(F.lit("1990-01-01").cast("date"), (k % 9000).cast("int"))
    date = F.when(k % 4 == 0, F.date_format(day, "yyyy-MM-dd")).when(k % 4 == 1, F.date_format(day, "yyyy-MM")).when(k % 4 == 2, F.date_format(day, "yyyy")).otherwise(F.lit("1990/1995"))
    link = val(title=F.concat(F.lit("S"), k % 7), rid=k % 7, is_public=yes)
    blank = val(value=F.lit("  "), is_public=yes)
    props = {
        "dcterms:identifier": [val(value=F.concat(F.lit("x-"), s), is_public=yes), val(value=F.concat(F.lit("id-"), s), is_public=yes)],
        "dcterms:title": [val(value=F.concat(F.lit(" Title "), s, F.lit(" ")), is_public=yes)],
        "dcterms:creator": [val(title=F.concat(F.lit("P"), k % 11), rid=k % 11, is_public=yes), val(value=F.col("lang"), is_public=k % 5 > 0)],
        "dcterms:publisher": [val(title=F.col("source"), rid=k % 20, is_public=yes)],
        "dcterms:date": [val(value=date, is_public=yes)],
        "dcterms:subject": [link, blank, link],
        "dcterms:spatial": [val(id=F.concat(F.lit("https://place/"), k % 5), is_public=yes)],
        "dcterms:language": [val(title=F.col("lang"), is_public=yes)],
        "dcterms:type": [val(value=F.lit("literal"), is_public=yes), val(title=F.lit("Linked"), is_public=yes)],
        "dcterms:rights": [val(label=F.lit(None), id=F.lit("https://rights/1"), is_public=yes)],
        "dcterms:abstract": [val(value=F.lit("English"), lang=F.lit("EN"), is_public=yes), val(value=F.when(k % 2 == 0, F.lit("Français")), lang=F.lit("fr"), is_public=yes)],
        "dcterms:description": [val(value=F.lit("any"), is_public=yes), val(value=F.when(k % 3 == 0, F.lit("tagged")), lang=F.lit("fr"), is_public=yes)],
        "dcterms:extent": [val(value=F.concat(F.lit("PT"), k % 3, F.lit("H"), k % 60, F.lit("M")), is_public=yes)],
        "bibo:shortDescription": [val(value=F.lit("short"), lang=F.lit("en"), is_public=yes), val(value=F.when(k % 2 == 0, F.lit("court")), is_public=yes)],
        "bibo:numPages": [val(value=F.when(k % 3 == 0, F.lit("12.0")).when(k % 3 == 1, F.lit("xii")).otherwise(F.lit("3.5")), is_public=yes)],
        "bibo:content": [val(value=F.substring("text", 1, 40), is_public=F.when(k % 3 > 0, k % 2 == 0))],
        "bibo:doi": [val(id=F.concat(F.lit("https://doi.org/10.1234/"), s), is_public=yes), val(value=F.lit("https://a.example/x"), is_public=no)],
        "fabio:hasURL": [val(id=F.concat(F.lit("https://u.example/"), k % 3), is_public=yes)],
        "curation:coordinates": [val(value=F.concat(k % 100, F.lit(", "), -(k % 50)), is_public=yes)],
        "panel:aTone": [val(value=F.when(k % 2 == 0, F.lit("good")), is_public=yes)],
        "panel:bTone": [val(title=F.lit("bad"), is_public=yes)],
        "panel:oldTone": [val(value=F.lit("gone"), is_public=yes)],
    }
    pairs = [x for name, vals in props.items() for x in (F.lit(name), F.array(*vals))]
    return read(spark, sf, "documents").select(
        k.alias("id"), F.concat(F.lit("T"), s).alias("title"), F.when(k % 2 == 0, F.lit("c:a")).otherwise(F.lit("c:b")).alias("resource_class"),
        F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T10:00:00+00:00")).alias("created"), F.when(k % 6 > 0, k % 2 == 0).alias("is_public"),
        F.array((k % 4).cast("string"), ((k + 1) % 4).cast("string")).alias("item_sets"), F.when(k % 3 > 0, F.concat(F.lit("https://f/"), s)).alias("media_file"),
        F.concat(F.lit("https://t/"), s).alias("media_thumbnail"), (k % 5 > 0).alias("has_media"), F.create_map(*pairs).alias("props"),
    )


SITE = mp.Site(
    address="https://site.example/", outlet_countries={"SRC1 ": "One", "src2": "Two"}, item_set_countries={"1": "One", "2": "Two"}, class_names={"c:a": "A", "c:b": "B"}, identifier_prefix="id-",
    columns_of={"dcterms:creator": ["author", "author_ids"], "bibo:content": ["content"], "bibo:doi": ["doi"]},
)

#: The same rows in SQL: every piece that a mapper can ask for.
BASE = """
WITH b AS (SELECT doc_id AS k, doc_id::VARCHAR AS id, lang, source AS src, text, DATE '1990-01-01' + (doc_id % 9000)::INT AS day FROM documents),
i AS (SELECT *, coalesce(CASE WHEN k % 6 > 0 THEN k % 2 = 0 END, false) AS item_is_public,
 array_to_string(list_sort(list_distinct(list_filter(['doi', CASE WHEN k % 5 = 0 THEN 'author' END, CASE WHEN k % 5 = 0 THEN 'author_ids' END, CASE WHEN NOT coalesce(CASE WHEN k % 3 > 0 THEN k % 2 = 0 END, false) THEN 'content' END], lambda x: x IS NOT NULL))), ',') AS private_fields,
 'x-' || id || '|id-' || id AS identifier, strftime(day, '%Y-%m-%d') AS added_date, 'https://site.example/item/' || id AS page_url,
 CASE WHEN k % 3 > 0 THEN 'https://site.example/iiif/' || id || '/manifest' ELSE '' END AS manifest, CASE WHEN k % 3 > 0 THEN 'https://f/' || id ELSE '' END AS file,
 CASE WHEN k % 3 > 0 THEN 'https://t/' || id ELSE '' END AS thumbnail, CASE WHEN k % 5 > 0 THEN 'https://t/' || id ELSE '' END AS any_thumbnail,
 'Title ' || id AS title, 'P' || (k % 11) || '|' || lang AS author, (k % 11)::VARCHAR AS author_ids, (k % 20)::VARCHAR AS outlet_ids,
 CASE src WHEN 'src1' THEN 'One' WHEN 'src2' THEN 'Two' ELSE '' END AS outlet_country, CASE k % 4 WHEN 0 THEN 'One' WHEN 1 THEN 'One' WHEN 2 THEN 'Two' ELSE '' END AS set_country, CASE k % 4 WHEN 0 THEN 'One' WHEN 1 THEN 'One|Two' WHEN 2 THEN 'Two' ELSE '' END AS set_countries,
 CASE k % 4 WHEN 0 THEN strftime(day, '%Y-%m-%d') WHEN 1 THEN strftime(day, '%Y-%m') WHEN 2 THEN strftime(day, '%Y') ELSE '1990/1995' END AS pub_date,
 CASE WHEN k % 4 = 3 THEN 1990 ELSE year(day) END::INT AS pub_year, ['day', 'month', 'year', 'range'][k % 4 + 1] AS pub_date_precision,
 CASE WHEN k % 2 = 0 THEN 'court' ELSE '' END AS summary, 'short' AS summary_en, 'S' || (k % 7) || '|S' || (k % 7) AS subject, (k % 7)::VARCHAR AS subject_ids, 'https://place/' || (k % 5) AS spatial, '' AS spatial_ids,
 CASE WHEN k % 3 = 0 THEN 12 END::BIGINT AS pages, 'https://u.example/' || (k % 3) AS url, trim(text[1:40], ' ') AS content, coalesce(k % 3 > 0 AND k % 2 = 0, false) AS content_is_public FROM b)
"""
HEAD = "id, item_is_public, private_fields, identifier, added_date, page_url"
DATE = "pub_date, pub_year, pub_date_precision"
SUBJECTS = "subject, subject_ids, spatial, spatial_ids"
CONTENT = "content, content_is_public"


def mapped(kind: str, spark: SparkSession, sf: str) -> DataFrame:
    out = mp.MAPPERS[kind](items(spark, sf), SITE)
    if "content" in out.columns:
        out = out.withColumn("content", F.trim("content"))
    return out.withColumn("private_fields", F.array_join("private_fields", ","))


@query(f"{BASE} SELECT {HEAD}, manifest, file, thumbnail, title, author, author_ids, src AS newspaper, outlet_ids AS newspaper_ids, outlet_country AS country, {DATE}, summary, summary_en, {SUBJECTS}, lang AS language, pages AS nb_pages, url, '' AS source, {CONTENT} FROM i")
def mapped_articles(spark: SparkSession, sf: str) -> DataFrame:
    return mapped("articles", spark, sf)


@query(f"{BASE} SELECT {HEAD}, manifest, file, thumbnail, title, author, author_ids, src AS newspaper, outlet_ids AS newspaper_ids, outlet_country AS country, {DATE}, '' AS issue, '' AS contents, {SUBJECTS}, lang AS language, pages AS nb_pages, url, '' AS source, {CONTENT} FROM i")
def mapped_publications(spark: SparkSession, sf: str) -> DataFrame:
    return mapped("publications", spark, sf)


@query(f"{BASE} SELECT {HEAD}, manifest, file, thumbnail, title, author, author_ids, '' AS contributor, set_country AS country, {DATE}, summary, summary_en, {SUBJECTS}, lang AS language, 'literal|Linked' AS type, pages AS nb_pages, '' AS source, 'https://rights/1' AS rights, {CONTENT} FROM i")
def mapped_documents(spark: SparkSession, sf: str) -> DataFrame:
    return mapped("documents", spark, sf)


@query(f"""{BASE} SELECT id, item_is_public, private_fields, 'id-' || id AS identifier, added_date, page_url, CASE WHEN k % 2 = 0 THEN 'A' ELSE 'B' END AS resource_class, title, '' AS author, '' AS author_ids, '' AS editor, '' AS editor_ids, '' AS review_of,
src AS publisher, outlet_ids AS publisher_ids, {DATE}, 'literal|Linked' AS type, '' AS book_title, '' AS chapter, '' AS volume, '' AS issue, '' AS edition, CASE k % 3 WHEN 0 THEN '12.0' WHEN 1 THEN 'xii' ELSE '3.5' END AS nb_pages, '' AS page_start, '' AS page_end,
CASE WHEN k % 2 = 0 THEN 'Français' ELSE 'English' END AS abstract, 'English' AS abstract_en, 'PT' || (k % 3) || 'H' || (k % 60) || 'M' AS extent, '' AS is_part_of, '' AS provenance, {SUBJECTS}, lang AS language, '10.1234/' || id AS doi, url || '|https://a.example/x' AS url, {CONTENT}, set_countries AS country FROM i""")
def mapped_references(spark: SparkSession, sf: str) -> DataFrame:
    return mapped("references", spark, sf)


@query(f"""{BASE} SELECT {HEAD}, any_thumbnail AS thumbnail, 'T' || id AS title, '' AS other_title, CASE WHEN k % 2 = 0 THEN 'A' ELSE 'B' END AS type, CASE WHEN k % 3 = 0 THEN 'tagged' ELSE 'any' END AS description, '' AS created, pub_date AS date, '' AS relation, '' AS replaced_by, '' AS part_of, spatial,
'' AS has_part, '' AS first_name, '' AS last_name, '' AS gender, '' AS birth, (k % 100) || ', ' || -(k % 50) AS coordinates, CASE WHEN k % 100 <= 90 THEN (k % 100)::DOUBLE END AS latitude, CASE WHEN k % 100 <= 90 THEN (-(k % 50))::DOUBLE END AS longitude FROM i""")
def mapped_authorities(spark: SparkSession, sf: str) -> DataFrame:
    return mapped("index", spark, sf)


@query(f"""{BASE} SELECT {HEAD}, manifest, file, any_thumbnail AS thumbnail, url, title, author AS creator, author_ids AS creator_ids, src AS publisher, outlet_ids AS publisher_ids, CASE WHEN outlet_country <> '' THEN outlet_country ELSE set_country END AS country, {DATE},
CASE WHEN k % 3 = 0 THEN 'any|tagged' ELSE 'any' END AS description, summary, summary_en, '' AS volume, '' AS issue, '' AS is_part_of, 'PT' || (k % 3) || 'H' || (k % 60) || 'M' AS extent, ((k % 3) * 3600 + (k % 60) * 60)::BIGINT AS duration_seconds, '' AS medium, 'Linked' AS type, 'https://rights/1' AS rights,
'' AS contributor, {SUBJECTS}, lang AS language, '' AS source, {CONTENT} FROM i""")
def mapped_audiovisual(spark: SparkSession, sf: str) -> DataFrame:
    return mapped("audiovisual", spark, sf)


@query(f"""{BASE} SELECT {HEAD}, manifest, file AS image_url, thumbnail, title, 'Linked' AS type, author AS creator, author_ids AS creator_ids, {DATE}, CASE WHEN k % 3 = 0 THEN 'any|tagged' ELSE 'any' END AS description, 'https://rights/1' AS rights, {SUBJECTS},
(k % 100) || ', ' || -(k % 50) AS coordinates, CASE WHEN k % 100 <= 90 THEN (k % 100)::DOUBLE END AS latitude, CASE WHEN k % 100 <= 90 THEN (-(k % 50))::DOUBLE END AS longitude, set_country AS country FROM i""")
def mapped_images(spark: SparkSession, sf: str) -> DataFrame:
    return mapped("images", spark, sf)


PANEL = mp.Panel((mp.Rater("old", 1, active=False, labels=False), mp.Rater("a", 2), mp.Rater("b", 2)), ("tone", "weight"))


@query("SELECT doc_id::VARCHAR AS id, CASE WHEN doc_id % 2 = 0 THEN 'good' ELSE '' END AS a_tone, '' AS a_weight, 'bad' AS b_tone, '' AS b_weight FROM documents")
def panel_columns(spark: SparkSession, sf: str) -> DataFrame:
    return mp.panel_columns(items(spark, sf), PANEL, score="weight")
