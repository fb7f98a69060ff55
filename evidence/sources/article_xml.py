"""Bibliographic XML to flat article rows, one parse per record.

A file is cut at the record end tag by the text source, so large files are read by many
tasks.  Inline markup is taken care of on the raw text, where a ``<`` is always markup;
after that every field is plain text for ``from_xml``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text

RECORD_TAG = "PubmedArticle"

# fixed values: inline elements of the record format
INLINE_TAGS = ("b", "i", "u", "sup", "sub", "DispFormula", "mml:[A-Za-z]+")

# text of a title or section up to a tag inside it, which is not kept
_INNER_TAG = (r"(<(?:ArticleTitle|AbstractText)\b[^<>]*>|\G(?!\A))([^<]*)"
              r"<(?!/?(?:ArticleTitle|AbstractText)\b)[^<>]*>")

_VALUE = "struct<_VALUE string>"
RECORD_TYPE = (
    f"MedlineCitation struct<PMID {_VALUE},"
    f"Article struct<ArticleTitle {_VALUE},"
    "Abstract struct<AbstractText array<struct<_VALUE string,_Label string>>>,"
    "Journal struct<Title string,JournalIssue struct<PubDate struct<"
    "Year string,Month string,Day string>>>,"
    f"PublicationTypeList struct<PublicationType array<{_VALUE}>>,"
    "AuthorList struct<Author array<struct<LastName string,ForeName string>>>,"
    "ELocationID array<struct<_VALUE string,_EIdType string>>>,"
    f"KeywordList array<struct<Keyword array<{_VALUE}>>>,"
    f"MeshHeadingList struct<MeshHeading array<struct<DescriptorName {_VALUE}>>>>"
)


def plain_markup(xml: Column, title_text: str = "full") -> Column:
    """Raw record without inline markup.

    ``full`` drops every tag inside titles and abstract sections and keeps the text;
    ``leading`` keeps titles and sections only up to their first child element.  Empty
    elements written as one tag are opened and closed first.
    """
    xml = F.regexp_replace(xml, r"<(ArticleTitle|AbstractText)\b([^<>]*)/>", "<$1$2></$1>")
    if title_text == "leading":
        return F.regexp_replace(
            xml, r"(?s)(<(ArticleTitle|AbstractText)\b[^>]*>[^<]*)<(?!/\2\b).*?(</\2>)", "$1$3")
    # each match goes on where the last one ended, so one pass takes all tags out of an element
    xml = F.regexp_replace(xml, _INNER_TAG, "$1$2")
    return F.regexp_replace(xml, rf"</?(?:{'|'.join(INLINE_TAGS)})(?:\s[^>]*)?/?>", "")


def _values(items: Column) -> Column:
    """Texts of repeated elements, empty ones left out."""
    kept = F.filter(F.transform(items, lambda x: x["_VALUE"]), lambda x: x != "")
    return F.coalesce(kept, F.array().cast("array<string>"))


def parse_records(df: DataFrame, xml: str = "xml", title_text: str = "full") -> DataFrame:
    """Article rows from a column of record texts.

    Records that are malformed or lack the citation or the article node are dropped.
    """
    options = {"mode": "PERMISSIVE", "ignoreSurroundingSpaces": "false"}
    keep = [c for c in df.columns if c != xml]
    parsed = text.computed(df, {
        "_r": F.from_xml(plain_markup(F.col(xml), title_text), RECORD_TYPE, options)})
    c = F.col("_r.MedlineCitation")
    a = c["Article"]
    date = a["Journal"]["JournalIssue"]["PubDate"]

    def plain(x: Column) -> Column:
        return F.coalesce(x, F.lit(""))

    sections = F.transform(a["Abstract"]["AbstractText"], lambda s: F.concat(
        F.when(s["_Label"] != "", F.concat(s["_Label"], F.lit(": "))).otherwise(""),
        plain(s["_VALUE"])))
    authors = F.transform(
        F.filter(a["AuthorList"]["Author"], lambda x: x["LastName"] != ""),
        lambda x: text.strip(F.concat_ws(" ", x["LastName"], x["ForeName"])))
    dois = F.filter(a["ELocationID"], lambda e: (e["_EIdType"] == "doi") & (e["_VALUE"] != ""))
    mesh = F.transform(c["MeshHeadingList"]["MeshHeading"], lambda m: m["DescriptorName"])
    empty = F.array().cast("array<string>")
    return parsed.filter(a.isNotNull()).select(
        plain(c["PMID"]["_VALUE"]).alias("pmid"),
        plain(a["ArticleTitle"]["_VALUE"]).alias("title"),
        plain(F.array_join(sections, " ")).alias("abstract"),
        plain(a["Journal"]["Title"]).alias("journal"),
        F.when(date.isNull(), "").otherwise(
            text.pub_date(date["Year"], date["Month"], date["Day"])).alias("pub_date"),
        _values(a["PublicationTypeList"]["PublicationType"]).alias("publication_types"),
        _values(F.get(c["KeywordList"], F.lit(0))["Keyword"]).alias("keywords"),
        _values(mesh).alias("mesh_terms"),
        F.coalesce(authors, empty).alias("authors"),
        plain(F.get(dois, F.lit(0))["_VALUE"]).alias("doi"), *keep)


def read_article_xml(spark: SparkSession, path: str | list[str], glob: str = "*.xml*",
                     title_text: str = "full", file: str | None = None) -> DataFrame:
    """Article rows of all XML files of a folder; with ``file``, a column of that name has each
    record's file."""
    end = f"</{RECORD_TAG}>"
    pieces = spark.read.option("lineSep", end).option("pathGlobFilter", glob).text(path)
    named = [F.col("_metadata.file_path").alias(file)] if file else []
    # what follows the last record holds no start tag and is dropped
    start = F.regexp_instr("value", F.lit(rf"<{RECORD_TAG}[\s>]"))
    records = (pieces.select("value", start.alias("_at"), *named).filter("_at > 0")
               .select(F.concat(F.expr("substr(value, _at)"), F.lit(end)).alias("xml"), *([file] if file else [])))
    return parse_records(records, "xml", title_text)
