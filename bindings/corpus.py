"""XML, date chunk, numbering and incremental queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from evidence.functions import text
from evidence.operators import chunks
from evidence.plans import acquire
from evidence.session import shared_folder
from evidence.sources import article_xml, sinks
from evidence.streaming import incremental

from .frames import ARTICLES_SQL, articles
from .registry import bound, table


def _escaped(c):
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                     F.lit(">"), F.lit("&gt;"))


def _tag(name, *content, attributes=""):
    return F.concat(F.lit(f"<{name}{attributes}>"), *content, F.lit(f"</{name}>"))


def xml_records(spark, sf):
    """Documents as record XML: title with inline markup, two labelled abstract sections.

    Every 13th record lacks the article node; every 17th is cut off.
    """
    d, title = F.col("doc_id"), _escaped(F.regexp_replace("title", r"[\x00-\x1f]", " "))
    body = _escaped(F.regexp_replace("abstract", r"[\x00-\x1f]", " "))
    author = F.concat(_tag("LastName", F.concat(F.lit("L"), d.cast("string"))),
                      F.when(d % 2 == 0, _tag("ForeName", F.lit("F & G".replace("&", "&amp;")))).otherwise(""))
    article = _tag(
        "Article",
        _tag("Journal", _tag("JournalIssue", _tag(
            "PubDate", _tag("Year", F.substring("pub_date", 1, 4)),
            F.when(d % 4 != 3, _tag("Month", F.date_format(F.col("pub_date").cast("date"), "MMMM"))).otherwise(""),
            F.when(d % 4 == 0, _tag("Day", F.substring("pub_date", 9, 2))).otherwise(""))),
            _tag("Title", F.col("journal"))),
        _tag("ArticleTitle", title, F.lit(" <i>in <b>vivo</b></i> &lt;x")),
        _tag("Abstract", _tag("AbstractText", body, attributes=' Label="AIM"'),
             _tag("AbstractText", F.lit("CO<sub>2</sub> end"))),
        _tag("AuthorList", _tag("Author", author), _tag("Author", _tag("CollectiveName", F.lit("Group")))),
        _tag("PublicationTypeList", _tag("PublicationType", F.lit("Journal Article"), attributes=' UI="D1"'),
             _tag("PublicationType", F.col("lang"))),
        F.lit('<ELocationID EIdType="pii">no</ELocationID>'),
        _tag("ELocationID", F.concat(F.lit("10.1/"), d.cast("string")), attributes=' EIdType="doi"'))
    citation = _tag(
        "MedlineCitation", _tag("PMID", d.cast("string"), attributes=' Version="1"'),
        F.when(d % 13 == 5, F.lit("")).otherwise(article),
        _tag("KeywordList", _tag("Keyword", F.col("lang")), _tag("Keyword", F.col("journal")), F.lit("<Keyword/>")),
        _tag("MeshHeadingList", _tag("MeshHeading", _tag("DescriptorName", F.lit("Humans"), attributes=' UI="D6"')),
             _tag("MeshHeading", _tag("DescriptorName", F.col("lang")))))
    xml = _tag("PubmedArticle", citation, F.lit("<PubmedData/>"))
    cut = F.concat(F.expr("left(xml, length(xml) - 40)"), F.lit("</PubmedArticle>"))
    return articles(spark, sf).select("doc_id", xml.alias("xml")).select(
        "doc_id", F.when(d % 17 == 3, cut).otherwise(F.col("xml")).alias("xml"))


_CLEAN = "regexp_replace({}, '[\\x00-\\x1f]', ' ', 'g')"
_XML_SQL = f"""SELECT pmid, {_CLEAN.format('title')} || ' in vivo <x' AS title,
    md5('AIM: ' || {_CLEAN.format('abstract')} || ' CO2 end') AS digest, journal,
    CASE doc_id % 4 WHEN 3 THEN substr(pub_date, 1, 4) || '-01-01' WHEN 0 THEN pub_date
      ELSE substr(pub_date, 1, 8) || '01' END AS pub_date,
    'Journal Article|' || lang AS types, lang || '|' || journal AS keywords, 'Humans|' || lang AS mesh,
    'L' || doc_id || CASE WHEN doc_id % 2 = 0 THEN ' F & G' ELSE '' END AS authors, '10.1/' || doc_id AS doi
  FROM ({ARTICLES_SQL}) WHERE doc_id % 13 <> 5 AND doc_id % 17 <> 3"""


def _shown(parsed):
    def joined(c):
        return F.array_join(c, "|")
    return parsed.select(
        "pmid", "title", F.md5("abstract").alias("digest"), "journal", "pub_date",
        joined("publication_types").alias("types"), joined("keywords").alias("keywords"),
        joined("mesh_terms").alias("mesh"), joined("authors").alias("authors"), "doi")


@bound(_XML_SQL)
def xml_articles(spark, sf):
    return _shown(article_xml.parse_records(xml_records(spark, sf)))


@bound(f"SELECT pmid, {_CLEAN.format('title')} || ' ' AS title, md5('AIM: ' || {_CLEAN.format('abstract')} || ' CO') AS digest "
       f"FROM ({ARTICLES_SQL}) WHERE doc_id % 13 <> 5 AND doc_id % 17 <> 3")
def xml_leading_text(spark, sf):
    return article_xml.parse_records(xml_records(spark, sf), title_text="leading").select(
        "pmid", "title", F.md5("abstract").alias("digest"))


@bound(_XML_SQL)
def xml_files(spark, sf):
    path = shared_folder(spark, "xml")
    xml_records(spark, sf).select("xml").write.text(path)
    return _shown(article_xml.read_article_xml(spark, path, "*.txt"))


@bound("""SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
    WHEN 1 THEN strftime(o_orderdate, '%Y-%m-01') WHEN 2 THEN strftime(o_orderdate, '%Y-01-01')
    WHEN 5 THEN '' ELSE strftime(o_orderdate, '%Y') END AS pub_date FROM orders""")
def publication_dates(spark, sf):
    k, d = F.col("o_orderkey") % 6, F.col("o_orderdate")
    month = (F.when(k == 2, F.lit(None)).when(k == 3, F.date_format(d, "MM"))
             .when(k == 1, F.date_format(d, "MMM")).otherwise(F.date_format(d, "MMMM")))
    day = F.when(k == 0, F.date_format(d, "d")).when(k == 4, "32")
    year = F.when(k != 5, F.date_format(d, "yyyy"))
    return table(spark, sf, "orders").select("o_orderkey", text.pub_date(year, month, day).alias("pub_date"))


@bound("SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year FROM orders")
def years_of_dates(spark, sf):
    k = F.col("o_orderkey")
    shown = F.when(k % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(
        F.date_format("o_orderdate", "yyyy"))
    return table(spark, sf, "orders").select("o_orderkey", text.year_of(shown).alias("year"))


# --- chunks --------------------------------------------------------------------------------------

def _dated_orders(spark, sf):
    k = F.col("o_orderkey")
    # every 50th order has only a year, every 51st no date; 1995 is outside the range
    date = (F.when(k % 51 == 0, F.lit(None)).when(k % 50 == 0, F.date_format("o_orderdate", "yyyy"))
            .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")))
    return table(spark, sf, "orders").select(k.cast("string").alias("pmid"), date.alias("pub_date"))


_DATED = """SELECT CAST(o_orderkey AS VARCHAR) AS pmid, CASE WHEN o_orderkey % 51 = 0 OR year(o_orderdate) NOT BETWEEN 1996 AND 2001 THEN 'undated'
    WHEN o_orderkey % 50 = 0 THEN strftime(o_orderdate, '%Y') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS d FROM orders"""


def _chunk(cap: int) -> str:
    return (f"SELECT pmid, CASE WHEN total <= {cap} THEN 'all' WHEN m <= {cap} THEN month ELSE d END AS chunk_id "
            f"FROM (SELECT *, count(*) OVER (PARTITION BY month) AS m, count(*) OVER () AS total FROM "
            f"(SELECT *, CASE WHEN d = 'undated' THEN d ELSE substr(d, 1, 7) END AS month FROM ({_DATED})))")


@bound(f"SELECT chunk_id, count(*) AS n FROM ({_chunk(180)}) GROUP BY chunk_id")
def chunk_manifest(spark, sf):
    return chunks.manifest(chunks.plan_chunks(_dated_orders(spark, sf), max_rows=180, years=(1996, 2001)))


@bound(_chunk(1600))
def chunk_rows(spark, sf):
    return chunks.plan_chunks(_dated_orders(spark, sf), max_rows=1600, years=(1996, 2001)).select(
        "pmid", "chunk_id")


@bound("""SELECT CASE WHEN (SELECT count(*) FROM events) <= 5000 THEN 'all' ELSE strftime(ts, '%Y-%m-%d') END AS chunk_id,
    count(*) AS n FROM events GROUP BY 1""")
def event_day_chunks(spark, sf):
    rows = table(spark, sf, "events").select(F.col("event_id").cast("string").alias("pmid"),
                                             F.date_format("ts", "yyyy-MM-dd").alias("pub_date"))
    return chunks.manifest(chunks.plan_chunks(rows, max_rows=5000, years=(2024, 2024)))


@bound("""SELECT chunk_id, count(*) AS n FROM (SELECT CASE WHEN (SELECT count(*) FROM documents
      WHERE contains(text, 'the') AND 2008 + doc_id % 20 <= 2026) <= 40 THEN 'all' ELSE substr(pub_date, 1, 7) END AS chunk_id
    FROM (SELECT *, printf('%04d-%02d', 2008 + doc_id % 20, 1 + doc_id % 12) AS pub_date FROM documents)
    WHERE regexp_matches(split_part(text, chr(10), 1) || ' ' || text, '(^|[^\\p{L}\\p{M}\\p{N}_])(?i:the)($|[^\\p{L}\\p{M}\\p{N}_])')
      AND 2008 + doc_id % 20 BETWEEN 2010 AND 2026) GROUP BY chunk_id""")
def acquired_chunks(spark, sf):
    found = acquire.acquire(articles(spark, sf), groups=(("the",),), excluded_types=(), max_rows=2000)
    # far from the cap, so months stay whole unless everything fits
    planned = chunks.plan_chunks(found.drop("chunk_id", "part"), max_rows=40)
    whole = F.substring("chunk_id", 1, 7)
    return planned.groupBy(whole.alias("chunk_id")).agg(F.count("*").alias("n"))


_BY_TEXT = "CAST(o_orderkey AS VARCHAR)"


@bound(f"SELECT pmid, CAST(floor((rn - 1) / 500) AS BIGINT) AS shard_no FROM (SELECT {_BY_TEXT} AS pmid, "
       f"row_number() OVER (ORDER BY {_BY_TEXT}) AS rn FROM orders)")
def numbered_shards(spark, sf):
    ids = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("pmid"))
    return chunks.number_shards(ids, ["pmid"], rows=500)


@bound(f"SELECT pmid FROM (SELECT {_BY_TEXT} AS pmid, o_orderdate FROM orders ORDER BY o_orderdate, pmid LIMIT 300 OFFSET 700)")
def sorted_page(spark, sf):
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("pmid"), "o_orderdate")
    return chunks.page(rows, ["o_orderdate", "pmid"], start=700, size=300).select("pmid")


@bound(f"SELECT pmid FROM (SELECT {_BY_TEXT} AS pmid, o_orderdate FROM orders ORDER BY o_orderdate, pmid LIMIT 12000 OFFSET 100)")
def large_page(spark, sf):
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("pmid"), "o_orderdate")
    return chunks.page(rows, ["o_orderdate", "pmid"], start=100, size=12000).select("pmid")


@bound(f"""SELECT count(*) AS n, min(pmid) AS first, max(pmid) AS last, CAST(0 AS BIGINT) AS out_of_order
  FROM (SELECT {_BY_TEXT} AS pmid FROM orders)""")
def sorted_ids(spark, sf):
    ids = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("pmid"))
    # neighbours are compared inside each sorted range
    placed = chunks.sorted_by(ids, tie=["pmid"]).select(
        "pmid", F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("i"))
    before = F.lag("pmid").over(Window.partitionBy("p").orderBy("i"))
    return placed.select("pmid", (before > F.col("pmid")).alias("wrong")).agg(
        F.count("*").alias("n"), F.min("pmid").alias("first"), F.max("pmid").alias("last"),
        F.count_if("wrong").alias("out_of_order"))


@bound("SELECT source AS shard, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents GROUP BY source")
def incremental_intake(spark, sf):
    """Two arrivals of shard files, each followed by a run; the second adds only new files."""
    base = shared_folder(spark, "intake")
    columns = ("pmid", "title", "abstract", "journal", "pub_date", "publication_types")
    rows = articles(spark, sf).withColumn("late", F.col("doc_id") % 2)
    for late in (0, 1):
        part = rows.filter(F.col("late") == late).select(*columns)
        sinks.write_jsonl(part, f"{base}/in")
        incremental.ingest(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint",
                           glob="*.json", by="none").awaitTermination()
    return (incremental.read_ingested(spark, f"{base}/out")
            .groupBy(F.col("journal").alias("shard"))
            .agg(F.count("*").alias("n"), F.sum(F.char_length("abstract")).alias("chars")))
