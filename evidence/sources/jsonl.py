"""JSON-lines sources: tolerant and strict scans, article rows, extracted documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from ..functions import coerce, jsontext, text
from ..operators.normalize import needs_review
from ..schema import ARTICLE_TYPE, DEFAULT_SCHEMA, ExtractionSchema

_FIELDS = ("struct<pmid string,title string,abstract string,journal string,pub_date string,"
           "doi string,country string,publication_types variant,keywords variant,"
           "mesh_terms variant,authors variant>")


def shard_of(file_name: Column | str) -> Column:
    """First digit run of the file stem, else the stem."""
    stem = F.regexp_replace(text.col(file_name), r"\.[^.]*$", "")
    digits = F.regexp_extract(stem, r"(\d+)", 1)
    return F.when(digits == "", stem).otherwise(digits)


def shard_of_path(path: Column, name: str = "shard") -> Column:
    """The value of the folder ``<name>=<value>`` in a path, null if there is none.

    The folder's own escapes are escaped once more in a path.
    """
    value = F.regexp_extract(path, rf"/{name}=([^/]*)/", 1)
    kept = F.try_url_decode(F.try_url_decode(F.regexp_replace(value, r"\+", "%252B")))
    return F.when(value != "", F.when(kept != "__HIVE_DEFAULT_PARTITION__", kept))


def with_file_position(lines: DataFrame) -> DataFrame:
    """Add file name, shard and reading order within the file.

    ``ord`` grows within one block of one file, so (file_name, block_start, ord) is the
    reading order, whichever task read the block.  The shard is the one a sink wrote the file
    for, else it comes from the file's name.
    """
    return lines.select(
        *[c for c in lines.columns if c != "shard"], F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("ord"),
    ).withColumn("shard", F.coalesce(shard_of_path(F.col("_path")), shard_of("file_name"))).drop("_path")


def parse_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Replace text lines by ``v`` (VARIANT object); blank, broken and non-object lines drop.

    Bytes that are no UTF-8 become the replacement character first.
    """
    clean = F.make_valid_utf8(F.col(value))
    return (text.computed(lines, {"v": jsontext.parse_strict_object(clean)})
            .filter("v is not null").drop(value))


def read_jsonl(spark: SparkSession, path: str | list[str], glob: str = "*.json*",
               mode: str = "tolerant", schema: str = ARTICLE_TYPE, nested: bool = False) -> DataFrame:
    """Scan all shards of a folder; with ``nested`` also of all folders below it.

    ``tolerant`` gives ``v, file_name, block_start, ord, shard``; ``strict`` gives typed
    columns of ``schema`` plus the position columns and fails on a broken line.
    """
    reader = _reader(spark, glob, nested)
    if mode == "strict":
        return with_file_position(reader.schema(schema).option("mode", "FAILFAST").json(path))
    return parse_lines(with_file_position(reader.text(path)))


def _reader(spark: SparkSession, glob: str, nested: bool) -> DataFrameReader:
    reader = spark.read.option("pathGlobFilter", glob)
    return reader.option("recursiveFileLookup", "true") if nested else reader


def _text_items(v: Column) -> Column:
    """Array items as text; a scalar is one item."""
    listed = F.try_variant_get(v, "$", "array<string>")
    return F.coalesce(coerce.clean_items(F.coalesce(
        listed, F.array(F.try_variant_get(v, "$", "string")))),
        F.array().cast("array<string>"))


def _mesh_items(v: Column) -> Column:
    """Mesh items as text: strings as they are, objects as ``D [q1; q2]``."""
    def one(item: Column) -> Column:
        parts = F.try_variant_get(item, "$", "struct<descriptor string,qualifiers variant>")
        return text.let(parts, lambda p: F.when(
            p.isNull(), text.norm_text(F.try_variant_get(item, "$", "string"))
        ).otherwise(text.join_mesh(F.array(F.struct(
            p["descriptor"].alias("descriptor"),
            F.try_variant_get(p["qualifiers"], "$", "array<string>").alias("qualifiers"))))))
    items = F.try_variant_get(v, "$", "array<variant>")
    return coerce.clean_items(F.when(items.isNotNull(), F.transform(items, one))
                              .otherwise(F.array(F.try_variant_get(v, "$", "string"))))


def articles(scan: DataFrame) -> DataFrame:
    """Typed article rows from a tolerant scan; one cast per record.

    Lists given as a scalar become one item, mesh objects become text.
    """
    position = [c for c in scan.columns if c != "v"]
    a = F.col("_a")
    texts = ("pmid", "title", "abstract", "journal", "pub_date", "doi", "country")
    return text.computed(scan, {"_a": F.try_variant_get("v", "$", _FIELDS)}).select(
        text.norm_text(a["pmid"]).alias("pmid"), *[a[c].alias(c) for c in texts[1:]],
        *[_text_items(a[c]).alias(c) for c in ("publication_types", "keywords", "authors")],
        _mesh_items(a["mesh_terms"]).alias("mesh_terms"), *position)


def read_documents(spark: SparkSession, path: str | list[str], glob: str = "*.json*",
                   schema: ExtractionSchema = DEFAULT_SCHEMA, nested: bool = False) -> DataFrame:
    """Extraction documents written earlier: ``doc`` in the type of the schema.

    ``needs_review`` is the stored flag, computed where a file has none.  Each part of a document is
    cast on its own, so parts that nobody selects are not cast, and no line is copied out of its box.
    """
    lines = with_file_position(_reader(spark, glob, nested).text(path))
    boxed = (text.computed(lines, {"_box": jsontext.boxed_object(F.make_valid_utf8(F.col("value")))})
             .filter("_box is not null"))

    def held(path: str, kind: str) -> Column:
        return F.try_variant_get("_box", f"$[0]{path}", kind)
    judged = text.let(held("", schema.judged_type()), lambda d: needs_review(d, schema=schema))
    return boxed.select(
        F.struct(*[held(f"['{name}']", kind).alias(name) for name, kind in schema.level_types().items()]).alias("doc"),
        held(".pmid", "string").alias("pmid"),
        F.coalesce(held(".needs_review", "boolean"), judged).alias("needs_review"), "shard", "file_name")


def read_responses(spark: SparkSession, path: str | list[str], glob: str = "*.json*") -> DataFrame:
    """Response table written by whoever ran the prompts."""
    typed = F.try_variant_get("v", "$", "struct<pmid string,model string,pass int,"
                                        "attempt int,status int,content string>")
    return (read_jsonl(spark, path, glob).select(typed.alias("r")).select("r.*")
            .withColumn("pmid", text.norm_text("pmid")))


def split_levels(docs: DataFrame, schema: ExtractionSchema = DEFAULT_SCHEMA,
                 doc: str = "doc") -> tuple[DataFrame, DataFrame]:
    """Article frame and entity frame, linked by ``_source_pmid``.

    The article frame carries the score block as ``study_*`` columns and the year.
    """
    level = F.col(doc)[schema.article_key]
    # the level alone first, so that a stored document's other parts are not read for it
    art = docs.select(level.alias("_level")).select("_level.*", F.col("_level.pmid").alias("_source_pmid"))
    art = (flatten_scores(art, schema.article_score, "study")
           .withColumn("year", text.year_of("pub_date")))
    # an inner explode gets a filter on its list, which is pushed down with the whole cast of the
    # document in it, twice; an outer one gets none, and its rows of empty lists have no position
    ent = (docs.select(level["pmid"].alias("_source_pmid"),
                       F.posexplode_outer(F.col(doc)[schema.entity_key]).alias("_at", "e"))
           .filter("_at is not null").select("e.*", "_source_pmid"))
    return art, ent


def flatten_scores(df: DataFrame, block: str, prefix: str) -> DataFrame:
    """Score struct as columns ``<prefix>_<key>``; the struct itself is dropped."""
    keys = [f.name for f in df.schema[block].dataType.fields]
    return df.select("*", *[F.col(f"{block}.{k}").alias(f"{prefix}_{k}") for k in keys]).drop(block)
