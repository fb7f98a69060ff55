"""What runs leave on disk, ids and rows without id, XML that loses nothing, spread and pages."""

import pathlib

import pytest
from pyspark.sql import functions as F

import evidence
from evidence.operators import analysis, chunks, records
from evidence.plans import extract
from evidence.session import shared_folder
from evidence.sources import article_xml, jsonl, sinks


def positioned(spark, ids):
    rows = [(i, f"t{n}", "a", "f", 0, n) for n, i in enumerate(ids)]
    return spark.createDataFrame(rows, "pmid string, title string, shard string, file_name string, block_start long, ord long")


def answered(spark, source):
    keys = [r[0] for r in records.with_record_key(source).select("record_key").collect()]
    return spark.createDataFrame([(k, "primary", 1, 1, 200, '{"article_level": {}}') for k in keys], records.RESPONSE_TYPE)


def test_no_folder_of_one_machine():
    root = pathlib.Path(evidence.__file__).parent
    assert not [p for p in root.rglob("*.py") if "tempfile" in p.read_text()]


def test_shared_folder_is_below_the_named_one(spark):
    assert shared_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_a_resumed_run_keeps_what_was_written(spark, tmp_path):
    first = positioned(spark, [" 1 ", "2", "", ""])
    every = positioned(spark, [" 1 ", "2", "", "", "3"])
    said, base = answered(spark, every), str(tmp_path)
    extract.run_extract(first, said, base, "r")
    stored = f"{base}/extracted/run=r"
    done = records.processed_ids(jsonl.read_documents(spark, stored), keep=["shard"])
    totals = extract.run_extract(every, said, base, "r", done)
    assert {(r.shard, r.total, r.scheduled) for r in totals.collect()} == {("a", 5, 3), (None, 5, 3)}
    docs = jsonl.read_documents(spark, stored)
    assert {r.shard for r in docs.select("shard").collect()} == {"a"}
    assert sorted(r.pmid.strip() for r in docs.collect()) == ["", "", "", "", "1", "2", "3"]


def test_the_same_run_twice_is_one_run(spark, tmp_path):
    source = positioned(spark, ["1", "2"])
    said, base = answered(spark, source), str(tmp_path)
    for _ in range(2):
        extract.run_extract(source, said, base, "r")
    assert jsonl.read_documents(spark, f"{base}/extracted/run=r").count() == 2
    assert spark.read.json(f"{base}/summary/run=r").count() == 2


def test_arbitration_from_disk(spark, tmp_path):
    source = positioned(spark, [" 1 ", "2", "2"])
    said, base = answered(spark, source), str(tmp_path)
    extract.run_extract(source, said, base, "r")
    docs = jsonl.read_documents(spark, f"{base}/extracted/run=r")
    second = said.withColumns({"model": F.lit("arbitration"), "pass": F.lit(2)})
    totals = extract.run_rerun_flagged(source, docs, second, base, "r").collect()
    assert {(r.shard, r.flagged, r.scheduled, r.ok) for r in totals} == {("a", 2, 3, 3), (None, 2, 3, 3)}


def test_rows_without_id_are_kept(spark):
    df = positioned(spark, ["", "", None, " ", "1", "1 "]).withColumns({"title": F.lit("same"), "ord": F.lit(0)})
    kept = records.dedupe_first(df, scope="global", order=("title",))
    assert kept.count() == 5
    assert records.pending(df, spark.createDataFrame([(" 1",)], "pmid string")).count() == 4


def test_a_wrong_reported_id_does_not_hide_a_record(spark):
    docs = spark.createDataFrame([("7", {"article_level": {"pmid": "8"}})], "pmid string, doc struct<article_level struct<pmid string>>") \
        .withColumn("needs_review", F.lit(True))
    assert records.flagged_ids(docs).first().pmid == "7"
    assert records.processed_ids(docs).first().pmid == "7"
    assert records.processed_ids(docs, prefer="document").first().pmid == "8"


def test_shards_come_from_folders(spark, tmp_path):
    rows = spark.createDataFrame([(str(i), f"s {i % 3}+ü/{i % 3}") for i in range(9)], "pmid string, shard string")
    sinks.write_by_shard(rows, str(tmp_path / "x"))
    back = jsonl.read_jsonl(spark, str(tmp_path / "x"), "*.json")
    assert {r.shard for r in back.select("shard").collect()} == {f"s {k}+ü/{k}" for k in range(3)}


def test_few_files_for_many_tasks(spark, tmp_path):
    rows = spark.range(20_000, numPartitions=40).select((F.col("id") % 50).cast("string").alias("shard"), "id")
    sinks.write_by_shard(rows, str(tmp_path / "x"))
    assert len(list((tmp_path / "x").rglob("part-*.json"))) <= 100


RECORD = ("<PubmedArticle><MedlineCitation><PMID>1</PMID><Article>{}<Abstract>{}</Abstract></Article></MedlineCitation></PubmedArticle>")


@pytest.mark.parametrize("mode", ["full", "leading"])
def test_xml_loses_no_text(spark, mode):
    title = "<ArticleTitle>Role of <em>in <b>vivo</b></em> tests <ref id='1'>1</ref> &amp; end</ArticleTitle>"
    sections = '<AbstractText Label="A"/><AbstractText Label="B">one <x:y>two</x:y> three</AbstractText><AbstractText/>'
    rows = [RECORD.format(title, sections), RECORD.format("<ArticleTitle/>", "<AbstractText>x</AbstractText>")]
    got = article_xml.parse_records(spark.createDataFrame([(r,) for r in rows], "xml string"), title_text=mode).collect()
    assert len(got) == 2
    want = {"full": ("Role of in vivo tests 1 & end", "one two three"), "leading": ("Role of ", "one ")}[mode]
    assert got[0].title == want[0] and want[1] in got[0].abstract and got[1].abstract == "x"


def test_rows_without_id_are_spread(spark):
    df = spark.range(10_000).select(F.lit("").alias("pmid"), F.concat(F.lit("t"), "id").alias("title"),
                                    F.lit("2020-01-02").alias("pub_date"))
    sizes = [r["count"] for r in chunks.plan_chunks(df, max_rows=1000).groupBy("part").count().collect()]
    assert len(sizes) == 10 and max(sizes) < 1500


def test_large_and_deep_pages(spark, monkeypatch):
    df = spark.range(30_000).select((F.col("id") % 10).alias("k"), "id")
    assert chunks.page(df, ["k", "id"], size=20_000).count() == 20_000
    plain = [tuple(r) for r in chunks.page(df, ["k", "id"], 25_000, 7).collect()]
    monkeypatch.setattr(chunks, "DEEP_ROWS", 100)
    assert [tuple(r) for r in chunks.page(df, ["k", "id"], 25_000, 7).collect()] == plain


def test_equal_keys_are_numbered_across_ranges(spark):
    df = spark.range(4000).select(F.lit(1).alias("k"), "id")
    got = chunks.number_rows(df, ["k"], 8)
    assert sorted(r.row_no for r in got.collect()) == list(range(1, 4001))


def test_table_one_counts_entities_once(spark):
    art = spark.createDataFrame([("", "g", True, 5, 2000), ("", "g", True, 5, 2000), ("1", "g", True, 5, 2000), ("1", "g", True, 5, 2000)],
                                "pmid string, primary_subspecialty string, article_has_external_validation boolean, study_total_score int, year int")
    ent = spark.createDataFrame([("",), ("",), ("1",), ("1",), ("1",)], "_source_pmid string")
    assert analysis.table1(art, ent).first().n_entities == 3


def test_whole_error_text(spark):
    said = spark.createDataFrame([("1", "m", 1, 1, 404, "x" * 5000)], records.RESPONSE_TYPE)
    row = records.best_attempt(said).first()
    assert len(row.error) < 1100 and row.error_text.endswith("x" * 5000)
