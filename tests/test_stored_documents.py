"""What larger runs met: stored documents read once and in part, packed, written without a shuffle of them."""

import json

from pyspark.sql import functions as F
from test_stored_runs import answered, positioned

from bindings import extraction
from evidence import session
from evidence.functions import jsontext
from evidence.plans import extract
from evidence.sources import jsonl, sinks


def test_arbitration_reads_documents_once(spark, tmp_path):
    source = positioned(spark, [str(i) for i in range(20)])
    said, base = answered(spark, source), str(tmp_path)
    extract.run_extract(source, said, base, "r")
    read = spark.sparkContext.accumulator(0)

    def seen(flag):
        read.add(1)
        return flag
    docs = extract.read_stream(spark, base, "r").withColumn("needs_review", F.udf(seen, "boolean")("needs_review"))
    second = said.withColumns({"model": F.lit("arbitration"), "pass": F.lit(2)})
    totals = extract.run_rerun_flagged(source, docs, second, base, "r").filter("shard is null").first()
    assert (totals.flagged, totals.scheduled, totals.ok) == (20, 20, 20)
    assert read.value == 20
    assert not list((tmp_path / "rerun" / "seen").rglob("part-*"))


def test_parts_that_nobody_selects_are_not_cast(spark, tmp_path):
    lines = [{"article_level": {"pmid": 7, "primary_subspecialty": "a"}, "needs_review": False, "pmid": " 1 "},
             {"article_level": [], "model_level": {}, "normalization": 3, "quality_flags": None},
             {"article_level": {"primary_subspecialty": {"x": 1}}, "model_level": [{"model_quality_score": {"total_score": 5}}, 4],
              "normalization": {"overall_extraction_confidence": "90"}},
             {"model_level": [{"model_quality_score": {"total_score": 5}}], "normalization": {"overall_extraction_confidence": 90},
              "quality_flags": {"requires_human_review": False}}]
    (tmp_path / "s_1.json").write_text("\n".join([*map(json.dumps, lines), "{} x", "[]", '{"a": 1', ""]))
    docs = jsonl.read_documents(spark, str(tmp_path))
    assert docs.count() == 4
    got = [(r.pmid, r.sub, r.needs_review, r.shard) for r in docs.select(
        "pmid", F.col("doc.article_level.primary_subspecialty").alias("sub"), "needs_review", "shard").collect()]
    assert got == [(" 1 ", "a", False, "1"), (None, None, True, "1"), (None, '{"x":1}', False, "1"), (None, None, False, "1")]
    whole = [r.doc.asDict(True) for r in docs.collect()]
    assert whole[1] == {"article_level": None, "model_level": None, "normalization": None, "quality_flags": None}
    assert [len(w["model_level"] or []) for w in whole] == [0, 0, 2, 1] and whole[0]["article_level"]["pmid"] == "7"
    plan = docs.select("pmid", F.col("doc.article_level.primary_subspecialty"))._jdf.queryExecution().optimizedPlan().toString()
    assert "StructField(title" in plan and "StructField(model_name" not in plan and "disease_ambiguous" not in plan


def test_boxed_objects(spark):
    texts = ['{"a": 1}', ' {"a": 2}\n', '{"a": 3} x', "[1]", "5", "", None, '{"a": 4', '{}']
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.a for r in rows.select(F.try_variant_get(jsontext.boxed_object("t"), "$[0].a", "int").alias("a")).collect()]
    assert got == [1, 2] + [None] * 7
    kept = [r.k for r in rows.select(F.to_json(jsontext.parse_strict_object("t")).alias("k")).collect()]
    assert kept == ['{"a":1}', '{"a":2}', *[None] * 6, "{}"]
    assert [r.k for r in rows.select(F.to_json(jsontext.parse_strict("t")).alias("k")).collect()][3:5] == ["[1]", "5"]


def test_few_shards_are_written_without_a_shuffle(spark, tmp_path, monkeypatch):
    source = positioned(spark, [str(i) for i in range(40)]).withColumn("shard", F.col("ord") % 3)
    source = source.withColumn("shard", F.col("shard").cast("string"))
    said, hints = answered(spark, source), []
    whole = sinks.write_by_shard
    monkeypatch.setattr(sinks, "write_by_shard", lambda *a, **k: hints.append(k["few"]) or whole(*a, **k))
    extract.run_extract(source, said, str(tmp_path), "r")
    assert hints == [True] * 3
    docs = extract.read_stream(spark, str(tmp_path), "r")
    assert sorted((int(r.pmid), r.shard) for r in docs.select("pmid", "shard").collect()) == [(i, str(i % 3)) for i in range(40)]
    many = spark.range(200).select((F.col("id") % (session.FEW_SHARDS + 1)).cast("string").alias("shard"))
    assert sinks.few_shards(source) and not sinks.few_shards(many)
    for none in (None, ""):
        assert not sinks.few_shards(spark.createDataFrame([("a",), (none,)], "shard string"))


def test_rows_without_a_shard_stay_in_one_file(spark, tmp_path):
    source = positioned(spark, [str(i) for i in range(40)]).withColumn("shard", F.when(F.col("ord") % 4 != 0, "a"))
    extract.run_extract(source.repartition(8), answered(spark, source), str(tmp_path), "r")
    docs = extract.read_stream(spark, str(tmp_path), "r")
    assert docs.filter("shard = 'a'").count() == 30
    assert docs.filter("shard != 'a'").select("shard").distinct().count() == 1 and docs.count() == 40


def test_reloaded_documents_are_packed(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(k, k) for k in range(1, 40)], "o_orderkey long, o_custkey long").withColumns(
        {"o_orderdate": F.to_date(F.lit("2020-01-02")), "o_orderpriority": F.lit("1-URGENT")}).write.parquet(f"{tmp_path}/orders.parquet")
    monkeypatch.setattr(extraction, "shared_folder", lambda *_: f"{tmp_path}/documents")
    rows = extraction.reloaded_documents(spark, str(tmp_path)).collect()
    assert sorted(int(r.pmid) for r in rows) == list(range(1, 40))
    files = [f.name for f in (tmp_path / "documents").iterdir() if f.name.startswith("part-")]
    assert files and all(f.endswith(".json.gz") for f in files)
