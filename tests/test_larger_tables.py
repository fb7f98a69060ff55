"""What larger tables met: limits of recursion, uneven scans, texts and documents sent or kept more often than needed."""

import pathlib
import re

import pytest
from pyspark.sql import functions as F
from test_stored_runs import answered, positioned

from bindings import registry, runs
from evidence.llm import token_files
from evidence.operators import hierarchy, records
from evidence.plans import acquire, extract
from evidence.schema import DEFAULT_SCHEMA
from evidence.sources import jsonl


def test_a_tree_of_more_rows_than_a_recursion_may_have(spark):
    tree = spark.range(1, 300).select(F.concat(F.lit("t "), "id").alias("term"), F.concat(F.lit("t "), F.floor(F.col("id") / 3)).alias("parent"))
    spark.conf.set("spark.sql.cteRecursionRowLimit", 100)
    try:
        up = {(r.term, r.ancestor): r.distance for r in hierarchy.ancestors(tree).collect()}
    finally:
        spark.conf.unset("spark.sql.cteRecursionRowLimit")
    expected = {}
    for n in range(300):
        at, distance = n, 0
        while True:
            expected[f"t_{n}", f"t_{at}"] = distance
            if not at:
                break
            at, distance = at // 3, distance + 1
    assert up == expected


def test_several_ways_up_do_not_multiply(spark):
    # 2 ** 24 ways from the first to the last
    tree = spark.createDataFrame([(f"n{i}{a}", f"n{i + 1}{b}") for i in range(24) for a in "ab" for b in "ab"], "term string, parent string")
    start = spark.createDataFrame([("n0a",)], "term string")
    up = {r.ancestor: r.distance for r in hierarchy.ancestors(tree, start).collect()}
    assert len(up) == 49 and up["n24a"] == up["n24b"] == 24


def test_rows_of_an_uneven_scan_are_dealt_out(spark, monkeypatch):
    uneven = spark.range(4000).coalesce(1).union(spark.range(0).repartition(20))
    sizes = [len(p) for p in registry.spread(uneven, "id").rdd.glom().collect()]
    assert sum(sizes) == 4000 and max(sizes) < 1500


def test_tasks_grow_with_the_rows(spark):
    sizes = [len(p) for p in registry.spread(spark.range(4000), "id", 100).rdd.glom().collect()]
    assert sum(sizes) == 4000 and len(sizes) == 40 and max(sizes) < 200


def test_texts_of_good_answers_stay_out_of_the_shuffle(spark, capsys):
    # as many bytes as a text that is good has, and one that is not
    rows = spark.createDataFrame([("1", "m", 1, 1, 200, '{"a": "GOOD"}'), ("2", "m", 1, 1, 200, "BAD"), ("2", "m", 1, 2, 500, "WORSE"), ("3", "m", 1, 1, 500, None)],
                                 records.RESPONSE_TYPE)
    best = records.best_attempt(rows)
    best.explain("formatted")
    plan = capsys.readouterr().out
    assert re.search(r"CASE WHEN NOT ok#\d+ THEN content#\d+", plan)
    got = {r.pmid: (r.attempt, r.ok, r.error_text) for r in best.drop("raw").collect()}
    assert got == {"1": (1, True, None), "2": (2, False, "HTTP 500: WORSE"), "3": (1, False, "HTTP 500: ")}


def test_answers_are_not_broadcast(spark):
    source = records.with_record_key(positioned(spark, [str(i) for i in range(20)]))
    said = answered(spark, source)
    model = said.first()["model"]
    rows = records.attach(source, said, model, 1)
    assert sum(r.error is None for r in rows.drop("raw").collect()) == 20
    assert len(rows.collect()) == 20
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_a_stored_document_is_cast_once_for_its_entities(spark, tmp_path):
    lines = ['{"article_level": {"pmid": "1"}, "model_level": [{"model_id_within_article": 1}, 7]}',
             '{"article_level": {"pmid": "2"}, "model_level": []}', '{"article_level": {"pmid": "3"}}', '{}', '  {} x']
    (tmp_path / "part.json").write_text("\n".join(lines))
    _, ent = jsonl.split_levels(jsonl.read_documents(spark, str(tmp_path)))
    assert sorted((r._source_pmid, r.model_id_within_article or 0) for r in ent.collect()) == [("1", 0), ("1", 1)]
    assert len(ent.columns) == len(DEFAULT_SCHEMA.entity_fields) + 2
    plan = ent._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("StructField(article_level") == 1
    assert plan.count("makeValid") == 1


def test_streams_are_packed(spark, tmp_path):
    source = positioned(spark, [str(i) for i in range(200)])
    extract.run_extract(source, answered(spark, source), str(tmp_path), "r")
    extract.run_rerun_flagged(source, extract.read_stream(spark, str(tmp_path), "r"), answered(spark, source), str(tmp_path), "r")
    for stream in (*extract.STREAMS, *extract.ADJUDICATED):
        files = list((tmp_path / stream).rglob("part-*"))
        files = [f for f in files if f.is_file()]
        assert files and all(f.name.endswith(".json.gz") for f in files), stream
    assert extract.read_stream(spark, str(tmp_path), "r").count() == extract.read_audit(spark, str(tmp_path), "r").count() == 200


def test_chunk_files_are_packed_and_scratch_is_gone(spark, tmp_path):
    record = ("<PubmedArticle><MedlineCitation><PMID>{0}</PMID><Article><Journal><JournalIssue><PubDate><Year>2020</Year></PubDate></JournalIssue></Journal>"
              "<ArticleTitle>vivo {0}</ArticleTitle></Article></MedlineCitation></PubmedArticle>")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.xml").write_text("".join(record.format(i) for i in (1, 2, 2, 3)))
    got = acquire.run_acquire(spark, str(tmp_path / "in"), str(tmp_path), "r", groups=(("vivo",),), years=(2008, 2027), excluded_types=()).collect()
    assert [r.n for r in got] == [3]
    written = [f.name for f in (tmp_path / "chunks").rglob("part-*") if f.is_file() and ".crc" not in f.name]
    assert written and all(n.endswith(".json.gz") for n in written)
    assert not [f for f in pathlib.Path(tmp_path / "unique").rglob("*") if f.is_file() and "part-" in f.name]


def test_the_pack_normalises_once(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(k, k) for k in range(1, 40)], "o_orderkey long, o_custkey long").withColumns(
        {"o_orderdate": F.to_date(F.lit("2020-01-02")), "o_orderpriority": F.lit("1-URGENT")}).write.parquet(f"{tmp_path}/orders.parquet")
    seen = []
    whole = runs.documents
    monkeypatch.setattr(runs, "documents", lambda *a, **k: seen.append(a) or whole(*a, **k))
    assert runs.pack_sketches(spark, str(tmp_path)).first().ids_within
    assert len(seen) == 1


@pytest.mark.parametrize("bound", [token_files.REMEMBERED_BYTES])
def test_remembered_words_leave_room_for_six_workers(bound):
    assert bound <= 96 << 20
