"""Operators on small frames: normalisation, keyed records, sources, chunks, streaming."""

import json

import pytest
from pyspark.sql import functions as F

from evidence.functions import jsontext
from evidence.functions.text import computed
from evidence.operators import analysis, chunks, prompts, records, screen
from evidence.operators.normalize import needs_review, normalize
from evidence.plans import acquire, extract, prescreen, report
from evidence.schema import (DEFAULT_SCHEMA, DIAGNOSTIC_ADDED, DIAGNOSTIC_RENAMES, SCORE_KEYS,
                             PrefilterRules)
from evidence.sources import article_xml, jsonl, sinks
from evidence.streaming import incremental

GOOD_SCORES = dict.fromkeys(SCORE_KEYS, 10)


def answer(**changes):
    """A clean answer that needs no review, with changes."""
    base = {
        "article_level": {"pmid": "1", "title": "T", "primary_subspecialty": "cardiology",
                          "study_quality_score": GOOD_SCORES},
        "model_level": [{"model_name": "m", "disease_subspecialty": "cardiology", "outcome_group": "mortality",
                         "model_method_group": "svm", "validation_type": "bootstrap",
                         "model_quality_score": GOOD_SCORES}],
        "normalization": {"overall_extraction_confidence": 90}, "quality_flags": {}}
    return {**base, **changes}


def normalised(spark, answers, **kw):
    rows = [(str(i), f"title {i}", json.dumps(a) if not isinstance(a, str) else a) for i, a in enumerate(answers)]
    df = spark.createDataFrame(rows, "pmid string, title string, content string").repartition(1)
    return normalize(computed(df, {"raw": jsontext.parse_object("content")}), **kw).drop("raw")


def collected(df):
    return [r.asDict(True) for r in df.orderBy(F.col("pmid").cast("int")).collect()]


def test_normalise_rules(spark):
    model = answer()["model_level"][0]
    docs = collected(normalised(spark, [
        answer(),
        answer(model_level=[model, "s", {**model, "validation_type": "external_validation",
                                         "has_external_validation": False}]),
        answer(article_level={"number_of_models_described": -1}),
        answer(article_level={"number_of_models_described": "5"}, model_level=None),
        {"article_level": []},
        answer(normalization={"overall_extraction_confidence": 59}),
        answer(normalization={"overall_extraction_confidence": "60 %"}),
        answer(model_level=[]),
        answer(model_level=[{**model, "model_quality_score": None}]),
        answer(quality_flags={"method_ambiguous": "yes"}),
        answer(article_level={"primary_subspecialty": "Other"}),
    ]).withColumn("review", needs_review()))
    art = [d["doc"]["article_level"] for d in docs]
    models = [d["doc"]["model_level"] for d in docs]
    assert docs[0]["issues"] == [] and not docs[0]["review"] and art[0]["pmid"] == "1"
    assert (models[0][0]["has_external_validation"], models[0][0]["has_internal_validation"]) == (False, True)
    assert (art[0]["article_has_external_validation"], art[0]["article_has_internal_validation"]) == (False, True)
    assert [m["model_id_within_article"] for m in models[1]] == [1, 2]
    assert models[1][1]["has_external_validation"] is False and art[1]["is_multimodel_article"]
    assert docs[1]["issues"] == ["model[1]_not_object"]
    assert docs[2]["issues"] == ["number_of_models_negative"] and art[2]["number_of_models_described"] == 1
    assert docs[3]["issues"] == ["missing_model_level_array"] and art[3]["number_of_models_described"] == 5
    assert art[3]["is_multimodel_article"] and art[3]["article_has_external_validation"] is None
    assert docs[4]["issues"] == ["missing_article_level", "missing_model_level_array"]
    assert art[4]["title"] == "title 4" and art[4]["pmid"] == "4" and art[4]["study_design"] == "unclear"
    assert [d["review"] for d in docs[5:10]] == [True, False, True, True, True]
    assert docs[10]["issues"] == ["article.primary_subspecialty_out_of_set"]
    flags = [d["doc"]["quality_flags"]["requires_human_review"] for d in docs]
    assert all(f == bool(d["issues"]) for f, d in zip(flags, docs))


def test_normalise_is_idempotent(spark, sf):
    from bindings.extraction import documents
    first = documents(spark, sf).filter("size(issues) = 0 or not array_contains(issues, 'x')")
    again = first.select("pmid", F.to_json("doc", {"ignoreNullFields": "false"}).alias("content"),
                         F.col("doc").alias("before"))
    redone = normalize(computed(again, {"raw": jsontext.parse_object("content")}))
    differing = redone.filter(
        F.to_json(F.col("doc").dropFields("quality_flags")) != F.to_json(F.col("before").dropFields("quality_flags")))
    assert differing.count() == 0


def test_failed_answers_give_the_empty_template(spark):
    df = spark.createDataFrame([("7", "T", "no  braces")], "pmid string, title string, error string")
    row = collected(normalize(df.withColumn("raw", F.parse_json(F.lit("1")).cast("variant"))
                              .withColumn("raw", F.try_parse_json(F.lit(""))), error="error"))[0]
    assert row["issues"] == ["primary_failed:no braces"]
    assert row["doc"]["article_level"]["overall_notes"] == "primary_failed: no braces"
    assert row["doc"]["quality_flags"]["requires_human_review"] and row["doc"]["model_level"] == []


def test_adapted_schema(spark):
    schema = DEFAULT_SCHEMA.adapted(DIAGNOSTIC_RENAMES, DIAGNOSTIC_ADDED, {"method": ("imaging", "unclear")})
    item = {"index_test_name": "CT", "test_modality": "Imaging", "reference_standard": " biopsy ",
            "index_test_description": "a; b"}
    doc = collected(normalised(spark, [answer(model_level=[item])], schema=schema))[0]["doc"]
    got = doc["model_level"][0]
    assert (got["test_id"], got["index_test_name"], got["test_modality"], got["reference_standard"]) == (
        1, "CT", "imaging", "biopsy")
    assert got["index_test_description"] == ["a", "b"]
    assert '"reference_standard"' in prompts.answer_skeleton(schema)


def test_prefilter_order(spark):
    long = "x" * 50
    rows = [("1", ["Case Reports"], "A review", long), ("2", ["Journal Article"], "A Review of x", long),
            ("3", [], "t", "x" * 49), ("4", [], "t", chr(0xA0) + long + "\n"), ("5", [], "t", None),
            ("6", None, None, long), ("7", ["Letter", "Systematic Review"], "t", long),
            ("8", [], "transcriptomic atlas", long), ("9", [], "Genome-wide study", long)]
    df = spark.createDataFrame(rows, "pmid string, publication_types array<string>, title string, abstract string")
    got = {r["pmid"]: r["exclude_reason"] for r in screen.prefilter(df).collect()}
    assert got == {"1": "Publication type: case report", "2": "Title match: review", "3": "No abstract or too short",
                   "4": None, "5": "No abstract or too short", "6": None, "7": "Publication type: review",
                   "8": None, "9": "Title match: omics-focused"}


def positioned(spark, ids, shard="a"):
    rows = [(p, i, shard, "f", 0) for i, p in enumerate(ids)]
    return spark.createDataFrame(rows, "pmid string, ord bigint, shard string, file_name string, block_start bigint")


def test_hot_and_empty_ids(spark):
    """One id fills a third of the rows, another third has none."""
    n = 3000
    df = positioned(spark, ["hot"] * n + [""] * n + [str(i) for i in range(n)]).repartition(8)
    kept = records.dedupe_first(df).cache()
    assert kept.count() == 1 + n + n
    assert kept.filter("pmid = 'hot'").first()["ord"] == 0
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    left = records.pending(df, spark.createDataFrame([("hot",), ("",), ("1",)], "pmid string"))
    assert left.count() == n + n - 1
    kept.unpersist()


def test_attempts(spark):
    rows = [("1", "m", 1, 1, 429, "busy"), ("1", "m", 1, 2, 200, '{"a": 1}'), ("1", "m", 1, 3, 200, '{"a": 2}'),
            ("2", "m", 1, 1, 200, "none"), ("2", "m", 1, 2, 503, "x" * 900), ("3", "m", 1, 1, 400, "y" * 2000)]
    best = {r["pmid"]: r for r in records.best_attempt(
        spark.createDataFrame(rows, records.RESPONSE_TYPE)).drop("raw").collect()}
    assert (best["1"]["attempt"], best["1"]["ok"], best["1"]["error"]) == (2, True, None)
    assert best["2"]["error"] == "HTTP 503: " + "x" * 500
    assert best["3"]["error"] == "HTTP 400: " + "y" * 1000


def test_second_pass(spark):
    source = positioned(spark, ["1", "2", "3", "4"]).withColumn("title", F.lit("t"))
    weak = answer(normalization={"overall_extraction_confidence": 30})
    rows = [(p, "a", 1, 1, 200, json.dumps(weak if p in "23" else answer())) for p in "123"]
    rows += [("2", "b", 2, 1, 200, json.dumps(answer())), ("3", "b", 2, 1, 500, "down"), ("1", "b", 2, 1, 200, "{}")]
    settings = extract.RunSettings("a", "b", second_pass=True)
    out = {r["pmid"]: r.asDict(True) for r in extract.extract(
        source, spark.createDataFrame(rows, records.RESPONSE_TYPE), settings=settings).collect()}
    assert [out[p]["needs_review"] for p in "1234"] == [False, False, True, True]
    assert [out[p]["audit"]["inline_second_pass"] for p in "1234"] == [False, True, True, False]
    assert [out[p]["status"] for p in "1234"] == ["ok", "ok", "ok", "error"]
    assert out["3"]["issues"][-1].startswith("second_pass_failed:LLM call failed, model=b")
    assert out["3"]["doc"]["normalization"]["overall_extraction_confidence"] == 20
    assert out["4"]["doc"]["article_level"]["overall_notes"].endswith("error=no response")


def test_run_and_resume(spark, tmp_path):
    source = positioned(spark, ["1", "2", "2", "", ""]).withColumn("title", F.col("ord").cast("string"))
    keyed = records.with_record_key(source)
    rows = [(r["record_key"], "primary", 1, 1, 200, json.dumps(answer(article_level={}))) for r in keyed.collect()]
    responses = spark.createDataFrame(rows, records.RESPONSE_TYPE)
    totals = extract.run_extract(source, responses, str(tmp_path), "r1").collect()
    assert {(r["shard"], r["total"], r["scheduled"], r["ok"], r["errors"]) for r in totals} == {
        ("a", 5, 4, 4, 0), (None, 5, 4, 4, 0)}
    docs = jsonl.read_documents(spark, f"{tmp_path}/extracted/run=r1")
    assert docs.count() == 4
    done = records.processed_ids(docs)
    assert sorted(r[0] for r in done.collect()) == ["1", "2"]
    assert extract.scheduled(source, done).count() == 2
    tables = report.analysis_pack(docs)
    assert tables["counts"].first()["n_articles"] == 4
    assert all(df.columns for df in tables.values())


def test_outgoing_and_incoming(spark):
    df = positioned(spark, ["1", ""]).withColumns({c: F.lit(c) for c in ("title", "abstract", "journal")})
    df = df.withColumn("publication_types", F.array(F.lit("x")))
    sent = extract.outgoing(df, style="short")
    assert {m["messages"][0]["role"] for m in sent.collect()} == {"system"}
    back = prompts.respond(sent, lambda batch: [json.dumps(answer()) for _ in batch], "primary")
    assert extract.extract(df, back).filter("status = 'ok'").count() == 2
    rules = PrefilterRules((), (), 0)
    asked = prescreen.outgoing(df, rules)
    said = prompts.respond(asked, lambda batch: ['{"decision": "include"}'] * len(batch), "m")
    assert prescreen.screened(df, said, rules).count() == 2


def test_tolerant_scan(spark, tmp_path):
    (tmp_path / "articles_00012.jsonl").write_bytes(
        b'{"pmid": "1", "publication_types": "Review", "mesh_terms": ["A", {"descriptor": "B", "qualifiers": ["q"]}]}\n'
        b'\n{"pmid": "2", bad\n[1]\n{"pmid": "3", "title": "x\xff"}\n{"pmid": "4"} tail\n')
    rows = {r["pmid"]: r for r in jsonl.articles(jsonl.read_jsonl(spark, str(tmp_path))).collect()}
    assert set(rows) == {"1", "3"}
    assert rows["1"]["publication_types"] == ["Review"] and rows["1"]["mesh_terms"] == ["A", "B [q]"]
    assert rows["3"]["title"] == "x" + chr(0xFFFD) and rows["3"]["shard"] == "00012"
    with pytest.raises(Exception):
        jsonl.read_jsonl(spark, str(tmp_path), mode="strict").collect()


def test_parse_is_not_repeated_below_the_filter(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"pmid": "1"}\n')
    plan = jsonl.read_jsonl(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1


def test_xml_files(spark, tmp_path):
    one = ("<PubmedArticle>\n<MedlineCitation><PMID>{0}</PMID><Article><ArticleTitle>A <i>b</i> c</ArticleTitle>"
           "</Article></MedlineCitation></PubmedArticle>\n")
    text = "<?xml version='1.0'?>\n<PubmedArticleSet>\n" + "".join(one.format(i) for i in range(50))
    (tmp_path / "x.xml").write_text(text + "<PubmedArticle><MedlineCitation/></PubmedArticle></PubmedArticleSet>\n")
    got = article_xml.read_article_xml(spark, str(tmp_path)).collect()
    assert sorted(int(r["pmid"]) for r in got) == list(range(50)) and got[0]["title"] == "A b c"
    lead = article_xml.read_article_xml(spark, str(tmp_path), title_text="leading").first()
    assert lead["title"] == "A "


def test_acquire_from_xml(spark, tmp_path):
    one = ("<PubmedArticle><MedlineCitation><PMID>{0}</PMID><Article><Journal><JournalIssue><PubDate><Year>2020</Year>"
           "<Month>{1}</Month></PubDate></JournalIssue></Journal><ArticleTitle>{2}</ArticleTitle></Article>"
           "</MedlineCitation></PubmedArticle>\n")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.xml").write_text("<PubmedArticleSet>" + "".join(
        one.format(i % 30, "Jan" if i % 2 else "Feb", "Risk models in patients" if i % 30 < 20 else "Other")
        for i in range(60)) + "</PubmedArticleSet>")
    got = acquire.acquire_xml(spark, str(tmp_path / "in"), str(tmp_path / "out"), rows=5, max_rows=12)
    assert {r["chunk_id"]: r["n"] for r in got.collect()} == {"2020-01": 10, "2020-02": 10}


def test_chunks_conserve_rows_and_split_hot_days(spark):
    dates = ["2020-01-05"] * 900 + [f"2020-02-{d:02d}" for d in range(1, 29)] * 10 + ["2021"] * 5 + [None, "1999-01-01"]
    df = spark.createDataFrame([(str(i), d) for i, d in enumerate(dates)], "pmid string, pub_date string")
    out = chunks.plan_chunks(df, max_rows=200)
    assert out.count() == len(dates)
    got = {r["chunk_id"]: r["n"] for r in chunks.manifest(out).collect()}
    assert got["2020-01-05"] == 900 and got["2020-02-07"] == 10 and got["2021"] == 5 and got["undated"] == 2
    assert out.filter("chunk_id = '2020-01-05'").select("part").distinct().count() == 5
    assert chunks.plan_chunks(df, max_rows=5000).select("chunk_id").distinct().collect() == [("all",)]


def test_numbering_matches_a_window(spark, sf):
    ids = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_orderkey").cast("string").alias("pmid"))
    got = [(r["pmid"], r["row_no"]) for r in chunks.number_rows(ids, ["pmid"]).orderBy("row_no").collect()]
    assert got == [(p, i + 1) for i, p in enumerate(sorted(p for p, _ in got))]


def test_incremental_intake(spark, tmp_path):
    def add(name, ids):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_text("".join(json.dumps({"pmid": i, "title": name}) + "\n" for i in ids))
    where = (str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"))

    def run(**kw):
        query = incremental.ingest(spark, *where, by="none", **kw)
        query.awaitTermination()
        return query
    add("s_1.jsonl", ["1", "2", "2", ""])
    first = run()
    assert sum(b["rows"] for b in incremental.progress(first)) == 4
    assert incremental.read_ingested(spark, where[1]).count() == 3
    run()
    assert incremental.read_ingested(spark, where[1]).count() == 3
    add("s_2.jsonl", ["2", "3"])
    run()
    assert sorted(r["pmid"] for r in incremental.read_ingested(spark, where[1]).collect()) == ["", "1", "2", "3"]
    forced = run(force=True)
    assert spark.read.parquet(forced.output_path).count() == 4


def test_stream_dedupe(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text('{"pmid": "1"}\n{"pmid": "1"}\n{"pmid": "2"}\n')
    stream = incremental.unique_ids(incremental.stream_articles(spark, str(tmp_path / "in")))
    query = (stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp"))
             .trigger(availableNow=True).start(str(tmp_path / "out")))
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_sharded_sink(spark, sf, tmp_path):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select(
        F.col("doc_id").cast("string").alias("pmid"), F.lit(None).cast("string").alias("doi"))
    sinks.write_sharded(rows, str(tmp_path / "o"), rows=40, order=["pmid"])
    files = list((tmp_path / "o").glob("*.json"))
    assert max(len(f.read_text().splitlines()) for f in files) <= 40
    assert '"doi":null' in files[0].read_text() and spark.read.json(str(tmp_path / "o")).count() == 200


def test_rubric_bands(spark):
    rows = [(99, 5, True), (99, 6, False), (500, 7, True), (500, 14, True), (500, 16, False), (2001, 15, True), (None, 3, None)]
    df = spark.createDataFrame(rows, "n int, s int, ok boolean")
    assert df.filter(~analysis.sample_size_in_band(F.col("n"), F.col("s")).eqNullSafe(F.col("ok"))).count() == 0


def test_compared_documents_of_one_side_and_without_id(spark):
    from evidence.operators import analysis
    kind = "pmid string, doc struct<x:string>"
    one = spark.createDataFrame([("1", ("a",)), ("2", ("a",)), (None, ("a",)), ("", ("b",))], kind)
    two = spark.createDataFrame([("1", ("b",)), ("3", ("a",)), ("4", ("a",)), (None, ("a",))], kind)
    got = [tuple(r) for r in analysis.compare_documents(one, two, ["x"]).collect()]
    assert got == [("x", 1, 1, 0, 0, 1, 2, 2, 1)]
