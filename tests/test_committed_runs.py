"""Committed parts, resumes by key, the id index, streams of batches, and the pruned normalisation."""

import json
import pathlib
import random

import pytest
from pyspark.sql import functions as F
from test_stored_runs import answered, positioned

from evidence.functions import jsontext
from evidence.operators import records
from evidence.operators.normalize import all_fields, needs_of, needs_review, normalize, review_fields
from evidence.plans import extract, prescreen
from evidence.schema import DEFAULT_SCHEMA, DIAGNOSTIC_ADDED, DIAGNOSTIC_RENAMES
from evidence.sources import commits, sinks
from evidence.streaming import incremental


def ids(df):
    return sorted((r.pmid or "").strip() for r in df.select("pmid").collect())


def total(df):
    return {(r.part, r.total, r.scheduled) for r in df.filter("shard is null").collect()}


def test_run_resume_force_and_a_broken_attempt(spark, tmp_path, monkeypatch):
    every = positioned(spark, [" 1 ", "2", "", "", "3"])
    first, said, base = every.filter("pmid != '3'"), answered(spark, every), str(tmp_path)
    extract.run_extract(first, said, base, "r")
    for n in (1, 0):
        extract.run_extract(every, said, base, "r", resume=True)
        # rows without id are resumed by their content
        assert ids(extract.read_stream(spark, base, "r")) == ["", "", "1", "2", "3"]
    assert {(x[1], x[2]) for x in total(extract.read_totals(spark, base, "r"))} == {(4, 4), (5, 1), (5, 0)}
    extract.run_extract(every, said, base, "r", force=True)
    assert ids(extract.read_stream(spark, base, "r")) == ["", "", "1", "2", "3"]
    assert {(x[1], x[2]) for x in total(extract.read_totals(spark, base, "r"))} == {(5, 5)}
    assert extract.read_audit(spark, base, "r").count() == 5

    def broken(streams, *where):
        sinks.write_by_shard(streams["extracted"], sinks.run_folder(where[0], "extracted", *where[1:]))
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(sinks, "write_streams", broken)
        with pytest.raises(RuntimeError):
            extract.run_extract(first, said, base, "r", force=True)
    assert ids(extract.read_stream(spark, base, "r")) == ["", "", "1", "2", "3"]
    assert len(list((pathlib.Path(base) / "extracted" / "run=r").iterdir())) == 2
    assert commits.vacuum(spark, base, "r", ["extract"], older_than_hours=0) > 0
    assert len(list((pathlib.Path(base) / "extracted" / "run=r").iterdir())) == 1
    extract.run_extract(first, said, base, "r")  # the whole run again, of fewer rows
    assert ids(extract.read_stream(spark, base, "r")) == ["", "", "1", "2"]


def test_named_parts(spark, tmp_path):
    one, two = positioned(spark, ["1"]), positioned(spark, ["2"])
    said, base = answered(spark, positioned(spark, ["1", "2"])), str(tmp_path)
    extract.run_extract(one, said, base, "r", part="a")
    extract.run_extract(two, said, base, "r", part="b")
    extract.run_extract(two, said, base, "r", part="b")
    assert ids(extract.read_stream(spark, base, "r")) == ["1", "2"]
    with pytest.raises(ValueError):
        extract.run_extract(two, said, base, "r", part="b", resume=True)
    assert commits.history(spark, base, "extract", "r").count() == 3
    assert [r.part for r in commits.live(spark, base, "extract", "r")] == ["a", "b"]


def test_nothing_is_committed_yet(spark, tmp_path):
    assert extract.read_stream(spark, str(tmp_path), "r").count() == 0
    assert extract.read_totals(spark, str(tmp_path), "r").count() == 0
    assert prescreen.read_outcomes(spark, str(tmp_path), "r").count() == 0
    assert commits.vacuum(spark, str(tmp_path), "r", ["extract"]) == 0


def test_forced_arbitration_replaces(spark, tmp_path):
    source = positioned(spark, ["1", "2"])
    said, base = answered(spark, source), str(tmp_path)
    extract.run_extract(source, said, base, "r")
    docs = extract.read_stream(spark, base, "r")
    second = said.withColumns({"model": F.lit("arbitration"), "pass": F.lit(2)})
    for _ in range(2):
        extract.run_rerun_flagged(source, docs, second, base, "r")
    done = extract.read_stream(spark, base, "r", "adjudicated")
    extract.run_rerun_flagged(source, docs, second, base, "r", adjudicated=done)
    assert ids(extract.read_stream(spark, base, "r", "adjudicated")) == ["1", "2"]
    assert ids(extract.read_audit(spark, base, "r", "adjudicated_audit")) == ["1", "2"]


def test_resumed_prescreen_keeps_its_parts_and_whole_answers(spark, tmp_path):
    abstract = "word " * 60
    rows = spark.createDataFrame([(i, f"t{i}", abstract, "s", "f", ["Journal Article"]) for i in ("1", "2", "3", "")],
                                 "pmid string, title string, abstract string, shard string, file_name string, publication_types array<string>")
    long = "no json here, " * 40
    keys = {r.pmid: r.record_key for r in records.with_record_key(rows).collect()}
    said = spark.createDataFrame(
        [(keys["1"], "m", 1, 1, 200, '{"decision": "include", "reason": "x"}'), (keys["2"], "m", 1, 1, 200, long),
         (keys["3"], "m", 1, 1, 500, "down"), (keys["3"], "m", 1, 2, 503, "still down " * 100), (keys[""], "m", 1, 1, 200, "{broken")],
        records.RESPONSE_TYPE)
    base = str(tmp_path)
    prescreen.run_prescreen(rows.filter("pmid in ('1', '2')"), said, base, "r")
    for _ in range(2):
        prescreen.run_prescreen(rows, said, base, "r", resume=True)
    got = {r.pmid or "": r for r in prescreen.read_outcomes(spark, base, "r").collect()}
    assert prescreen.read_outcomes(spark, base, "r").count() == 4
    assert got["1"].outcome == "included" and got["1"].error_text is None
    assert got["2"].error_text == long and len(got["2"].reason) < 130
    assert got["3"].error_text.endswith("still down " * 100) and got[""].error_text == "{broken"
    assert len(records.best_screening_attempt(said, head_chars=7).filter(F.col("pmid") == keys["2"]).first().answer.reason) < 30


def add(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps({"pmid": i, "title": f"t{i}"}) + "\n" for i in rows))


def test_index_reads_touched_buckets_only(spark, tmp_path):
    add(tmp_path / "in", "s_1.jsonl", [str(i) for i in range(500)])
    where = [str(tmp_path / x) for x in ("in", "out", "cp")]
    incremental.ingest(spark, *where, by="none").awaitTermination()
    batch = spark.createDataFrame([("7",), (" 7 ",), ("900",), ("",)], "pmid string")
    buckets = {r[0] for r in batch.filter("pmid != ''").select(incremental.bucket_of("pmid")).collect()}
    for _ in range(2):
        found = incremental.arrived(batch, where[1])
        files = {pathlib.Path(f).parent.name for f in found.inputFiles()}
        read = {pathlib.Path(f.replace("file://", "")).parent.name for f in
                {r[0] for r in found.select(F.input_file_name()).collect()}}
        assert read <= {f"bucket={b}" for b in buckets} and len(files) > len(buckets)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
        assert ids(records.pending(batch, found)) == ["", "900"]
        incremental.compact_ids(spark, where[1])
        assert len(incremental.index_paths(spark, where[1])) == 1
    add(tmp_path / "in", "s_2.jsonl", ["7", "900"])
    incremental.ingest(spark, *where, by="none").awaitTermination()
    assert len(incremental.index_paths(spark, where[1])) == 2  # the merged one and the new batch's
    assert incremental.read_ingested(spark, where[1]).count() == 501
    assert [(r.rows, r.written) for r in incremental.progress_table(spark, where[1]).orderBy("committed_at").collect()] == [(500, 500), (2, 1)]
    # a forced run does not look at what it replaces, nor at a merged index of it
    incremental.ingest(spark, *where, by="none", force=True, files_per_batch=1).awaitTermination()
    assert incremental.read_ingested(spark, where[1]).count() == 501
    live = incremental.progress_table(spark, where[1]).filter("live").orderBy("committed_at").collect()
    assert [(r.generation, r.rows, r.written) for r in live] == [(2, 500, 500), (2, 2, 1)]


def test_a_repeated_batch_replaces_itself(spark, tmp_path, monkeypatch):
    """A batch fails after its commit but before the stream's checkpoint; the restart repeats it."""
    add(tmp_path / "in", "s_1.jsonl", ["1", "2", "2"])
    where = [str(tmp_path / x) for x in ("in", "out", "cp")]
    asked = []

    def respond(prompts):
        keys = [r.record_key for r in prompts.collect()]
        asked.append(sorted(keys))
        return spark.createDataFrame([(k, "primary", 1, 1, 200, '{"article_level": {}}') for k in keys], records.RESPONSE_TYPE)

    def failing(*_):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(commits, "drop_folder", failing)
        with pytest.raises(Exception, match="lost"):
            incremental.extract_stream(spark, *where, respond).awaitTermination()
    assert ids(incremental.read_extracted(spark, where[1])) == ["1", "2"]
    incremental.extract_stream(spark, *where, respond).awaitTermination()
    assert ids(incremental.read_extracted(spark, where[1])) == ["1", "2"] and asked == [["1", "2"]] * 2
    add(tmp_path / "in", "s_1_more.jsonl", ["2", "3"])
    incremental.extract_stream(spark, *where, respond).awaitTermination()
    for stream in ("extracted", "review"):
        assert ids(incremental.read_extracted(spark, where[1], stream)) == ["1", "2", "3"]
    assert asked[-1] == ["3"]
    table = incremental.progress_table(spark, where[1])
    assert {(r.live, r.rows, r.ok, r.review) for r in table.collect()} == {(False, 3, 2, 2), (True, 3, 2, 2), (True, 2, 1, 1)}


# --- pruned normalisation ---------------------------------------------------------------------

SCORES = {"sample_size_score": 3, "validation_rigor_score": "4 of 20", "method_score": 30, "performance_score": 1,
          "clinical_applicability_score": 2, "total_score": 50}
ANSWERS = [
    {"article_level": {"pmid": 5, "title": " a  b ", "primary_subspecialty": "Oncology!", "number_of_models_described": -2,
                       "study_quality_score": SCORES, "article_has_external_validation": "yes"},
     "model_level": [{"model_name": "m", "validation_type": "bootstrap", "sample_size": "n=1,200", "predictors_raw": "a; b",
                      "performance_metrics": {"auc": "0.8 (x)"}, "model_quality_score": SCORES},
                     "no object", {"validation_type": "external validation", "has_internal_validation": "no"}],
     "normalization": {"overall_extraction_confidence": "70%"}, "quality_flags": {"disease_ambiguous": "Y"}},
    {"article_level": [], "model_level": {}}, {"model_level": []}, {"article_level": {"is_multimodel_article": True}, "model_level": [{}, {}]},
    [], None,
]


def normalised(spark, schema, fields=None):
    rows = spark.createDataFrame([(str(n), "src", json.dumps(a), None if n else "failed") for n, a in enumerate(ANSWERS)],
                                 "pmid string, journal string, content string, error string").coalesce(1)
    parsed = rows.withColumn("raw", jsontext.parse_object("content"))
    return normalize(parsed, schema, error="error", fields=fields).orderBy("pmid")


def value(row, path):
    if path == "issues":
        return row.issues
    level, _, name = path.partition(".")
    held = row.doc[level]
    return [m[name] for m in held] if isinstance(held, list) and name else held[name] if name else len(held)


@pytest.mark.parametrize("schema", [DEFAULT_SCHEMA, DEFAULT_SCHEMA.adapted(DIAGNOSTIC_RENAMES, DIAGNOSTIC_ADDED)])
def test_pruned_fields_have_the_values_of_the_whole(spark, schema):
    whole = normalised(spark, schema).collect()
    rng, every = random.Random(4), all_fields(schema)
    kinds = {f.kind: f"{level}.{f.name}" for level, fields in ((schema.article_key, schema.article_fields),
                                                              (schema.entity_key, schema.entity_fields)) for f in fields}
    alone = [schema.entity_key, "issues", f"{schema.article_key}.{schema.article_count}", f"{schema.article_key}.{schema.article_multi}",
             f"{schema.article_key}.{schema.article_external}", f"{schema.entity_key}.{schema.entity_internal}",
             f"{schema.article_key}.{schema.article_notes}", f"quality_flags.{schema.review_flag}", "normalization", *kinds.values()]
    for wanted in [[x] for x in alone] + [rng.sample(every, 5) for _ in range(6)]:
        got = normalised(spark, schema, wanted).collect()
        given = needs_of(wanted, schema).given
        for a, b in zip(whole, got, strict=True):
            assert {p: value(a, p) for p in given} == {p: value(b, p) for p in given}, wanted
        assert ("issues" in got[0]) == ("issues" in wanted)


def test_review_of_pruned_documents(spark):
    pruned = normalised(spark, DEFAULT_SCHEMA, review_fields()).select(needs_review().alias("r")).collect()
    assert pruned == normalised(spark, DEFAULT_SCHEMA).select(needs_review().alias("r")).collect()


def test_a_field_does_not_read_the_rest(spark):
    one = normalised(spark, DEFAULT_SCHEMA, ["article_level.journal"])._jdf.queryExecution().optimizedPlan().toString()
    assert "model_name" not in one and "validation_type" not in one
    with pytest.raises(ValueError):
        needs_of(["article_level.nothing"])
    assert needs_of(["article_level.is_multimodel_article"]).computed == {
        "article_level.is_multimodel_article", "article_level.number_of_models_described", "model_level"}
