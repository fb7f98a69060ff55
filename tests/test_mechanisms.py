"""Term index, stored order, names by hierarchy, answers in rounds, the merged pack, acquisition as a run."""

import math
import random

import pytest
from pyspark.sql import functions as F
from test_committed_runs import ANSWERS, normalised
from test_stored_runs import answered, positioned

from evidence.functions import terms
from evidence.operators import chunks, hierarchy, prompts, records, screen
from evidence.plans import acquire, extract, pack, report, rounds
from evidence.schema import DEFAULT_SCHEMA, SHORT_RULES, ExtractionSchema, Field
from evidence.sources import commits

TERMS = ["risk", "prognos*", "risk score", "x-ray*", "machine learning*", "c++", "++", "naïve bayes", "Größe", "σοφός", "İzmir", "ſtone*",
         "a.b", "o'clock", "don't*", "back\\slash", "über*", "-omics", "_low", "漢字", "e9*", "deep  two"]


def test_term_index_answers_like_the_pattern(spark):
    rng = random.Random(6)
    parts = ["risk", "Risk-score", "risk score", "riskscore", "PROGNOSTIC", "prognosis", "x-ray", "X-rays", "xray", "machine", "learning",
             "Machine Learnings", "c++", "c", "++", "NAÏVE BAYES", "naive", "GRÖSSE", "größe", "ΣΟΦΌΣ", "σοφός", "izmir", "İZMİR", "Stones", "ſtone",
             "a.b", "A.Bc", "o'clock", "o’clock", "don't", "don'ts", "back\\slash", "Übermut", "pan-omics", "-omics", "_low", "漢字", "漢字学", "E9b", "e 9",
             "deep  two", "deep two", "\n", "\t", "(", ")", "́", "3", ""]
    rows = [(k, " ".join(rng.choice(parts) for _ in range(rng.randrange(5))) if k else None) for k in range(500)]
    rows += [(1000 + k, p) for k, p in enumerate(parts)]
    df = spark.createDataFrame(rows, "k int, t string")
    for some in [TERMS, *([t] for t in TERMS), *(rng.sample(TERMS, 5) for _ in range(4))]:
        got = df.select("k", "t", terms.TermIndex(some).hit("t").alias("a"), F.rlike("t", F.lit(terms.term_pattern(some))).alias("b"))
        assert got.filter("NOT (a <=> b)").collect() == [], some


def test_large_groups_use_the_index(spark):
    many = tuple(f"term{i}" for i in range(3000)) + ("risk",)
    df = spark.createDataFrame([("a risk", "", "2015"), ("term29 99", "", "2015"), ("term2999!", "", "2015"), ("terms", None, "2015")],
                               "title string, abstract string, pub_date string")
    kept = screen.corpus_filter(df, (many, ("risk", "term2999")), (2010, 2020), ())
    assert sorted(r.title for r in kept.collect()) == ["a risk", "term2999!"]


def test_pages_are_adjacent_on_both_sides_of_the_border(spark, monkeypatch):
    df = spark.range(60).select((F.col("id") % 3).alias("k"), "id").repartition(5)
    monkeypatch.setattr(chunks, "DEEP_ROWS", 20)
    got = [r.id for start in (0, 10, 20, 30, 40, 50) for r in chunks.page(df, ["k"], start, 10).collect()]
    assert sorted(got) == list(range(60))


def test_stored_pages_read_their_folders_only(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), "id", F.lit(None).cast("string").alias("nothing"))
    chunks.store_order(df, str(tmp_path / "o"), ["k"], block_rows=100)
    got = [r.id for start in range(0, 1000, 90) for r in chunks.stored_page(spark, str(tmp_path / "o"), start, 90).collect()]
    assert sorted(got) == list(range(1000))
    page = chunks.stored_page(spark, str(tmp_path / "o"), 250, 100)
    assert page.columns == ["k", "id", "nothing"]
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(block" in plan and "block#" in plan.split("PartitionFilters")[1][:120]
    chunks.store_order(df.limit(0), str(tmp_path / "e"), ["k"])
    assert chunks.stored_page(spark, str(tmp_path / "e"), 0, 10).count() == 0 if (tmp_path / "e" / "rows").exists() else True


def test_hierarchy_of_many_parents_cycles_and_spellings(spark):
    tree = spark.createDataFrame([("Heart Failure", "heart diseases"), ("heart diseases", "Cardiovascular"), ("Cardiovascular", "Diseases"),
                                  ("heart failure", "symptoms"), ("loop a", "loop b"), ("loop b", "loop a"), ("x", "x"), ("", "y"), (None, "z")],
                                 "term string, parent string")
    known = spark.createDataFrame([("Diseases",), ("Symptoms",), ("Cardiovascular",)], "term string")
    labels = spark.createDataFrame([("HEART failure",), ("heart diseases",), ("diseases",), ("loop a",), ("unknown",), (None,), ("heart failure",)], "l string")
    got = hierarchy.conservative_name(labels, "l", tree, known, "n").collect()
    assert len(got) == 7
    said = {r.l: (r.n, r.n_distance) for r in got}
    assert said == {"HEART failure": ("Symptoms", 1), "heart failure": ("Symptoms", 1), "heart diseases": ("Cardiovascular", 1),
                    "diseases": ("Diseases", 0), "loop a": (None, None), "unknown": (None, None), None: (None, None)}
    depth = {(r.term, r.ancestor) for r in hierarchy.at_depth(tree, 1, labels.withColumnRenamed("l", "term")).collect()}
    assert ("heart_failure", "cardiovascular") in depth and ("diseases", "diseases") not in depth
    assert hierarchy.ancestors(tree.limit(0)).count() == 0


def test_rounds_go_on_where_the_commits_end(spark, tmp_path, monkeypatch):
    source = positioned(spark, [str(i) for i in range(10)])
    asked, base = prompts.render_prompts(source, "pmid", style="short"), str(tmp_path)

    def infer(keys, messages, attempt):
        if attempt == 2 and "3" in keys:
            raise RuntimeError("worker lost")
        return [(200, '{"a": 1}') if int(k) % 3 < attempt else (429, "slow down") for k in keys]
    with monkeypatch.context() as m:
        m.setattr(commits, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("broken off")))
        with pytest.raises(RuntimeError):
            rounds.run_prompts(asked, infer, base, "r")
    assert rounds.rounds(spark, base, "r").count() == 0
    rounds.run_prompts(asked, infer, base, "r", max_attempts=1)
    got = rounds.run_prompts(asked, infer, base, "r")
    told = {r.attempt: (r.asked, r.good) for r in rounds.rounds(spark, base, "r").collect()}
    assert told[1] == (10, 4) and told[2][0] == 6 and list(told.values())[-1][1] > 0 and sum(g for _, g in told.values()) == 10
    best = records.best_attempt(got).collect()
    assert len(best) == 10 and all(r.ok for r in best)
    with pytest.raises(Exception, match="answers came back"):
        rounds.asked(asked, lambda k, m, a: [], "m", 1, 1).count()


def test_later_rounds_neither_render_nor_lose_prompts(spark, tmp_path):
    """Every prompt is made once; a key that comes twice is settled by its one good answer, a null key never is."""
    made = spark.sparkContext.accumulator(0)

    def render(k):
        made.add(1)
        return "None" if k is None else k
    words = F.udf(render, "string")
    keys = spark.createDataFrame([(str(i),) for i in range(8)] + [("5",), (None,)], "k string").repartition(1)
    asked = keys.select("k", F.array(F.struct(F.lit("user").alias("role"), words("k").alias("content"))).alias("messages"))

    def infer(keys_, messages, attempt):
        assert [m[0]["content"] for m in messages] == list(keys_)
        fives = iter((False, True))
        return [(200, '{"a": 1}') if (next(fives, True) if k == "5" else k == "None" or int(k) % 3 < attempt) else (429, "") for k in keys_]
    got = rounds.run_prompts(asked, infer, str(tmp_path), "r", max_attempts=3)
    told = {r.attempt: (r.asked, r.good) for r in rounds.rounds(spark, str(tmp_path), "r").collect()}
    assert told == {1: (10, 5), 2: (5, 4), 3: (2, 2)} and got.count() == 17
    assert made.value == 10
    assert not any(p.is_file() for p in (tmp_path / "asked").rglob("*"))


def test_a_merged_pack_equals_the_pack_of_all(spark, tmp_path):
    docs = normalised(spark, DEFAULT_SCHEMA).select("doc")
    docs = docs.unionByName(docs.limit(1)).withColumn("half", F.monotonically_increasing_id() % 2)
    whole, base = report.analysis_pack(docs.drop("half")), str(tmp_path)
    for part in (0, 1, 0):
        pack.add_part(docs.filter(F.col("half") == part).drop("half"), base, "r", f"p{part}")
    merged = pack.pack_tables(spark, base, "r")

    def cells(df):
        return sorted(tuple("~" if x is None else f"{x:.9g}" if isinstance(x, float) and not math.isnan(x) else str(x) for x in r)
                      for r in df.collect())
    for name in merged.keys() - {"sample_sizes"}:
        assert merged[name].columns == whole[name].columns, name
        assert cells(merged[name]) == cells(whole[name]), name
    assert len(ANSWERS) + 1 == merged["counts"].first().n_articles
    empty = pack.pack_tables(spark, str(tmp_path / "none"), "r")
    assert empty["counts"].first().n_articles == 0 and empty["subspecialties"].count() == 0


RECORD = ("<PubmedArticle><MedlineCitation><PMID>{0}</PMID><Article><Journal><JournalIssue><PubDate><Year>2020</Year></PubDate>"
          "</JournalIssue></Journal><ArticleTitle>risk {1}</ArticleTitle></Article></MedlineCitation></PubmedArticle>\n")


def test_acquisition_reads_new_and_changed_files_only(spark, tmp_path, monkeypatch):
    (tmp_path / "in put").mkdir()

    def put(name, ids):
        (tmp_path / "in put" / name).write_text("<Set>" + "".join(RECORD.format(i, name) for i in ids) + "</Set>")
    options = {"groups": (("risk",),), "excluded_types": (), "years": (2010, 2026)}
    args = (spark, str(tmp_path / "in put"), str(tmp_path / "out"), "r")
    put("a.xml", [1, 2, 2])
    put("empty.xml", [])
    assert {r.chunk_id: r.n for r in acquire.run_acquire(*args, **options).collect()} == {"all": 2}
    put("b.xml", [2, 3])
    for _ in range(2):
        assert acquire.run_acquire(*args, **options).first().n == 3
    assert commits.history(spark, args[2], "acquire", "r").count() == 2
    files = {r.file.rsplit("/")[-1]: (r.records, r.kept) for r in acquire.read_files(*args[:1], *args[2:]).collect()}
    assert files == {"a.xml": (3, 2), "b.xml": (2, 1), "empty.xml": (0, 0)}
    put("a.xml", [1, 2, 4, 5, 6])  # another size: read again
    assert acquire.run_acquire(*args, **options).first().n == 6
    assert sorted(r.pmid for r in acquire.read_chunks(spark, *args[2:]).collect()) == list("123456")
    with monkeypatch.context() as m:
        m.setattr(commits, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        put("c.xml", [7])
        with pytest.raises(RuntimeError):
            acquire.run_acquire(*args, **options)
    assert acquire.read_manifest(spark, *args[2:]).first().n == 6
    assert acquire.run_acquire(*args, **options).first().n == 7
    assert acquire.run_acquire(*args, force=True, **options).first().n == 7
    assert acquire.read_files(spark, *args[2:]).count() == 4


def test_prompts_come_from_the_schema():
    schema = ExtractionSchema().adapted({"model_name": "test_name"}, (Field("arm", "int"),), {"method": ("ct", "mri")})
    long, short = prompts.system_prompt(schema), prompts.system_prompt(schema, "short")
    assert "model_level[].test_name: text, or null" in long and "model_level[].arm: whole number, or null" in long
    assert "one of ct | mri; unclear if none fits" in long and "method: ct | mri" in short and "test_name" not in short
    assert "each 0 to 20 or null" in long and prompts.user_template(schema, "short").endswith("abstract:\n<<ABSTRACT>>\n")
    assert SHORT_RULES.excluded_types[0] in prompts.screening_system(SHORT_RULES)


def test_rows_of_a_forced_extraction_are_audited_once(spark, tmp_path):
    source = positioned(spark, ["1", "2"])
    said, base = answered(spark, source), str(tmp_path)
    extract.run_extract(source, said, base, "r")
    extract.run_extract(source, said, base, "r", force=True)
    assert sorted(r.pmid for r in extract.read_audit(spark, base, "r").collect()) == ["1", "2"]
    assert [r.generation for r in commits.live(spark, base, "extract", "r")] == [2]
