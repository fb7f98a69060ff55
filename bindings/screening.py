"""Screening, JSON and coercion queries."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from evidence.functions import coerce, jsontext, text
from evidence.operators import prompts, screen
from evidence.plans import prescreen
from evidence.session import shared_folder
from evidence.schema import PrefilterRules
from evidence.sources import jsonl

from .frames import ARTICLES_SQL, articles
from .registry import bound, table

RULES = PrefilterRules(
    excluded_types=("src1", "src7"),
    title_patterns=((r"\b(the|and)\b", "english"), (r"\b(der|und|sch.n)\b", "german")))
OTHER_RULES = PrefilterRules(excluded_types=("src3",), title_patterns=((r"\b(le|la)\b", "french"),),
                             min_abstract_chars=200)


def _word(alternatives: str) -> str:
    """RE2 form of a Unicode word boundary."""
    return rf"(^|[^\p{{L}}\p{{M}}\p{{N}}_])({alternatives})($|[^\p{{L}}\p{{M}}\p{{N}}_])"


_STRIPPED = "length(trim(abstract, ' ' || chr(9) || chr(10) || chr(13)))"
_REASON = f"""CASE
  WHEN contains(ptype, 'src1') THEN 'Publication type: src1'
  WHEN contains(ptype, 'src7') THEN 'Publication type: src7'
  WHEN regexp_matches(lower(title), '{_word('the|and')}') THEN 'Title match: english'
  WHEN regexp_matches(lower(title), '{_word('der|und|sch.n')}') THEN 'Title match: german'
  WHEN {_STRIPPED} < 50 THEN 'No abstract or too short' END"""
# answers of the screening stage stand in for labels
_DECISION = """CASE WHEN doc_id % 11 = 10 OR quality IS NULL THEN 'error'
  WHEN toxic = 1 THEN 'uncertain' WHEN quality = 1 THEN 'include' ELSE 'exclude' END"""


@bound(f"SELECT pmid, {_REASON} AS exclude_reason, ({_REASON}) IS NOT NULL AS excluded FROM ({ARTICLES_SQL})")
def prefilter_rows(spark, sf):
    return screen.prefilter(articles(spark, sf), RULES).select("pmid", "exclude_reason", "excluded")


@bound(f"""SELECT lang, CASE WHEN contains(ptype, 'src3') THEN 'Publication type: src3'
  WHEN regexp_matches(lower(title), '{_word('le|la')}') THEN 'Title match: french'
  WHEN {_STRIPPED} < 200 THEN 'No abstract or too short' ELSE 'kept' END AS reason, count(*) AS n
  FROM ({ARTICLES_SQL}) GROUP BY ALL""")
def prefilter_other_rules(spark, sf):
    reason = F.coalesce(screen.prefilter_reason(OTHER_RULES), F.lit("kept"))
    return articles(spark, sf).groupBy("lang", reason.alias("reason")).agg(F.count("*").alias("n"))


_TERMS, _CONTEXT = ("tion", "est", "ung"), ("the", "les", "der", "los")
_MARKS, _BUILD = ("eau", "ción"), ("men", "sch", "ado")


def _any(column: str, terms) -> str:
    return "(" + " OR ".join(f"contains({column}, '{t}')" for t in terms) + ")"


_BOTH = "lower(title || ' ' || abstract)"


@bound(f"""SELECT pmid, CASE
    WHEN trim(title, ' ' || chr(9) || chr(13)) = '' OR {_STRIPPED} = 0 THEN 'Missing title or abstract'
    WHEN NOT ({_any(_BOTH, _TERMS)} AND {_any(_BOTH, _CONTEXT)}) THEN 'No model or context keyword'
    WHEN {_any(_BOTH, _MARKS)} AND NOT {_any(_BOTH, _BUILD)} THEN 'Validation only' END AS reason
  FROM ({ARTICLES_SQL})""")
def keyword_rules(spark, sf):
    return articles(spark, sf).select(
        "pmid", screen.keyword_reason(_TERMS, _CONTEXT, _MARKS, _BUILD).alias("reason"))


_GROUPS = (("the*", "der", "les"), ("th", "und", "au*"))


def _group(terms) -> str:
    alternatives = "|".join(re.escape(t.rstrip("*")) + (r"[\p{L}\p{M}\p{N}_]*" if t.endswith("*") else "")
                            for t in terms)
    return f"regexp_matches(lower(title || ' ' || abstract), '{_word(alternatives)}')"


_CORPUS = (f"{_group(_GROUPS[0])} AND {_group(_GROUPS[1])} AND NOT contains(lower(ptype), 'src2') "
           "AND CAST(substr(pub_date, 1, 4) AS INT) BETWEEN 2010 AND 2024")


@bound(f"SELECT pmid, pub_date FROM ({ARTICLES_SQL}) WHERE {_CORPUS}")
def corpus_rows(spark, sf):
    return screen.corpus_filter(articles(spark, sf), _GROUPS, (2010, 2024), ("src2",)) \
        .select("pmid", "pub_date")


@bound(f"SELECT count(*) AS n FROM ({ARTICLES_SQL}) WHERE {_CORPUS}")
def corpus_hit_count(spark, sf):
    from evidence.operators.chunks import hit_count
    return hit_count(articles(spark, sf), screen.corpus_predicate(_GROUPS, (2010, 2024), ("src2",)))


def screening_responses(spark, sf):
    """Labels as screening answers: quality and toxicity become a decision, in loose JSON."""
    d = F.col("doc_id")
    decision = (F.when(F.col("toxic") == 1, "uncertain").when(F.col("quality") == 1, "include")
                .otherwise("exclude"))
    body = F.concat(F.lit('{"decision": "'), decision, F.lit('", "reason": "label '),
                    d.cast("string"), F.lit('"}'))
    content = (F.when(d % 11 == 10, F.concat(body, F.lit(" or }")))
               .when(d % 3 == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```")))
               .when(d % 3 == 1, F.concat(F.lit("Answer: "), body, F.lit(" as asked")))
               .otherwise(body))
    return table(spark, sf, "labels").select(
        d.cast("string").alias("pmid"), F.lit("m").alias("model"), F.lit(1).alias("pass"),
        F.lit(1).alias("attempt"), F.lit(200).alias("status"), content.alias("content"))


@bound(f"SELECT CAST(doc_id AS VARCHAR) AS pmid, {_DECISION} AS decision, "
       "CASE WHEN doc_id % 11 <> 10 THEN 'label ' || doc_id END AS reason FROM labels")
def screening_answers(spark, sf):
    parsed = screening_responses(spark, sf).select("pmid", screen.parse_decision("content").alias("a"))
    return parsed.select("pmid", "a.decision", F.when(F.col("a.decision") != "error",
                                                     F.col("a.reason")).alias("reason"))


@bound(f"SELECT CAST(doc_id AS VARCHAR) AS pmid FROM labels WHERE {_DECISION} = 'include'")
def decision_gate(spark, sf):
    answered = screening_responses(spark, sf).select(
        "pmid", screen.parse_decision("content").alias("answer"))
    return screen.gate(answered).select("pmid")


@bound("""SELECT CAST(doc_id AS VARCHAR) AS pmid,
    quality = 1 AND toxic = 0 AND doc_id % 5 <> 0 AND doc_id % 7 < 6 AS kept,
    CAST(least(100, doc_id % 130) AS INT) AS confidence FROM labels""")
def flag_gate(spark, sf):
    d = F.col("doc_id")
    body = F.concat(
        F.lit('{"include": '), F.when(F.col("quality") == 1, '"yes"').otherwise("0"),
        F.lit(', "is_original_article": '), F.when(F.col("toxic") == 0, "true").otherwise('"No"'),
        F.lit(', "is_clinical_prediction_model": '), F.when(d % 5 != 0, "1").otherwise("false"),
        F.when(d % 7 < 6, ', "has_model_building": "TRUE"').otherwise(""),
        F.lit(', "confidence": "'), (d % 130).cast("string"), F.lit(' %"}'))
    answers = table(spark, sf, "labels").select(
        d.cast("string").alias("pmid"), screen.parse_flags(body).alias("answer"))
    return answers.select("pmid", screen.passes_gate(F.col("answer"), "flags").alias("kept"),
                          "answer.confidence")


_OUTCOMES = f"""SELECT d.*, CASE WHEN ({_REASON}) IS NOT NULL THEN 'excluded_local'
    WHEN {_DECISION.replace('doc_id', 'd.doc_id')} = 'include' THEN 'included'
    WHEN {_DECISION.replace('doc_id', 'd.doc_id')} = 'error' THEN 'error' ELSE 'excluded_llm' END AS outcome
  FROM ({ARTICLES_SQL}) d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


@bound(f"""SELECT journal AS shard, count(*) AS total,
    count(*) FILTER (WHERE outcome = 'included') AS included,
    count(*) FILTER (WHERE outcome = 'excluded_local') AS excluded_local,
    count(*) FILTER (WHERE outcome = 'excluded_llm') AS excluded_llm,
    count(*) FILTER (WHERE outcome = 'error') AS error
  FROM ({_OUTCOMES}) GROUP BY ROLLUP (journal)""")
def prescreen_totals(spark, sf):
    rows = prescreen.prescreen(articles(spark, sf), screening_responses(spark, sf), RULES)
    return prescreen.totals(rows)


@bound(f"SELECT pmid, title FROM ({_OUTCOMES}) WHERE outcome = 'included'")
def screened_rows(spark, sf):
    return prescreen.screened(articles(spark, sf), screening_responses(spark, sf), RULES) \
        .select("pmid", "title")


@bound(f"""SELECT outcome, written, n FROM (SELECT outcome, count(*) AS n, 'outcomes' AS written FROM ({_OUTCOMES}) GROUP BY outcome
    UNION ALL SELECT outcome, count(*), 'screened' FROM ({_OUTCOMES}) WHERE outcome = 'included' GROUP BY outcome)""")
def prescreen_run(spark, sf):
    """A run over half of the articles, resumed with all of them: what its folders hold."""
    base, source = shared_folder(spark, "prescreen"), articles(spark, sf)
    said = screening_responses(spark, sf)
    prescreen.run_prescreen(source.filter("doc_id % 2 = 0"), said, base, "r", RULES)
    done = spark.read.schema("pmid string").json(f"{base}/outcomes/run=r")
    prescreen.run_prescreen(source, said, base, "r", RULES, done, part="1")
    outcomes = spark.read.schema("pmid string, outcome string").json(f"{base}/outcomes/run=r")
    kept = spark.read.schema("pmid string").json(f"{base}/screened/run=r")
    return (outcomes.groupBy("outcome").agg(F.count("*").alias("n")).withColumn("written", F.lit("outcomes"))
            .unionByName(kept.groupBy(F.lit("included").alias("outcome")).agg(F.count("*").alias("n"))
                         .withColumn("written", F.lit("screened"))))


@bound("""SELECT CAST(doc_id AS VARCHAR) AS pmid,
    CASE WHEN lang = 'en' THEN TRUE ELSE FALSE END AS english,
    round(CAST(length(regexp_replace(text, '[\\x00-\\x7f]', '', 'g')) AS DOUBLE) / nullif(length(text), 0), 6) AS odd
  FROM documents""")
def language_flags(spark, sf):
    share = F.round(text.non_ascii_share("abstract"), 6)
    return articles(spark, sf).select("pmid", (F.col("lang") == "en").alias("english"),
                                      share.alias("odd"))


def _language_hits(words):
    return f"len(regexp_extract_all(t, ' ({'|'.join(words)}) '))"


# every character that is no part of a word becomes two blanks, so that neighbours share none
@bound("SELECT lang, guess, count(*) AS n FROM (SELECT lang, CASE WHEN greatest(" + ", ".join(
    f"n_{k}" for k in text.STOP_WORDS) + ") < 1 THEN NULL " + " ".join(
    f"WHEN n_{k} = greatest({', '.join(f'n_{x}' for x in text.STOP_WORDS)}) THEN '{k}'"
    for k in text.STOP_WORDS) + " END AS guess FROM (SELECT lang, " + ", ".join(
    f"{_language_hits(w)} AS n_{k}" for k, w in text.STOP_WORDS.items()) + r"""
  FROM (SELECT lang, ' ' || regexp_replace(lower(text), '[^\p{L}\p{M}\p{N}_]', '  ', 'g') || ' ' AS t FROM documents))) GROUP BY lang, guess""")
def guessed_languages(spark, sf):
    return (articles(spark, sf).groupBy("lang", text.abstract_language("abstract").alias("guess"))
            .agg(F.count("*").alias("n")))


# --- prompts ------------------------------------------------------------------------------------

@bound("""SELECT CAST(doc_id AS VARCHAR) AS pmid, md5('PMID: ' || doc_id || chr(10) || 'Title: '
    || split_part(text, chr(10), 1) || chr(10) || 'Publication types: ' || source || chr(10)
    || 'Abstract: ' || text) AS digest FROM documents""")
def screening_prompt_texts(spark, sf):
    sent = prompts.screening_prompts(articles(spark, sf))
    return sent.select("pmid", F.md5(F.col("messages")[1]["content"]).alias("digest"))


@bound("""SELECT CAST(doc_id AS VARCHAR) AS pmid, md5('PMID: ' || doc_id || chr(10) || 'Title: '
    || split_part(text, chr(10), 1) || chr(10) || 'Publication types: ' || source || chr(10)
    || 'Abstract: ' || substr(text, 1, 3000)) AS digest FROM documents""")
def screening_prompt_texts_cut(spark, sf):
    sent = prompts.screening_prompts(articles(spark, sf), limit=3000)
    return sent.select("pmid", F.md5(F.col("messages")[1]["content"]).alias("digest"))


_NORM = r"trim(regexp_replace({}, '[\s\x0b\x1c-\x1f\x{{85}}\x{{a0}}\x{{2000}}-\x{{200a}}\x{{3000}}]+', ' ', 'g'))"
_TEMPLATE = "Id <<PMID>> in <<JOURNAL>> of <<PUB_DATE>>: <<TITLE>> (<<KEYWORDS>>; <<MESH_TERMS>>; <<PUBLICATION_TYPES>>)\n<<ABSTRACT>>\nend"


@bound(f"""SELECT pmid, md5('Id ' || pmid || ' in ' || journal || ' of ' || pub_date || ': '
    || {_NORM.format('title')} || ' (' || lang || '; ' || journal || '; M ' || lang || '; ' || journal || ')'
    || chr(10) || {_NORM.format('abstract')} || chr(10) || 'end') AS digest FROM ({ARTICLES_SQL})""")
def extraction_prompt_texts(spark, sf):
    sent = prompts.render_prompts(articles(spark, sf), template=_TEMPLATE)
    return sent.select("pmid", F.md5(F.col("messages")[1]["content"]).alias("digest"))


@bound(f"""SELECT pmid, md5('pmid = ' || pmid || chr(10) || 'title = ' || {_NORM.format('title')} || chr(10) || 'journal = ' || journal
    || chr(10) || 'pub_date = ' || pub_date || chr(10) || 'publication_types = ' || journal || chr(10) || 'keywords = ' || lang || '; ' || journal
    || chr(10) || 'mesh_terms = M ' || lang || chr(10) || 'abstract:' || chr(10) || {_NORM.format('abstract')} || chr(10)) AS digest,
    2 AS messages FROM ({ARTICLES_SQL})""")
def default_prompt_texts(spark, sf):
    sent = prompts.render_prompts(articles(spark, sf), style="short")
    return sent.select("pmid", F.md5(F.col("messages")[1]["content"]).alias("digest"), F.size("messages").alias("messages"))


@bound("""SELECT p_partkey, p_name || ' [' || lower(p_type) || '; ' || p_brand || ']; ' || p_type || '; ' || p_brand AS mesh
  FROM part""")
def mesh_strings(spark, sf):
    def item(name, *qualifiers):
        return F.struct(name.alias("descriptor"),
                        F.array(*qualifiers).cast("array<string>").alias("qualifiers"))
    items = F.array(item(F.concat(F.lit("  "), "p_name"), F.lower("p_type"), F.lit(" "), F.col("p_brand")),
                    item(F.col("p_type")), item(F.lit(" "), F.col("p_type")), item(F.col("p_brand"), F.lit("")))
    return table(spark, sf, "part").select("p_partkey", text.join_mesh(items).alias("mesh"))


# --- JSON in text -----------------------------------------------------------------------------------

def _e():
    return F.col("event_id")


def _loose(body):
    """Event JSON in the ways a model writes it, and two ways that cannot be read."""
    return (F.when(_e() % 8 == 0, body)
            .when(_e() % 8 == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```")))
            .when(_e() % 8 == 2, F.concat(F.lit("Sure. "), body, F.lit(" Anything else }?")))
            .when(_e() % 8 == 3, F.concat(body, F.lit(' {"k": -1}')))
            .when(_e() % 8 == 4, F.concat(F.lit('x {"s": "a } \\" {", "k": '), F.get_json_object(body, "$.k"), F.lit("} y")))
            .when(_e() % 8 == 5, F.concat(F.lit("["), body, F.lit("]")))
            .when(_e() % 8 == 6, F.concat(F.lit("{ "), body))
            .otherwise(F.concat(F.lit('{"k": "open '), body)))


_K_SQL = "CAST(json_extract_string(props, '$.k') AS BIGINT)"


@bound(f"""SELECT event_id, CASE WHEN event_id % 8 < 6 THEN {_K_SQL} END AS k,
    event_id % 8 < 6 AS parsed FROM events""")
def json_objects(spark, sf):
    parsed = table(spark, sf, "events").select(
        "event_id", jsontext.parse_object(_loose(F.col("props"))).alias("v"))
    return parsed.select("event_id", F.try_variant_get("v", "$.k", "bigint").alias("k"),
                         F.col("v").isNotNull().alias("parsed"))


@bound(f"""SELECT event_type, event_id % 8 AS kind, count(*) AS n,
    count(*) FILTER (WHERE event_id % 8 < 2) AS objects,
    CAST(sum(CASE WHEN event_id % 8 < 2 OR event_id % 8 = 4 THEN {_K_SQL} END) AS BIGINT) AS k
  FROM events GROUP BY ALL""")
def json_screening(spark, sf):
    # kinds 2, 3 and 6 end in a brace that makes the greedy match unreadable
    v = table(spark, sf, "events").select(
        "event_type", (_e() % 8).alias("kind"),
        jsontext.parse_screening(_loose(F.col("props"))).alias("v"))
    k = F.try_variant_get("v", "$.k", "bigint")
    return v.groupBy("event_type", "kind").agg(
        F.count("*").alias("n"),
        F.count_if((F.col("kind") < 2) & k.isNotNull()).alias("objects"), F.sum(k).alias("k"))


@bound(f"""SELECT event_type, count(*) AS n, CAST(sum({_K_SQL}) AS BIGINT) AS k FROM events
  WHERE event_id % 7 < 3 GROUP BY event_type""")
def json_lines(spark, sf):
    p = F.col("props")
    line = (F.when(_e() % 7 == 0, p).when(_e() % 7 == 1, F.concat(F.lit(" \t"), p, F.lit(" \r")))
            .when(_e() % 7 == 2, F.concat(F.lit("\u00a0"), p)).when(_e() % 7 == 3, F.concat(p, F.lit(" x")))
            .when(_e() % 7 == 4, F.concat(F.lit("["), p, F.lit("]")))
            .when(_e() % 7 == 5, F.concat(p, F.lit("] "))).otherwise("  "))
    scan = jsonl.parse_lines(table(spark, sf, "events").select("event_type", line.alias("value")))
    return scan.groupBy("event_type").agg(
        F.count("*").alias("n"), F.sum(F.try_variant_get("v", "$.k", "bigint")).alias("k"))


@bound("SELECT page_id, nullif(regexp_extract(html, '\\{[^{}\"]*\\}'), '') AS found FROM pages")
def first_braces_in_pages(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", jsontext.first_json_object("html").alias("found"))


# --- coercions ----------------------------------------------------------------------------------------

def _q():
    return F.col("l_quantity").cast("bigint")


def _variant(value):
    return F.get(F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), value, F.lit("]"))), "$",
                                   "array<variant>"), F.lit(0))


@bound("""SELECT kind, count(*) AS n, CAST(sum(i) AS BIGINT) AS ints, round(sum(CAST(f AS DOUBLE)), 2) AS floats,
    count(i) AS known FROM (
    SELECT l_partkey % 9 AS kind,
      CASE l_partkey % 9 WHEN 0 THEN q WHEN 1 THEN q + 1000 WHEN 2 THEN q WHEN 3 THEN 1 WHEN 4 THEN NULL
        WHEN 5 THEN NULL WHEN 6 THEN -q WHEN 7 THEN q * 1000 WHEN 8 THEN NULL END AS i,
      CASE l_partkey % 9 WHEN 0 THEN q WHEN 1 THEN q + 1000 WHEN 2 THEN q + 0.5 WHEN 3 THEN 1 WHEN 4 THEN NULL
        WHEN 5 THEN NULL WHEN 6 THEN -q - 0.75 WHEN 7 THEN q * 1000 WHEN 8 THEN NULL END AS f
    FROM (SELECT l_partkey, CAST(l_quantity AS BIGINT) AS q FROM lineitem)) GROUP BY kind""")
def coerced_numbers(spark, sf):
    p, q = F.col("l_partkey") % 9, _q().cast("string")
    value = (F.when(p == 0, q)
             .when(p == 1, F.concat(F.lit('"n='), F.format_number(_q() + 1000, 0), F.lit(' pts"')))
             .when(p == 2, F.concat(F.lit('"'), q, F.lit('.5 %"'))).when(p == 3, F.lit("true"))
             .when(p == 4, F.lit("null")).when(p == 5, F.lit('"none"'))
             .when(p == 6, F.concat(F.lit("-"), q, F.lit(".75"))).when(p == 7, F.concat(q, F.lit("e3")))
             .otherwise(F.concat(F.lit("["), q, F.lit("]"))))
    v = table(spark, sf, "lineitem").select(p.alias("kind"), _variant(value).alias("v"))
    return (v.select("kind", coerce.to_int_or_null("v").alias("i"), coerce.to_float_or_null("v").alias("f"))
            .groupBy("kind").agg(F.count("*").alias("n"), F.sum("i").alias("ints"),
                                 F.round(F.sum("f"), 2).alias("floats"), F.count("i").alias("known")))


@bound("""SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN TRUE WHEN 1 THEN FALSE WHEN 2 THEN TRUE
    WHEN 3 THEN FALSE WHEN 4 THEN TRUE WHEN 5 THEN FALSE END AS b,
    coalesce(CASE o_orderkey % 8 WHEN 0 THEN TRUE WHEN 1 THEN FALSE WHEN 2 THEN TRUE
    WHEN 3 THEN FALSE WHEN 4 THEN TRUE WHEN 5 THEN FALSE END, TRUE) AS b_default FROM orders""")
def coerced_booleans(spark, sf):
    k = F.col("o_orderkey")
    words = ("true", '"No"', "2.5", "0.0", '" YES "', '"n"', '"maybe"', "[1]")
    v = _variant(F.get(F.array(*[F.lit(w) for w in words]), (k % 8).cast("int")))
    rows = table(spark, sf, "orders").select("o_orderkey", v.alias("v"))
    return rows.select("o_orderkey", coerce.to_bool_or_null("v").alias("b"),
                       coerce.to_bool("v", True).alias("b_default"))


@bound("""SELECT p_partkey, CASE p_partkey % 4 WHEN 3 THEN 0 WHEN 2 THEN 1 ELSE 2 END AS n,
    CASE p_partkey % 4 WHEN 0 THEN p_name || '|' || p_type || ', x' WHEN 1 THEN p_name || '|' || p_brand
      WHEN 2 THEN p_name ELSE '' END AS items FROM part""")
def coerced_lists(spark, sf):
    k = F.col("p_partkey") % 4
    value = (F.when(k == 0, F.concat(F.lit('" '), "p_name", F.lit(" ;; "), "p_type", F.lit(', x"')))
             .when(k == 1, F.concat(F.lit('["'), "p_name", F.lit('", null, " ", "'), "p_brand", F.lit('"]')))
             .when(k == 2, F.concat(F.lit('"'), "p_name", F.lit(',"'))).otherwise(F.lit("null")))
    rows = table(spark, sf, "part").select("p_partkey", coerce.to_list_str(_variant(value)).alias("l"))
    return rows.select("p_partkey", F.size("l").alias("n"), F.array_join("l", "|").alias("items"))


@bound("""SELECT l_orderkey % 13 AS kind, count(*) AS n, CAST(sum(c20) AS BIGINT) AS c20,
    CAST(sum(c100) AS BIGINT) AS c100, count(c20) AS known FROM (
    SELECT l_orderkey, CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE greatest(0, least(20, v)) END AS c20,
      CASE WHEN l_orderkey % 13 = 0 THEN 7 ELSE greatest(0, least(100, v)) END AS c100
    FROM (SELECT l_orderkey, CASE WHEN l_orderkey % 13 = 1 THEN 20 ELSE CAST(l_quantity AS BIGINT) * 4 - 30 END AS v
          FROM lineitem)) GROUP BY 1""")
def clamped_scores(spark, sf):
    kind = F.col("l_orderkey") % 13
    value = (F.when(kind == 0, F.lit('"n/a"')).when(kind == 1, F.lit('"20/123456789012345678901"'))
             .when(kind == 2, F.concat(F.lit('"'), (_q() * 4 - 30).cast("string"), F.lit(' of 100"')))
             .otherwise((_q() * 4 - 30).cast("string")))
    v = table(spark, sf, "lineitem").select(kind.alias("kind"), _variant(value).alias("v"))
    return (v.select("kind", coerce.clamp_int_or_null("v", 0, 20).alias("c20"),
                     coerce.clamp_0_100("v", 7).alias("c100"))
            .groupBy("kind").agg(F.count("*").alias("n"), F.sum("c20").alias("c20"),
                                 F.sum("c100").alias("c100"), F.count("c20").alias("known")))


@bound("""SELECT o_orderkey, CASE WHEN o_orderkey % 5 < 3 THEN lower(replace(replace(substr(o_orderpriority, 3), ' ', '_'), '-', '_'))
      ELSE 'other' END AS value, o_orderkey % 5 IN (3) AS out_of_set
  FROM orders""")
def coerced_vocabulary(spark, sf):
    k, p = F.col("o_orderkey"), F.substring("o_orderpriority", 3, 99)
    words = ("low", "not_specified", "high", "medium", "urgent", "other")
    given = (F.when(k % 5 == 0, p).when(k % 5 == 1, F.concat(F.lit(" "), F.lower(p), F.lit("  ")))
             .when(k % 5 == 2, F.replace(F.initcap(p), F.lit(" "), F.lit(" - ")))
             .when(k % 5 == 3, F.lit("surgery & icu")).otherwise("  "))
    rows = table(spark, sf, "orders").select("o_orderkey", given.alias("given"))
    value = coerce.coerce_enum("given", words, "other")
    return rows.select("o_orderkey", value.alias("value"),
                       coerce.out_of_set("given", value, "other").alias("out_of_set"))


@bound("""SELECT p_partkey, lower(replace(p_name, ' ', '_')) || '_and_' || lower(p_type) AS name_label,
    regexp_replace(lower(p_brand), '[^a-z0-9]+', '_', 'g') AS brand_label FROM part""")
def part_labels(spark, sf):
    both = F.concat(F.lit("  "), "p_name", F.lit(" & "), "p_type", F.lit("!"))
    return table(spark, sf, "part").select("p_partkey", text.label(both).alias("name_label"),
                                           text.label("p_brand").alias("brand_label"))


@bound(f"""SELECT CAST(doc_id AS VARCHAR) AS pmid, md5({_NORM.format('text')}) AS digest FROM documents""")
def normalised_texts(spark, sf):
    return articles(spark, sf).select("pmid", F.md5(text.norm_text("abstract")).alias("digest"))


@bound("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN CAST(p_partkey AS VARCHAR)
    WHEN p_partkey % 3 = 1 THEN replace(p_name, ' ', '_') ELSE regexp_extract(p_brand, '[0-9]+') END AS shard FROM part""")
def shard_ids(spark, sf):
    k = F.col("p_partkey")
    name = (F.when(k % 3 == 0, F.concat(F.lit("articles_"), k.cast("string"), F.lit("_7.jsonl")))
            .when(k % 3 == 1, F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), F.lit(".jsonl")))
            .otherwise(F.concat("p_brand", F.lit(".v2.jsonl"))))
    return table(spark, sf, "part").select("p_partkey", jsonl.shard_of(name).alias("shard"))
