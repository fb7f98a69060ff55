"""Rule tables: hand-written inputs and expected values of the column functions."""

import json
import random

import pytest
from pyspark.sql import functions as F

from evidence.functions import coerce, jsontext, text
from evidence.schema import METHOD_GROUPS, SCORE_KEYS, SUBSPECIALTIES


def check(spark, rows, expression, dtype="string"):
    """Rows of (input, expected) through one expression, in one job."""
    data = [(i, r[0]) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, f"i int, x {dtype}").repartition(1)
    got = {r["i"]: r["y"] for r in df.select("i", expression(F.col("x")).alias("y")).collect()}
    assert [(r[0], got[i]) for i, r in enumerate(rows)] == [(r[0], r[1]) for r in rows]


def as_variant(x):
    return F.try_parse_json(x)


def test_norm_text(spark):
    check(spark, [("  a \n b ", "a b"), (None, ""), ("a" + chr(0xA0) + chr(0x2003) + "b", "a b"),
                  (chr(0x1C) + "x" + chr(0x85), "x"), ("one two", "one two"), (chr(0x3000), "")],
          text.norm_text)


def test_first_text(spark):
    check(spark, [("", "z"), (None, "z"), ("q", "q")], lambda x: text.first_text(x, F.lit(""), F.lit("z")))
    check(spark, [("", None), (" ", None), ("a  b", "a b")], text.maybe_text)


def test_label(spark):
    rows = [("Tree-Based  ML", "tree_based_ml"), ("Surgery & ICU", "surgery_and_icu"), ("__x__", "x"),
            (None, ""), ("!!", "")]
    check(spark, rows, text.label)
    assert [text.label_of(x or "") for x, _ in rows] == [y for _, y in rows]


def test_booleans(spark):
    rows = [('"Yes"', True), ("0", False), ('"maybe"', None), ("null", None), ("2", True), ("0.0", False),
            ('" N "', False), ("[1]", None), ('"TRUE"', True), ("true", True)]
    check(spark, rows, lambda x: coerce.to_bool_or_null(as_variant(x)))
    check(spark, [('"maybe"', True), ("0", False)], lambda x: coerce.to_bool(as_variant(x), True))


def test_integers(spark):
    rows = [('"n=1,234 pts"', 1234), ('"3.7"', 3), ("-1.9", -1), ("true", 1), ('"none"', None), ("[1]", None),
            ('"18/20"', 18), ("1e3", 1000), ('""', None), ("12345678901234567890", None), ('"-5"', -5)]
    check(spark, rows, lambda x: coerce.to_int_or_null(as_variant(x)))


def test_floats(spark):
    rows = [('"85%"', 85.0), ('"0.81 (0.7-0.9)"', 0.81), ('"1e5"', 1.0), ("0.5", 0.5), ("false", 0.0),
            ("{}", None), ('"1,000.5"', 1000.5)]
    check(spark, rows, lambda x: coerce.to_float_or_null(as_variant(x)))


def test_lists(spark):
    rows = [('"a; b;;c"', ["a", "b", "c"]), ('"a, b"', ["a", "b"]), ('"a; b, c"', ["a", "b, c"]), ("null", []),
            ('["x ", null, 3, ""]', ["x", "3"]), ('"one"', ["one"]), ("7", ["7"])]
    check(spark, rows, lambda x: coerce.to_list_str(as_variant(x)))


def test_clamps(spark):
    rows = [("25", 20), ("-3", 0), ('"18/20"', 18), ("null", None), ("123456789012345678901234567890", 20),
            ("-1e300", 0), ('"-99999999999999999999 x"', 0), ("7.9", 7)]
    check(spark, rows, lambda x: coerce.clamp_int_or_null(as_variant(x), 0, 20))
    check(spark, [("null", 5), ("150", 100)], lambda x: coerce.clamp_0_100(as_variant(x), 5))


def test_vocabulary(spark):
    def value(x):
        return coerce.coerce_enum(x, METHOD_GROUPS, "unclear")
    check(spark, [("Cox Regression", "cox_regression"), ("xyz", "unclear"), ("svm", "svm"), (None, "unclear"),
                  ("  Deep-Learning ", "deep_learning"), ("??", "unclear")], value)
    check(spark, [("Cox Regression", False), ("xyz", True), ("unclear", True), (" ", False), (None, False)],
          lambda x: coerce.out_of_set(x, value(x), "unclear"))
    check(spark, [("xyz", True), ("Unclear", False)],
          lambda x: coerce.out_of_set(x, value(x), "unclear", strict_default=False))
    both = ("A B", "a_b", "z")
    check(spark, [("a_b", "a_b"), (" A  B", "A B"), ("a-b", "A B")], lambda x: coerce.coerce_enum(x, both, "z"))


@pytest.mark.parametrize("given, total, mismatch", [
    ({**dict.fromkeys(SCORE_KEYS, 10), "total_score": 60}, 50, True),
    ({**dict.fromkeys(SCORE_KEYS, 10), "total_score": "50 points"}, 50, False),
    (dict(zip(SCORE_KEYS[:3], (1, 2, 3))), 6, False),
    ({}, None, False),
    ({SCORE_KEYS[0]: 5, SCORE_KEYS[1]: 5, "total_score": 40}, 40, False),
    ({**dict.fromkeys(SCORE_KEYS, 99), "total_score": 200}, 100, False),
])
def test_score_block(spark, given, total, mismatch):
    keys = (*SCORE_KEYS, "total_score")
    raw = F.try_variant_get(F.parse_json(F.lit(json.dumps(given))), "$",
                            f"struct<{','.join(k + ' variant' for k in keys)}>")
    row = spark.range(1).select(coerce.score_block(raw, SCORE_KEYS, "total_score", 20, 100).alias("s")).first()["s"]
    assert (row["scores"]["total_score"], row["mismatch"]) == (total, mismatch)


def test_objects_in_text(spark):
    def shown(x):
        return F.to_json(jsontext.parse_object(x))
    check(spark, [
        ('```json\n{"a": 1}\n```', '{"a":1}'), ('Sure: {"a": 1} ok }', '{"a":1}'), ('{"a":1} {"b":2}', '{"a":1}'),
        ('x {"a": "}{"} y', '{"a":"}{"}'), ('{"a": {"b": 1}', None), ('{"a": "open', None), ("[1]", None),
        ('[{"a":1}]', '{"a":1}'), ("", None), (None, None), ('```\n{"a":"\\""}```', '{"a":"\\""}'),
        ('no {braces} {"a":1}', None), ('{"a":1,"a":2}', '{"a":2}')], shown)


def balanced(s):
    """First balanced object by a plain character walk."""
    at = s.find("{")
    depth, quoted, skip = 0, False, False
    for pos in range(at, len(s)) if at >= 0 else ():
        ch = s[pos]
        if skip:
            skip = False
        elif quoted:
            quoted, skip = ch != '"', ch == "\\"
        elif ch == '"':
            quoted = True
        elif ch in "{}":
            depth += 1 if ch == "{" else -1
            if not depth:
                return s[at:pos + 1]
    return None


def test_first_object_against_character_rule(spark):
    """The token fold against a plain character walk on random texts."""
    rng = random.Random(7)
    texts = ["".join(rng.choice('{}"\\ab') for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    check(spark, [(t, balanced(t)) for t in texts], jsontext.first_json_object)


def test_parse_object_against_the_stated_rule(spark):
    """Parsing from the first brace against: fence off, whole text, else first balanced object."""
    rng = random.Random(11)
    parts = ['{"a": 1}', '{"b": {"c": "}"}}', "{", "}", '"', "[", "]", " ", "```json\n", "```", "x", ",", '\\"', ":", "1"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 7))) for _ in range(6000)]

    def parsed(s):
        try:
            return json.loads(s or "")
        except ValueError:
            return None

    def rule(s):
        s = s.strip()
        if s.startswith("```"):
            s = s[3:].removeprefix("json").lstrip()
            s = s[:-3].rstrip() if s.endswith("```") else s
        for candidate in (parsed(s), parsed(balanced(s))):
            if isinstance(candidate, dict):
                return json.dumps(candidate, separators=(",", ":"))
        return None
    check(spark, [(t, rule(t)) for t in texts], lambda x: F.to_json(jsontext.parse_object(x)))


def test_code_fences(spark):
    check(spark, [("```json\n{}\n```", "{}"), (" ```JSON {} ", "{}"), ("```\nx```", "x"), ("a ``` b", "a ``` b"), (" y ", "y")],
          jsontext.strip_code_fence)


def test_screening_text(spark):
    check(spark, [('x {"a":1} y }', None), ('x {"a":1} y', '{"a":1}'), ('```json\n{"a":1}\n``` bye\n', '{"a":1}'),
                  ("[1]", "[1]"), ("nothing", None)], lambda x: F.to_json(jsontext.parse_screening(x)))


def test_strict_objects(spark):
    check(spark, [('{"a":1} junk', None), (' {"a":1}\t', '{"a":1}'), ("[1]", None), ('{"a":1}] x', None),
                  ('{"a":1},{"b":2}', None), ("", None), ('{"a":1},0] x', None)],
          lambda x: F.to_json(jsontext.parse_strict_object(x)))


@pytest.mark.parametrize("year, month, day, expected", [
    ("2020", "Mar", "5", "2020-03-05"), ("2020", None, None, "2020-01-01"), ("2020", "03", None, "2020"),
    ("2020", "June", None, "2020-06-01"), ("2020", "Mar", "32", "2020"), ("2019", "Feb", "29", "2019"),
    (None, "Mar", "1", ""), ("2020", "mar", "1", "2020")])
def test_publication_date(spark, year, month, day, expected):
    c = [F.lit(x).cast("string") for x in (year, month, day)]
    assert spark.range(1).select(text.pub_date(*c)).first()[0] == expected


def test_render_does_not_scan_inserted_text(spark):
    template = "a <<X>> b <<Y>> <<Z>>"
    got = spark.range(1).select(text.render(template, {"X": F.lit("<<Y>>"), "Y": F.lit("2")})).first()[0]
    assert got == "a <<Y>> b 2 <<Z>>"


def test_language_flag(spark):
    check(spark, [("the cat and the dog", "en"), ("der Hund und die Katze", "de"), ("xyz", None), (None, None)],
          text.abstract_language)


def test_vocabularies_are_looked_up_in_sets_in_every_spelling(spark):
    """A vocabulary of plain labels needs no search through a map; spellings find what the label rule finds."""
    forms = (str, str.upper, lambda m: m.replace("_", " ").title(), lambda m: "  " + m.replace("_", "-") + " ",
             lambda m: f"({m})", lambda m: m.replace("_", " / "), lambda m: "\t" + m, lambda m: m + "x")
    said = [(f(m), m if i < len(forms) - 1 else "other") for m in SUBSPECIALTIES for i, f in enumerate(forms)]
    rows = spark.createDataFrame([*said, (None, "other"), ("", "other"), ("--", "other")], "c string, want string")
    got = rows.withColumn("got", coerce.coerce_enum("c", SUBSPECIALTIES, "other"))
    assert "element_at" not in got._jdf.queryExecution().analyzed().toString()
    assert not got.filter("got is distinct from want").collect()
