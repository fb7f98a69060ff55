"""Quality rules: a table of thresholds compiled into one projection, without user functions.

Each rule bounds one ratio of a text; the verdict is the conjunction of all of them and of
the base rules. Everything is row local: no shuffle, no Python, any text length in
O(n log n) (repeated windows are found by sorting a text's own window hashes).

Defined cases: null or blank text has no words, fails the base rules and no ratio rule
(ratios over nothing are null and pass). Rows are judged one by one, so ties, repeated rows
and null ids change nothing. Extra columns are left out; an empty table gives an empty one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidence.llm.base import WHITE, ascii_lower, bind, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20

# Frequent function words of the languages in use
STOP_WORDS = (
    "the", "and", "of", "to", "in", "is", "that", "with", "for", "on", "as", "by", "are", "was",
    "die", "der", "und", "das", "den", "ein", "eine", "mit", "von", "zu", "ist", "auf", "nicht",
    "le", "la", "les", "des", "et", "un", "une", "que", "dans", "pour", "est", "qui", "sur", "par",
    "el", "los", "las", "y", "del", "con", "por", "para", "en", "de", "su", "se", "no", "al",
)


@dataclass(frozen=True)
class Rule:
    """numerator / denominator must lie in [low, high]; an open end is None."""
    name: str
    numerator: str
    denominator: str
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("word_length", "word_chars", "n_words", 2.0, 15.0),
    Rule("symbols", "n_symbols", "n_words", None, 0.1),
    Rule("stop_words", "n_stop_words", "n_words", 0.02, None),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 0.5),
)


def repeated_window_words(w: Column, width: int = WINDOW) -> Column:
    """How many of the words w lie in a window of ``width`` words that occurs again in w."""
    def measure(hashes: Column) -> Column:
        def covered(s: Column) -> Column:
            again = F.filter(F.transform(s, lambda x, i: F.when(
                (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]), x["at"])),
                lambda p: p.isNotNull())
            return bind(F.array_sort(again), lambda p: F.aggregate(
                F.transform(p, lambda x, i: F.coalesce(
                    F.least(F.get(p, i + 1) - x, F.lit(width)), F.lit(width))),
                F.lit(0), lambda a, x: a + x))
        placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at")))
        # most texts repeat nothing, which a hash set tells without sorting
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0) \
            .otherwise(bind(F.array_sort(placed), covered))

    windows = F.transform(F.sequence(F.lit(0), F.size(w) - width),
                          lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)]))
    return F.when(F.size(w) < width, 0).otherwise(bind(windows, measure))


def measures(docs: DataFrame) -> DataFrame:
    """doc_id and the counts that the rules are made of, all long."""
    text = F.coalesce(F.col("text"), F.lit(""))
    held = docs.select(
        "doc_id", words(text).alias("w"),
        F.filter(F.split(text, "\n", -1), lambda x: F.length(F.btrim(x, F.lit(WHITE))) > 0).alias("lines"),
        F.length(F.translate(text, WHITE, "")).alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).alias("n_symbols"))
    # read by several expressions below: they stand on their own so that each is made once
    held = held.select("doc_id", "word_chars", "n_symbols", "w", "lines")
    stop = F.lit(f" {' '.join(STOP_WORDS)} ")
    out = {
        "n_words": F.size("w"), "word_chars": F.col("word_chars"), "n_symbols": F.col("n_symbols"),
        "n_lines": F.size("lines"),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": repeated_window_words(F.col("w")),
        "n_stop_words": F.size(F.filter("w", lambda x: (F.length(x) <= 5) & stop.contains(
            F.concat(F.lit(" "), ascii_lower(x), F.lit(" "))))),
    }
    return held.select("doc_id", *[c.cast("long").alias(n) for n, c in out.items()])


def within(rule: Rule) -> Column:
    ratio = F.try_divide(F.col(rule.numerator), F.col(rule.denominator))
    bounds = [x for x in (None if rule.low is None else ratio >= rule.low,
                          None if rule.high is None else ratio <= rule.high) if x is not None]
    held = F.lit(True)
    for b in bounds:
        held = held & b
    return F.coalesce(held, F.lit(True))


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, min_words: int = MIN_WORDS,
          max_repeated_percent: int = MAX_REPEATED_PERCENT) -> DataFrame:
    """The measures, base_failed, failed (names of the rules not met) and kept, per document."""
    base = (F.col("n_words") < min_words) \
        | (100 * F.col("n_repeat_words") > max_repeated_percent * F.col("n_words"))
    failed = F.array_compact(F.array(*[F.when(~within(r), F.lit(r.name)) for r in rules]))
    held = measures(docs).withColumns({"base_failed": base, "failed_rules": F.array_join(failed, ",")})
    return held.withColumn("kept", ~F.col("base_failed") & (F.col("failed_rules") == ""))
