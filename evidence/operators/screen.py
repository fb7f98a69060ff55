"""Screening: local prefilter, keyword rules, corpus predicate and decision gates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import coerce, jsontext, text
from ..functions.terms import TermIndex, term_pattern
from ..schema import (BUILDING_TERMS, CONTEXT_TERMS, CORPUS_EXCLUDED_TYPES, CORPUS_GROUPS,
                      CORPUS_YEARS, MODEL_TERMS, VALIDATION_ONLY_TERMS, PrefilterRules)

# Unicode classes, and '.' stopping at '\n' only
_REGEX_FLAGS = "(?Ud)"


def _first_reason(tests: Sequence[tuple[Column, str]]) -> Column:
    chain = F.when(tests[0][0], F.lit(tests[0][1]))
    for hit, reason in tests[1:]:
        chain = chain.when(hit, F.lit(reason))
    return chain


def type_reason(types: Column, terms: Sequence[str]) -> Column:
    """First term that is a substring of any publication type.

    The types are joined with a line break, which no term holds, so one plain substring
    test per term replaces a lambda over the array.
    """
    joined = F.lower(F.coalesce(F.array_join(types, "\n"), F.lit("")))
    return _first_reason([(F.contains(joined, F.lit(t)), f"Publication type: {t}")
                          for t in terms])


def title_reason(title: Column, patterns: Sequence[tuple[str, str]]) -> Column:
    low = F.lower(F.coalesce(title, F.lit("")))
    return _first_reason([(F.rlike(low, F.lit(_REGEX_FLAGS + p)), f"Title match: {r}")
                          for p, r in patterns])


def abstract_reason(abstract: Column, minimum: int) -> Column:
    short = F.coalesce(F.char_length(text.strip(abstract)), F.lit(0)) < minimum
    return F.when(short, F.lit("No abstract or too short"))


def prefilter_reason(rules: PrefilterRules = PrefilterRules(), types: str = "publication_types",
                     title: str = "title", abstract: str = "abstract") -> Column:
    """Why a record is dropped before any answer is asked for; null keeps it."""
    reasons = []
    if rules.excluded_types:
        reasons.append(type_reason(F.col(types), rules.excluded_types))
    if rules.title_patterns:
        reasons.append(title_reason(F.col(title), rules.title_patterns))
    reasons.append(abstract_reason(F.col(abstract), rules.min_abstract_chars))
    return F.coalesce(*reasons)


def prefilter(df: DataFrame, rules: PrefilterRules = PrefilterRules()) -> DataFrame:
    """Add ``exclude_reason`` and ``excluded``; rows are kept as data, not dropped."""
    return (df.withColumn("exclude_reason", prefilter_reason(rules))
            .withColumn("excluded", F.col("exclude_reason").isNotNull()))


# --- keyword rules of the guide ------------------------------------------------------------

def _both(title: str, abstract: str) -> Column:
    return F.concat_ws(" ", F.col(title), F.col(abstract))


def has_required_keywords(model_terms: Sequence[str] = MODEL_TERMS,
                          context_terms: Sequence[str] = CONTEXT_TERMS,
                          title: str = "title", abstract: str = "abstract") -> Column:
    """A model term and a context term occur in title or abstract."""
    both = _both(title, abstract)
    return text.contains_any(both, model_terms) & text.contains_any(both, context_terms)


def is_validation_only(markers: Sequence[str] = VALIDATION_ONLY_TERMS,
                       building: Sequence[str] = BUILDING_TERMS,
                       title: str = "title", abstract: str = "abstract") -> Column:
    """A validation/comparison marker occurs, but no word of building a model."""
    both = _both(title, abstract)
    return text.contains_any(both, markers) & ~text.contains_any(both, building)


def is_missing_text(title: str = "title", abstract: str = "abstract") -> Column:
    return ~text.has_text(title) | ~text.has_text(abstract)


def keyword_reason(model_terms: Sequence[str] = MODEL_TERMS,
                   context_terms: Sequence[str] = CONTEXT_TERMS,
                   markers: Sequence[str] = VALIDATION_ONLY_TERMS,
                   building: Sequence[str] = BUILDING_TERMS) -> Column:
    """The three documented rules in order, to be put behind `prefilter_reason`."""
    return _first_reason([
        (is_missing_text(), "Missing title or abstract"),
        (~has_required_keywords(model_terms, context_terms), "No model or context keyword"),
        (is_validation_only(markers, building), "Validation only"),
    ])


# --- corpus predicate -----------------------------------------------------------------------

#: groups of more terms are looked up by word instead of tried one by one
INDEXED_TERMS = 40


def corpus_predicate(groups: Sequence[Sequence[str]] = CORPUS_GROUPS,
                     years: tuple[int, int] | None = CORPUS_YEARS,
                     excluded_types: Sequence[str] = CORPUS_EXCLUDED_TYPES) -> Column:
    """Every group of terms hits title or abstract, the year is in range, no excluded type.

    Large groups go through `TermIndex`, which gives the same answers.
    """
    keep = F.lit(True)
    if years:
        keep = keep & F.coalesce(text.year_of("pub_date").between(*years), F.lit(False))
    if excluded_types:
        keep = keep & type_reason(F.col("publication_types"), excluded_types).isNull()
    both = _both("title", "abstract")
    for terms in groups:
        keep = keep & (TermIndex(terms).hit(both) if len(terms) > INDEXED_TERMS
                       else F.rlike(both, F.lit(term_pattern(terms))))
    return keep


def corpus_filter(df: DataFrame, groups: Sequence[Sequence[str]] = CORPUS_GROUPS,
                  years: tuple[int, int] | None = CORPUS_YEARS,
                  excluded_types: Sequence[str] = CORPUS_EXCLUDED_TYPES) -> DataFrame:
    return df.filter(corpus_predicate(groups, years, excluded_types))


# --- decisions --------------------------------------------------------------------------------

DECISION_FLAGS = ("include", "is_original_article", "is_clinical_prediction_model",
                  "has_model_building")


def parse_decision(content: Column | str) -> Column:
    """``struct<decision, reason>`` of a screening answer."""
    return decision_of(jsontext.parse_screening(content), answer_head(content))


#: characters of an unreadable answer that its reason shows
HEAD_CHARS = 100


def answer_head(content: Column | str, chars: int = HEAD_CHARS) -> Column:
    """Start of an answer, for the reason of a failed parse."""
    return F.substring(jsontext.drop_fence_lines(content), 1, chars)


def decision_of(parsed: Column, head: Column) -> Column:
    """Decision of a parsed answer.

    An answer that is no JSON object is an ``error``; so is an object without a decision.
    """
    failed = F.struct(F.lit("error").alias("decision"),
                      F.concat(F.lit("JSON parse failed: "), head).alias("reason"))
    return text.let(
        F.try_variant_get(parsed, "$", "struct<decision string,reason string>"),
        lambda d: F.when(d.isNull(), failed).otherwise(
            F.struct(F.coalesce(d["decision"], F.lit("error")).alias("decision"),
                     d["reason"].alias("reason"))))


def parse_flags(content: Column | str) -> Column:
    """Documented answer form: four booleans, exclusion reason and confidence."""
    raw = ",".join(f"{f} variant" for f in (*DECISION_FLAGS, "confidence"))
    parsed = F.try_variant_get(jsontext.parse_screening(content), "$",
                               f"struct<{raw},exclude_reason string>")
    return text.let(parsed, lambda d: F.struct(
        *[coerce.to_bool(d[f]).alias(f) for f in DECISION_FLAGS],
        d["exclude_reason"].alias("exclude_reason"),
        coerce.clamp_0_100(d["confidence"]).alias("confidence")))


def passes_gate(answer: Column, form: str = "decision") -> Column:
    """``decision`` form: exactly ``include``; ``flags`` form: all four flags true."""
    if form == "decision":
        return F.coalesce(answer["decision"] == "include", F.lit(False))
    keep = F.lit(True)
    for f in DECISION_FLAGS:
        keep = keep & F.coalesce(answer[f], F.lit(False))
    return keep


def gate(df: DataFrame, answer: str = "answer", form: str = "decision") -> DataFrame:
    return df.filter(passes_gate(F.col(answer), form))


def screening_outcome(reason: Column, decision: Column) -> Column:
    """included, excluded_local, excluded_llm or error; errors are kept apart."""
    return (F.when(reason.isNotNull(), "excluded_local")
            .when(decision == "include", "included")
            .when(F.coalesce(decision, F.lit("error")) == "error", "error")
            .otherwise("excluded_llm"))
