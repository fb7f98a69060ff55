"""Text rules as column expressions."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Whitespace as Unicode text processing sees it, plus the four ASCII separators.
# Spark's trim knows only the space character and Java's \s only ASCII.
WHITESPACE = "".join(map(chr, (
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
# the same set without the space, as regex ranges
_GAPS = r"\t-\r\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
# A lone space is already normal form, so ordinary prose needs no replacement at all.  No visible
# ASCII character is a gap: one comparison passes over it, where the set below takes a dozen.
_TO_COLLAPSE = f"(?=[^!-~])(?: (?=[^!-~])[ {_GAPS}]+|[{_GAPS}][ {_GAPS}]*)"
HAS_TEXT = f"[^ {_GAPS}]"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``.

    Inside lambdas Spark does no common-subexpression elimination.  This is the finish
    step of a fold over no elements: nothing is looped and no array is built.
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda acc, _: acc, body)


def either(condition: Column, then: Column, other: Column) -> Column:
    """``then`` where the condition holds, else ``other``.

    The same as ``when(...).otherwise(...)``; inside lambdas, where nothing is compiled, a choice of
    two costs a fraction of a list of branches.
    """
    return F.call_function("if", condition, then, other)


def computed(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add expensive columns that are evaluated exactly once per row.

    A filter on a plain projected column is pushed below the projection with the whole
    expression copied into it.  A one-row ``inline`` gives the same columns, but a filter
    on them stays above, while filters on other columns still go through.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select(*[c for c in df.columns if c not in columns], F.inline(F.array(row)))


def strip(c: Column | str) -> Column:
    """Trim all Unicode whitespace on both ends."""
    return F.btrim(col(c), F.lit(WHITESPACE))


def norm_text(c: Column | str) -> Column:
    """Collapse whitespace runs to one space and trim; null becomes ''."""
    return F.coalesce(F.trim(F.regexp_replace(col(c), _TO_COLLAPSE, " ")), F.lit(""))


def first_text(*candidates: Column | str) -> Column:
    """First candidate that is neither null nor empty, else null."""
    first, *rest = candidates
    return let(col(first), lambda x: either(x != "", x, first_text(*rest) if rest else F.lit(None).cast("string")))


def maybe_text(c: Column | str) -> Column:
    """`norm_text`, but empty becomes null."""
    return first_text(norm_text(c))


def has_text(c: Column | str) -> Column:
    return F.coalesce(F.rlike(col(c), F.lit(HAS_TEXT)), F.lit(False))


def label(c: Column | str) -> Column:
    """Vocabulary key: lower case, ``&`` as ``and``, other runs as one ``_``."""
    lowered = F.replace(F.lower(F.coalesce(col(c), F.lit(""))), F.lit("&"), F.lit(" and "))
    return F.btrim(F.regexp_replace(lowered, "[^a-z0-9]+", "_"), F.lit("_"))


def plain_label(c: Column | str) -> Column:
    """Lower case, outer spaces off, each space and hyphen as ``_``: where that is made of letters and
    digits with single ``_`` between them it is the `label`, found without a regular expression."""
    lowered = F.lower(F.trim(F.coalesce(col(c), F.lit(""))))
    return F.replace(F.replace(lowered, F.lit(" "), F.lit("_")), F.lit("-"), F.lit("_"))


def label_of(s: str) -> str:
    """`label` for a vocabulary member known when the plan is built."""
    kept = "".join(ch if ch.isascii() and ch.isalnum() else " "
                   for ch in s.lower().replace("&", " and "))
    return "_".join(kept.split())


def join_items(items: Column, sep: str = "; ") -> Column:
    """Join an array of strings after `norm_text`, empty items dropped."""
    cleaned = F.filter(F.transform(items, norm_text), lambda x: x != "")
    return F.coalesce(F.array_join(cleaned, sep), F.lit(""))


def join_mesh(items: Column) -> Column:
    """Join ``array<struct<descriptor, qualifiers>>`` as ``D [q1; q2]; ...``."""
    def one(m: Column) -> Column:
        return let(F.struct(norm_text(m["descriptor"]).alias("d"),
                            join_items(m["qualifiers"]).alias("q")),
                   lambda x: F.when(x["d"] == "", "").when(x["q"] == "", x["d"])
                   .otherwise(F.concat(x["d"], F.lit(" ["), x["q"], F.lit("]"))))
    return join_items(F.transform(items, one))


def render(template: str, values: Mapping[str, Column]) -> Column:
    """Fill ``<<KEY>>`` slots.

    The template is cut at its slots when the plan is built, so inserted text is never
    scanned again and one ``concat`` does the work.
    """
    pieces: list[Column] = []
    rest = template
    while rest:
        at = {rest.find(f"<<{k}>>"): k for k in values if f"<<{k}>>" in rest}
        if not at:
            break
        pos = min(at)
        if pos:
            pieces.append(F.lit(rest[:pos]))
        pieces.append(F.coalesce(values[at[pos]], F.lit("")))
        rest = rest[pos + len(at[pos]) + 4:]
    if rest:
        pieces.append(F.lit(rest))
    return F.concat(*pieces) if pieces else F.lit("")


def contains_any(c: Column | str, terms: Sequence[str]) -> Column:
    """True when the lower-cased text holds one of the terms; null text gives false."""
    low = F.lower(F.coalesce(col(c), F.lit("")))
    hit = F.lit(False)
    for t in terms:
        hit = hit | F.contains(low, F.lit(t.lower()))
    return hit


def year_of(c: Column | str) -> Column:
    """Leading four-digit year of a date text, also of a bare year."""
    return F.regexp_extract(col(c), r"^(\d{4})", 1).try_cast("int")


# fixed values: month abbreviations in calendar order
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def pub_date(year: Column, month: Column, day: Column) -> Column:
    """``YYYY-MM-DD`` from year, month name and day; the bare year when no such day exists.

    A missing month counts as January and a missing day as the first.
    """
    number = F.try_element_at(
        F.create_map(*[F.lit(x) for i, m in enumerate(MONTHS, 1) for x in (m, f"{i:02d}")]),
        F.substring(F.coalesce(month, F.lit("Jan")), 1, 3))
    text = F.format_string("%s-%s-%02d", year, number,
                           strip(F.coalesce(day, F.lit("01"))).try_cast("int"))
    valid = number.isNotNull() & F.try_to_date(text, "yyyy-MM-dd").isNotNull()
    return F.coalesce(F.when(valid, text), year, F.lit(""))


# fixed values: frequent function words per language
STOP_WORDS = {
    "en": ("the", "and", "of", "in", "with", "for"),
    "fr": ("le", "les", "des", "et", "dans", "pour"),
    "de": ("der", "die", "und", "das", "mit", "von"),
    "es": ("el", "los", "las", "y", "con", "para"),
}


def abstract_language(c: Column | str, minimum_hits: int = 1) -> Column:
    """Language with most function-word hits, 'en' on ties, null below ``minimum_hits``."""
    text = F.lower(F.coalesce(col(c), F.lit("")))
    counted = F.array(*[
        F.struct(F.regexp_count(text, F.lit(rf"(?U)\b({'|'.join(words)})\b")).alias("n"),
                 F.lit(-rank).alias("rank"), F.lit(lang).alias("lang"))
        for rank, (lang, words) in enumerate(STOP_WORDS.items())])
    return let(F.array_max(counted),
               lambda best: F.when(best["n"] >= minimum_hits, best["lang"]))


def non_ascii_share(c: Column | str) -> Column:
    """Share of characters outside ASCII; null for empty text."""
    text = col(c)
    odd = F.regexp_count(text, F.lit(r"[^\x00-\x7f]"))
    return F.try_divide(odd.cast("double"), F.char_length(text).cast("double"))
