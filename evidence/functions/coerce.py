"""Type coercion of VARIANT values whose JSON type is not known in advance.

Each rule is one column expression.  Numbers and booleans go through
``try_variant_get``; only JSON strings take the text rule.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, either, has_text, label, label_of, let, norm_text, plain_label, strip

# fixed values: words read as booleans
TRUE_WORDS = ("true", "1", "yes", "y")
FALSE_WORDS = ("false", "0", "no", "n")


def _is_string(v: Column) -> Column:
    return F.schema_of_variant(v) == "STRING"


def _as_text(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def _literal_map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def bool_of_text(c: Column | str) -> Column:
    """Words true/1/yes/y and false/0/no/n in any case; anything else is null."""
    words = {**{w: True for w in TRUE_WORDS}, **{w: False for w in FALSE_WORDS}}
    return F.try_element_at(_literal_map(words), F.lower(strip(c)))


def to_bool_or_null(v: Column | str) -> Column:
    v = col(v)
    return either(_is_string(v), bool_of_text(_as_text(v)), F.try_variant_get(v, "$", "boolean"))


def to_bool(v: Column | str, default: bool = False) -> Column:
    return F.coalesce(to_bool_or_null(v), F.lit(default))


def _first_number(c: Column | str, pattern: str) -> Column:
    # no match gives '', which try_cast turns into null
    return F.regexp_extract(F.replace(col(c), F.lit(","), F.lit("")), pattern, 0)


def int_of_text(c: Column | str) -> Column:
    """First integer in the text, thousands commas ignored."""
    return _first_number(c, r"-?\d+").try_cast("bigint")


def float_of_text(c: Column | str) -> Column:
    """First decimal number in the text, thousands commas ignored."""
    return _first_number(c, r"-?\d+(?:\.\d+)?").try_cast("double")


def to_int_or_null(v: Column | str) -> Column:
    """Integer of any scalar; fractions are cut toward zero."""
    v = col(v)
    return either(_is_string(v), int_of_text(_as_text(v)), F.try_variant_get(v, "$", "bigint"))


def to_float_or_null(v: Column | str) -> Column:
    v = col(v)
    return either(_is_string(v), float_of_text(_as_text(v)), F.try_variant_get(v, "$", "double"))


def _clamped(v: Column, lo: int, hi: int) -> Column:
    # greatest/least skip nulls, so null needs its own branch; a number beyond 64 bits
    # still clamps to the right bound, by way of double
    def bounded(n: Column, low, high) -> Column:
        return either(n.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), n)), F.lit(None)).cast("int")

    def of_text(t: Column) -> Column:
        return let(_first_number(t, r"-?\d+"), lambda d: F.coalesce(
            bounded(d.try_cast("bigint"), lo, hi), bounded(d.try_cast("double"), float(lo), float(hi))))

    def of_value(x: Column) -> Column:
        whole = let(F.try_variant_get(x, "$", "bigint"), lambda n: bounded(n, lo, hi))
        real = let(F.try_variant_get(x, "$", "double"), lambda n: bounded(n, float(lo), float(hi)))
        return F.coalesce(whole, real)

    return either(v.isNull(), F.lit(None).cast("int"),
                  either(_is_string(v), of_text(_as_text(v)), of_value(v)))


def clamp_all(values: Sequence[Column], lo: int, hi: int) -> Column:
    """Array of the values as integers within the bounds, null where there is no number."""
    return F.transform(F.array(*values), lambda v: _clamped(v, lo, hi))


def clamp_int_or_null(v: Column | str, lo: int, hi: int) -> Column:
    return let(col(v), lambda x: _clamped(x, lo, hi))


def clamp_0_100(v: Column | str, default: int = 0) -> Column:
    return F.coalesce(clamp_int_or_null(v, 0, 100), F.lit(max(0, min(100, default))))


def clean_items(items: Column) -> Column:
    return F.filter(F.transform(items, norm_text), lambda x: x != "")


def _delimited(c: Column) -> Column:
    s = F.coalesce(c, F.lit(""))
    return F.when(F.contains(s, F.lit(";")), F.split(s, ";")).otherwise(F.split(s, ","))


def list_of_text(c: Column | str) -> Column:
    """Split on ``;`` if present, else on ``,``; items normalised, empties dropped."""
    return clean_items(_delimited(col(c)))


def to_list_str(v: Column | str) -> Column:
    """List of texts from a JSON array or from a delimited scalar."""
    v = col(v)
    items = (F.when(F.startswith(F.schema_of_variant(v), F.lit("ARRAY")),
                    F.try_variant_get(v, "$", "array<string>"))
             .otherwise(_delimited(_as_text(v))))
    return clean_items(items)


def coerce_enum(c: Column | str, allowed: Sequence[str], default: str) -> Column:
    """Vocabulary member equal to the text, or equal after `label`; else the default."""
    by_label: dict[str, str] = {}
    for member in allowed:
        by_label.setdefault(label_of(member), member)
    if all(label_of(m) == m for m in allowed):
        # members are their own labels: looked up in a hash set, the label rule last
        def member_or(value: Column, other: Column) -> Column:
            return either(value.isin(*allowed), value, other)
        return member_or(col(c), let(plain_label(c), lambda p: member_or(
            p, let(label(c), lambda n: member_or(n, F.lit(default))))))
    # well-spelled answers hit the first lookup and skip the label rule
    exact = {m: m for m in allowed}
    found = F.coalesce(F.try_element_at(_literal_map(exact), col(c)), *(
        [] if all(by_label[label_of(m)] == m for m in allowed) else
        # two members share a label: an exact hit after norm_text goes first
        [F.try_element_at(_literal_map(exact), norm_text(c))]),
        F.try_element_at(_literal_map(by_label), label(c)))
    # a text made of nothing but punctuation has the empty label, which is no member
    return F.coalesce(found, F.lit(default))


def out_of_set(c: Column | str, result: Column, default: str, strict_default: bool = True) -> Column:
    """True when a non-empty input ended on the default.

    With ``strict_default`` a literal default counts as well.
    """
    hit = (result == default) & has_text(c)
    return hit if strict_default else hit & (label(c) != label_of(default))


def score_block(raw: Column, keys: Sequence[str], total_key: str,
                sub_max: int, total_max: int) -> Column:
    """``struct<scores: struct<keys..., total>, mismatch: boolean>``.

    With all sub-scores known the total is their sum and a different given total is a
    mismatch; otherwise the given total, else the sum of what is known, else null.
    """
    def build(x: Column) -> Column:
        subs = [x["subs"][i] for i in range(len(keys))]
        known = F.filter(x["subs"], lambda s: s.isNotNull())
        return let(
            F.struct(x["subs"].alias("subs"), x["given"].alias("given"),
                     F.size(known).alias("n"),
                     F.aggregate(known, F.lit(0), lambda a, s: a + s).alias("sum")),
            lambda y: F.struct(
                F.struct(*[y["subs"][i].alias(k) for i, k in enumerate(keys)],
                         either(y["n"] == len(keys), y["sum"],
                                F.coalesce(y["given"], either(y["n"] > 0, F.least(y["sum"], F.lit(total_max)),
                                                              F.lit(None).cast("int"))))
                         .alias(total_key)).alias("scores"),
                F.coalesce((y["n"] == len(keys)) & (y["given"] != y["sum"]), F.lit(False))
                .alias("mismatch")))

    return let(F.struct(clamp_all([raw[k] for k in keys], 0, sub_max).alias("subs"),
                        clamp_int_or_null(raw[total_key], 0, total_max).alias("given")), build)
