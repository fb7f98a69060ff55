"""JSON objects out of free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, let, strip

# Tokens that tile any text: a closed string, a brace, plain text, a quote left open.
_TOKENS = r'(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+"|[{}]|[^{}"]++|"'
_FENCE = "```"


def strip_code_fence(c: Column | str) -> Column:
    """Drop a leading and a trailing code fence; other text is only trimmed."""
    t = strip(c)
    inner = F.regexp_replace(F.regexp_replace(t, r"(?iU)^```(?:json)?\s*", ""), r"(?U)\s*```$", "")
    return F.when(F.startswith(t, F.lit(_FENCE)), strip(inner)).otherwise(t)


def drop_fence_lines(c: Column | str) -> Column:
    """Fenced text without any line that starts with a fence."""
    t = strip(c)
    kept = F.filter(F.split(t, "\n"), lambda line: ~F.startswith(line, F.lit(_FENCE)))
    return F.when(F.startswith(t, F.lit(_FENCE)), strip(F.array_join(kept, "\n"))).otherwise(t)


def first_json_object(c: Column | str) -> Column:
    """First balanced ``{...}``, braces inside strings not counted; null if none closes.

    A fold over tokens rather than characters.  ``end`` is the length up to the closing
    brace, 0 while open; an open quote before that ends the search.
    """
    t = col(c)
    tail = F.substr(t, F.locate("{", t))
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("pos"),
                     F.lit(0).alias("end"), F.lit(False).alias("dead"))

    def step(s: Column, tok: Column) -> Column:
        depth = s["depth"] + F.when(tok == "{", 1).when(tok == "}", -1).otherwise(0)
        pos = s["pos"] + F.char_length(tok)
        moved = F.struct(
            depth.alias("depth"), pos.alias("pos"),
            F.when((tok == "}") & (s["depth"] == 1), pos).otherwise(0).alias("end"),
            (tok == '"').alias("dead"))
        return F.when((s["end"] > 0) | s["dead"], s).otherwise(moved)

    def cut(x: Column) -> Column:
        end = F.aggregate(F.regexp_extract_all(x, F.lit(_TOKENS), F.lit(0)), start, step,
                          lambda s: s["end"])
        return let(end, lambda e: F.when(e > 0, F.substr(x, F.lit(1), e)))

    return F.when(F.locate("{", t) > 0, let(tail, cut))


def parse_object(c: Column | str) -> Column:
    """VARIANT object held by an answer text, or null.

    The rule is: the text behind a code fence if that is an object, else its first
    balanced object.  ``try_parse_json`` reads one value and ignores what follows, so
    parsing from the first brace on gives the same in every case: a value that parses
    there is the first balanced object, and if none parses there the rule fails too.
    """
    t = col(c)
    at = F.locate("{", t)
    return F.when(at > 0, F.try_parse_json(F.substr(t, at)))


def _boxed(t: Column) -> Column:
    """VARIANT array of a text that is exactly one JSON value and of the text's hash, else null.

    ``try_parse_json`` ignores whatever follows the first value.  Here the text is put
    into an array in front of its own hash: only a text that is one complete value leaves
    the hash as the second element.
    """
    boxed = F.try_parse_json(F.concat(F.lit("["), t, F.lit(","), F.xxhash64(t).cast("string"),
                                      F.lit("]")))
    return let(boxed, lambda v: F.when(F.try_variant_get(v, "$[1]", "bigint") == F.xxhash64(t), v))


def parse_strict(c: Column | str) -> Column:
    """VARIANT of a text that is exactly one JSON value, else null."""
    return F.try_variant_get(_boxed(col(c)), "$[0]", "variant")


def boxed_object(c: Column | str) -> Column:
    """VARIANT array whose first item is the object that the text is, else null; the text is stripped once.

    Taking the object out copies all of it; a reader of a few values reads them below ``$[0]``.
    """
    return let(strip(c), lambda t: F.when(F.startswith(t, F.lit("{")), _boxed(t)))


def parse_strict_object(c: Column | str) -> Column:
    """`parse_strict`, objects only."""
    return F.try_variant_get(boxed_object(c), "$[0]", "variant")


def parse_screening(c: Column | str) -> Column:
    """VARIANT of a screening answer: the whole text, else first ``{`` to last ``}``."""
    def pick(t: Column) -> Column:
        greedy = F.regexp_extract(t, r"(?s)\{.*\}", 0)
        return F.coalesce(parse_strict(t), parse_strict(greedy))
    return let(drop_fence_lines(c), pick)
