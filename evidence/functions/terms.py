"""Thousands of terms against a text in one pass over its words.

The rule of a term is a case-insensitive whole-word match, with ``*`` at its end for any word
ending. One alternation of all terms tries them one by one at every place of the text. Here the text
is cut into its words once; a hash set of whole-word terms, one of word beginnings by length, and an
index of phrases by one of their words are asked for each word. Only a phrase whose word is in the
text is looked for as a pattern, so the time hardly grows with the number of terms. All of it is
built-in expressions.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections import defaultdict
from collections.abc import Callable, Collection, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, let

_WORD = r"(?U)\w+"
#: word index of phrases, cut by a hash so that a look-up walks through few entries
_SLOTS = 256


def term_pattern(terms: Sequence[str]) -> str:
    """Whole-word alternation, case-insensitive; a trailing ``*`` matches word endings."""
    parts = [re.escape(t.rstrip("*")) + (r"\w*" if t.endswith("*") else "") for t in terms]
    return rf"(?iU)\b(?:{'|'.join(parts)})\b"


def _folded(ch: str) -> str:
    """One character as a case-insensitive pattern compares it: lower case of its upper case."""
    upper = ch.upper() if len(ch.upper()) == 1 else ch
    lower = upper.lower() if len(upper.lower()) == 1 else upper.lower()[:1]
    return lower


# characters that folding takes elsewhere than lower case does, found by that rule
_FOLDED = {chr(i): _folded(chr(i)) for i in range(128, sys.maxunicode + 1)
           if not 0xD800 <= i <= 0xDFFF and _folded(chr(i)) != chr(i).lower()}


def fold(s: str) -> str:
    return "".join(_FOLDED.get(ch) or ch.lower() for ch in s)


def folded(c: Column | str) -> Column:
    odd, plain = "".join(_FOLDED), "".join(_FOLDED.values())
    # texts in ASCII have none of these; lower() gives a capital sigma by its place in the word
    return F.when(F.octet_length(col(c)) == F.char_length(col(c)), F.lower(col(c))).otherwise(
        F.translate(F.lower(F.translate(col(c), odd, plain)), "ς", "σ"))


def _words(term: str) -> list[str]:
    return re.findall(r"\w+", term)


def _quoted(word: str) -> str:
    return "'" + word.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _slots(words: Collection[str]) -> list[list[str]]:
    out: list[list[str]] = [[] for _ in range(_SLOTS)]
    for w in sorted(words):
        out[zlib.crc32(w.encode()) % _SLOTS].append(w)
    return out


def _slot(w: Column) -> Column:
    return (F.crc32(w) % _SLOTS).cast("int")


def _set(words: Collection[str]) -> Column:
    """A literal of words by slot; parsed at once, folded when the plan is optimised."""
    return F.expr("array(" + ", ".join(
        f"array({', '.join(map(_quoted, s))})" if s else "CAST(array() AS ARRAY<STRING>)" for s in _slots(words)) + ")")


def _map(entries: dict[str, str]) -> Column:
    return F.expr("array(" + ", ".join(
        "map(" + ", ".join(f"{_quoted(k)}, {_quoted(entries[k])}" for k in s) + ")" if s
        else "CAST(map() AS MAP<STRING, STRING>)" for s in _slots(entries)) + ")")


class TermIndex:
    """Terms sorted by how they are looked up; the index of one group of terms."""

    def __init__(self, terms: Sequence[str]):
        self.whole: set[str] = set()
        self.beginnings: dict[int, set[str]] = defaultdict(set)
        self.phrases: dict[str, list[str]] = defaultdict(list)
        self.rest: list[str] = []
        for term in dict.fromkeys(terms):
            bare, open_end = term.rstrip("*"), term.endswith("*")
            words = [fold(w) for w in _words(bare)]
            if words and _words(bare) == [bare]:  # a single word
                if open_end:
                    self.beginnings[len(words[0])].add(words[0])
                else:
                    self.whole.add(words[0])
                continue
            # the last word of an open phrase is only the beginning of one
            complete = words[:-1] if open_end and re.search(r"\w$", bare) else words
            if complete:
                self.phrases[max(complete, key=len)].append(term)
            else:
                self.rest.append(term)

    def hit(self, text: Column | str) -> Column:
        """Whether a term is in the text; null for a null text."""
        def within(words: Column, value: Callable[[Column], Column], members: Collection[str]) -> Column:
            held = _set(members)
            return F.exists(words, lambda w: F.array_contains(F.get(held, _slot(value(w))), value(w)))

        def any_word(words: Column) -> Column:
            found = F.lit(False)
            if self.whole:
                found = found | within(words, lambda w: w, self.whole)
            for n, heads in sorted(self.beginnings.items()):
                found = found | within(words, lambda w, n=n: F.substring(w, 1, n), heads)
            if self.phrases:
                index = _map({word: term_pattern(terms) for word, terms in self.phrases.items()})

                def phrase(w: Column) -> Column:
                    own = F.try_element_at(F.get(index, _slot(w)), w)
                    return let(own, lambda p: F.when(p.isNotNull(), F.rlike(col(text), p)).otherwise(F.lit(False)))
                found = found | F.exists(words, phrase)
            if self.rest:
                found = found | F.rlike(col(text), F.lit(term_pattern(self.rest)))
            return found
        words = F.array_distinct(F.regexp_extract_all(folded(text), F.lit(_WORD), F.lit(0)))
        return let(words, lambda w: F.when(w.isNotNull(), any_word(w)))
