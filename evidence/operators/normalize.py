"""Normalise parsed answers into the fixed extraction document.

The work is row local, so there is no shuffle.  The VARIANT is cast once to a struct whose
text fields are strings and whose other fields stay VARIANT (a value of the wrong JSON type
becomes null by that cast).  Article and entities are normalised from that struct, then
rolled up and assembled.  All of it is one expression with bound intermediate values, so
nothing is evaluated twice and no intermediate document is written to a row.

That expression is opaque to Catalyst's column pruning.  A reader of few fields names them
(``fields``): the expression is then compiled for these alone, with what their rules depend on,
and the cast reads nothing else from the VARIANT.
"""

from __future__ import annotations

from collections.abc import Collection, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import coerce, text
from ..functions.text import either, let
from ..schema import (DEFAULT_SCHEMA, ERROR_CONFIDENCE_CAP, NOTE_CHARS, REVIEW_THRESHOLD,
                      SCORE_KEYS, SUB_MAX, TOTAL_KEY, TOTAL_MAX, ExtractionSchema, Field)


ISSUES = "issues"


def all_fields(schema: ExtractionSchema) -> tuple[str, ...]:
    """Paths of everything a normalisation gives."""
    return (*[f"{schema.article_key}.{f.name}" for f in schema.article_fields],
            *[f"{schema.entity_key}.{f.name}" for f in schema.entity_fields], schema.entity_key,
            *[f"normalization.{c}" for c in schema.confidences],
            *[f"quality_flags.{c}" for c in schema.flags], ISSUES)


def review_fields(schema: ExtractionSchema = DEFAULT_SCHEMA) -> tuple[str, ...]:
    """What `needs_review` looks at."""
    return (*[f"quality_flags.{c}" for c in schema.flags], f"normalization.{schema.overall_confidence}",
            f"{schema.entity_key}.{schema.entity_score}")


def dependencies(schema: ExtractionSchema) -> dict[str, tuple[str, ...]]:
    """The paths a path's rule reads besides its own value in the answer."""
    a, e = schema.article_key, schema.entity_key
    judged = tuple(f"{level}.{f.name}" for level, fields in ((a, schema.article_fields), (e, schema.entity_fields))
                   for f in fields if f.kind in ("enum", "score"))
    out = {f"{e}.{f.name}": (e,) for f in schema.entity_fields}
    flags = {schema.article_external: schema.entity_external, schema.article_internal: schema.entity_internal}
    out |= {f"{a}.{k}": (f"{e}.{v}",) for k, v in flags.items()}
    out |= {f"{e}.{v}": (e, f"{e}.{schema.entity_validation}") for v in flags.values()}
    out[f"{a}.{schema.article_multi}"] = (f"{a}.{schema.article_count}",)
    out[f"{a}.{schema.article_count}"] = (e,)
    out[ISSUES] = (a, e, *judged, f"{a}.{schema.article_count}")
    out[f"quality_flags.{schema.review_flag}"] = (ISSUES,)
    return out


@dataclass(frozen=True)
class Needs:
    """Paths that are given, and those that are computed for them."""

    given: frozenset[str]
    computed: frozenset[str]

    def of(self, level: str, fields: Iterable[Field], given: bool = False) -> list[Field]:
        paths = self.given if given else self.computed
        return [f for f in fields if f"{level}.{f.name}" in paths]

    def names(self, level: str, names: Iterable[str], given: bool = False) -> list[str]:
        paths = self.given if given else self.computed
        return [n for n in names if f"{level}.{n}" in paths]


def needs_of(fields: Collection[str] | None, schema: ExtractionSchema = DEFAULT_SCHEMA) -> Needs:
    """The fields named and all that their rules depend on; a level's name stands for all of it."""
    every = all_fields(schema)
    given = set(every) if fields is None else set()
    for name in fields or ():
        under = [p for p in every if p == name or p.startswith(f"{name}.")]
        if not under:
            raise ValueError(f"no such field: {name}")
        given.update(under)
    # entities are numbered whichever of their fields is wanted
    if any(p.startswith(f"{schema.entity_key}.") for p in given):
        given.add(schema.entity_key)
    rules, computed, open_ = dependencies(schema), set(given), list(given)
    while open_:
        for path in rules.get(open_.pop(), ()):
            if path not in computed:
                computed.add(path)
                open_.append(path)
    return Needs(frozenset(given), frozenset(computed))


def _score(raw: Column) -> Column:
    return coerce.score_block(raw, SCORE_KEYS, TOTAL_KEY, SUB_MAX, TOTAL_MAX)


def _simple(f: Field, raw: Column, source: dict[str, Column]) -> Column:
    """Value of a field that carries no cross-field rule."""
    value = raw[f.name]
    if f.kind == "text":
        fallbacks = [source[f.source]] if f.source in source else []
        return F.coalesce(text.first_text(text.norm_text(value), *fallbacks), F.lit(f.default))
    if f.kind == "maybe":
        return text.maybe_text(value)
    if f.kind == "int":
        return coerce.to_int_or_null(value)
    if f.kind == "float":
        return coerce.to_float_or_null(value)
    if f.kind == "bool":
        return coerce.to_bool_or_null(value)
    if f.kind == "list":
        return F.coalesce(coerce.to_list_str(value), F.array().cast("array<string>"))
    if f.kind == "group":
        return F.struct(*[_simple(g, value, source).alias(g.name) for g in f.fields])
    raise ValueError(f"no simple rule for {f.name}: {f.kind}")


def _level(fields: Sequence[Field], raw: Column, prefix: Column, schema: ExtractionSchema,
           source: dict[str, Column], finish) -> Column:
    """``struct<fields, issues>`` of one level; enums and scores are bound before use."""
    enums = [f for f in fields if f.kind == "enum"]
    scores = [f for f in fields if f.kind == "score"]
    held = [*[coerce.coerce_enum(raw[f.name], schema.vocabularies[f.vocabulary], f.default)
              .alias(f.name) for f in enums],
            *[_score(raw[f.name]).alias(f.name) for f in scores]]

    def build(b: Column) -> Column:
        values = {f.name: b[f.name] if f.kind == "enum"
                  else b[f.name]["scores"] if f.kind == "score"
                  else _simple(f, raw, source) for f in fields}
        issues = [either(coerce.out_of_set(raw[f.name], b[f.name], f.default,
                                           schema.strict_default),
                         F.concat(prefix, F.lit(f".{f.issue}")), F.lit(None)) for f in enums]
        issues += [either(b[f.name]["mismatch"],
                          F.concat(prefix, F.lit(".quality_score_total_mismatch")), F.lit(None))
                   for f in scores]
        return finish(values, F.array_compact(F.array(*issues)) if issues else _no_text())

    return let(F.struct(*held), build) if held else build(raw)


def _no_text() -> Column:
    return F.array().cast("array<string>")


def _article(r: Column, schema: ExtractionSchema, source: dict[str, Column], needs: Needs) -> Column:
    def finish(values: dict[str, Column], issues: Column) -> Column:
        return F.struct(*[v.alias(k) for k, v in values.items()], issues.alias("issues"))
    return _level(needs.of(schema.article_key, schema.article_fields), r[schema.article_key],
                  F.lit("article"), schema, source, finish)


#: stands for an object of which no field is wanted
_ANY = "_any"


def _entities(r: Column, schema: ExtractionSchema, needs: Needs) -> Column:
    """``array<struct<doc, issues>>``; ``doc`` is null for an item that is no object."""
    ext, internal, kind = (schema.entity_external, schema.entity_internal,
                           schema.entity_validation)

    def one(m: Column, i: Column) -> Column:
        prefix = F.concat(F.lit(f"{schema.entity_prefix}["), i.cast("string"), F.lit("]"))

        def finish(values: dict[str, Column], issues: Column) -> Column:
            # explicit flags win; the vocabulary is closed, so "not external" means false
            for flag, kinds in ((ext, schema.external_values), (internal, schema.internal_values)):
                if flag in values:
                    values[flag] = F.coalesce(values[flag], values[kind].isin(*kinds))
            doc = [v.alias(k) for k, v in values.items()] or [F.lit(True).alias(_ANY)]
            return F.struct(F.struct(*doc).alias("doc"), issues.alias("issues"))

        bad = F.struct(F.lit(None).alias("doc"),
                       F.array(F.concat(prefix, F.lit("_not_object"))).alias("issues"))
        return either(m.isNull(), bad, _level(fields, m, prefix, schema, {}, finish))

    fields = needs.of(schema.entity_key, schema.entity_fields)
    models = F.coalesce(r[schema.entity_key], F.array().cast(schema.raw_entities_type(fields)))
    return F.transform(models, one)


def _renumbered(entities: Column, schema: ExtractionSchema, needs: Needs) -> Column:
    kept = F.filter(entities, lambda e: e["doc"].isNotNull())
    return F.transform(kept, lambda e, i: F.struct(
        (i + 1).alias(schema.entity_id),
        *[e["doc"][f.name].alias(f.name) for f in needs.of(schema.entity_key, schema.entity_fields)]))


def _any_known(models: Column, flag: str) -> Column:
    # null when no entity says anything
    known = F.filter(F.transform(models, lambda m: m[flag]), lambda x: x.isNotNull())
    return F.array_max(known)


def extraction(raw: Column, source: dict[str, Column], schema: ExtractionSchema = DEFAULT_SCHEMA,
               error: Column | None = None, error_label: Column | None = None,
               needs: Needs | None = None) -> Column:
    """``struct<doc, issues>`` of one answer; with a non-null ``error`` the empty template.

    With ``needs`` only the fields given there, and ``issues`` only if they are.
    """
    needs = needs or needs_of(None, schema)
    entities, judged = schema.entity_key in needs.computed, ISSUES in needs.computed

    def with_raw(r: Column) -> Column:
        levels = [_article(r, schema, source, needs).alias("article")]
        if entities:
            levels.append(_entities(r, schema, needs).alias("entities"))
        return let(F.struct(*levels), lambda x: with_levels(r, x))

    def with_levels(r: Column, x: Column) -> Column:
        found = []
        if entities:
            found.append(_renumbered(x["entities"], schema, needs).alias("models"))
        if judged:
            found.append(_issues(r, x, schema, error, error_label).alias("issues"))
        if not found:
            return parts(r, x, r)
        return let(F.struct(*found), lambda y: parts(r, x, y))

    def parts(r: Column, x: Column, y: Column) -> Column:
        out = [_document(r, x["article"], y["models"] if entities else None, y["issues"] if judged else None,
                         schema, error, error_label, needs).alias("doc")]
        if ISSUES in needs.given:
            out.append(y["issues"].alias("issues"))
        return F.struct(*out)

    return let(F.try_variant_get(raw, "$", schema.raw_type(
        needs.of(schema.article_key, schema.article_fields), needs.of(schema.entity_key, schema.entity_fields),
        needs.names("normalization", schema.confidences), needs.names("quality_flags", schema.flags))), with_raw)


def _issues(r: Column, x: Column, schema: ExtractionSchema, error: Column | None,
            label: Column | None) -> Column:
    a, none = x["article"], F.array().cast("array<string>")
    structure = F.array_compact(F.array(
        F.when(r[schema.article_key].isNull(), F.lit(f"missing_{schema.article_key}")),
        F.when(r[schema.entity_key].isNull(), F.lit(f"missing_{schema.entity_key}_array"))))
    negative = F.when(a[schema.article_count] < 0, F.array(F.lit("number_of_models_negative")))
    found = either(r.isNull(), F.array(F.lit("top_level_not_object")), F.concat(
        structure, a["issues"], F.flatten(x["entities"]["issues"]), F.coalesce(negative, none)))
    if error is None:
        return found
    return either(error.isNotNull(), F.array(F.concat(label, F.lit(":"), text.norm_text(error))), found)


def _document(r: Column, a: Column, models: Column | None, issues: Column | None, schema: ExtractionSchema,
              error: Column | None, label: Column | None, needs: Needs) -> Column:
    article = needs.of(schema.article_key, schema.article_fields, given=True)
    wanted = {f.name for f in article}
    derived: dict[str, Column] = {}
    if {schema.article_count, schema.article_multi} & wanted:
        given = a[schema.article_count]
        count = either(given >= 0, given, F.size(models).cast("bigint"))
        derived |= {schema.article_count: count, schema.article_multi: count > 1}
    for flag, inner in ((schema.article_external, schema.entity_external),
                        (schema.article_internal, schema.entity_internal)):
        if flag in wanted:
            derived[flag] = F.coalesce(a[flag], _any_known(models, inner))
    if error is not None and schema.article_notes in wanted:
        note = F.substring(F.concat(label, F.lit(": "), text.norm_text(error)), 1, NOTE_CHARS)
        derived[schema.article_notes] = F.when(error.isNotNull(), note).otherwise(
            a[schema.article_notes])
    out = []
    if article:
        out.append(F.struct(*[derived.get(f.name, a[f.name]).alias(f.name) for f in article]).alias(schema.article_key))
    if schema.entity_key in needs.given:
        own = needs.of(schema.entity_key, schema.entity_fields, given=True)
        narrow = F.transform(models, lambda m: F.struct(
            m[schema.entity_id].alias(schema.entity_id), *[m[f.name].alias(f.name) for f in own]))
        out.append((models if len(own) == len(needs.of(schema.entity_key, schema.entity_fields)) else narrow)
                   .alias(schema.entity_key))
    confidences = needs.names("normalization", schema.confidences, given=True)
    if confidences:
        out.append(F.struct(*[coerce.clamp_0_100(r["normalization"][c]).alias(c) for c in confidences])
                   .alias("normalization"))
    flags = needs.names("quality_flags", schema.flags, given=True)
    if flags:
        out.append(F.struct(*[
            ((F.size(issues) > 0) | coerce.to_bool(r["quality_flags"][c]) if c == schema.review_flag
             else coerce.to_bool(r["quality_flags"][c])).alias(c) for c in flags]).alias("quality_flags"))
    return F.struct(*out) if out else F.struct(F.lit(None).cast("string").alias(_ANY))


SOURCE_FIELDS = ("pmid", "title", "journal", "pub_date", "country")

# One expression per session, schema and set of fields, over inputs of fixed names.  Building it
# takes thousands of calls into the JVM, so every caller shares it; those of the last session go.
_BUILT: dict[tuple, Column] = {}


def _built(df: DataFrame, schema: ExtractionSchema, needs: Needs) -> Column:
    session = df.sparkSession.sparkContext.applicationId
    for key in [k for k in _BUILT if k[0] != session]:
        del _BUILT[key]
    key = (session, repr(schema), needs.given)
    if key not in _BUILT:
        given = F.col("_in")
        _BUILT[key] = F.inline(F.array(extraction(
            given["raw"], {c: text.norm_text(given[c]) for c in SOURCE_FIELDS}, schema,
            given["error"], given["label"], needs)))
    return _BUILT[key]


def normalize(df: DataFrame, schema: ExtractionSchema = DEFAULT_SCHEMA, *, raw: str = "raw",
              error: str | None = None, error_label: str = "primary_failed",
              fields: Collection[str] | None = None) -> DataFrame:
    """Add ``doc`` and ``issues`` to rows that hold source columns and a VARIANT ``raw``.

    Source columns ``pmid, title, journal, pub_date, country`` are used where present.
    Rows where the ``error`` column is set get the empty template with the error as note.
    ``fields`` names the paths of the document that are wanted (``article_level.title``,
    ``model_level`` for all of a level, ``issues``); ``doc`` then has these alone, with the same
    values, and ``issues`` is there only if named.
    """
    nothing = F.lit(None).cast("string")
    keep = [c for c in df.columns if c not in ("doc", "issues")]
    given = F.struct(
        F.col(raw).alias("raw"), (F.col(error) if error else nothing).alias("error"),
        F.lit(error_label).alias("label"),
        *[(F.col(c) if c in keep else nothing).alias(c) for c in SOURCE_FIELDS])
    # a one-row inline keeps filters on the document above its computation
    return (df.select(*keep, given.alias("_in")).select(*keep, _built(df, schema, needs_of(fields, schema))))


def needs_review(doc: Column | str = "doc", threshold: int = REVIEW_THRESHOLD,
                 schema: ExtractionSchema = DEFAULT_SCHEMA) -> Column:
    """True when a normalised document should be looked at by a person or a second pass."""
    d = text.col(doc)
    models = d[schema.entity_key]
    flagged = F.lit(False)
    for c in schema.flags:
        flagged = flagged | F.coalesce(d["quality_flags"][c], F.lit(False))
    low = F.coalesce(d["normalization"][schema.overall_confidence], F.lit(0)) < threshold
    unscored = F.forall(models, lambda m: m[schema.entity_score][TOTAL_KEY].isNull())
    return flagged | low | F.coalesce(F.size(models) == 0, F.lit(True)) | unscored


def add_error_note(doc: Column, message: Column, schema: ExtractionSchema = DEFAULT_SCHEMA) -> Column:
    """Document with the message in its notes, the review flag on and confidence capped."""
    short = F.substring(text.norm_text(message), 1, NOTE_CHARS)
    old = doc[schema.article_key][schema.article_notes]
    notes = F.when(text.has_text(old),
                   F.btrim(F.concat(old, F.lit("; "), short), F.lit("; "))).otherwise(short)
    capped = F.least(doc["normalization"][schema.overall_confidence],
                     F.lit(ERROR_CONFIDENCE_CAP))
    return (doc.withField(f"{schema.article_key}.{schema.article_notes}", notes)
            .withField(f"normalization.{schema.overall_confidence}", capped)
            .withField(f"quality_flags.{schema.review_flag}", F.lit(True)))
