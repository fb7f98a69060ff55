"""Parameters of the engine: vocabularies, screening rules and the extraction schema.

Nothing here touches Spark.  Every operator takes these objects as arguments, so a
different study type is a different parameter value, not different code.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

# --- fixed values: controlled vocabularies -------------------------------------------

SUBSPECIALTIES = (
    "cardiology", "oncology", "neurology", "respiratory_medicine", "gastroenterology",
    "hepatology", "nephrology", "endocrinology", "hematology", "rheumatology",
    "infectious_disease", "critical_care", "emergency_medicine", "surgery",
    "anesthesiology_perioperative", "obstetrics_gynecology", "pediatrics", "psychiatry",
    "radiology", "rehabilitation", "public_health", "general_medicine", "other",
)
OUTCOME_GROUPS = (
    "mortality", "survival", "recurrence", "complication", "treatment_response",
    "functional_outcome", "diagnosis", "event_risk", "hospitalization_utilization", "other",
)
METHOD_GROUPS = (
    "logistic_regression", "cox_regression", "lasso_cox", "lasso_logistic",
    "linear_regression", "tree_based_ml", "svm", "neural_network", "deep_learning",
    "nomogram", "risk_score", "ensemble_model", "signature_model",
    "statistical_model_other", "unclear",
)
VALIDATION_TYPES = (
    "none_reported", "internal_split", "cross_validation", "bootstrap",
    "temporal_validation", "external_validation", "independent_validation_cohort", "unclear",
)
TRIAL_INTERVENTIONS = (
    "pharmacological", "surgical", "behavioral", "device", "diagnostic_strategy",
    "screening_program", "rehabilitation", "lifestyle", "dietary", "combination", "other",
)
EXTERNAL_VALIDATION = ("external_validation", "independent_validation_cohort")
INTERNAL_VALIDATION = (
    "internal_split", "cross_validation", "bootstrap", "temporal_validation",
)
SCORE_KEYS = (
    "sample_size_score", "validation_rigor_score", "method_score", "performance_score",
    "clinical_applicability_score",
)
TOTAL_KEY = "total_score"
SUB_MAX, TOTAL_MAX = 20, 100

# --- fixed values: screening rule lists ----------------------------------------------

EXCLUDED_TYPES = (
    "review", "meta-analysis", "systematic review", "case report", "editorial", "letter",
    "comment", "news", "guideline", "protocol", "retracted publication",
    "published erratum", "interview", "congresses", "lecture", "video-audio media",
    "patient education handout", "biography", "historical article", "newspaper article",
    "autobiography", "bibliography", "directory", "festschrift", "legal case",
    "legislation", "portrait", "consensus development conference",
    "consensus development conference, nih", "practice guideline", "clinical conference",
    "scientific integrity review", "twin study", "technical report",
    "interactive tutorial", "dataset",
)
TITLE_PATTERNS = (
    (r"\b(review|meta.analysis|systematic review)\b", "review"),
    (r"\b(case report|case study)\b", "case report"),
    (r"\b(protocol|guideline|consensus)\b", "protocol/guideline"),
    (r"\b(genome.wide|transcriptom|proteom|metabolom)\b", "omics-focused"),
)
SHORT_EXCLUDED_TYPES = EXCLUDED_TYPES[:17]
SHORT_TITLE_PATTERNS = TITLE_PATTERNS[:3] + (
    (r"\b(bioinformatics|genomic|transcriptomic|proteomic)\b", "omics-focused"),
)
MODEL_TERMS = (
    "prediction model", "risk model", "nomogram", "risk score", "machine learning",
    "deep learning", "classifier", "model", "score",
)
CONTEXT_TERMS = (
    "patient", "clinical", "hospital", "cohort", "disease", "diagnosis", "prognosis",
)
VALIDATION_ONLY_TERMS = ("validation", "comparison", "benchmark")
BUILDING_TERMS = (
    "develop", "derive", "build", "construct", "train", "establish", "create", "update",
)
CORPUS_GROUPS = (
    ("clinical prediction model*", "prediction model*", "predictive model*", "risk model*",
     "risk prediction", "prognostic model*", "diagnostic model*", "nomogram*",
     "risk score*"),
    ("clinic*", "patient*", "disease*", "hospital*", "medical"),
)
CORPUS_YEARS = (2010, 2026)
CORPUS_EXCLUDED_TYPES = ("review", "meta-analysis", "systematic")

# --- fixed values: limits --------------------------------------------------------------

MIN_ABSTRACT_CHARS = 50
PROMPT_ABSTRACT_CHARS = 3000
NOTE_CHARS = 300
SHARD_ROWS = 5000
CHUNK_ROWS = 9800
PAGE_ROWS = 10000
REVIEW_THRESHOLD = 60
ERROR_CONFIDENCE_CAP = 20
RETRIED_STATUS = (429, 500, 502, 503, 504)
# tokens per call (in, out) used by the workload estimate
CALL_TOKENS = {"prescreen": (500, 100), "extract": (2000, 1000), "arbitrate": (2000, 1000)}


@dataclass(frozen=True)
class PrefilterRules:
    """Rule lists of the local prefilter, tried in this order; the first hit gives the reason."""

    excluded_types: tuple[str, ...] = EXCLUDED_TYPES
    title_patterns: tuple[tuple[str, str], ...] = TITLE_PATTERNS
    min_abstract_chars: int = MIN_ABSTRACT_CHARS


SHORT_RULES = PrefilterRules(SHORT_EXCLUDED_TYPES, SHORT_TITLE_PATTERNS)


@dataclass(frozen=True)
class Field:
    """One output field of the extraction document.

    ``kind`` is ``text`` (never null, falls back to ``source`` then ``default``),
    ``maybe`` (null when empty), ``enum``, ``int``, ``float``, ``bool``, ``list``,
    ``score`` (block of sub-scores) or ``group`` (nested struct of ``fields``).
    """

    name: str
    kind: str = "text"
    default: str = ""
    source: str | None = None
    vocabulary: str | None = None
    issue: str | None = None
    fields: tuple["Field", ...] = ()


def _texts(*names: str, default: str = "unclear") -> tuple[Field, ...]:
    return tuple(Field(n, default=default) for n in names)


ARTICLE_FIELDS = (
    Field("pmid", source="pmid"),
    Field("title", source="title"),
    Field("journal", source="journal"),
    Field("pub_date", source="pub_date"),
    *_texts("prediction_type", "article_model_type", "clinical_use_case",
            "target_population_summary", "study_design", "data_source_type"),
    Field("country_or_region", default="unclear", source="country"),
    Field("primary_disease_raw", "maybe"),
    *_texts("primary_disease_standard"),
    Field("primary_subspecialty", "enum", default="other", vocabulary="subspecialty",
          issue="primary_subspecialty_out_of_set"),
    Field("article_has_external_validation", "bool"),
    Field("article_has_internal_validation", "bool"),
    Field("is_multimodel_article", "bool"),
    Field("number_of_models_described", "int"),
    Field("study_quality_score", "score"),
    Field("overall_notes"),
)

METRIC_FIELDS = (
    *(Field(n, "float") for n in ("auc", "c_index", "sensitivity", "specificity", "ppv", "npv")),
    *(Field(n, "bool") for n in ("calibration_reported", "dca_reported", "nri_reported")),
)

ENTITY_FIELDS = (
    Field("model_name", "maybe"),
    Field("model_stage", "maybe"),
    *_texts("prediction_type"),
    Field("target_disease_raw", "maybe"),
    *_texts("target_disease_standard"),
    Field("disease_subspecialty", "enum", default="other", vocabulary="subspecialty",
          issue="disease_subspecialty_out_of_set"),
    Field("outcome_raw", "maybe"),
    *_texts("outcome_standard"),
    Field("outcome_group", "enum", default="other", vocabulary="outcome",
          issue="outcome_group_out_of_set"),
    Field("time_horizon", "maybe"),
    Field("sample_size", "int"),
    Field("events", "int"),
    Field("predictors_raw", "list"),
    Field("predictor_domains", "list"),
    Field("model_method_raw", "maybe"),
    Field("model_method_group", "enum", default="unclear", vocabulary="method",
          issue="method_group_out_of_set"),
    Field("validation_type", "enum", default="unclear", vocabulary="validation",
          issue="validation_type_out_of_set"),
    Field("has_external_validation", "bool"),
    Field("has_internal_validation", "bool"),
    Field("performance_metrics", "group", fields=METRIC_FIELDS),
    Field("model_quality_score", "score"),
    Field("comparator", "maybe"),
    Field("notes"),
)


@dataclass(frozen=True)
class ExtractionSchema:
    """Shape of the extraction document and the fields that carry a special rule."""

    article_key: str = "article_level"
    entity_key: str = "model_level"
    entity_id: str = "model_id_within_article"
    entity_prefix: str = "model"
    article_fields: tuple[Field, ...] = ARTICLE_FIELDS
    entity_fields: tuple[Field, ...] = ENTITY_FIELDS
    vocabularies: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "subspecialty": SUBSPECIALTIES, "outcome": OUTCOME_GROUPS,
        "method": METHOD_GROUPS, "validation": VALIDATION_TYPES,
    })
    confidences: tuple[str, ...] = (
        "disease_standardization_confidence", "subspecialty_classification_confidence",
        "overall_extraction_confidence",
    )
    ambiguity_flags: tuple[str, ...] = (
        "disease_ambiguous", "outcome_ambiguous", "method_ambiguous",
    )
    review_flag: str = "requires_human_review"
    overall_confidence: str = "overall_extraction_confidence"
    article_external: str = "article_has_external_validation"
    article_internal: str = "article_has_internal_validation"
    article_multi: str = "is_multimodel_article"
    article_count: str = "number_of_models_described"
    article_score: str = "study_quality_score"
    article_notes: str = "overall_notes"
    article_group: str = "primary_subspecialty"
    entity_validation: str = "validation_type"
    entity_external: str = "has_external_validation"
    entity_internal: str = "has_internal_validation"
    entity_score: str = "model_quality_score"
    entity_group: str = "disease_subspecialty"
    entity_method: str = "model_method_group"
    entity_outcome: str = "outcome_group"
    external_values: tuple[str, ...] = EXTERNAL_VALIDATION
    internal_values: tuple[str, ...] = INTERNAL_VALIDATION
    strict_default: bool = True

    # -- Spark types, as DDL -----------------------------------------------------------

    def raw_type(self, article: Sequence[Field] | None = None, entity: Sequence[Field] | None = None,
                 confidences: Sequence[str] | None = None, flags: Sequence[str] | None = None) -> str:
        """Type the parsed answer is cast to: text as string, everything else as VARIANT.

        Of each level all fields, or those given.
        """
        def variants(names: Sequence[str]) -> str:
            return f"struct<{','.join(f'{c} variant' for c in names or ('_any',))}>"
        return (f"struct<{self.article_key} {_raw_struct(self.article_fields if article is None else article)},"
                f"{self.entity_key} {self.raw_entities_type(entity)},"
                f"normalization {variants(self.confidences if confidences is None else confidences)},"
                f"quality_flags {variants(self.flags if flags is None else flags)}>")

    def raw_entities_type(self, entity: Sequence[Field] | None = None) -> str:
        return f"array<{_raw_struct(self.entity_fields if entity is None else entity)}>"

    def level_types(self) -> dict[str, str]:
        """Types of the parts of the normalised document."""
        return {self.article_key: _doc_struct(self.article_fields),
                self.entity_key: f"array<{self.entity_type()}>",
                "normalization": f"struct<{','.join(f'{c} int' for c in self.confidences)}>",
                "quality_flags": f"struct<{','.join(f'{c} boolean' for c in self.flags)}>"}

    def doc_type(self) -> str:
        """Type of the normalised document."""
        return f"struct<{','.join(f'{name} {kind}' for name, kind in self.level_types().items())}>"

    def judged_type(self) -> str:
        """Type of what the review rules look at in a normalised document."""
        kinds = self.level_types()
        return (f"struct<{self.entity_key} array<struct<{self.entity_score} struct<{TOTAL_KEY} int>>>,"
                f"normalization {kinds['normalization']},quality_flags {kinds['quality_flags']}>")

    def entity_type(self) -> str:
        return f"struct<{self.entity_id} int,{_doc_struct(self.entity_fields)[7:-1]}>"

    @property
    def flags(self) -> tuple[str, ...]:
        return (*self.ambiguity_flags, self.review_flag)

    def adapted(self, renames: dict[str, str] | None = None, added: tuple[Field, ...] = (),
                vocabularies: dict[str, tuple[str, ...]] | None = None) -> "ExtractionSchema":
        """Schema for another study type: entity fields renamed, new ones appended."""
        renames = renames or {}
        special = {a: renames[v] for a, v in vars(self).items()
                   if a.startswith("entity_") and isinstance(v, str) and v in renames}
        return replace(
            self,
            entity_fields=tuple(replace(f, name=renames.get(f.name, f.name))
                                for f in self.entity_fields) + added,
            vocabularies={**self.vocabularies, **(vocabularies or {})}, **special)


def _raw_struct(fields: Sequence[Field]) -> str:
    if not fields:  # only whether it is an object
        return "struct<_any variant>"

    def one(f: Field) -> str:
        if f.kind in ("text", "maybe", "enum"):
            return f"{f.name} string"
        if f.kind == "score":
            return f"{f.name} struct<{','.join(f'{k} variant' for k in (*SCORE_KEYS, TOTAL_KEY))}>"
        if f.kind == "group":
            return f"{f.name} {_raw_struct(f.fields)}"
        return f"{f.name} variant"
    return f"struct<{','.join(one(f) for f in fields)}>"


_DOC_TYPES = {"text": "string", "maybe": "string", "enum": "string", "int": "bigint",
              "float": "double", "bool": "boolean", "list": "array<string>"}


def _doc_struct(fields: tuple[Field, ...]) -> str:
    def one(f: Field) -> str:
        if f.kind == "score":
            return f"{f.name} struct<{','.join(f'{k} int' for k in (*SCORE_KEYS, TOTAL_KEY))}>"
        if f.kind == "group":
            return f"{f.name} {_doc_struct(f.fields)}"
        return f"{f.name} {_DOC_TYPES[f.kind]}"
    return f"struct<{','.join(one(f) for f in fields)}>"


DEFAULT_SCHEMA = ExtractionSchema()

# entity renames of the guide for two other study types
DIAGNOSTIC_RENAMES = {
    "model_id_within_article": "test_id", "model_name": "index_test_name",
    "predictors_raw": "index_test_description", "model_method_group": "test_modality",
}
TRIAL_RENAMES = {
    "model_id_within_article": "arm_id", "model_name": "intervention_name",
    "model_method_group": "intervention_type", "predictors_raw": "inclusion_criteria",
}
DIAGNOSTIC_ADDED = (Field("reference_standard", "maybe"),)
TRIAL_ADDED = (Field("primary_endpoint", "maybe"), Field("allocation", "maybe"))

ARTICLE_TYPE = (
    "pmid string,title string,abstract string,journal string,pub_date string,"
    "publication_types array<string>,keywords array<string>,mesh_terms array<string>,"
    "authors array<string>,doi string"
)
