"""Bibliographic records and model-written answers to an analysis-ready dataset, on Spark."""

from .schema import DEFAULT_SCHEMA, ExtractionSchema, Field, PrefilterRules

__all__ = ["DEFAULT_SCHEMA", "ExtractionSchema", "Field", "PrefilterRules"]
