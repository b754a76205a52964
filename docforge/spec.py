"""Declarative dataset and analyzer specifications.

A ``DatasetSpec`` is everything the pipeline needs to turn a source table
into a document table: where rows come from, which fields to project, how to
derive the id, the declared mapping, the analyzer and the facet/search/sort
intents used by the audit. It is a frozen value, resolved at plan time.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Union

from pyspark.sql import DataFrame, SparkSession

# Mapping type names understood by the pipeline.
MAPPING_TYPES = ("text", "keyword", "long", "integer", "float", "double", "boolean", "date", "object")

# Languages the stemmer filter is implemented for. Any other
# configured language raises instead of silently skipping the stemming step.
STEMMER_LANGUAGES = ("english", "french", "german", "hungarian", "spanish")

Provider = Union[DataFrame, Callable[[SparkSession], DataFrame], None]


@dataclass(frozen=True)
class AnalyzerSpec:
    """Analysis chain of one dataset: tokenise, lowercase, fold, stem.

    ``language`` null or empty means no analysis is configured: the default
    analyzer only (tokenise + lowercase), even when folding is enabled.
    """

    language: str | None = None
    ascii_folding: bool = True

    def __post_init__(self):
        if self.language == "":
            object.__setattr__(self, "language", None)

    @property
    def configured(self) -> bool:
        return self.language is not None

    def filters(self) -> list[str]:
        if not self.configured:
            return []
        chain = ["lowercase"]
        if self.ascii_folding:
            chain.append("asciifolding")
        chain.append("stemmer")
        return chain


@dataclass(frozen=True)
class FieldSpec:
    """One declared mapping entry. ``type`` None = object/nested (no type)."""

    type: str | None
    has_keyword: bool = False

    def __post_init__(self):
        if self.type is not None and self.type not in MAPPING_TYPES:
            raise ValueError(f"unknown mapping type {self.type!r}")


@dataclass(frozen=True)
class FieldIntentSpec:
    """What the entity asked for one property (facet/filter/search/sort)."""

    name: str
    facet: bool = False
    filterable: bool = False
    searchable: bool = False
    sortable: bool = False


@dataclass(frozen=True)
class DatasetSpec:
    code: str
    entity: str | None = None
    table: str | None = None
    provider: Provider = None
    id_field: str = "id"
    source_fields: tuple[str, ...] = ()
    search_fields: tuple[str, ...] = ()
    mapper: Callable[[DataFrame], DataFrame] | None = None
    facet_fields: Mapping[str, str | None] = field(default_factory=dict)
    sort_fields: tuple[str, ...] = ()
    mappings: Mapping[str, FieldSpec] = field(default_factory=dict)
    analyzer: AnalyzerSpec = AnalyzerSpec()
    strict: bool = True
    intents: tuple[FieldIntentSpec, ...] = ()

    @property
    def alias(self) -> str:
        return self.code

    def projected_fields(self) -> tuple[str, ...]:
        """PRJ-1: ``source_fields``, or ``search_fields`` when that is empty."""
        return tuple(self.source_fields) if self.source_fields else tuple(self.search_fields)

    def document_source_kind(self) -> str:
        """SCL-10: 'provider' if one is configured, 'table' if a table is known, else 'none'.

        The provider is never invoked to answer this.
        """
        if self.provider is not None:
            return "provider"
        return "none" if self.table is None else "table"
