"""Defaults of every stage, as plain dataclasses."""

from __future__ import annotations

from dataclasses import dataclass, field


# The defaults the stages are specified with.
@dataclass(frozen=True)
class Collection:
    max_pages_per_source: int = 100
    links_per_page: int = 5
    min_content_length: int = 100
    max_content_length: int = 1_000_000
    min_alphabetic_words: int = 10
    allowed_domains: tuple[str, ...] = ()
    blocked_domains: tuple[str, ...] = ()
    blocked_extensions: tuple[str, ...] = (".jpg", ".png", ".gif", ".mp4", ".avi")


@dataclass(frozen=True)
class Cleaning:
    min_text_length: int = 50
    remove_html_tags: bool = True
    normalize_whitespace: bool = True
    language: str | None = None


@dataclass(frozen=True)
class Deduplication:
    method: str = "fuzzy"
    bar: float = 0.7
    shingle_words: int = 3


@dataclass(frozen=True)
class Quality:
    min_score: float = 0.7
    filters: tuple[str, ...] = ("language_detection", "content_relevance", "readability")


@dataclass(frozen=True)
class Chunking:
    max_size: int = 2048
    overlap: int = 64
    min_text_length: int = 100


@dataclass(frozen=True)
class CorpusConfig:
    cleaning: Cleaning = field(default_factory=Cleaning)
    deduplication: Deduplication = field(default_factory=Deduplication)
    quality: Quality = field(default_factory=Quality)
    chunking: Chunking = field(default_factory=Chunking)
    source_types: tuple[str, ...] | None = None


@dataclass(frozen=True)
class Curation:
    threshold: float = 0.7
    max_examples: int = 1000
    min_answer: int = 20
    max_answer: int = 200
    question_types: tuple[str, ...] = ("factual", "analytical", "explanatory")
