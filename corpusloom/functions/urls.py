"""URL parts and the URL filter. Regexes, since java.net.URI rejects many live URLs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.config import Collection

SCHEME = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?"


def netloc(url: Column) -> Column:
    """Host with port and user part, '' when the URL has none."""
    return F.regexp_extract(url, SCHEME + r"//([^/?#]*)", 1)


def url_path(url: Column) -> Column:
    whole = F.regexp_extract(url, SCHEME + r"(?://[^/?#]*)?([^?#]*)", 1)
    return F.regexp_replace(whole, ";[^/]*$", "")


def is_web(path: Column) -> Column:
    return F.startswith(path, F.lit("http://")) | F.startswith(path, F.lit("https://"))


def url_allowed(url: Column, rules: Collection = Collection()) -> Column:
    """Blocked and allowed names are substrings of the lower-cased host."""
    host, path = F.lower(netloc(url)), F.lower(url_path(url))

    def any_of(tests: list[Column]) -> Column:
        return reduce(lambda a, b: a | b, tests, F.lit(False))

    blocked = any_of([host.contains(name) for name in rules.blocked_domains])
    suffix = any_of([path.endswith(ext) for ext in rules.blocked_extensions])
    allowed = any_of([host.contains(name) for name in rules.allowed_domains])
    if not rules.allowed_domains:
        allowed = F.lit(True)
    return ~blocked & allowed & ~suffix


def reader_for(path: Column) -> Column:
    """Which reader takes an input: by scheme first, then by file suffix."""
    name = F.regexp_extract(F.lower(path), r"([^/]*)$", 1)
    suffix = F.regexp_extract(name, r"^.+(\.[^.]+)$", 1)
    return (
        F.when(is_web(path), "web")
        .when(suffix == ".pdf", "pdf")
        .when(suffix == ".docx", "docx")
        .when(suffix.isin(".txt", ".md", ".markdown"), "text")
        .when(suffix == ".html", "html")
        .when(suffix == ".csv", "csv")
        .when(suffix == ".json", "json")
        .otherwise("unsupported")
    )
