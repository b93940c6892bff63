"""Tagged documents to (title, body, topics) rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def inner_text(document: Column, tag: str) -> Column:
    return F.regexp_extract(document, rf"(?s)<{tag}[^>]*>(.*?)</{tag}>", 1)


def document_title(document: Column) -> Column:
    return inner_text(document, "title")


def document_body(document: Column, tag: str = "body") -> Column:
    """Everything from the opening tag on, without tags and comments, white space collapsed."""
    rest = F.regexp_extract(document, rf"(?s)<{tag}[^>]*>(.*)", 1)
    plain = F.regexp_replace(rest, r"(?s)<!--.*?-->|<[^>]*>", " ")
    return F.trim(F.regexp_replace(plain, r"\s+", " "))


def document_topics(document: Column) -> Column:
    """Texts of all links, in document order."""
    return F.regexp_extract_all(document, F.lit(r"<a [^>]*>([^<]*)</a>"), F.lit(1))
