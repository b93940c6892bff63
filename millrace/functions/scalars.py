"""Column functions for times, flags, JSON, text and lookups. Everything stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: words that end an administrative part of an address
ADDRESS_MARKERS = ["街道", "镇", "乡"]

# fixed value: lines that quote or announce somebody else's message
QUOTED_LINE = r"(writes in|writes:|wrote:|says:|said:|^In article|^Quoted from|^\||^>)"


def local_time(epoch_s: Column, hours: int = 8) -> Column:
    """Epoch seconds as a zone-less timestamp shifted by whole hours."""
    return (F.timestamp_seconds(epoch_s) + F.expr(f"interval {int(hours)} hours")).cast("timestamp_ntz")


def weekday_number(epoch_s: Column) -> Column:
    """Monday = 1 .. Sunday = 7; NULL stays NULL."""
    return F.weekday(F.timestamp_seconds(epoch_s)) + 1


def hour_of_day(epoch_s: Column) -> Column:
    return F.hour(F.timestamp_seconds(epoch_s))


def dispatch_type(flag: Column) -> Column:
    """Bit 2 set, or flag unknown: manual."""
    return F.when(flag.bitwiseAND(2) == 0, "system").otherwise("manual")


def auto_dispatch(flag: Column) -> Column:
    bit = F.lit(1 << 35)
    return F.when(flag.bitwiseAND(bit) == bit, 1).otherwise(0)


def price_from_json(prices: Column, key: Column) -> Column:
    """Whole-number price stored under a numeric key of a JSON map; 0 if there is none."""
    parsed = F.from_json(prices, "map<string,double>")
    found = F.try_element_at(parsed, key.cast("string"))
    return F.coalesce(found.try_cast("int"), F.lit(0))


def json_field(document: Column, path: str, dtype: str) -> Column:
    return F.get_json_object(document, path).try_cast(dtype)


def positive_or(newer: Column, older: Column) -> Column:
    """The newer value only where it is above zero; NULL keeps the older one."""
    return F.when(newer > 0, newer).otherwise(older)


def event_time(text: Column) -> Column:
    """`yyyy-MM-dd_HH:mm:ss` to a zone-less timestamp; unreadable text gives NULL."""
    return F.try_to_timestamp(F.translate(text, "_", " "), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")


def map_values(value: Column, mapping: dict) -> Column:
    """Dictionary replacement; values without an entry pass through."""
    pairs = [F.lit(x) for entry in mapping.items() for x in entry]
    to_text = all(isinstance(v, str) for v in mapping.values())
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value), value.cast("string") if to_text else value)


def mask_quoted_spaces(message: Column) -> Column:
    """Spaces inside `:"several words"` become underscores."""
    quoted = F.regexp_extract_all(message, F.lit(r':"(?:[\w\\()-]+\s)+[\w\\()-]+"'), F.lit(0))
    return F.aggregate(quoted, message, lambda text, q: F.replace(text, q, F.translate(q, " ", "_")))


def log_tokens(message: Column) -> Column:
    return F.split(F.trim(mask_quoted_spaces(message)), " +")


def header_part(message: Column) -> Column:
    return F.substring_index(message, "\n\n", 1)


def body_part(message: Column) -> Column:
    """Text after the first blank line, without quoted lines and signature."""
    at = F.instr(message, "\n\n")
    body = F.when(at > 0, F.substring(message, at + 2, F.length(message))).otherwise("")
    kept = F.array_join(F.filter(F.split(body, "\n"), lambda line: ~line.rlike(QUOTED_LINE)), "\n")
    signature = r"(?s)^(.*)\n[ \t\r]*-*[ \t\r]*(?:\n.*)?$"
    trimmed = F.regexp_replace(kept, r"^\s+|\s+$", "")
    cut_at_signature = F.regexp_extract(trimmed, signature, 1)
    return F.when(trimmed.rlike(signature), cut_at_signature).otherwise(kept)


def subject_line(message: Column) -> Column:
    return F.regexp_extract(header_part(message), r"(?m)^Subject:(.*)$", 1)


def remove_once(text: Column, part: Column) -> Column:
    """Drop the first occurrence of `part`; a missing part changes nothing."""
    literal = F.replace(F.coalesce(part, F.lit("")), F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
    return F.regexp_replace(text, F.concat(F.lit("(?s)^(.*?)\\Q"), literal, F.lit("\\E")), F.lit("$1"))


def short_address(name: Column, parts: list[Column]) -> Column:
    """Remove the given address parts once each; without any, cut behind a marker word."""
    by_parts = name
    for part in parts:
        by_parts = remove_once(by_parts, part)
    by_marker = name
    for marker in reversed(ADDRESS_MARKERS):
        by_marker = F.when(F.instr(name, marker) > 1, F.split_part(name, F.lit(marker), F.lit(2))).otherwise(by_marker)
    has_parts = F.coalesce(*parts).isNotNull()
    return F.when(has_parts, by_parts).otherwise(by_marker)


def number_tokens(text: Column) -> Column:
    """Words of two or more characters; those starting with a digit or underscore become #NUMBER."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0))
    return F.transform(words, lambda w: F.when(w.rlike(r"^[0-9_]"), "#NUMBER").otherwise(w))


def rounded(value: Column, digits: int) -> Column:
    """Round and drop the sign of zero."""
    return F.round(value, digits) + F.lit(0.0)
