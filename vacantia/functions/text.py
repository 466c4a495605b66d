"""String, array and hash expressions shared by all stages."""

from __future__ import annotations

import json
from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(c: Column) -> Column:
    """Without outer Unicode white space; null stays null."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def normalize_whitespace(c: Column) -> Column:
    """Runs of white space become one blank, the ends are cut; null becomes empty."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))


def normalized_key(c: Column) -> Column:
    """Lower case with runs outside a-z 0-9 + # . as one blank; null becomes empty."""
    return F.trim(F.regexp_replace(F.lower(normalize_whitespace(c)), r"[^a-z0-9+#.]+", " "))


def clean(c: Column) -> Column:
    """Stripped text; null becomes empty."""
    return F.coalesce(strip(c.cast("string")), F.lit(""))


def blank_to_null(c: Column) -> Column:
    return F.nullif(clean(c), F.lit(""))


def label(c: Column, fallback: str = "unspecified") -> Column:
    """Stripped text, or the fallback where nothing is left."""
    return F.coalesce(blank_to_null(c), F.lit(fallback))


def unique_ci(values: Column) -> Column:
    """The first of values that are equal but for case, in order; null array becomes empty."""
    own = F.coalesce(values, F.array().cast("array<string>"))
    folded = F.transform(own, F.lower)
    return F.filter(own, lambda x, i: F.array_position(folded, F.lower(x)) == i + 1)


def strings(values: Column) -> Column:
    """Stripped, non-blank values, unique but for case, sorted by lower case (ties: by the text itself)."""
    kept = F.filter(F.transform(F.coalesce(values, F.array().cast("array<string>")), clean), lambda x: x != "")
    pairs = F.transform(unique_ci(kept), lambda x: F.struct(F.lower(x).alias("k"), x.alias("v")))
    return F.transform(F.array_sort(pairs), lambda p: p["v"])


def job_text_sha256(title: Column, description: Column) -> Column:
    """Digest of title and description, by which later stages see that a posting's text has changed."""
    text = F.concat(F.coalesce(title, F.lit("")), F.lit("\n"), F.coalesce(description, F.lit("")))
    return F.sha2(strip(text), 256)


def stable_key(provider: Column, token: Column, source_id: Column, url: Column, name: Column, title: Column, location: Column, description: Column) -> Column:
    """provider:token:identity, where identity is the source's id, else a digest of the address, else of the content."""
    content = F.concat_ws("|", F.coalesce(name, F.lit("")), normalized_key(title), normalized_key(location), F.substring(F.coalesce(description, F.lit("")), 1, 500))
    short = lambda c: F.substring(F.sha2(c, 256), 1, 24)
    identity = F.coalesce(blank_to_null(source_id), F.concat(F.lit("url-"), short(blank_to_null(url))), F.concat(F.lit("content-"), short(content)))
    return F.concat_ws(":", provider, F.coalesce(token, F.lit("")), identity)


def normalize_url(c: Column) -> Column:
    """Without query and fragment."""
    return F.regexp_replace(c, r"[?#].*$", "")


def strip_html_tags(c: Column) -> Column:
    """Text of markup without a parser: scripts and styles dropped, tags and the common entities replaced."""
    out = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?is)<(script|style)\b[^>]*>.*?</(script|style)>", " ")
    out = F.regexp_replace(out, r"(?s)<[^>]+>", " ")
    for entity, char in ENTITIES.items():
        out = F.replace(out, F.lit(entity), F.lit(char))
    return normalize_whitespace(out)


# Entities that strip_html_tags decodes, &amp; last.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&amp;": "&"}


def matching_links(html: Column, pattern: str) -> Column:
    """Distinct href values that match a pattern."""
    links = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"(?i)href\s*=\s*[\"']([^\"']+)[\"']"), F.lit(1))
    return F.array_distinct(F.filter(links, lambda x: x.rlike(pattern)))


def iso_instant(c: Column) -> Column:
    """Timestamp of an ISO-8601 text with optional zone (UTC if none); null for other shapes and impossible dates."""
    text = normalize_whitespace(c)
    shaped = text.rlike(r"(?i)^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.,]\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?)?$")
    return F.when(shaped, F.upper(F.replace(text, F.lit(","), F.lit("."))).try_cast("timestamp"))


def source_date(c: Column) -> Column:
    """Day, month name and year, else an ISO instant."""
    text = normalize_whitespace(c)
    named = [F.when(text.rlike(rf"^\d{{1,2}} [A-Za-z]{{{n}}} \d{{4}}$"), F.try_to_timestamp(text, F.lit(f))) for f, n in (("d MMM yyyy", "3"), ("d MMMM yyyy", "4,9"))]
    return F.coalesce(*named, iso_instant(c))


def canonical_json(value: object) -> bytes:
    """JSON whose bytes depend on the value alone: keys in order, no blanks, UTF-8, one line end."""
    return (json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False) + "\n").encode()


def file_stamp(at: datetime) -> str:
    """A time as part of a file name, in UTC to the microsecond; times without a zone are UTC."""
    return (at if at.tzinfo else at.replace(tzinfo=UTC)).astimezone(UTC).strftime("%Y%m%dT%H%M%S%fZ")


def iso_text(c: Column) -> Column:
    """A timestamp as ISO-8601 text in UTC."""
    return F.date_format(F.to_utc_timestamp(c, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def sql_strip(expr: str) -> str:
    return rf"regexp_replace({expr}, '^\s+|\s+$', '', 'g')"


def sql_normalize_whitespace(expr: str) -> str:
    return rf"trim(regexp_replace(coalesce({expr}, ''), '[\s\x{{00a0}}\x{{2000}}-\x{{200a}}\x{{202f}}\x{{205f}}\x{{3000}}\x0b\x{{85}}\x{{1680}}\x{{2028}}\x{{2029}}]+', ' ', 'g'))"


def sql_normalized_key(expr: str) -> str:
    return f"trim(regexp_replace(lower({sql_normalize_whitespace(expr)}), '[^a-z0-9+#.]+', ' ', 'g'))"


def sql_clean(expr: str) -> str:
    return rf"coalesce(regexp_replace({expr}, '^[\s\x{{00a0}}]+|[\s\x{{00a0}}]+$', '', 'g'), '')"


def sql_label(expr: str, fallback: str = "unspecified") -> str:
    return f"coalesce(nullif({sql_clean(expr)}, ''), '{fallback}')"
