"""Text, date, hash and key normalisation as plain Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marks of a CAPTCHA page, looked for in the first 5,000 characters.
# "captcha" also covers "recaptcha" and "hcaptcha".
CAPTCHA_MARKS = ("captcha", "challenge-form", "cf-turnstile")
CAPTCHA_WINDOW = 5000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(text: Column | str) -> Column:
    return F.regexp_replace(_col(text), r"(?U)^\s+|\s+$", "")


def non_empty(text: Column | str) -> Column:
    """Null instead of the empty string: an empty value counts as absent."""
    return F.nullif(_col(text), F.lit(""))


def non_empty_array(values: Column | str) -> Column:
    values = _col(values)
    return F.when(F.size(values) > 0, values)


def first_non_empty(*values: Column | str) -> Column:
    return F.coalesce(*[non_empty(v) for v in values])


def _named_month(text: Column) -> Column:
    day = F.try_to_date(text, "MMMM d, yyyy")
    return F.coalesce(day, F.try_to_date(text, "MMM d, yyyy"))


def normalize_date(text: Column | str) -> Column:
    """``YYYY-MM-DD`` or null.

    Tried in order: ISO date with optional time and offset, English month names,
    month/day/year, day/month/year, then any text that starts like an ISO date
    (taken unchecked). The local date is kept, offsets never shift it.
    """
    raw = F.regexp_replace(strip(text), r"\s+", " ")
    iso = r"^(\d{4}-\d{1,2}-\d{1,2})(?:T(?:2[0-3]|[01]?\d):[0-5]?\d:(?:6[01]|[0-5]?\d)(?:Z|[+-]\d{2}:?[0-5]\d(?::?[0-5]\d(?:\.\d{1,6})?)?)?)?$"
    day = F.coalesce(
        F.when(raw.rlike(iso), F.try_to_date(F.regexp_extract(raw, iso, 1), "yyyy-M-d")),
        F.when(raw.rlike(r"^[A-Za-z]+ \d{1,2}, \d{4}$"), _named_month(raw)),
        F.when(
            raw.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"),
            F.coalesce(F.try_to_date(raw, "M/d/yyyy"), F.try_to_date(raw, "d/M/yyyy")),
        ),
    )
    prefix = non_empty(F.regexp_extract(raw, r"^(\d{4}-\d{2}-\d{2})", 1))
    return F.coalesce(F.date_format(day, "yyyy-MM-dd"), prefix)


def publish_date(date_published: Column | str) -> Column:
    """The normalised text as a date; null when it is no calendar day."""
    return F.try_to_date(_col(date_published), "yyyy-MM-dd")


def content_hash(text: Column | str) -> Column:
    return F.sha2(_col(text), 256)


def item_hash(body: Column | str) -> Column:
    """Hash of the item body; items without one share the empty hash."""
    body = _col(body)
    return F.when(F.coalesce(body, F.lit("")) == "", F.lit("")).otherwise(content_hash(body))


def item_key(source_url: Column | str, canonical_url: Column | str) -> Column:
    return F.coalesce(non_empty(source_url), _col(canonical_url), F.lit(""))


def is_captcha(html: Column | str) -> Column:
    head = F.lower(F.substring(F.coalesce(_col(html), F.lit("")), 1, CAPTCHA_WINDOW))
    hit = F.lit(False)
    for mark in CAPTCHA_MARKS:
        hit = hit | F.contains(head, F.lit(mark))
    return hit
