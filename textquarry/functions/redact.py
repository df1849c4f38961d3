"""Masking of personal data by ordered pattern rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Rule, pattern, mask, in the order in which they apply. Fixed values. Years and parts of card numbers fall to the phone rule first.
RULES = (
    # Only from where a run of its characters begins, or the last match ended: nowhere else can one match.
    ("email", r"(?:(?<![a-zA-Z0-9_.+-])|\G)[a-zA-Z0-9_.+-]++@[a-zA-Z0-9-]++\.[a-zA-Z0-9-.]++", "[EMAIL REDACTED]"),
    ("long_number", r"\b\d{10,}\b", "[PHONE NUMBER REDACTED]"),
    ("phone", r"\+?\d{1,3}[-.\s]?\(?\d{1,4}\)?[-.\s]?\d{1,4}[-.\s]?\d{1,9}", "[PHONE NUMBER REDACTED]"),
    ("card", r"\b\d{4}[-\s]?\d{4}[-\s]?\d{4}[-\s]?\d{4}\b", "[CREDIT CARD REDACTED]"),
    ("date_dmy", r"\b\d{1,2}[-/]\d{1,2}[-/]\d{2,4}\b", "[DATE REDACTED]"),
    ("date_ymd", r"\b\d{4}[-/]\d{2}[-/]\d{2}\b", "[DATE REDACTED]"),
    # Possessive, each word with its own border: the engine would recurse for each word of a long list of names.
    ("name", r"\b[A-Z][a-z]++\b(?:\s[A-Z][a-z]++\b)*+", "[NAME REDACTED]"),
)


def redact(text: Column, *names: str) -> Column:
    """All rules, or those named, in order. (?U): digits, blanks and word borders are Unicode's."""
    for name, pattern, mask in RULES:
        if not names or name in names:
            text = F.regexp_replace(text, f"(?U){pattern}", mask)
    return text
