"""Readers for values printed by hand: dates and case numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def printed_date(c: Column) -> Column:
    """A DATE from its printed forms (ISO, compact, month-first slashes, "Month d, yyyy"); null if none fits.

    Each format is tried only where its shape matches, so ANSI mode and the parser's legacy checks never raise.
    """
    t = F.trim(c)

    def tried(shape: str, text: Column, fmt: str) -> Column:
        return F.when(t.rlike(shape), F.try_to_date(text, fmt))

    return F.coalesce(
        tried(r"^\d{4}-\d{2}-\d{2}", F.substring(t, 1, 10), "yyyy-MM-dd"),
        tried(r"^\d{8}$", t, "yyyyMMdd"),
        tried(r"^\d{1,2}/\d{1,2}/\d{4}$", t, "M/d/yyyy"),
        tried(
            r"(?i)^(january|february|march|april|may|june|july|august|september|october|november|december) \d{1,2}, \d{4}$",
            F.initcap(t),
            "MMMM d, yyyy",
        ),
        tried(r"(?i)^(jan|feb|mar|apr|jun|jul|aug|sep|oct|nov|dec)\.? \d{1,2}, \d{4}$", F.initcap(F.replace(t, F.lit("."), F.lit(""))), "MMM d, yyyy"),
    )


def epoch_day(c: Column) -> Column:
    """Days since 1970-01-01 of a printed date."""
    return F.datediff(printed_date(c), F.lit("1970-01-01").cast("date"))


def case_number(c: Column) -> Column:
    """Case number without prefix, type suffix and blanks; two-digit years are 19xx; null if there is none."""
    pattern = r"(?<!\d)(\d{4}|\d{2})([.\-])\s*(\d+)"
    year = F.regexp_extract(c, pattern, 1)
    return F.when(
        year != "",
        F.concat(
            F.when(F.length(year) == 2, F.concat(F.lit("19"), year)).otherwise(year),
            F.regexp_extract(c, pattern, 2),
            F.regexp_extract(c, pattern, 3),
        ),
    )
