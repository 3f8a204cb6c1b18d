"""Canonical values: one writing for identifiers, dates and types that people write in many ways.

Every function takes and returns a Column and never raises under ANSI mode; null and blank text give null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Writings that stand for "nothing".
FILLERS = ("", "-", "--", "n/a", "na", "none", "null", "nil", "unknown", "not stated", "not known", "not available", "tba", "tbc", "tbd", "?", ".")

_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
_SPACE = r"[\s   -​    　﻿]+"
_APOSTROPHES = r"['’‘ʼ′`´＇]"


def squeeze(c: Column) -> Column:
    """White space of any kind to one space, trimmed."""
    return F.trim(F.regexp_replace(c, _SPACE, " "))


def present(c: Column) -> Column:
    """Squeezed text, or null for blanks and fillers."""
    text = squeeze(c)
    return F.when(~F.lower(text).isin(*FILLERS), text)


def digits(c: Column) -> Column:
    """Only the ASCII digits; null where there are none."""
    return F.nullif(F.regexp_replace(c, "[^0-9]", ""), F.lit(""))


def acn_canon(c: Column) -> Column:
    """Nine digits, zero-padded; longer runs stay as they are; null where no digit is given."""
    d = digits(c)
    return F.when(F.length(d) <= 9, F.lpad(d, 9, "0")).otherwise(d)


def date_canon(c: Column) -> Column:
    """A date from ISO text (with or without a time), day-first numbers, or day, month name and year; else null."""
    s = squeeze(c)
    iso = r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})(?!\d)"
    dmy = r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})(?!\d)"
    named = r"^(\d{1,2})[ -]?([A-Za-z]{3})[A-Za-z]*\.?,?[ -]?(\d{4})(?!\d)"
    at = F.position(F.lower(F.regexp_extract(s, named, 2)), F.lit(_MONTHS))
    text = (
        F.when(s.rlike(iso), F.concat_ws("-", *[F.regexp_extract(s, iso, i) for i in (1, 2, 3)]))
        .when(s.rlike(dmy), F.concat_ws("-", *[F.regexp_extract(s, dmy, i) for i in (3, 2, 1)]))
        .when(s.rlike(named) & (at % 3 == 1), F.concat_ws("-", F.regexp_extract(s, named, 3), ((at + 2) / 3).cast("int").cast("string"), F.regexp_extract(s, named, 1)))
    )
    return text.try_cast("date")


def date_or_text(c: Column) -> Column:
    """The ISO date, or the folded text where it is no date, so that two unreadable values can still differ."""
    return F.coalesce(date_canon(c).cast("string"), F.nullif(F.lower(squeeze(c)), F.lit("")))


def type_canon(c: Column) -> Column:
    """Lower case without white space and apostrophes; null for blanks."""
    return F.nullif(F.regexp_replace(F.lower(c), f"{_SPACE}|{_APOSTROPHES}", ""), F.lit(""))
