"""Street addresses and opening hours as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from townlens.functions.text import c, normalize_whitespace

#: Short street suffixes and what they are written out as; a state's name and its letters.
SUFFIXES = {"ave": "Avenue", "st": "Street", "rd": "Road", "dr": "Drive", "ln": "Lane", "blvd": "Boulevard"}
STATE, LETTERS = "connecticut", "CT"


def _tidy(x: Column | str) -> Column:
    """White space as single spaces, en dashes as hyphens."""
    return F.replace(normalize_whitespace(c(x)), F.lit("\u2013"), F.lit("-"))


def _trimmed(x: Column) -> Column:
    return F.nullif(F.btrim(x, F.lit(" ,;")), F.lit(""))


def _spaced(x: Column, sign: str, written: str) -> Column:
    return F.regexp_replace(x, rf"\s*{sign}\s*", written)


def normal_address(x: Column | str) -> Column:
    """Commas followed by one space, suffixes written out, no points at the ends of words, the state by its letters."""
    t = _spaced(_tidy(x), ",", ", ")
    for short, full in SUFFIXES.items():
        t = F.regexp_replace(t, rf"(?i)\b{short}\b", full)
    t = F.regexp_replace(t, r"\.(?=\s|,|$)", "")
    return _trimmed(F.regexp_replace(t, rf"(?i)\b{STATE}\b", LETTERS))


def normal_hours(x: Column | str) -> Column:
    """Hyphens between spaces, commas and semicolons before one; a leading "and" and trailing ampersands go."""
    t = F.regexp_replace(_tidy(x), r"(?i)^and\s+", "")
    for sign, written in (("-", " - "), (",", ", "), (";", "; ")):
        t = _spaced(t, sign, written)
    return _trimmed(F.regexp_replace(t, "&+$", ""))
