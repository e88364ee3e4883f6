"""What reads as a person, a title or a department on a staff page, as column functions; and digits split over text nodes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from townlens.functions.text import WHITE, c, has_any, let

# Words and phrases that decide what a line of a staff page is.
TITLE_HINTS = ("director", "manager", "administrator", "clerk", "collector", "assessor", "chief", "officer", "coordinator", "superintendent", "mayor", "selectman", "assistant", "treasurer", "accounting", "enforcement officer")
DEPARTMENT_HINTS = ("administration", "finance", "police", "fire", "public works", "town clerk", "city clerk", "assessor", "tax collector", "zoning", "planning", "human resources", "department", "office", "division", "town hall", "city hall")
GENERIC_HEADINGS = ("administration", "finance", "police", "fire", "public works", "departments", "government", "town hall", "city hall")
ACTION_TEXTS = ("email", "phone", "contact", "read more", "staff directory", "contact info", "office phone", "location", "learn more", "details", "view", "click here")
ACTION_PARTS = ("email", "contact", "read more", "click", "view")
NAME_LITERALS = ("email", "phone", "contact", "staff directory", "contact info", "services", "links", "request", "information")
NAME_PHRASES = ("quick links", "online services", "ada services", "absentee ballots", "if you require", "to request", "contact us", "town hall", "municipal center", "main street", "community development", "groton long point", "main level", "level ridgefield")
NAME_TOKENS = ("level", "floor", "elementary", "office", "services", "payments", "phone", "fax", "hours", "staff", "links", "resource")
NAME_FRAGMENTS = ("contact", "services", "links", "request", "information")
PLACE_TOKENS = ("street", "avenue", "road", "drive", "lane", "boulevard", "highway", "main st", "town hall", "city hall", "municipal center", "point", "ridgefield", "elementary", "school", "community", "town of", "city of")
STREET_ENDS = ("st", "street", "rd", "road", "ave", "avenue", "ln", "lane", "dr", "drive", "blvd", "boulevard", "ct", "court", "way")
VACANT = ("vacant", "vacancy", "position vacant")
DEPARTMENT_LITERALS = ("education", "contact us", "office hours", "resources", "related links", "bids and rfp's", "bids and rfps", "quick links", "online services", "community development")
STRUCTURAL_TEXTS = ("office hours", "resources", "related links")
PERSON = r"^[A-Z][a-zA-Z'`-]+(?:\s+(?:[A-Z]\.|[A-Z][a-zA-Z'`-]+|de|del|la|van|von|da|di)){1,4}(?:\s+(?:Jr\.?|Sr\.?|II|III|IV))?$"
NAME_IN_TEXT = r"\b([A-Z][a-zA-Z'`-]+(?:\s+(?:[A-Z]\.|[A-Z][a-zA-Z'`-]+)){1,4}(?:,?\s*(?:Jr\.?|Sr\.?|II|III|IV))?)\b"
#: What is joined of digits that text nodes split, in this order, and with what.
SPLIT_DIGITS = (
    (r"(?i)\b([0-9]{2})\s+([0-9][\s.\-]?[0-9]{3}[\s.\-]?[0-9]{4}(?:\s*(?:x|ext\.?|extension)\s*[0-9]{1,6})?)\b", "$1$2"),
    (r"(?i)(?<=[0-9])\s+(?=(?:x|ext\.?|extension)\s*[0-9]{1,6}\b)", ""),
    (r"\b([0-9]{3})\s+([0-9]{3})\s+([0-9]{4})(\b|$)", "$1-$2-$3"),
    (r"\b([0-9]{3}[-.\s]?[0-9]{3}[-.\s]?[0-9]{4})(?:\s+\1\b)++", "$1"),
)


def clean(x: Column | str) -> Column:
    """One space between words, none outside; null as empty. nullif() would write its argument twice, at each of many levels."""
    return F.coalesce(F.trim(F.regexp_replace(c(x), WHITE, " ")), F.lit(""))


def joined_digits(x: Column | str) -> Column:
    """Text with its split digits joined."""
    out = clean(x)
    for pattern, by in SPLIT_DIGITS:
        out = clean(F.regexp_replace(out, pattern, by))
    return out


def joins_of(x: Column | str) -> Column:
    """How many places joined_digits() joins: each rule counts on what the one before it left."""
    out, n = clean(x), F.lit(0)
    for pattern, by in SPLIT_DIGITS:
        n = n + F.regexp_count(out, F.lit(pattern))
        out = clean(F.regexp_replace(out, pattern, by))
    return n


def is_title(x: Column | str) -> Column:
    return has_any(F.lower(clean(x)), *TITLE_HINTS)


def is_department(x: Column | str) -> Column:
    return has_any(F.lower(clean(x)), *DEPARTMENT_HINTS)


def is_vacancy(x: Column | str) -> Column:
    return has_any(F.lower(clean(x)), *VACANT)


def is_place(x: Column | str) -> Column:
    """Holds a house number, a state, or a word of addresses."""
    return _place(F.lower(clean(x)))


def _place(low: Column) -> Column:
    return low.rlike(r"\b[0-9]{1,5}\b|\bct\b|\bconnecticut\b|\b[0-9]{5}(?:-[0-9]{4})?\b") | has_any(low, *PLACE_TOKENS)


def is_person(x: Column | str) -> Column:
    """Reads as a person's name; x has its split digits joined."""

    def judged(both: Column) -> Column:
        text, low = both["text"], both["low"]
        last = F.regexp_replace(F.regexp_extract(low, r"(\S+)$", 1), r"^\.+|\.+$", "")
        words = F.split(F.regexp_replace(low, r"[^a-z\s]", ""), r"\s+")
        suffix_apart = clean(F.regexp_replace(text, r"(?i),\s*(Jr\.?|Sr\.?|II|III|IV)$", " $1"))
        never = low.isin(*NAME_LITERALS, *ACTION_TEXTS, *GENERIC_HEADINGS) | has_any(low, *VACANT, *NAME_PHRASES, *NAME_FRAGMENTS, *ACTION_PARTS, *DEPARTMENT_HINTS, *TITLE_HINTS) | _place(low)
        never = never | (F.upper(text) == text) | low.rlike("[0-9]") | F.arrays_overlap(words, F.array(*map(F.lit, NAME_TOKENS))) | last.isin(*STREET_ENDS)
        return suffix_apart.rlike(PERSON) & ~never & ~low.rlike(r"\b(building|annex|municipal|academy|school)\b")

    return let(let(clean(x), lambda t: F.struct(t.alias("text"), F.lower(t).alias("low"))), judged)


def person_in(text: Column | str) -> Column:
    """The first name of a person in text with its split digits joined."""
    found = F.regexp_extract_all(c(text), F.lit(NAME_IN_TEXT), F.lit(1))
    return F.get(F.filter(F.transform(found, clean), is_person), F.lit(0))


def accepts_name(name: Column, title: Column) -> Column:
    """Two words with letters, or one and a title."""
    words = F.size(F.filter(F.split(clean(name), r"\s+"), lambda w: w.rlike("[A-Za-z]")))
    return (words >= 2) | ((clean(name) != "") & (clean(title) != ""))


def department_label(x: Column | str) -> Column:
    """A heading, crumb or path segment as the name of a department, or null."""
    low = F.lower(clean(x))
    for town in ("town", "city"):
        low = F.regexp_replace(F.regexp_replace(low, rf"^{town} of\s+[^|:\-]+[|:\-]\s*", ""), r"^[ \-|]+|[ \-|]+$", "")
    low = clean(F.regexp_replace(low, "[_-]", " "))
    for word in (r"\bdepartment(s)?\b", r"\boffice\b", r"\bcontact info\b", r"\bbreadcrumbs?\b"):
        low = F.trim(F.regexp_replace(low, word, ""))

    def shown(low: Column) -> Column:
        never = low.isin("", *GENERIC_HEADINGS, "government", "departments", "home", "staff", "directory", *DEPARTMENT_LITERALS) | has_any(low, "bids", "rfp", "request for proposal", "main street", ", ct", " connecticut", " jewett city", "town hall")
        words = F.transform(F.split(low, " "), lambda w: F.concat(F.upper(F.substr(w, F.lit(1), F.lit(1))), F.substr(w, F.lit(2))))
        return F.when(~never, F.array_join(words, " "))

    return F.when(~is_place(x), let(clean(low), shown))
