"""Column functions on text: blank handling, token tests, keys, phones. Null, empty and all-space text are the same."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(value: Column, body) -> Column:
    """body(value) with value computed once, however often body names it: long rules else repeat what they build on."""
    return F.element_at(F.transform(F.array(value), body), 1)


def blank_to_null(x: Column | str) -> Column:
    return F.nullif(F.trim(c(x)), F.lit(""))


def filled(x: Column | str) -> Column:
    """Whether the text holds anything but spaces."""
    return F.coalesce(F.trim(c(x)) != "", F.lit(False))


def low(x: Column | str) -> Column:
    """Lower case; null as empty."""
    return F.lower(F.coalesce(c(x), F.lit("")))


def norm(x: Column | str) -> Column:
    """Lower case without outer spaces; null as empty."""
    return F.lower(F.trim(F.coalesce(c(x), F.lit(""))))


def flag(test: Column) -> Column:
    return F.coalesce(test, F.lit(False)).cast("int")


def has_any(x: Column, *tokens: str) -> Column:
    """Whether lower-case text holds one of the tokens: a single pass by one alternation."""
    if len(tokens) == 1:
        return x.contains(tokens[0])
    return x.rlike("|".join(re.escape(t).replace("\\ ", " ") for t in tokens))


def one_of(x: Column, *values: str) -> Column:
    return x.isin(*values)


def chain(*rules: tuple[Column, object], default: object = None) -> Column:
    """The outcome of the first rule whose test holds."""
    out = None
    for test, outcome in rules:
        value = outcome if isinstance(outcome, Column) else F.lit(outcome)
        out = F.when(test, value) if out is None else out.when(test, value)
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def points(*terms: tuple[Column, float]) -> Column:
    """Sum of the weights whose tests hold, added in the order given."""
    out = None
    for test, weight in terms:
        term = F.when(test, F.lit(weight)).otherwise(F.lit(type(weight)(0)))
        out = term if out is None else out + term
    return out


def clamp(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def word_count(x: Column | str) -> Column:
    """Spaces and one, on trimmed text."""
    t = F.trim(F.coalesce(c(x), F.lit("")))
    return F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit(""))) + 1


WHITE = r"[\s\x0B\x{1C}-\x{1F}\x{85}\p{Z}]+"


def normalize_whitespace(x: Column | str) -> Column:
    return F.nullif(F.trim(F.regexp_replace(c(x), WHITE, " ")), F.lit(""))


def keyword_blob(x: Column | str) -> Column:
    """Letters and digits with single spaces between, padded: a keyword is looked up between two spaces."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(low(x), "[^a-z0-9]+", " ")), F.lit(" "))


def keyword_in(blob: Column, keyword: str) -> Column:
    """A phrase counts wherever it stands, a single word only as a whole word."""
    plain = " ".join(re.sub("[^a-z0-9]+", " ", keyword.lower()).split())
    return blob.contains(plain if " " in plain else f" {plain} ")


def any_keyword(blob: Column, keywords: tuple[str, ...]) -> Column:
    plain = [" ".join(re.sub("[^a-z0-9]+", " ", k.lower()).split()) for k in keywords]
    return blob.rlike("|".join(p if " " in p else f" {p} " for p in plain))


def make_id(prefix: str, *parts: Column | str) -> Column:
    """prefix and the first 20 hex digits of the SHA-256 of the normalised parts; a null part is empty."""
    joined = F.concat_ws("||", *[norm(p) for p in parts])
    return F.concat(F.lit(f"{prefix}_"), F.substring(F.sha2(joined, 256), 1, 20))


def safe_phone(x: Column | str) -> Column:
    """A phone as text: words for nothing are empty, numbers in scientific or .0 notation become plain digits."""
    t = F.trim(F.coalesce(c(x), F.lit("")))
    number = F.format_string("%.10f", t.try_cast("double"))
    exact = t.try_cast("decimal(38,10)").cast("string")
    plain = F.regexp_replace(F.regexp_replace(F.coalesce(exact, number), r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
    return F.when(F.lower(t).isin("nan", "none", "null", "inf", "+inf", "-inf"), "").when(t.rlike(r"^[+-]?[0-9]+(\.[0-9]+)?[eE][+-]?[0-9]+$") | t.rlike(r"^[+-]?[0-9]+\.0+$"), plain).otherwise(t)


def display_name(x: Column | str, prefix: str = "ct_") -> Column:
    """A key as a title: prefix and underscores go, words are capitalised."""
    return F.initcap(F.replace(F.regexp_replace(c(x), f"^{prefix}", ""), F.lit("_"), F.lit(" ")))
