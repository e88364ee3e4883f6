"""Native spans: where a pattern matches in a text, in code points, from built-in functions alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<s:int,e:int,v:string>>"
#: Numbers summed by one fold: a fold copies its list for each number, so long lists are summed in pieces of this size.
PIECE = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def matches(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches; put this into a column of its own before spans()."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _fold(numbers: Column) -> Column:
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        at = acc["at"] + x
        return F.struct(at.alias("at"), F.concat(acc["out"], F.array(at)).alias("out"))

    return F.aggregate(numbers, start, step, lambda acc: acc["out"])


def running(numbers: Column, piece: int = PIECE) -> Column:
    """Running sums of an array of int, in time that grows with its length."""

    def pieces(x: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(x) - 1) / piece).cast("int"))
        return F.transform(starts, lambda k: _fold(F.slice(x, k * piece + 1, F.lit(piece))))

    def joined(parts: Column) -> Column:
        totals = _fold(F.transform(parts, lambda p: F.element_at(p, -1)))
        moved = lambda p, t: F.transform(p, lambda v: v + t - F.element_at(p, -1))
        return F.flatten(F.zip_with(parts, totals, moved))

    return F.when(F.size(numbers) <= piece, _fold(numbers)).otherwise(let(pieces(numbers), joined))


def spans(text: Column, pattern: str, found: Column) -> Column:
    """The matches with their places: what lies between them comes from split() by the same pattern."""
    none = F.array().cast(SPAN)
    between = F.split(text, pattern, -1)
    lengths = F.zip_with(found, F.slice(between, F.lit(1), F.size(found)), lambda v, b: F.length(v) + F.length(b))
    placed = F.zip_with(found, let(lengths, lambda x: running(x)), lambda v, e: F.struct((e - F.length(v)).alias("s"), e.alias("e"), v.alias("v")))
    return F.when(F.size(found) == 0, none).otherwise(placed)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    back = F.reverse(number)

    def part(i: Column) -> Column:
        d = F.substr(back, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(number)), part), F.lit(0), lambda a, b: a + b) % 10 == 0


def tagged(kind: str, found: Column) -> Column:
    """kind:start:end of each span."""
    return F.transform(found, lambda x: F.concat_ws(":", F.lit(kind), x["s"].cast("string"), x["e"].cast("string")))
