"""The title nearest to a name and its anchor: distance to the name counts tenfold, distance to the anchor once.

In one document the cost of a place p is 10 |p - name| + |p - anchor|. It falls up to the name and rises behind it, whatever
the anchor, so only the last title at or before the name and the first one at or behind it can be nearest: two window lookups,
no pairs. `nearest_in` says the same of the lines of one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from townlens.functions.text import c

#: Fixed value: how often a step away from the name counts against one away from the anchor.
NAME_WEIGHT = 10


def cost(place: Column, name: Column, anchor: Column) -> Column:
    return NAME_WEIGHT * F.abs(place - name) + F.abs(place - anchor)


def nearest_titles(lines: DataFrame, anchors: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Each row of anchors (doc, anchor, name: places; a null name stands where its anchor does) with title_at and title, its
    nearest row of lines (doc, place, title) in the document; the earlier of two that are as near, null where there is none.
    Places of lines are distinct within a document."""
    name = F.coalesce("name", "anchor")
    both = anchors.select(doc, name.alias("place"), F.lit(True).alias("asks"), "anchor", F.col("name").alias("name"), F.lit(None).cast("struct<place:bigint,title:string>").alias("line"))
    said = F.struct(F.col("place").cast("long").alias("place"), F.col("title").alias("title"))
    both = both.unionByName(lines.filter(F.col("title").isNotNull()).select(doc, "place", F.lit(False).alias("asks"), F.lit(None).cast("long").alias("anchor"), F.lit(None).cast("long").alias("name"), said.alias("line")))
    run = Window.partitionBy(doc).orderBy("place")  # equal places see one another
    before = F.last("line", ignorenulls=True).over(run.rangeBetween(Window.unboundedPreceding, 0))
    behind = F.first("line", ignorenulls=True).over(run.rangeBetween(0, Window.unboundedFollowing))
    both = both.withColumns({"before": before, "behind": behind}).filter("asks")
    far = lambda x: cost(F.col(f"{x}.place"), F.col("place"), F.col("anchor"))
    best = F.when(F.col("before").isNull() | (far("behind") < far("before")), F.coalesce("behind", "before")).otherwise(F.col("before"))
    return both.select(doc, "anchor", "name", best["place"].alias("title_at"), best["title"].alias("title"))


def nearest_in(lines: Column | str, name: Column | str, anchor: Column | str, is_title) -> Column:
    """Of an array of lines, the one that is_title() and lies nearest to the first line equal to name (else to the anchor) and
    the first equal to anchor (else the first line); the name itself is none."""
    lines, name = c(lines), c(name)
    at = lambda x: F.nullif(F.coalesce(F.array_position(lines, x), F.lit(0)), F.lit(0)) - 1
    anchor_at = F.coalesce(at(c(anchor)), F.lit(0))
    name_at = F.coalesce(at(name), anchor_at)
    placed = F.transform(lines, lambda x, i: F.struct(x.alias("line"), i.alias("i")))
    found = F.filter(placed, lambda x: (x["line"] != "") & ~x["line"].eqNullSafe(name) & is_title(x["line"]))
    return F.array_min(F.transform(found, lambda x: F.struct(cost(x["i"], name_at, anchor_at).alias("cost"), x["i"].alias("i"), x["line"].alias("line"))))["line"]
