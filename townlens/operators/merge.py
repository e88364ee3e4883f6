"""Ordered merges: what a sequence of conflicting upserts leaves, as one aggregation by key.

Rows of a key are folded in the order of an explicit sequence column. Groups are the repeated sightings of one record,
so an ordered list of a group is small; rows are narrowed to the merged fields before they are gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townlens.functions.text import filled

CONTACT_FIELDS = ("name", "title", "department", "email_type", "phone", "phone_ext", "address", "hours", "source_context", "source_url")
RICHNESS = {"name": 4, "title": 4, "department": 2, "email": 5, "phone": 3, "phone_ext": 1, "address": 1, "hours": 1}


def larger(a: Column, b: Column) -> Column:
    """Null where either is null, as a two-argument maximum has it."""
    return F.when(a.isNull() | b.isNull(), None).otherwise(F.greatest(a, b))


def _gathered(df: DataFrame, key: str, fields: tuple[str, ...], seq: str) -> DataFrame:
    return df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(seq).alias("_seq"), *fields))).alias("rows"))


def fold(df: DataFrame, key: str, fields: tuple[str, ...], step, seq: str = "seq") -> DataFrame:
    """Fold the rows of each key in order; step(old, new, field) gives a field's value after the new row."""
    rows = _gathered(df, key, fields, seq)

    def merge(old: Column, new: Column) -> Column:
        return F.struct(new["_seq"].alias("_seq"), *[step(old, new, f).alias(f) for f in fields])

    first = F.element_at("rows", 1)
    out = F.aggregate(F.slice("rows", F.lit(2), F.size("rows")), first, merge)
    return rows.select(key, out.alias("r")).select(key, *[f"r.{f}" for f in fields])


def _contact_step(old: Column, new: Column, field: str) -> Column:
    if field == "confidence":
        return larger(old[field], new[field])
    if field in ("municipality_id", "email"):
        return old[field]
    open_ = old[field].isNull()
    if field == "email_type":
        open_ = open_ | old[field].isin("", "unknown")
    wins = F.coalesce(open_, F.lit(False)) | F.coalesce(new["confidence"] >= old["confidence"], F.lit(False))
    return F.when(wins, F.coalesce(new[field], old[field])).otherwise(old[field])


def upsert_contacts(df: DataFrame, seq: str = "seq") -> DataFrame:
    """A field follows the more confident row, blanks are filled, the email of the first row stays."""
    return fold(df, "contact_id", ("municipality_id", "email", *CONTACT_FIELDS, "confidence"), _contact_step, seq)


def _signal_step(old: Column, new: Column, field: str) -> Column:
    if field == "value":
        return new[field]
    if field == "confidence":
        return larger(old[field], new[field])
    if field == "source_url":
        wins = F.coalesce(new["confidence"] >= old["confidence"], F.lit(False)) & new[field].isNotNull()
        return F.when(wins, new[field]).otherwise(old[field])
    return old[field]


def upsert_signals(df: DataFrame, seq: str = "seq") -> DataFrame:
    return fold(df, "signal_id", ("municipality_id", "signal_type", "value", "confidence", "source_url"), _signal_step, seq)


def _newest(df: DataFrame, key: str, frozen: tuple[str, ...], filled_in: tuple[str, ...], overwritten: tuple[str, ...], most: tuple[str, ...], seq: str) -> DataFrame:
    """Merges without order-dependent guards need no list: each column is an aggregate of its own."""
    s = F.col(seq)
    out = [F.min_by(f, s).alias(f) for f in frozen]
    out += [F.max_by(f, F.when(F.col(f).isNotNull(), s)).alias(f) for f in filled_in]
    out += [F.max_by(f, s).alias(f) for f in overwritten]
    out += [F.when(F.count(f) == F.count("*"), F.max(f)).alias(f) for f in most]
    return df.groupBy(key).agg(*out)


def upsert_municipalities(df: DataFrame, seq: str = "seq") -> DataFrame:
    rest = tuple(c for c in df.columns if c not in ("municipality_id", seq))
    return _newest(df, "municipality_id", (), (), rest, (), seq)


def upsert_pages(df: DataFrame, seq: str = "seq") -> DataFrame:
    return _newest(df, "page_id", ("municipality_id", "url"), ("title", "discovered_from"), ("page_type",), (), seq)


def upsert_service_links(df: DataFrame, seq: str = "seq") -> DataFrame:
    return _newest(df, "service_id", ("municipality_id", "category", "url", "domain"), ("label", "vendor", "service_page_type", "source_url"), (), ("confidence",), seq)


def upsert_locations(df: DataFrame, seq: str = "seq") -> DataFrame:
    return _newest(df, "location_id", ("municipality_id", "source_url"), ("address", "hours"), (), (), seq)


def richness() -> Column:
    out = F.lit(0)
    for field, weight in RICHNESS.items():
        out = out + F.when(filled(field), weight).otherwise(0)
    return out


def merge_sightings(df: DataFrame, key: list[str], fields: tuple[str, ...], seq: str = "seq") -> DataFrame:
    """Left-biased merge: for each field the first filled value in order, and the highest confidence."""
    first = [F.min_by(f, F.when(filled(f), F.col(seq))).alias(f) for f in fields]
    return df.groupBy(*key).agg(*first, F.max("confidence").alias("confidence"), F.count("*").alias("sightings"))


def first_by(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key."""
    from pyspark.sql import Window

    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter("_rn = 1").drop("_rn")
