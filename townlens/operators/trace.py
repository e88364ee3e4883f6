"""Where rows are lost between stages, and alarms on pages that lose most of theirs.

A row is followed by a fingerprint of its words, since ids are given late and change. All stages are one tagged union and one
exchange by fingerprint; the first stage that a row does not reach is where it was lost, and the stage before says why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from townlens.functions.text import c, chain, flag, normalize_whitespace

FIELDS = ("name", "title", "department", "email", "phone", "source_url")
#: A page that keeps less than this share of the rows read from it is alarming; a town, from so many rows on.
KEPT, TOWN_ROWS = 0.25, 8


def fingerprint(town: Column | str = "municipality_id") -> Column:
    """Town and words of a row as an id: white space, case and outer spaces do not count, null is empty."""
    words = [F.lower(F.trim(F.coalesce(normalize_whitespace(f), F.lit("")))) for f in FIELDS]
    joined = F.concat_ws("||", F.lower(F.trim(F.coalesce(c(town), F.lit("")))), *words)
    return F.concat(F.lit("rtrace_"), F.substring(F.sha2(joined, 256), 1, 18))


def row_trace(stages: dict[str, DataFrame], reasons: dict[str, Column]) -> DataFrame:
    """Every fingerprint of the first stage and those that only later ones have: municipality_id, fingerprint, name, title,
    department, source_url, rows (of it, at each stage, as a map), stages (those reached, in order), drop_stage (the first one
    not reached, null where all were) and drop_reason, by the rule of the stage before it, over that stage's columns; rows that
    begin later have `not_loaded`. Rows of one fingerprint are one: a stage is reached if any is there, a reason is the least
    of theirs."""
    names = list(stages)
    tagged = None
    for name, df in stages.items():
        why = reasons.get(name, F.lit("unknown_pipeline_drop"))
        part = df.select("municipality_id", *FIELDS, F.lit(name).alias("stage"), why.cast("string").alias("reason"))
        tagged = part if tagged is None else tagged.unionByName(part)
    at = lambda n: F.count_if(c("stage") == n)
    shown = [F.min(normalize_whitespace(f)).alias(f) for f in ("name", "title", "department", "source_url")]
    whys = F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*[F.min(F.when(c("stage") == n, c("reason"))) for n in names]))
    rows = F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*[at(n) for n in names]))
    out = tagged.withColumn("fingerprint", fingerprint()).groupBy("municipality_id", "fingerprint").agg(*shown, rows.alias("rows"), whys.alias("why"))
    listed = F.array(*map(F.lit, names))
    reached = F.filter(listed, lambda n: F.element_at(c("rows"), n) > 0)
    lost = F.get(F.filter(listed, lambda n: F.element_at(c("rows"), n) == 0), F.lit(0))
    out = out.withColumns({"stages": reached, "drop_stage": lost})
    before = F.get(listed, (F.array_position(listed, c("drop_stage")) - 2).cast("int"))
    reason = F.when(c("drop_stage") == names[0], "not_loaded").when(c("drop_stage").isNotNull(), F.coalesce(F.element_at("why", before), F.lit("unknown_pipeline_drop")))
    return out.withColumn("drop_reason", reason).drop("why")


def trace_losses(trace: DataFrame) -> DataFrame:
    """(municipality_id, drop_stage, drop_reason, rows): lost rows of a trace, counted in the stage before each was lost."""
    names = F.map_keys("rows")
    before = F.get(names, (F.array_position(names, c("drop_stage")) - 2).cast("int"))
    lost = trace.filter(c("drop_stage").isNotNull() & (c("drop_reason") != "not_loaded"))
    return lost.groupBy("municipality_id", "drop_stage", "drop_reason").agg(F.sum(F.element_at("rows", before)).alias("rows"))


def contact_trace(enriched: DataFrame, clean: DataFrame, candidates: DataFrame, winners: DataFrame) -> DataFrame:
    """The trace of contacts from loading over the clean view and the role candidates to the winners."""
    loaded = chain((F.col("record_rank") > 1, "duplicate_rank"), (F.col("is_likely_noise") == 1, "likely_noise"), default="other")
    cleaned = F.lit("failed_role_mapping")
    scored = F.coalesce(F.nullif(F.trim("winner_disqualifier_reason"), F.lit("")), F.lit("failed_role_mapping_or_scoring"))
    return row_trace({"loaded": enriched, "clean": clean, "candidates": candidates, "winners": winners}, {"loaded": loaded, "clean": cleaned, "candidates": scored})


# ---- shares of rows that are kept


def kept_ratios(rows: DataFrame, by: list[str], kept: Column | str = "kept", least: float = KEPT, fewest: int = 1) -> DataFrame:
    """by, seen, kept, ratio and alarm: groups of `fewest` rows or more that keep less than `least` of them. A null `kept` is
    false."""
    n, k = F.count("*"), F.sum(flag(F.coalesce(c(kept), F.lit(False)))).cast("long")
    out = rows.groupBy(*by).agg(n.alias("seen"), k.alias("kept"))
    return out.withColumn("ratio", c("kept") / c("seen")).withColumn("alarm", (c("seen") >= fewest) & (c("ratio") < least))


def observed(rows: DataFrame, name: str, kept: Column | str = "kept") -> tuple[DataFrame, Observation]:
    """rows, and the counters of whatever action reads them (seen and kept): they come with
    that action and cost no pass of their own. observation.get holds them once it has run."""
    seen = Observation(name)
    k = F.coalesce(c(kept), F.lit(False))
    return rows.observe(seen, F.count(F.lit(1)).alias("seen"), F.count_if(k).alias("kept")), seen
