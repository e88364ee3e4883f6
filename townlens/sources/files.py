"""CSV and JSON sources and sinks with checked headers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from townlens.functions.text import norm, safe_phone

MANIFEST = ("municipality_id", "town_name", "county", "batch_id", "priority", "status", "notes")
QA_FILES = ("qa_role_winners", "qa_role_candidates_for_review", "qa_unresolved_roles", "qa_suspicious_winners", "qa_missing_key_roles", "qa_manual_review_towns", "qa_blocked_towns", "qa_crawl_diagnostics", "qa_blocked_recovery_status", "qa_coverage_summary", "qa_batch_summary")


def read_csv(spark: SparkSession, path: str, missing_ok: str | None = None) -> DataFrame:
    """All columns as trimmed text; a byte-order mark before the header goes. missing_ok: schema where no file is."""
    try:
        df = spark.read.csv(path, header=True, multiLine=True, escape='"', inferSchema=False)
    except AnalysisException:
        if missing_ok is None:
            raise
        return spark.createDataFrame([], missing_ok)
    return df.select(*[F.trim(F.coalesce(F.col(f"`{c}`"), F.lit(""))).alias(c.lstrip("﻿").strip()) for c in df.columns])


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest; its header must be exact, rows without an id go."""
    df = read_csv(spark, path)
    if tuple(df.columns) != MANIFEST:
        raise ValueError(f"manifest columns are {df.columns}, expected {list(MANIFEST)}")
    return df.filter("municipality_id != ''")


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """Seed towns with an id and a name; the domain in lower case."""
    df = read_csv(spark, path)
    return df.filter("municipality_id != '' and name != ''").withColumn("domain", F.lower("domain"))


def platform_map(seed: DataFrame) -> DataFrame:
    if not {"municipality_id", "platform"} <= set(seed.columns):
        raise ValueError("the seed has no municipality_id or platform column")
    return seed.filter("municipality_id != ''").select("municipality_id", "platform")


def select_manifest(manifest: DataFrame, batch_id: str, status: str | None = None) -> DataFrame:
    out = manifest.filter(norm("batch_id") == batch_id.strip().lower())
    return out if status is None else out.filter(norm("status") == status.strip().lower())


def split_by_platform(manifest: DataFrame, platforms: DataFrame, platform: str) -> tuple[DataFrame, DataFrame]:
    """The towns of a platform, and the others."""
    df = manifest.join(platforms, "municipality_id", "left").withColumn("_mine", norm("platform") == platform.strip().lower())
    return df.filter("_mine").select(*manifest.columns), df.filter("not _mine").select(*manifest.columns)


def manifest_of(seed: DataFrame, platform: str, batch_id: str, exclude: bool = False, keep_blank: bool = True) -> DataFrame:
    """A manifest of the towns of a platform, or of all others, in the order of their ids."""
    same = norm("platform") == platform.strip().lower()
    rows = seed.filter(~same if exclude else same)
    if not keep_blank:
        rows = rows.filter(norm("platform") != "")
    return rows.select("municipality_id", F.col("name").alias("town_name"), "county", F.lit(batch_id).alias("batch_id"), F.lit("1").alias("priority"), F.lit("pending").alias("status"), F.lit("").alias("notes")).orderBy("municipality_id")


def write_csv(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """One CSV file with a header, or an empty one without where there are no rows; phone columns become plain text. For
    reports of a few rows a town."""
    phones = {c: safe_phone(c) for c in df.columns if c in ("phone", "top_candidate_phone")}
    out = df.withColumns(phones) if phones else df
    (out.orderBy(*order) if order else out).coalesce(1).write.mode("overwrite").csv(path, header=not out.isEmpty(), escape='"', emptyValue="")


def write_qa_set(spark: SparkSession, frames: dict[str, DataFrame], folder: str) -> None:
    """The whole set of QA files; those without a frame are written empty."""
    for name in QA_FILES:
        df = frames.get(name)
        write_csv(df if df is not None else spark.createDataFrame([], "municipality_id string"), f"{folder}/{name}.csv")


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def with_missing_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add the columns of an additive schema change that are not there yet, as nulls."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


def sitemap_urls(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumn("url", F.explode(F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?is)<loc[^>]*>\s*(.*?)\s*</loc>"), F.lit(1)), F.trim))).filter("url != ''")


def robots_paths(df: DataFrame, text: str = "text") -> DataFrame:
    """Allowed and disallowed paths without wildcards."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?im)^\s*(?:allow|disallow)\s*:\s*(/[^\s#]*)"), F.lit(1))
    return df.withColumn("path", F.explode(F.array_distinct(found))).filter(~F.col("path").rlike(r"[*$]"))
