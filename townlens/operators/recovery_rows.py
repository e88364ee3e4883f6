"""The full row about the recovery of each blocked town: the newest status, then the newest interface inventory, over defaults.

A field's value comes from the payload, else from the payload's notes (`k=v;k=v`), else from its default; a few fields have no
note. Both payloads are read with one pass over their newest row of each town (`reports.latest`), and everything else is column
expressions. A payload that is no JSON object changes nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townlens.functions.text import c, let
from townlens.operators import recovery
from townlens.operators.reports import latest

# The fields in their order with their defaults, results and enumerations.
FIELDS: dict[str, str | int] = {
    "batch_id": "", "blocked_reason": "", "recovery_mode_attempted": "false", "recovery_result": "", "homepage_status": "", "fallback_status": "", "sitemap_status": "", "robots_status": "",
    "known_path_hits": 0, "directory_hit": 0, "directory_fallback_attempted": 0, "directory_fallback_contacts": 0, "directory_source": "", "deep_path_hits": 0, "first_deep_category": "", "first_deep_path": "",
    "deep_hit_directory": 0, "deep_hit_finance": 0, "deep_hit_clerk": 0, "deep_hit_assessor": 0, "deep_hit_tax": 0, "deep_hit_building": 0, "deep_hit_planning": 0,
    "deep_extraction_path_count": 0, "first_deep_extraction_category": "", "first_deep_extraction_path": "", "deep_extraction_paths": "", "deep_fetch_success_count": 0, "deep_html_candidate_count": 0, "deep_extraction_attempt_count": 0, "deep_extraction_contact_count": 0, "deep_extraction_outcomes": "", "deep_extraction_zero_reason": "not_applicable", "deep_path_trust": "none", "deep_path_legacy_suspected": 0,
    "recovered_contact_count": 0, "recovered_role_winner_count": 0, "api_hit": 0, "api_type": "none", "api_paths_hit": "", "api_inventory_type": "none", "api_endpoint_count": 0, "api_inventory_paths": "", "swagger_json_path": "", "documented_get_count": 0, "selected_api_probe_count": 0, "successful_api_probe_count": 0, "likely_structured_endpoint_count": 0, "best_api_endpoint": "", "best_api_endpoint_class": "",
    "playwright_attempted": 0, "playwright_success": 0, "playwright_path": "", "notes": "recovery_not_attempted",
}
RESULTS = ("unrecovered_http_block", "recovered_known_path", "recovered_sitemap_path", "recovered_manual_seed_needed", "partial_recovery", "discovery_failure", "recovered_directory_hit", "directory_present_no_extract", "partial_directory_recovery", "api_available_no_scrape", "api_inventory_viable", "api_structured_data_found", "recovered_deep_path", "partial_deep_path_recovery", "deep_path_present_no_extract")
ENUMS = {"deep_path_trust": ("none", "low", "medium", "high"), "api_type": recovery.API_TYPES, "api_inventory_type": recovery.INVENTORY_TYPES}
#: Fields that notes do not give, and those that a blocked town brings along.
NO_NOTE = ("batch_id", "blocked_reason", "recovery_mode_attempted", "recovery_result", "homepage_status", "fallback_status", "sitemap_status", "robots_status", "known_path_hits", "recovered_contact_count", "recovered_role_winner_count", "notes")
BROUGHT = ("batch_id", "blocked_reason")
#: Field of the row by field of an inventory.
INVENTORY = {"swagger_json_path": "swagger_json_path", "documented_get_count": "documented_get_count", "selected_probe_count": "selected_api_probe_count", "successful_probe_count": "successful_api_probe_count", "likely_structured_endpoint_count": "likely_structured_endpoint_count", "best_endpoint_path": "best_api_endpoint", "best_endpoint_class": "best_api_endpoint_class"}


def _said(payload: Column, field: str) -> Column:
    return F.get_json_object(payload, f"$.{field}")


def _filled(x: Column) -> Column:
    return F.when(F.trim(x) != "", x)


def _whole(x: Column) -> Column:
    """A number as written, cut to a whole one; null for anything else. true and false count as 1 and 0."""
    return F.coalesce(F.trim(x).try_cast("double").cast("int"), F.when(F.lower(F.trim(x)) == "true", 1).when(F.lower(F.trim(x)) == "false", 0))


def _listed(paths: Column) -> Column:
    return F.size(F.filter(F.split(paths, ","), lambda x: F.trim(x) != ""))


def recovery_rows(blocked: DataFrame, statuses: DataFrame, inventories: DataFrame) -> DataFrame:
    """municipality_id and FIELDS of each town of blocked (municipality_id, batch_id, blocked_reason). statuses, inventories:
    (municipality_id, seq, value), of which the newest of each town counts."""
    newest = lambda df, name: latest(df).select("municipality_id", F.when(F.trim("value").startswith("{") & F.get_json_object("value", "$").isNotNull(), c("value")).alias(name))
    rows = blocked.select("municipality_id", *[F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f"_{f}") for f in BROUGHT])
    rows = rows.join(newest(statuses, "_p"), "municipality_id", "left").join(newest(inventories, "_i"), "municipality_id", "left")
    rows = rows.withColumn("_n", F.coalesce(_said(c("_p"), "notes"), F.lit("")))

    def value(x: Column, field: str, default: str | int) -> Column:
        own = _said(x["p"], field)
        note = None if field in NO_NOTE else F.nullif(recovery.note(x["n"], field), F.lit(""))
        found = [_whole(own), *([] if note is None else [_whole(note)])] if isinstance(default, int) else [_filled(own), *([] if note is None else [note])]
        return F.coalesce(*found, x[field] if field in BROUGHT else F.lit(default))

    read = F.struct(c("_p").alias("p"), c("_n").alias("n"), *[c(f"_{f}").alias(f) for f in BROUGHT])
    told = let(read, lambda x: F.struct(*[value(x, f, d).alias(f) for f, d in FIELDS.items()]))
    rows = rows.select("municipality_id", "_p", "_i", "_n", F.explode(F.array(told)).alias("_v")).select("municipality_id", "_p", "_i", "_n", "_v.*")
    n = F.col
    one_of = lambda f: F.when(F.lower(F.trim(f)).isin(*ENUMS[f]), F.lower(F.trim(f))).otherwise("none")
    attempted = F.when(F.lower(F.trim("recovery_mode_attempted")).isin("1", "true", "yes"), "true").otherwise("false")
    notes = F.when(n("_p").isNull(), FIELDS["notes"]).otherwise(n("_n"))
    rows = rows.withColumns({"recovery_mode_attempted": attempted, "recovery_result": F.when(F.trim("recovery_result").isin(*RESULTS), F.trim("recovery_result")).otherwise(""), "notes": notes, **{f: one_of(f) for f in ENUMS}})
    counted = lambda field, paths: F.when((n(field) <= 0) & (n(paths) != ""), _listed(n(paths))).otherwise(n(field))
    hit = F.coalesce(_whole(_said(n("_p"), "api_hit")), _whole(F.nullif(recovery.note("_n", "api_hit"), F.lit(""))), (n("api_paths_hit") != "").cast("int"))
    rows = rows.withColumns({
        "deep_extraction_path_count": counted("deep_extraction_path_count", "deep_extraction_paths"), "api_endpoint_count": counted("api_endpoint_count", "api_inventory_paths"),
        "api_hit": F.when((hit <= 0) & (n("api_type") != "none"), 1).otherwise(hit), "playwright_attempted": F.when((n("playwright_attempted") <= 0) & (n("playwright_success") > 0), 1).otherwise(n("playwright_attempted")),
    })
    for source, field in INVENTORY.items():
        own = _said(n("_i"), source)
        rows = rows.withColumn(field, F.coalesce(_whole(own) if isinstance(FIELDS[field], int) else _filled(own), n(field)))
    return rows.select("municipality_id", *FIELDS)
