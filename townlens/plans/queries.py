"""The engine's queries over staged tables, each with a DuckDB twin of the same name in ORACLES."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from townlens.functions import text as t
from townlens.functions import urls
from townlens.operators import candidates as cand
from townlens.operators import enrich, extract, merge, mining, recovery, reports
from townlens.plans.oracles import ENRICHED, SCORED, UNRESOLVED
from townlens.sources import files
from townlens.sources.shared import settled
from townlens.sources.staging import spark_table, with_sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def enriched(spark: SparkSession, sf_dir: str, legacy: bool = False) -> DataFrame:
    return enrich.enrich_contacts(spark_table(spark, sf_dir, "contacts"), legacy)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cand.score_candidates(enriched(spark, sf_dir))


def settled_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For queries that read the enriched contacts more than once."""
    return settled(enriched(spark, sf_dir), "enriched")


def settled_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settled(scored(spark, sf_dir), "scored")


def winners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cand.best_role_per_town(scored(spark, sf_dir))


def services(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.enrich_services(spark_table(spark, sf_dir, "service_links"), spark_table(spark, sf_dir, "municipalities"))


def towns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_table(spark, sf_dir, "municipalities")


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


# ---- projections over contacts


@query(f"WITH {ENRICHED} SELECT entity_type, count(*) AS contacts FROM enriched GROUP BY entity_type")
def entity_type_counts(spark, sf_dir):
    return enriched(spark, sf_dir).groupBy("entity_type").agg(F.count("*").alias("contacts"))


@query(f"WITH {ENRICHED} SELECT contact_id, has_name, has_email, has_phone, has_department, is_role_only FROM enriched")
def presence_flags(spark, sf_dir):
    return enriched(spark, sf_dir).select("contact_id", "has_name", "has_email", "has_phone", "has_department", "is_role_only")


@query(f"WITH {ENRICHED} SELECT contact_id, role_normalized FROM enriched")
def role_normalized(spark, sf_dir):
    return enriched(spark, sf_dir).select("contact_id", "role_normalized")


@query(f"WITH {ENRICHED} SELECT contact_id, role_family FROM enriched")
def role_family(spark, sf_dir):
    return enriched(spark, sf_dir).select("contact_id", "role_family")


@query(f"WITH {ENRICHED} SELECT contact_id, department_normalized FROM enriched")
def department_normalized(spark, sf_dir):
    return enriched(spark, sf_dir).select("contact_id", "department_normalized")


@query(f"WITH {ENRICHED} SELECT contact_id, page_type FROM enriched")
def page_type_current(spark, sf_dir):
    return enriched(spark, sf_dir).select("contact_id", "page_type")


@query(f"WITH {ENRICHED} SELECT contact_id, page_type_legacy AS page_type FROM enriched")
def page_type_legacy(spark, sf_dir):
    return enriched(spark, sf_dir, True).select("contact_id", "page_type")


@query(f"WITH {ENRICHED} SELECT contact_id, is_likely_noise FROM enriched")
def noise_current(spark, sf_dir):
    return enriched(spark, sf_dir).select("contact_id", "is_likely_noise")


@query(f"WITH {ENRICHED} SELECT contact_id, noise_legacy AS is_likely_noise FROM enriched")
def noise_legacy(spark, sf_dir):
    return enriched(spark, sf_dir, True).select("contact_id", "is_likely_noise")


@query(f"WITH {ENRICHED} SELECT contact_id, suspicious_reason FROM enriched")
def suspicious_reason(spark, sf_dir):
    return enriched(spark, sf_dir).select("contact_id", "suspicious_reason")


@query(f"WITH {ENRICHED} SELECT contact_id, round(semantic_confidence, 6) AS semantic_confidence, round(display_confidence, 6) AS display_confidence, title FROM enriched")
def semantic_confidence(spark, sf_dir):
    return rounded(enriched(spark, sf_dir).select("contact_id", "semantic_confidence", "display_confidence", "title"), "semantic_confidence", "display_confidence")


@query(f"WITH {ENRICHED} SELECT contact_id, dedupe_key FROM enriched")
def dedupe_key(spark, sf_dir):
    return enriched(spark, sf_dir).select("contact_id", "dedupe_key")


@query(f"WITH {ENRICHED} SELECT contact_id, record_rank FROM enriched")
def record_rank_current(spark, sf_dir):
    return enriched(spark, sf_dir).select("contact_id", "record_rank")


@query(f"WITH {ENRICHED} SELECT contact_id, rank_legacy AS record_rank FROM enriched")
def record_rank_legacy(spark, sf_dir):
    return enriched(spark, sf_dir, True).select("contact_id", "record_rank")


@query(f"WITH {ENRICHED} SELECT contact_id, municipality_id, entity_type, name, title, role_normalized, role_family, department, department_normalized, email, email_type, phone, phone_ext, address, hours, page_type, source_url, round(display_confidence, 6) AS display_confidence FROM clean")
def contacts_clean(spark, sf_dir):
    return rounded(enrich.clean_contacts(enriched(spark, sf_dir)), "display_confidence")


@query(f"WITH {ENRICHED} SELECT contact_id, role_normalized, email, phone FROM enriched WHERE is_likely_noise = 0 AND record_rank = 1 AND (f_email OR f_phone)")
def customer_contacts(spark, sf_dir):
    return reports.customer_contacts(enriched(spark, sf_dir)).select("contact_id", "role_normalized", "email", "phone")


@query(f"WITH {ENRICHED} SELECT municipality_id, role_normalized, role_family, name, email, phone, department_normalized, source_url, round(display_confidence, 6) AS display_confidence FROM clean WHERE role_normalized IS NOT NULL AND entity_type <> 'unknown'")
def role_directory(spark, sf_dir):
    return rounded(reports.role_directory(enrich.clean_contacts(enriched(spark, sf_dir))), "display_confidence")


@query(f"WITH {ENRICHED} SELECT e.municipality_id, CASE WHEN record_rank > 1 THEN 'duplicate_rank' WHEN is_likely_noise = 1 THEN 'likely_noise' ELSE 'other' END AS drop_reason, count(*) AS dropped FROM enriched e WHERE contact_id NOT IN (SELECT contact_id FROM clean) GROUP BY ALL")
def drop_reasons(spark, sf_dir):
    df = settled_enriched(spark, sf_dir)
    return reports.dropped_before_clean(df, enrich.clean_contacts(df))


@query(f"WITH {ENRICHED} SELECT municipality_id, count(*) AS contacts, sum(has_name)::BIGINT AS with_name, sum(has_email)::BIGINT AS with_email, sum(has_phone)::BIGINT AS with_phone, sum(has_department)::BIGINT AS with_department, max((record_rank > 1)::INT) AS any_duplicate FROM enriched GROUP BY municipality_id")
def presence_sums(spark, sf_dir):
    return enriched(spark, sf_dir).groupBy("municipality_id").agg(F.count("*").alias("contacts"), *[F.sum(f"has_{f}").alias(f"with_{f}") for f in ("name", "email", "phone", "department")], F.max((F.col("record_rank") > 1).cast("int")).alias("any_duplicate"))


@query(f"WITH {SCORED} SELECT contact_id, person_name_score, source_score, reconstruction_score, contact_score, department_score, role_match_score, suspicious_score, candidate_score, winner_disqualifier_reason, high_confidence_eligible, review_candidate_eligible, candidate_rank, high_confidence_rank, eligible_candidate_count, candidate_state, invalid_candidate_disqualified, source_structure_type FROM cand")
def candidates_scored(spark, sf_dir):
    return scored(spark, sf_dir).select("contact_id", "person_name_score", "source_score", "reconstruction_score", "contact_score", "department_score", "role_match_score", "suspicious_score", "candidate_score", "winner_disqualifier_reason", "high_confidence_eligible", "review_candidate_eligible", "candidate_rank", "high_confidence_rank", "eligible_candidate_count", "candidate_state", "invalid_candidate_disqualified", "source_structure_type")


@query(f"WITH {SCORED} SELECT municipality_id, role_group, role_normalized, contact_id, name, title, email, phone, candidate_score, candidate_state, forced_fallback, round(display_confidence, 6) AS display_confidence FROM winners")
def best_role_per_town(spark, sf_dir):
    return rounded(winners(spark, sf_dir).select("municipality_id", "role_group", "role_normalized", "contact_id", "name", "title", "email", "phone", "candidate_score", "candidate_state", "forced_fallback", "display_confidence"), "display_confidence")


@query(f"WITH {UNRESOLVED} SELECT municipality_id, role_normalized, candidate_count, review_candidate_count, invalid_candidate_disqualified_count, 1 AS forced_fallback_blocked, top_candidate_contact_id, top_candidate_score, top_candidate_state, top_candidate_winner_block_reason, unresolved_reason FROM unresolved")
def unresolved_roles(spark, sf_dir):
    df = settled_scored(spark, sf_dir)
    out = cand.unresolved_roles(df, cand.best_role_per_town(df))
    return out.select("municipality_id", "role_normalized", "candidate_count", "review_candidate_count", "invalid_candidate_disqualified_count", "forced_fallback_blocked", "top_candidate_contact_id", "top_candidate_score", "top_candidate_state", "top_candidate_winner_block_reason", "unresolved_reason")


@query(f"WITH {SCORED} SELECT contact_id, municipality_id, role_normalized, candidate_rank FROM cand WHERE tagged AND candidate_state = 'candidate_for_review'")
def candidates_for_review(spark, sf_dir):
    return scored(spark, sf_dir).filter((F.col("is_revize") == 1) & (F.col("candidate_state") == "candidate_for_review")).select("contact_id", "municipality_id", "role_normalized", "candidate_rank")


HIGH_VALUE = ("Assessor", "Tax Collector", "Town Clerk", "Building Official", "Finance Director", "First Selectman", "Mayor", "Town Manager")


@query(f"WITH {SCORED} SELECT municipality_id, role_normalized, contact_id FROM winners WHERE role_normalized IN {HIGH_VALUE}")
def high_value_roles(spark, sf_dir):
    return winners(spark, sf_dir).filter(F.col("role_normalized").isin(*HIGH_VALUE)).select("municipality_id", "role_normalized", "contact_id")


@query(f"WITH {SCORED} SELECT municipality_id, role_normalized, contact_id FROM winners WHERE NOT f_email")
def roles_without_email(spark, sf_dir):
    return winners(spark, sf_dir).filter(~t.filled("email")).select("municipality_id", "role_normalized", "contact_id")


@query(f"WITH {SCORED} SELECT DISTINCT c.municipality_id, c.role_normalized FROM cand c WHERE NOT EXISTS (SELECT 1 FROM winners w WHERE w.municipality_id = c.municipality_id AND w.role_normalized = c.role_normalized)")
def roles_with_no_winner(spark, sf_dir):
    df = settled_scored(spark, sf_dir)
    key = ["municipality_id", "role_normalized"]
    return df.select(*key).distinct().join(cand.best_role_per_town(df).select(*key), key, "left_anti")


SUSPICIOUS = f"""{SCORED}, sus AS (
  SELECT *, NOT reach AS q1, (role_normalized = 'Assessor' AND dl NOT LIKE '%assessor%') OR (role_normalized = 'Tax Collector' AND dl NOT LIKE '%tax%') OR (role_normalized = 'Town Clerk' AND dl NOT LIKE '%clerk%') OR (role_normalized = 'Building Official' AND dl NOT LIKE '%building%') OR (role_normalized = 'Finance Director' AND dl NOT LIKE '%finance%') AS q2,
    role_normalized = 'Assessor' AND (ul LIKE '%tax%' OR lower(coalesce(email, '')) LIKE '%tax%') AND dl NOT LIKE '%tax assessor%' AND tt NOT LIKE '%tax assessor%' AS q3, role_normalized = 'Tax Collector' AND regexp_matches(ul, 'clerk|planning') AS q4, role_normalized = 'Town Clerk' AND ul LIKE '%planning%' AS q5,
    role_normalized = 'First Selectman' AND regexp_matches(ul, 'finance|building') AS q6, role_normalized IN ('First Selectman', 'Mayor', 'Town Manager') AND (regexp_matches(nl || '~' || tt, 'assistant|administrative') OR dl LIKE '%assistant%') AS q7 FROM winners)"""


@query(f"WITH {SUSPICIOUS} SELECT municipality_id, role_normalized, contact_id, CASE WHEN q1 THEN 'missing_email_and_phone' WHEN winner_disqualifier_reason <> '' THEN winner_disqualifier_reason WHEN sr <> '' THEN sr WHEN q2 THEN 'role_department_mismatch' WHEN q3 THEN 'assessor_tax_mismatch' WHEN q4 THEN 'tax_collector_role_page_mismatch' WHEN q5 THEN 'town_clerk_planning_mismatch' WHEN q6 THEN 'first_selectman_role_page_mismatch' WHEN q7 THEN 'chief_role_assistant_contamination' WHEN is_likely_noise = 1 THEN 'likely_noise_flag' ELSE 'review' END AS suspicious_reason FROM sus WHERE q1 OR sr <> '' OR q2 OR q3 OR q4 OR q5 OR q6 OR q7 OR is_likely_noise = 1")
def suspicious_winners(spark, sf_dir):
    return reports.suspicious_winners(winners(spark, sf_dir)).select("municipality_id", "role_normalized", "contact_id", "suspicious_reason")


MISSING = f"""{SCORED}, {with_sql("municipalities")}, groups(g, o, members) AS (VALUES ('executive', 1, ['First Selectman', 'Mayor', 'Town Manager', 'Town Administrator']), ('assessment', 2, ['Assessor']), ('tax', 3, ['Tax Collector']), ('clerk', 4, ['Town Clerk']), ('building', 5, ['Building Official']), ('planning', 6, ['Planner', 'Land Use', 'Zoning Enforcement Officer', 'ZEO']), ('finance', 7, ['Finance Director', 'Treasurer'])),
grid AS (SELECT m.municipality_id, m.name AS town_name, g, o, len(list_filter(members, x -> x IN (SELECT role_normalized FROM winners w WHERE w.municipality_id = m.municipality_id))) AS n FROM municipalities m, groups),
missing AS (SELECT municipality_id, town_name, string_agg(g, '; ' ORDER BY o) FILTER (n = 0) AS missing_role_groups, (count(*) FILTER (n = 0))::INT AS missing_group_count, coalesce(string_agg(g, '; ' ORDER BY o) FILTER (n > 0), '') AS present_role_groups FROM grid GROUP BY ALL HAVING count(*) FILTER (n = 0) > 0)"""
MISSING = MISSING.replace("len(list_filter(members, x -> x IN (SELECT role_normalized FROM winners w WHERE w.municipality_id = m.municipality_id)))", "(SELECT count(*) FROM winners w WHERE w.municipality_id = m.municipality_id AND list_contains(members, w.role_normalized))")


@query(f"WITH {MISSING} SELECT municipality_id, town_name, missing_role_groups, missing_group_count, present_role_groups FROM missing")
def missing_key_roles(spark, sf_dir):
    return reports.missing_key_roles(towns(spark, sf_dir), winners(spark, sf_dir)).drop("present_group_roles")


SUMMARY = f"""{MISSING}, summary AS (SELECT m.municipality_id, m.name AS town_name, m.platform, (SELECT count(*) FROM contacts x WHERE x.municipality_id = m.municipality_id) AS raw, (SELECT count(*) FROM clean x WHERE x.municipality_id = m.municipality_id) AS clean, (SELECT count(*) FROM winners x WHERE x.municipality_id = m.municipality_id) AS winners FROM municipalities m)"""
DIAGNOSED = """diag AS (SELECT *, CASE WHEN http_status IN (401, 403, 429, 503) THEN TRUE WHEN contact_rows_extracted > 0 OR (http_status = 200 AND extracted_link_count > 0 AND candidate_service_link_count > 0) THEN FALSE ELSE coalesce(http_status = 200 AND detected_block_signal = 1 AND candidate_service_link_count = 0 AND extracted_link_count <= 1, FALSE) END AS blocked FROM diagnostics),
last AS (SELECT * FROM diag QUALIFY row_number() OVER (PARTITION BY municipality_id ORDER BY seq DESC) = 1)"""


def summary(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    df = settled_enriched(spark, sf_dir)
    won = settled(cand.best_role_per_town(cand.score_candidates(df)), "winners")
    return reports.batch_summary(towns(spark, sf_dir), raw=spark_table(spark, sf_dir, "contacts"), clean=enrich.clean_contacts(df), winners=won), reports.missing_key_roles(towns(spark, sf_dir), won)


@query(f"WITH {SUMMARY} SELECT municipality_id, town_name, raw, clean, winners FROM summary")
def batch_summary(spark, sf_dir):
    return summary(spark, sf_dir)[0]


@query(f"WITH {SUMMARY}, {with_sql('diagnostics')}, {DIAGNOSED}, f AS (SELECT s.*, coalesce(l.blocked, FALSE) AS b, x.municipality_id IS NOT NULL AS lacks FROM summary s LEFT JOIN last l USING (municipality_id) LEFT JOIN missing x USING (municipality_id)) SELECT 'all' AS batch_id, count(*) AS municipalities_total, count(*) FILTER (b) AS municipalities_blocked, count(*) FILTER (NOT b) AS municipalities_unblocked, count(*) FILTER (NOT b AND raw = 0 AND clean = 0 AND winners = 0) AS municipalities_with_zero_yield_unblocked, count(*) FILTER (NOT b AND lacks) AS municipalities_with_any_missing_groups_unblocked, greatest(0, count(*) FILTER (NOT b) - count(*) FILTER (NOT b AND lacks)) AS municipalities_fully_covered_unblocked FROM f")
def coverage_summary(spark, sf_dir):
    return reports.coverage_summary(*summary(spark, sf_dir), spark_table(spark, sf_dir, "diagnostics"), "all")


@query(f"WITH {SUMMARY}, {with_sql('diagnostics')}, {DIAGNOSED} SELECT coalesce(nullif(trim(platform), ''), '(blank)') AS vendor, count(*) AS towns, count(*) FILTER (coalesce(blocked, FALSE)) AS blocked, count(*) FILTER (NOT coalesce(blocked, FALSE) AND x.municipality_id IS NULL) AS fully_covered, count(*) FILTER (x.municipality_id IS NOT NULL) AS with_missing_groups, sum(raw)::BIGINT AS raw_contacts, sum(winners)::BIGINT AS role_winners FROM summary s LEFT JOIN last l USING (municipality_id) LEFT JOIN missing x ON x.municipality_id = s.municipality_id GROUP BY 1")
def vendor_rollup(spark, sf_dir):
    return reports.vendor_rollup(towns(spark, sf_dir), *summary(spark, sf_dir), spark_table(spark, sf_dir, "diagnostics"))


PROFILE_COLUMNS = ", ".join(f"(SELECT {x} FROM clean c WHERE c.municipality_id = m.municipality_id AND role_family = '{f}' ORDER BY round(display_confidence, 9) DESC, coalesce(source_url, ''), contact_id LIMIT 1) AS {f}_{x}" for f in reports.FAMILIES for x in ("name", "email", "phone"))
SERVICES = f"""{with_sql("municipalities", "service_links")}, sv AS (
  SELECT s.*, nullif(trim(category), '') AS service_type, lower(coalesce(category, '')) AS a, lower(coalesce(label, '')) AS b, lower(coalesce(url, '')) AS u, lower(coalesce(vendor, '')) AS v, lower(trim(coalesce(s.domain, ''))) AS h, lower(trim(coalesce(m.domain, ''))) AS td
  FROM service_links s LEFT JOIN (SELECT municipality_id AS mid, domain FROM municipalities) m ON mid = s.municipality_id
), sv2 AS (
  SELECT *, CASE WHEN regexp_matches(a || '~' || b || '~' || u, 'gis') THEN 'gis' WHEN regexp_matches(a, 'property|field card') OR regexp_matches(b, 'property card|field card') OR u LIKE '%property%' THEN 'property_cards' WHEN a LIKE '%tax%' OR b LIKE '%tax payment%' OR u LIKE '%tax%' THEN 'tax_payment'
    WHEN regexp_matches(a, 'job|employment') OR regexp_matches(b, 'job|employment') THEN 'jobs' WHEN regexp_matches(a || '~' || b || '~' || u, 'permit') THEN 'permits' WHEN regexp_matches(a || '~' || b || '~' || u, 'agenda|minute') THEN 'agendas_minutes' ELSE service_type END AS service_type_normalized,
    CASE WHEN v LIKE '%civicplus%' THEN 'CivicPlus' WHEN v LIKE '%governmentjobs%' THEN 'GovernmentJobs' WHEN v LIKE '%vision%' THEN 'Vision' ELSE nullif(trim(vendor), '') END AS provider_normalized,
    (regexp_matches(lower(coalesce(service_page_type, '')), 'external|vendor|third') OR (h <> '' AND td <> '' AND NOT suffix(h, td) AND NOT suffix(td, h)))::INT AS is_external FROM sv
), services AS (SELECT *, greatest(0::DOUBLE, least(1::DOUBLE, coalesce(confidence, 0) + 0.05::DOUBLE * (provider_normalized IS NOT NULL)::INT + 0.05::DOUBLE * (service_type_normalized IS NOT NULL)::INT)) AS display_confidence FROM sv2)"""
PROFILE_LINKS = ", ".join(f"(SELECT url FROM services c WHERE c.municipality_id = m.municipality_id AND service_type_normalized = '{k}' ORDER BY round(display_confidence, 9) DESC, coalesce(source_url, ''), service_id LIMIT 1) AS {k}_url" for k in ("gis", "property_cards", "tax_payment", "jobs", "permits", "agendas_minutes"))


@query(f"WITH {ENRICHED}, {SERVICES} SELECT m.municipality_id, {PROFILE_COLUMNS}, {PROFILE_LINKS} FROM municipalities m")
def town_profile(spark, sf_dir):
    return reports.town_profile(towns(spark, sf_dir), enrich.clean_contacts(enriched(spark, sf_dir)), services(spark, sf_dir))


@query(f"WITH {SERVICES} SELECT service_id, municipality_id, service_type_normalized, label, url, provider_normalized, domain, is_external, round(display_confidence, 6) AS display_confidence, source_url FROM services")
def service_directory(spark, sf_dir):
    return rounded(reports.service_directory(services(spark, sf_dir)), "display_confidence")


@query(f"WITH {SERVICES} SELECT municipality_id, count(*) AS external_links FROM services WHERE is_external = 1 GROUP BY 1")
def service_external(spark, sf_dir):
    return services(spark, sf_dir).filter("is_external = 1").groupBy("municipality_id").agg(F.count("*").alias("external_links"))


@query(f"WITH {SERVICES} SELECT coalesce(service_type_normalized, '(none)') AS category, count(*) AS links FROM services GROUP BY 1")
def category_counts(spark, sf_dir):
    return services(spark, sf_dir).groupBy(F.coalesce("service_type_normalized", F.lit("(none)")).alias("category")).agg(F.count("*").alias("links"))


@query(f"WITH {UNRESOLVED} SELECT (SELECT count(*) FROM contacts) AS contacts, (SELECT count(*) FROM clean) AS clean_contacts, (SELECT count(*) FROM cand) AS candidates, (SELECT count(*) FROM winners) AS winners, (SELECT count(*) FROM winners WHERE forced_fallback = 1) AS forced_winners, (SELECT count(*) FROM unresolved) AS unresolved, (SELECT count(*) FROM enriched WHERE is_likely_noise = 1) AS noise, (SELECT count(*) FROM enriched WHERE suspicious_reason IS NOT NULL) AS suspicious, (SELECT count(DISTINCT municipality_id) FROM winners) AS towns_with_winner")
def postprocess_metrics(spark, sf_dir):
    df = settled_enriched(spark, sf_dir)
    sc = settled(cand.score_candidates(df), "scored")
    won = settled(cand.best_role_per_town(sc), "winners")
    one = df.agg(F.count("*").alias("contacts"), F.sum(t.flag((F.col("record_rank") == 1) & ((F.col("is_likely_noise") == 0) | (F.col("key_is_noise") == 1)))).alias("clean_contacts"), F.sum("is_likely_noise").alias("noise"), F.count("suspicious_reason").alias("suspicious"))
    two = won.agg(F.count("*").alias("winners"), F.sum("forced_fallback").alias("forced_winners"), F.count_distinct("municipality_id").alias("towns_with_winner"))
    return one.join(sc.agg(F.count("*").alias("candidates"))).join(two).join(cand.unresolved_roles(sc, won).agg(F.count("*").alias("unresolved")))  # one row each


@query(f"WITH {with_sql('contacts')} SELECT contact_id, 'initial_backfill' AS extraction_method, length(coalesce(name, '')) AS name_length FROM contacts")
def evidence_seed(spark, sf_dir):
    out = reports.evidence(spark_table(spark, sf_dir, "contacts"))
    return out.select("contact_id", "extraction_method", F.length(F.get_json_object("field_claims_json", "$.name")).cast("long").alias("name_length"))


#: Every seventh contact belongs to a town that no table has.
MOVED = "CASE WHEN seq % 7 = 0 THEN concat('gone_', municipality_id) ELSE municipality_id END"


@query(f"WITH {with_sql('contacts', 'municipalities')}, m AS (SELECT contact_id, {MOVED} AS mid FROM contacts) SELECT contact_id FROM m WHERE mid NOT IN (SELECT municipality_id FROM municipalities)")
def orphan_contacts(spark, sf_dir):
    return reports.orphans(spark_table(spark, sf_dir, "contacts").withColumn("municipality_id", F.expr(MOVED)), towns(spark, sf_dir)).select("contact_id")


# ---- signals, diagnostics, recovery


@query(f"WITH {with_sql('signals')} SELECT seq, signal_id, signal_type FROM signals WHERE signal_type NOT IN ('crawl_diagnostics', 'blocked_recovery_status', 'crawl_error', 'page_fetch')")
def signals_public(spark, sf_dir):
    return reports.public_signals(spark_table(spark, sf_dir, "signals")).select("seq", "signal_id", "signal_type")


PIVOT = ("agenda_vendor", "jobs_vendor", "gis_vendor", "tax_vendor", "email_pattern")


@query(f"WITH {with_sql('signals')} SELECT municipality_id, {', '.join(f'max(value) FILTER (signal_type = {k!r}) AS {k}' for k in PIVOT)} FROM signals GROUP BY 1")
def signal_pivot(spark, sf_dir):
    return reports.signal_pivot(spark_table(spark, sf_dir, "signals"), PIVOT)


@query(f"WITH {with_sql('diagnostics')} SELECT municipality_id, seq, http_status, contact_rows_extracted FROM diagnostics QUALIFY row_number() OVER (PARTITION BY municipality_id ORDER BY seq DESC) = 1")
def latest_diagnostics(spark, sf_dir):
    return reports.latest(spark_table(spark, sf_dir, "diagnostics")).select("municipality_id", "seq", "http_status", "contact_rows_extracted")


@query(f"WITH {with_sql('diagnostics')} SELECT seq, CASE WHEN http_status IN (401, 403, 429, 503) THEN 'blocked_or_forbidden' WHEN contact_rows_extracted > 0 OR (http_status = 200 AND candidate_service_link_count > 0 AND extracted_link_count > 0) THEN 'ok' WHEN http_status = 200 AND detected_block_signal = 1 AND candidate_service_link_count = 0 AND extracted_link_count <= 1 THEN 'blocked_or_forbidden' WHEN http_status = 200 AND candidate_service_link_count = 0 AND (response_text_length <= 1200 OR extracted_link_count <= 1 OR detected_js_shell_signal = 1) THEN 'probable_js_shell' WHEN (http_status = 200 AND extracted_link_count > 0 AND candidate_service_link_count = 0) OR (http_status IS NULL AND extracted_link_count = 0 AND candidate_service_link_count = 0) THEN 'discovery_failure' WHEN http_status = 200 AND candidate_service_link_count > 0 THEN 'low_extraction' ELSE 'ok' END AS diagnostic_class FROM diagnostics")
def crawl_diagnostic_class(spark, sf_dir):
    return spark_table(spark, sf_dir, "diagnostics").select("seq", extract.crawl_class().alias("diagnostic_class"))


@query(f"WITH {with_sql('diagnostics')}, {DIAGNOSED} SELECT seq, CASE WHEN http_status IN (401, 403) THEN 'http_forbidden' WHEN http_status = 429 THEN 'rate_limited' WHEN http_status = 503 THEN 'service_unavailable_or_protected' WHEN detected_block_signal > 0 THEN 'block_signal_detected' ELSE 'blocked_or_forbidden' END AS blocked_reason FROM diag WHERE blocked")
def blocked_reason(spark, sf_dir):
    return spark_table(spark, sf_dir, "diagnostics").filter(extract.effectively_blocked()).select("seq", extract.blocked_reason().alias("blocked_reason"))


# ---- scope, sources, keys


@query(f"WITH {with_sql('manifest')} SELECT municipality_id, town_name, county, batch_id, priority, status, notes FROM manifest WHERE lower(batch_id) = 'batch_1' AND lower(status) = 'active'")
def manifest_select(spark, sf_dir):
    return files.select_manifest(spark_table(spark, sf_dir, "manifest"), "batch_1", "active")


@query(f"WITH {with_sql('municipalities')}, u AS (SELECT municipality_id, 1 AS k, jobs_url AS url, domain FROM municipalities UNION ALL SELECT municipality_id, 2, directory_url, domain FROM municipalities UNION ALL SELECT municipality_id, 3, assessor_url, domain FROM municipalities UNION ALL SELECT municipality_id, 4, tax_url, domain FROM municipalities) SELECT municipality_id, url, CASE WHEN regexp_extract(url, '//([^/]+)', 1) = domain OR suffix(regexp_extract(url, '//([^/]+)', 1), '.' || domain) THEN 'internal' ELSE 'external' END AS seed_kind FROM u WHERE coalesce(trim(url), '') <> ''")
def seed_unpivot(spark, sf_dir):
    df = towns(spark, sf_dir).select("municipality_id", "domain", F.explode(F.array("jobs_url", "directory_url", "assessor_url", "tax_url")).alias("url")).filter(t.filled("url"))
    inside = urls.is_internal(urls.domain("url"), F.col("domain"))
    return df.select("municipality_id", "url", F.when(inside, "internal").otherwise("external").alias("seed_kind")).dropDuplicates()


@query(f"WITH {with_sql('contacts')} SELECT contact_id, 'ctc_' || substr(sha256(lower(trim(municipality_id)) || '||email||' || lower(trim(coalesce(email, '')))), 1, 20) AS merged_id FROM contacts")
def make_id(spark, sf_dir):
    return spark_table(spark, sf_dir, "contacts").select("contact_id", t.make_id("ctc", "municipality_id", F.lit("email"), "email").alias("merged_id"))


@query("WITH p AS (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN '8.6E+09' WHEN 1 THEN CAST(8605550000 + o_orderkey AS VARCHAR) || '.0' WHEN 2 THEN 'NaN' WHEN 3 THEN ' 0123456789 ' WHEN 4 THEN NULL ELSE '2.04e9' END AS phone FROM orders) SELECT o_orderkey, CASE WHEN phone IS NULL OR lower(trim(phone)) = 'nan' THEN '' WHEN phone = '8.6E+09' THEN '8600000000' WHEN phone = '2.04e9' THEN '2040000000' WHEN phone LIKE '%.0' THEN replace(phone, '.0', '') ELSE trim(phone) END AS phone FROM p")
def safe_phone(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/orders.parquet")
    k = F.col("o_orderkey") % 6
    raw = F.when(k == 0, "8.6E+09").when(k == 1, F.concat((F.lit(8605550000) + F.col("o_orderkey")).cast("string"), F.lit(".0"))).when(k == 2, "NaN").when(k == 3, " 0123456789 ").when(k == 4, None).otherwise("2.04e9")
    return df.select("o_orderkey", t.safe_phone(raw).alias("phone"))


# ---- text, links, vendors


@query("SELECT doc_id, array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(text, '(?i)\\b[A-Z0-9._%+\\-]+@[A-Z0-9.\\-]+\\.[A-Z]{2,}\\b'), lambda x: lower(x)))), ',') AS emails FROM documents WHERE contains(text, '@')")
def emails_in_text(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter(F.col("text").contains("@"))
    return docs.select("doc_id", F.array_join(extract.emails("text"), ",").alias("emails"))


PHONE_SQL = r"(?i)(?:\+?1[\s.\-]?)?\(?([2-9][0-9]{2})\)?[\s.\-]?([0-9]{3})[\s.\-]?([0-9]{4})(?:\s*(?:,|;)?\s*(?:ext\.?|extension|x)\s*([0-9]{1,6}))?"


@query(f"WITH f AS (SELECT doc_id, list_transform(regexp_extract_all(text, '{PHONE_SQL}'), lambda x: regexp_extract(x, '{PHONE_SQL}', 1) || regexp_extract(x, '{PHONE_SQL}', 2) || regexp_extract(x, '{PHONE_SQL}', 3) || coalesce('x' || nullif(regexp_extract(x, '{PHONE_SQL}', 4), ''), '')) AS p FROM documents) SELECT doc_id, array_to_string(list_sort(list_distinct(p)), ',') AS phones FROM f WHERE len(p) > 0")
def phones_in_text(spark, sf_dir):
    found = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", extract.phones("text").alias("p")).filter(F.size("p") > 0)
    return found.select("doc_id", F.array_join(F.array_sort(F.array_distinct(F.transform("p", lambda x: F.concat(x["phone"], F.coalesce(F.concat(F.lit("x"), x["phone_ext"]), F.lit("")))))), ",").alias("phones"))


HINTS = "|".join(extract.ROLE_EMAIL_HINTS)


@query(f"WITH {with_sql('contacts')}, l AS (SELECT contact_id, lower(coalesce(split_part(email, '@', 1), '')) AS x FROM contacts) SELECT contact_id, CASE WHEN x = '' THEN 'unknown' WHEN x = 'contact' OR regexp_matches(regexp_replace(x, '[^a-z0-9]', '', 'g'), '{HINTS}') THEN 'role_based' WHEN regexp_full_match(x, '[a-z][a-z]+[.][a-z][a-z]+') THEN 'direct' WHEN contains(x, '.') THEN 'unknown' WHEN regexp_full_match(x, '[a-z][a-z]+[0-9]*') THEN 'direct' ELSE 'unknown' END AS email_type FROM l")
def email_type(spark, sf_dir):
    return spark_table(spark, sf_dir, "contacts").select("contact_id", extract.email_type("email").alias("email_type"))


@query("SELECT page_id, unnest(regexp_extract_all(html, '(?i)href\\s*=\\s*[\"'']([^\"'']+)[\"'']', 1)) AS url FROM pages")
def page_links(spark, sf_dir):
    return extract.page_links(pages(spark, sf_dir))


@query("SELECT page_id, nullif(trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\\s+', ' ', 'g')), '') AS title FROM pages")
def page_titles(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", extract.page_title("html").alias("title"))


BLOB = "' ' || trim(regexp_replace(lower(coalesce(label, '') || ' ' || coalesce(url, '')), '[^a-z0-9]+', ' ', 'g')) || ' '"
_has = lambda words: " OR ".join(f"contains(k, '{w if ' ' in w else f' {w} '}')" for w in words)
LINKED = f"""{with_sql("service_links")}, kb AS (SELECT service_id, municipality_id, label, url, {BLOB} AS k, lower(coalesce(url, '')) AS u FROM service_links),
pt AS (SELECT *, CASE WHEN {_has(('directory', 'staff'))} THEN 'directory_page' WHEN {_has(('contact',))} THEN 'contact_page' WHEN {_has(extract.OFFICIAL_KEYWORDS)} THEN 'official_page' WHEN {_has(extract.DEPARTMENT_KEYWORDS)} THEN 'department_page' WHEN {_has(extract.SERVICE_KEYWORDS)} THEN 'service_page' ELSE 'candidate' END AS page_type FROM kb),
sc AS (SELECT *, {" + ".join(f"CASE WHEN {_has((w,))} THEN {v}::DOUBLE ELSE 0 END" for w, v in extract.LINK_WEIGHTS.items())} - CASE WHEN regexp_matches(u, '[.](pdf|doc|docx|xls|xlsx)$') THEN 0.5::DOUBLE ELSE 0 END + CASE WHEN u LIKE '%/departments%' THEN 0.75::DOUBLE ELSE 0 END + CASE WHEN page_type = 'service_page' THEN 0.8::DOUBLE WHEN page_type <> 'candidate' THEN 1.2::DOUBLE ELSE 0 END AS score FROM pt)"""


@query(f"WITH {LINKED} SELECT service_id, page_type, round(score, 3) AS score FROM sc")
def link_score(spark, sf_dir):
    return spark_table(spark, sf_dir, "service_links").select("service_id", extract.page_class("url", "label").alias("page_type"), F.round(extract.link_score("url", "label"), 3).alias("score"))


@query(f"WITH {LINKED}, m AS (SELECT municipality_id, url, max(score) AS score FROM sc WHERE url IS NOT NULL AND score >= 2.5 GROUP BY ALL) SELECT municipality_id, url, round(score, 3) AS score, row_number() OVER (PARTITION BY municipality_id ORDER BY round(score, 3) DESC, url)::INT AS rank FROM m QUALIFY rank <= 35")
def link_topk(spark, sf_dir):
    return extract.select_links(spark_table(spark, sf_dir, "service_links"), "municipality_id").select("municipality_id", "url", "score", "rank")


@query(f"WITH {LINKED} SELECT page_type, count(*) AS links FROM pt GROUP BY 1")
def page_type_links(spark, sf_dir):
    return spark_table(spark, sf_dir, "service_links").groupBy(extract.page_class("url", "label").alias("page_type")).agg(F.count("*").alias("links"))


_in = lambda col, w: f"contains({col}, '{(' ' + w + ' ') if ' ' not in w.replace('-', ' ') else w.replace('-', ' ')}')"
_cat = lambda k: " + ".join([f"CASE WHEN {_in('a', w)} THEN 1.4::DOUBLE ELSE 0 END" for w in extract.SERVICE_TOKENS[k][0]] + [f"CASE WHEN {_in('p', w)} THEN 1.0::DOUBLE ELSE 0 END" for w in extract.SERVICE_TOKENS[k][1]])
SERVICE_SQL = f"""{with_sql("service_links")}, z AS (SELECT service_id, lower(regexp_extract(coalesce(url, ''), '^[A-Za-z]+://([^/?#]*)', 1)) AS h, ' ' || trim(regexp_replace(lower(coalesce(label, '')), '[^a-z0-9]+', ' ', 'g')) || ' ' AS a, ' ' || trim(regexp_replace(lower(regexp_replace(regexp_replace(coalesce(url, ''), '^[A-Za-z]+://', ''), '#.*$', '')), '[^a-z0-9]+', ' ', 'g')) || ' ' AS p FROM service_links),
y AS (SELECT *, [{", ".join(f"{{'s': {_cat(k)}{' - CASE WHEN ' + ' OR '.join(_in(c, w) for w in extract.PERMIT_NEGATIVES for c in 'ap') + ' THEN 1.8::DOUBLE ELSE 0 END' if k == 'permits' else ''}, 'r': {-i}, 'c': '{k}'}}" for i, k in enumerate(extract.SERVICE_TOKENS))}] AS l FROM z), x AS (SELECT *, list_max(l) AS m FROM y)"""


@query(f"WITH {SERVICE_SQL} SELECT service_id, CASE WHEN h LIKE '%axisgis.com%' THEN 'gis' WHEN h LIKE '%propertyrecordcards.com%' THEN 'property_cards' WHEN h LIKE '%mytaxbill.org%' THEN 'tax_payment' WHEN m.s >= 1.8 THEN m.c END AS category, CASE WHEN regexp_matches(h, 'axisgis[.]com|propertyrecordcards[.]com|mytaxbill[.]org') THEN 0.95::DOUBLE WHEN m.s >= 1.8 THEN round(least(0.98, 0.5 + m.s * 0.12), 3) ELSE 0 END AS confidence FROM x")
def service_class(spark, sf_dir):
    return spark_table(spark, sf_dir, "service_links").select("service_id", extract.service_class("url", "label").alias("x")).select("service_id", "x.category", "x.confidence")


@query(f"WITH {with_sql('service_links')}, v AS (SELECT service_id, regexp_replace(lower(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1)), '^www[.]', '') AS h, lower(coalesce(vendor, '')) AS x FROM service_links) SELECT service_id, CASE WHEN h LIKE '%axisgis.com%' THEN 'AxisGIS' WHEN h LIKE '%mytaxbill.org%' THEN 'MyTaxBill' WHEN h LIKE '%governmentjobs.com%' THEN 'GovernmentJobs' WHEN h LIKE '%recdesk.com%' THEN 'RecDesk' WHEN x LIKE '%civicplus%' THEN 'CivicPlus' WHEN x LIKE '%governmentjobs%' THEN 'GovernmentJobs' END AS vendor FROM v")
def vendor_detect(spark, sf_dir):
    return spark_table(spark, sf_dir, "service_links").select("service_id", extract.vendor("url", "vendor")["vendor"].alias("vendor"))


@query(f"WITH {with_sql('service_links')} SELECT service_id, CASE WHEN regexp_matches(url, '^https?://') THEN regexp_extract(url, '^https?://', 0) || lower(regexp_extract(url, '^https?://([^/?#]*)', 1)) || regexp_replace(regexp_replace(url, '^https?://[^/?#]*', ''), '#.*$', '') END AS url FROM service_links")
def normalized_urls(spark, sf_dir):
    return spark_table(spark, sf_dir, "service_links").select("service_id", urls.normalize_absolute("url").alias("url"))


# ---- merges


@query(f"WITH RECURSIVE {with_sql('contacts')}, o AS (SELECT *, 'k' || CAST(seq // 8 AS VARCHAR) AS kid, row_number() OVER (PARTITION BY seq // 8 ORDER BY seq) AS i FROM contacts), f AS (SELECT kid, i, name, title, phone, email, confidence FROM o WHERE i = 1 UNION ALL SELECT o.kid, o.i, CASE WHEN f.name IS NULL OR o.confidence >= f.confidence THEN coalesce(o.name, f.name) ELSE f.name END, CASE WHEN f.title IS NULL OR o.confidence >= f.confidence THEN coalesce(o.title, f.title) ELSE f.title END, CASE WHEN f.phone IS NULL OR o.confidence >= f.confidence THEN coalesce(o.phone, f.phone) ELSE f.phone END, f.email, greatest(f.confidence, o.confidence) FROM f JOIN o ON o.kid = f.kid AND o.i = f.i + 1) SELECT kid AS contact_id, name, title, phone, email, round(confidence, 6) AS confidence FROM f QUALIFY row_number() OVER (PARTITION BY kid ORDER BY i DESC) = 1")
def upsert_contacts(spark, sf_dir):
    df = spark_table(spark, sf_dir, "contacts").withColumn("contact_id", F.concat(F.lit("k"), F.floor(F.col("seq") / 8).cast("string")))
    return rounded(merge.upsert_contacts(df), "confidence").select("contact_id", "name", "title", "phone", "email", "confidence")


@query(f"WITH {with_sql('signals')} SELECT signal_id, arg_max(CASE WHEN value IS NULL THEN '~' ELSE value END, seq) AS value, round(CASE WHEN count(confidence) = count(*) THEN max(confidence) END, 6) AS confidence FROM signals GROUP BY signal_id")
def upsert_signals(spark, sf_dir):
    out = merge.upsert_signals(spark_table(spark, sf_dir, "signals"))
    return out.select("signal_id", F.coalesce("value", F.lit("~")).alias("value"), F.round("confidence", 6).alias("confidence"))


@query(f"WITH {with_sql('locations')} SELECT municipality_id AS location_id, arg_max(address, seq) FILTER (address IS NOT NULL) AS address, arg_max(hours, seq) FILTER (hours IS NOT NULL) AS hours FROM locations GROUP BY 1")
def upsert_locations(spark, sf_dir):
    df = spark_table(spark, sf_dir, "locations").withColumn("location_id", F.col("municipality_id"))
    return merge.upsert_locations(df).select("location_id", "address", "hours")


# ---- mining


INVENTORY = f"""{ENRICHED}, pi AS (SELECT *, coalesce(nullif(regexp_replace(regexp_replace(lower(regexp_extract(trim(source_url), '^[a-z]+://[^/?#]*([^?#]*)', 1)), '/+', '/', 'g'), '/+$', ''), ''), '/') AS canonical_path, lower(coalesce(role_normalized, '') || ' ' || coalesce(role_family, '') || ' ' || coalesce(department_normalized, '') || ' ' || coalesce(title, '')) AS mb
  FROM enriched WHERE trim(ul) <> '' AND is_likely_noise = 0 AND (page_type IN ('staff_directory', 'department_page', 'contact_hub') OR (page_type = 'other' AND regexp_matches(ul, 'directory|department|government|finance|clerk|assessor|tax|building|planning|zoning|land-use|staff')))),
inv AS (SELECT *, CASE WHEN canonical_path LIKE '%directory%' OR canonical_path LIKE '%staffdirectory%' THEN 'directory' WHEN regexp_matches(canonical_path, 'finance|treasurer|comptroller') THEN 'finance' WHEN canonical_path LIKE '%clerk%' THEN 'clerk' WHEN regexp_matches(canonical_path, 'assessor|assessment') THEN 'assessor' WHEN canonical_path LIKE '%tax%' THEN 'tax' WHEN regexp_matches(canonical_path, 'building|inspectional|code-enforcement') THEN 'building' WHEN regexp_matches(canonical_path, 'planning|zoning|land-use') THEN 'planning' WHEN regexp_matches(canonical_path, '/departments|/government') THEN 'departments_root'
  WHEN regexp_matches(mb, 'finance|treasurer|comptroller') THEN 'finance' WHEN mb LIKE '%clerk%' THEN 'clerk' WHEN mb LIKE '%assessor%' THEN 'assessor' WHEN role_normalized = 'Tax Collector' OR role_family = 'tax_collector' OR ' ' || mb || ' ' LIKE '% tax %' OR mb LIKE '%tax-collector%' THEN 'tax' WHEN regexp_matches(mb, 'building|inspectional|inspection|code enforcement') THEN 'building' WHEN role_normalized = 'Planner' OR regexp_matches(mb, 'planning|zoning|land-use|land use') THEN 'planning' ELSE 'other' END AS category FROM pi)"""


@query(f"WITH {INVENTORY} SELECT contact_id, canonical_path, category FROM inv")
def path_inventory(spark, sf_dir):
    return mining.path_inventory(enriched(spark, sf_dir)).select("contact_id", "canonical_path", "category")


MINED = f"""{SCORED}, {INVENTORY.removeprefix(ENRICHED + ", ")}, pc0 AS (SELECT category, canonical_path, count(DISTINCT municipality_id) AS municipality_count, count(*) AS row_count, count(DISTINCT CASE WHEN municipality_id IN (SELECT municipality_id FROM winners) THEN municipality_id END) AS winner_backed_count, count(*) FILTER (page_type IN ('staff_directory', 'department_page')) AS pref FROM inv GROUP BY ALL),
pc1 AS (SELECT *, 3 * (municipality_count >= 2)::INT + 3 * (winner_backed_count > 0)::INT + 2 * (category NOT IN ('departments_root', 'other'))::INT + (pref > 0)::INT - 2 * (canonical_path IN ('/', '/home', '/index', '/contact-us'))::INT - 2 * regexp_matches(canonical_path, 'news|calendar|events|bid|alert')::INT AS score FROM pc0),
pc AS (SELECT *, regexp_matches(canonical_path, '/[0-9]+(/|$)')::INT AS is_numeric_slug, (canonical_path <> '/' AND NOT regexp_matches(canonical_path, '/[0-9]+(/|$)') AND regexp_matches(canonical_path, '^/[a-z0-9][a-z0-9/.-]*$'))::INT AS is_clean_slug, CASE WHEN canonical_path IN ('/', '/home', '/index', '/contact-us') OR score <= 1 THEN 'too_generic' WHEN score >= 7 THEN 'add_to_probe_list' ELSE 'review_manually' END AS recommendation FROM pc1)"""


@query(f"WITH {MINED} SELECT category, canonical_path, score, municipality_count, row_count, winner_backed_count, is_clean_slug, is_numeric_slug, recommendation FROM pc")
def path_candidates(spark, sf_dir):
    df = settled_enriched(spark, sf_dir)
    return mining.path_candidates(mining.path_inventory(df), cand.best_role_per_town(cand.score_candidates(df))).drop("example_municipalities")


@query(f"WITH {MINED} SELECT category, row_number() OVER (PARTITION BY category ORDER BY is_clean_slug DESC, score DESC, municipality_count DESC, row_count DESC, canonical_path)::INT AS rank, canonical_path FROM pc WHERE recommendation = 'add_to_probe_list' AND municipality_count >= 2 AND (is_numeric_slug = 0 OR municipality_count >= 3) AND category <> 'other' QUALIFY rank <= 10")
def probe_paths(spark, sf_dir):
    df = settled_enriched(spark, sf_dir)
    return mining.probe_paths(mining.path_candidates(mining.path_inventory(df), cand.best_role_per_town(cand.score_candidates(df))))


_sig = {g: " OR ".join(f"contains(kb, '{w if ' ' in w else f' {w} '}')" for w in words) for g, words in mining.GROUP_SIGNALS.items()}
_signals = " ".join(f"WHEN '{g}' THEN role_family = '{mining.GROUP_FAMILY[g]}' OR lower(coalesce(department_normalized, '')) IN ({', '.join(repr(d) for d in mining.GROUP_DEPARTMENTS[g])}) OR {_sig[g]}" for g in mining.GROUP_FAMILY)
SYNONYMS = f"""{SCORED}, {with_sql("municipalities")}, gr(g, members) AS (VALUES {', '.join(f"('{g}', {list(reports.ROLE_GROUPS[g])!r})" for g in mining.GROUP_FAMILY)}),
lack AS (SELECT m.municipality_id, g, members FROM municipalities m, gr WHERE NOT EXISTS (SELECT 1 FROM winners w WHERE w.municipality_id = m.municipality_id AND list_contains(members, w.role_normalized))),
sy AS (SELECT e.*, g, members, ' ' || trim(regexp_replace(lower(coalesce(e.title, '') || ' ' || coalesce(department, '') || ' ' || coalesce(source_context, '')), '[^a-z0-9]+', ' ', 'g')) || ' ' AS kb FROM enriched e JOIN lack USING (municipality_id) WHERE e.title IS NOT NULL OR f_dept),
sg AS (SELECT g AS role_group_target, lower(trim(coalesce(title, ''))) AS title_key, lower(trim(coalesce(department, ''))) AS department_key, count(DISTINCT municipality_id) AS municipality_count, count(*) AS contact_count, sum(coalesce(list_contains(members, role_normalized), FALSE)::INT)::BIGINT AS normalized_match_count, sum(is_likely_noise) AS n,
  count(*) FILTER (CASE g {' '.join(f"WHEN '{g}' THEN role_family = '{f}'" for g, f in mining.GROUP_FAMILY.items())} END) AS f, count(*) FILTER (CASE g {' '.join(f"WHEN '{g}' THEN lower(coalesce(department_normalized, '')) IN ({', '.join(repr(d) for d in ds)})" for g, ds in mining.GROUP_DEPARTMENTS.items())} END) AS d
  FROM sy WHERE coalesce(CASE g {_signals} END, FALSE) GROUP BY ALL), sh AS (SELECT *, trim(title_key || ' ' || department_key) AS tx FROM sg)"""


@query(f"WITH {SYNONYMS} SELECT role_group_target, title_key, department_key, municipality_count, contact_count, normalized_match_count, 3 * (f > 0)::INT + 3 * (d > 0)::INT + 2 * (municipality_count >= 2)::INT + 2 - 3 * (tx LIKE '%board%')::INT - 3 * (tx LIKE '%page%')::INT - 2 * (n > 0)::INT - 4 * (normalized_match_count = contact_count)::INT AS score, CASE WHEN n > 0 OR regexp_matches(tx, 'board|page') THEN 'likely_noise' WHEN role_group_target = 'finance' AND tx LIKE '%treasurer%' THEN 'map_to_treasurer' WHEN role_group_target = 'finance' AND regexp_matches(tx, 'finance|financial|cfo|comptroller|administrative services|business manager') THEN 'map_to_finance_director' WHEN role_group_target = 'clerk' AND tx LIKE '%clerk%' THEN 'map_to_town_clerk' WHEN role_group_target = 'building' AND regexp_matches(tx, 'building|inspector|inspection|code enforcement') THEN 'map_to_building_official' WHEN role_group_target = 'planning' AND regexp_matches(tx, 'planning|planner|land use|zoning|zeo') THEN 'map_to_planner' ELSE 'review_manually' END AS recommendation FROM sh")
def synonym_candidates(spark, sf_dir):
    df = settled_enriched(spark, sf_dir)
    missing = mining.missing_groups(towns(spark, sf_dir), cand.best_role_per_town(cand.score_candidates(df)))
    return mining.synonym_candidates(df, missing).drop("example_municipalities", "proposed_role_normalized")


# ---- reviews and recovery


REVIEWS = f"""{UNRESOLVED}, {SUSPICIOUS.removeprefix(SCORED + ", ")}, {MISSING.removeprefix(SCORED + ", ")}"""


@query(f"WITH {REVIEWS} SELECT municipality_id, 'suspicious_winner' AS review_type, role_normalized, contact_id, '' AS missing_role_groups FROM sus WHERE q1 OR sr <> '' OR q2 OR q3 OR q4 OR q5 OR q6 OR q7 OR is_likely_noise = 1 UNION ALL SELECT municipality_id, 'candidate_for_review', role_normalized, contact_id, '' FROM cand WHERE tagged AND candidate_state = 'candidate_for_review' UNION ALL SELECT municipality_id, 'unresolved_role', role_normalized, top_candidate_contact_id, '' FROM unresolved UNION ALL SELECT municipality_id, 'missing_role_groups_2plus', '', '', missing_role_groups FROM missing WHERE missing_group_count >= 2")
def manual_review_towns(spark, sf_dir):
    sc = settled_scored(spark, sf_dir)
    won = cand.best_role_per_town(sc)
    return reports.manual_review(reports.suspicious_winners(won), sc, cand.unresolved_roles(sc, won), reports.missing_key_roles(towns(spark, sf_dir), won))


NOTES = "concat('api_hit=', CAST(event_id % 2 AS {t}), '; API_type=', CASE event_id % 3 WHEN 0 THEN 'Swagger' WHEN 1 THEN 'rest_root' ELSE 'odd' END, ';deep_path_hits=', CASE WHEN event_id % 5 = 0 THEN 'x' ELSE CAST(event_id % 7 AS {t}) END, ';api_hit=9')"


@query(f"WITH n AS (SELECT event_id, string_split({NOTES.format(t='VARCHAR')}, ';') AS p FROM events) SELECT event_id, CAST(split_part(p[1], '=', 2) AS INT) AS api_hit, CASE WHEN lower(trim(split_part(p[2], '=', 2))) IN ('swagger', 'rest_root') THEN lower(trim(split_part(p[2], '=', 2))) ELSE 'none' END AS api_type, coalesce(try_cast(split_part(p[3], '=', 2) AS INT), 0) AS deep_path_hits FROM n")
def notes_parse(spark, sf_dir):
    notes = F.expr(NOTES.format(t="STRING"))
    df = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", notes.alias("notes"))
    return df.select("event_id", recovery.note_int("notes", "api_hit").alias("api_hit"), recovery.note_enum("notes", "api_type", recovery.API_TYPES, "none").alias("api_type"), recovery.note_int("notes", "deep_path_hits").alias("deep_path_hits"))


COUNTERS = {"directory_hit": "event_id % 2", "recovered_contact_count": "event_id % 3", "recovered_role_winner_count": "event_id % 5 % 2", "recovered_from_sitemap": "event_id % 7 % 2", "recovered_from_known": "event_id % 11 % 2", "has_any_200": "event_id % 13 % 2", "known_path_hits": "event_id % 4 % 2", "discovered_path_hits": "event_id % 17 % 2", "blocked_responses": "event_id % 19", "deep_path_hits": "event_id % 9 % 2", "deep_extraction_contact_total": "event_id % 23 % 2", "deep_html_candidate_count": "event_id % 6", "deep_extraction_attempt_count": "event_id % 8 % 3", "successful_api_probe_count": "event_id % 10 % 3", "likely_structured_endpoint_count": "event_id % 14 % 3", "documented_get_count": "event_id % 12 % 5", "api_hit": "event_id % 15 % 2"}
COUNTED = "SELECT event_id, CASE WHEN event_id % 3 = 1 THEN '/swagger.json' ELSE '' END AS swagger_json_path, " + ", ".join(f"{v} AS {k}" for k, v in COUNTERS.items()) + " FROM "


@query(f"WITH k AS ({COUNTED}events) SELECT event_id, CASE WHEN deep_path_hits > 0 THEN CASE WHEN recovered_contact_count > 0 AND recovered_role_winner_count > 0 THEN 'recovered_deep_path' WHEN recovered_contact_count > 0 OR deep_extraction_contact_total > 0 THEN 'partial_deep_path_recovery' ELSE 'deep_path_present_no_extract' END WHEN recovered_contact_count = 0 AND successful_api_probe_count > 0 AND likely_structured_endpoint_count > 0 THEN 'api_structured_data_found' WHEN recovered_contact_count = 0 AND swagger_json_path <> '' AND documented_get_count > 0 THEN 'api_inventory_viable' WHEN recovered_contact_count = 0 AND api_hit = 1 THEN 'api_available_no_scrape' WHEN directory_hit = 1 THEN CASE WHEN recovered_contact_count > 0 AND recovered_role_winner_count = 0 THEN 'partial_directory_recovery' WHEN recovered_contact_count > 0 THEN 'recovered_directory_hit' ELSE 'directory_present_no_extract' END WHEN recovered_contact_count > 0 THEN CASE WHEN recovered_from_sitemap = 1 THEN 'recovered_sitemap_path' WHEN recovered_from_known = 1 THEN 'recovered_known_path' ELSE 'partial_recovery' END WHEN has_any_200 = 1 AND known_path_hits > 0 THEN 'discovery_failure' WHEN known_path_hits > 0 OR discovered_path_hits > 0 THEN 'partial_recovery' WHEN blocked_responses >= 3 THEN 'unrecovered_http_block' ELSE 'recovered_manual_seed_needed' END AS recovery_result, CASE WHEN deep_path_hits > 0 THEN CASE WHEN deep_html_candidate_count <= 0 THEN 'no_html_candidate' WHEN deep_extraction_attempt_count <= 0 THEN 'guard_filtered_all_html' WHEN deep_extraction_contact_total <= 0 THEN 'extractor_returned_zero' WHEN recovered_contact_count <= 0 THEN 'upsert_no_net_new' ELSE 'none' END END AS zero_reason FROM k")
def recovery_result(spark, sf_dir):
    spark.read.parquet(f"{sf_dir}/events.parquet").createOrReplaceTempView("stage_events")
    return spark.sql(COUNTED + "stage_events").select("event_id", recovery.recovery_result().alias("recovery_result"), recovery.zero_reason().alias("zero_reason"))


PLANNED = [(i, k, p) for i, (k, p) in enumerate((k, p) for k in ("directory", "finance", "clerk", "assessor", "tax", "building", "planning", "departments_root") for p in recovery.DEEP_PATHS[k])]


@query("WITH " + with_sql("municipalities") + ", p(i, c, x) AS (VALUES " + ", ".join(f"({i}, '{k}', '{p}')" for i, k, p in PLANNED) + "), f AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY lower(x) ORDER BY i) = 1), o AS (SELECT row_number() OVER (ORDER BY i)::INT AS ordinal, c AS category, x AS path FROM f QUALIFY ordinal <= 20) SELECT municipality_id, ordinal, category, path, concat(rtrim(website_url, '/'), path) AS url FROM municipalities, o")
def deep_path_plan(spark, sf_dir):
    return recovery.deep_path_plan(towns(spark, sf_dir))


PROBES = "SELECT user_id % 25 AS municipality_id, event_id AS ordinal, CASE WHEN event_id * 7 % 11 < 6 THEN 403 ELSE 200 END AS status FROM "


@query(f"WITH p AS ({PROBES}events), a AS (SELECT *, status = 403 AND lag(status, 1, 0) OVER w = 403 AND lag(status, 2, 0) OVER w = 403 AS hit FROM p WINDOW w AS (PARTITION BY municipality_id ORDER BY ordinal)) SELECT municipality_id, ordinal FROM a WHERE ordinal <= coalesce((SELECT min(ordinal) FROM a b WHERE b.municipality_id = a.municipality_id AND b.hit), 9e18)")
def probes_until_blocked(spark, sf_dir):
    spark.read.parquet(f"{sf_dir}/events.parquet").createOrReplaceTempView("stage_events")
    return recovery.until_blocked(spark.sql(PROBES + "stage_events")).select("municipality_id", "ordinal")


# ---- pages read as documents: no SQL twin, tests hold the readers against golden pages


@query(f"WITH {LINKED}, t AS (SELECT municipality_id AS mid, domain FROM ({with_sql('municipalities').removeprefix('municipalities AS (')[:-1]})), c AS (SELECT *, regexp_replace(lower(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1)), '^www[.]', '') AS h FROM sc JOIN t ON mid = municipality_id) SELECT service_id FROM c WHERE h <> '' AND (h = domain OR suffix(h, '.' || domain))")
def internal_links(spark, sf_dir):
    df = spark_table(spark, sf_dir, "service_links").join(towns(spark, sf_dir).select("municipality_id", F.col("domain").alias("town_domain")), "municipality_id")
    host = urls.domain("url")
    return df.filter(host.isNotNull() & urls.is_internal(host, F.col("town_domain"))).select("service_id")


TOWN_DOMAINS = f"td AS (SELECT municipality_id AS mid, domain FROM ({with_sql('municipalities').removeprefix('municipalities AS (')[:-1]}))"
_hostof = "nullif(regexp_replace(lower(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1)), '^www[.]', ''), '')"
_any_path = lambda x, paths: f"regexp_matches({x}, '{'|'.join(paths)}')"
_files = lambda suffixes: "'(" + "|".join(x.replace(".", "[.]") for x in suffixes) + ")$'"
CHILD_SQL = f"""{LINKED}, {TOWN_DOMAINS}, ci AS (SELECT *, {_hostof} AS h, lower(regexp_extract(coalesce(url, ''), '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1)) AS p FROM sc JOIN td ON mid = municipality_id),
ck AS (SELECT *, CASE WHEN {_has(extract.DEPARTMENT_KEYWORDS + extract.OFFICIAL_KEYWORDS)} OR {_any_path('p', extract.CATEGORY_PATHS)} THEN 'directory_category_page' ELSE page_type END AS kind FROM ci WHERE domain <> '' AND (h = domain OR ends_with(h, '.' || domain)) AND NOT regexp_matches(u, {_files(extract.NON_HTML_SUFFIXES)})),
cs AS (SELECT *, score + {" + ".join(f"CASE WHEN {_has((w,))} THEN {v}::DOUBLE ELSE 0 END" for w, v in extract.BROAD_WEIGHTS.items())} + CASE WHEN kind = 'directory_category_page' THEN 3.4::DOUBLE WHEN kind IN ('official_page', 'department_page', 'directory_page', 'contact_page') THEN 1.6::DOUBLE ELSE 0 END - CASE WHEN contains(u, 'directory.aspx?eid=') THEN 1.25::DOUBLE ELSE 0 END + CASE WHEN kind IN ('department_page', 'contact_page', 'official_page') AND {_any_path('u', extract.KEY_ROLE_PATHS)} THEN 1.1::DOUBLE ELSE 0 END AS total FROM ck),
cb AS (SELECT municipality_id, url, round(max(total), 3) AS score FROM cs WHERE NOT (total < 1.2 AND kind = 'candidate') GROUP BY ALL)"""


@query(f"WITH {CHILD_SQL} SELECT *, CAST(row_number() OVER (PARTITION BY municipality_id ORDER BY score DESC, url) AS INT) AS rank FROM cb QUALIFY rank <= 8")
def child_links(spark, sf_dir):
    df = spark_table(spark, sf_dir, "service_links").join(towns(spark, sf_dir).select("municipality_id", F.col("domain").alias("town_domain")), "municipality_id")
    return extract.select_child_links(df, "municipality_id", F.col("town_domain"), F.lit("directory_page")).select("municipality_id", "url", "score", "rank")


@query("SELECT nullif(trim(regexp_replace(lower(n_name), '[^a-z0-9]+', ' ', 'g')), '') AS canonical, n_nationkey FROM nation")
def canonical_text(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/nation.parquet")
    return df.select(F.trim(t.keyword_blob("n_name")).alias("canonical"), "n_nationkey")


# ---- samples and traces


@query(f"WITH {ENRICHED}, {with_sql('municipalities', 'service_links', 'locations', 'signals')} SELECT m.municipality_id, (SELECT count(*) FROM enriched x WHERE x.municipality_id = m.municipality_id) AS contacts, {', '.join(f'coalesce((SELECT sum(has_{f}) FROM enriched x WHERE x.municipality_id = m.municipality_id), 0)::BIGINT AS with_{f}' for f in ('name', 'email', 'phone', 'department'))}, (SELECT count(*) FROM signals x WHERE x.municipality_id = m.municipality_id) AS signals, EXISTS (SELECT 1 FROM signals x WHERE x.municipality_id = m.municipality_id AND signal_type = 'crawl_diagnostics')::INT AS has_diagnostics, EXISTS (SELECT 1 FROM signals x WHERE x.municipality_id = m.municipality_id AND signal_type = 'blocked_recovery_status')::INT AS has_recovery, (SELECT count(*) FROM service_links x WHERE x.municipality_id = m.municipality_id) AS service_links, (SELECT count(*) FROM locations x WHERE x.municipality_id = m.municipality_id) AS locations FROM municipalities m")
def town_sample(spark, sf_dir):
    return reports.town_sample(towns(spark, sf_dir), enriched(spark, sf_dir), *[spark_table(spark, sf_dir, n) for n in ("service_links", "locations", "signals")])


@query(f"WITH {SCORED}, u AS (SELECT municipality_id, 1 AS k FROM enriched UNION ALL SELECT municipality_id, 2 FROM clean UNION ALL SELECT municipality_id, 3 FROM cand UNION ALL SELECT municipality_id, 4 FROM winners) SELECT municipality_id, count(*) FILTER (k = 1) AS loaded, count(*) FILTER (k = 2) AS clean, count(*) FILTER (k = 3) AS candidates, count(*) FILTER (k = 4) AS winners FROM u GROUP BY 1")
def stage_counts(spark, sf_dir):
    df = settled_enriched(spark, sf_dir)
    sc = cand.score_candidates(df)
    return reports.stage_counts(df, enrich.clean_contacts(df), sc, cand.best_role_per_town(sc))


#: Towns of the second priority stand in the manifest under ids that no table has.
LISTED = "CASE WHEN priority = '2' THEN concat('gone_', municipality_id) ELSE municipality_id END"


@query(f"WITH {with_sql('manifest', 'municipalities')}, m AS (SELECT {LISTED} AS municipality_id FROM manifest) SELECT municipality_id FROM m WHERE municipality_id NOT IN (SELECT municipality_id FROM municipalities)")
def manifest_missing_ids(spark, sf_dir):
    manifest = spark_table(spark, sf_dir, "manifest").withColumn("municipality_id", F.expr(LISTED))
    return reports.missing_ids(manifest, towns(spark, sf_dir))[1].select("municipality_id")


KINDS = ("staff_directory", "department_page", "contact_hub", "generic", "homepage", "board_page", "other", "archive")


@query(f"WITH {ENRICHED} SELECT v AS value, count(e.contact_id) AS n FROM (SELECT unnest({list(KINDS)!r}) AS v) LEFT JOIN enriched e ON e.page_type = v GROUP BY v")
def page_class_counts(spark, sf_dir):
    return reports.enum_counts(enriched(spark, sf_dir), "page_type", KINDS)


@query(f"WITH {with_sql('municipalities')}, s AS (SELECT concat('ct_nation_', CAST(user_id % 31 AS VARCHAR)) AS municipality_id, event_id, concat('{{\"api_hit\": ', CAST(event_id % 3 AS VARCHAR), ', \"api_type\": \"', event_type, '\"}}') AS value FROM events), l AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY municipality_id ORDER BY event_id DESC) = 1) SELECT m.municipality_id, coalesce(CAST(json_extract_string(value, '$.api_hit') AS INT), 0) AS api_hit, coalesce(json_extract_string(value, '$.api_type'), '') AS api_type, 0 AS deep_path_hits FROM municipalities m LEFT JOIN l USING (municipality_id)")
def recovery_status(spark, sf_dir):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    value = F.to_json(F.struct((F.col("event_id") % 3).alias("api_hit"), F.col("event_type").alias("api_type")))
    statuses = ev.select(F.concat(F.lit("ct_nation_"), (F.col("user_id") % 31).cast("string")).alias("municipality_id"), F.col("event_id").alias("seq"), value.alias("value"))
    return reports.recovery_status(towns(spark, sf_dir), statuses, {"api_hit": "int", "api_type": "string", "deep_path_hits": "int"})


@query(f"WITH {SCORED} SELECT 'contacts' AS name, count(*) AS rows, count(*) > 0 AS ok FROM contacts UNION ALL SELECT 'winners', count(*), count(*) > 0 FROM winners")
def pipeline_validation(spark, sf_dir):
    return reports.validate(contacts=spark_table(spark, sf_dir, "contacts"), winners=winners(spark, sf_dir))


CATALOG = ("municipalities", "contacts", "service_links", "locations", "signals", "manifest")


@query(" UNION ALL ".join(f"SELECT '{n}' AS table_name, column_name, filled FROM (UNPIVOT (SELECT count(COLUMNS(*)) FROM (WITH {with_sql(n)} SELECT * FROM {n})) ON COLUMNS(*) INTO NAME column_name VALUE filled)" for n in CATALOG))
def catalog_columns(spark, sf_dir):
    """The columns of the staged tables, and in how many rows each is filled."""
    out = None
    for n in CATALOG:
        df = spark_table(spark, sf_dir, n)
        counted = df.agg(F.array(*[F.struct(F.lit(c).alias("column_name"), F.count(c).alias("filled")) for c in df.columns]).alias("x"))
        one = counted.select(F.lit(n).alias("table_name"), F.inline("x"))
        out = one if out is None else out.unionByName(one)
    return out


from townlens.plans import gathering, staffing  # noqa: E402, F401  (register their queries)


def queries() -> dict[str, Query]:
    return dict(QUERIES)
