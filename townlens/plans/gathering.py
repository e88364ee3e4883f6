"""Queries over what is gathered before rows are loaded; each has a twin, or golden values staged beside its input."""

from __future__ import annotations

from pyspark.sql import functions as F

from townlens.functions import places, text, urls
from townlens.operators import candidates as cand
from townlens.operators import enrich, extract, gather, merge, page_contacts, recovery, reports
from townlens.plans.oracles import ENRICHED, SCORED
from townlens.plans.queries import MISSING, TOWN_DOMAINS, _files, _has, _hostof, query, settled_enriched, towns, winners
from townlens.sources import files
from townlens.sources.staging import spark_table, with_sql

ROUTES = "directory|staff|department|government|town-clerk|tax|assessor|building|planning|zoning|finance|contact"


# ---- pages with contacts: the values that pages were made of are the truth


@query(f"WITH {with_sql('contact_pages')} SELECT page_id, name, title, phone, email, CASE layout WHEN 0 THEN 'table' WHEN 1 THEN 'contact_card' WHEN 2 THEN 'inline_staff_list' ELSE 'labeled_staff' END AS source_kind FROM contact_pages")
def contacts_read_from_pages(spark, sf_dir):
    return page_contacts.extract_contacts(spark_table(spark, sf_dir, "contact_pages")).select("page_id", "name", "title", "phone", "email", "source_kind")


@query(f"WITH {with_sql('contact_pages')} SELECT page_id, CASE address WHEN '12 Main Ave.' THEN '12 Main Avenue' WHEN '203 Middlesex Rd' THEN '203 Middlesex Road' WHEN '1 Oak blvd.' THEN '1 Oak Boulevard' ELSE address END AS address, 'Hours: Monday - Friday 9 am - 5 pm' AS hours FROM contact_pages")
def locations_read_from_pages(spark, sf_dir):
    return page_contacts.extract_locations(spark_table(spark, sf_dir, "contact_pages"))


@query(f"WITH {with_sql('contact_pages')} SELECT page_id, CASE WHEN layout IN (0, 1, 3) THEN 'directory' ELSE 'unknown' END AS kind FROM contact_pages")
def directory_page_kinds(spark, sf_dir):
    return page_contacts.page_kinds(spark_table(spark, sf_dir, "contact_pages").withColumn("status", F.lit(200)))


LOCATION_SQL = r"""
SELECT location_id, nullif(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(address, '\s*,\s*', ', ', 'g'), '\b[Aa]ve\b', 'Avenue', 'g'), '\b[Ss]t\b', 'Street', 'g'), '\.(\s|,|$)', '\1', 'g'), 'Connecticut', 'CT'), ' ,;'), '') AS address,
  CASE hours WHEN 'Mon-Fri 9-5' THEN 'Mon - Fri 9 - 5' WHEN 'and Mon ,Tue;8 -4' THEN 'Mon, Tue; 8 - 4' WHEN '9–5' THEN '9 - 5' END AS hours FROM locations"""


@query(f"WITH {with_sql('locations')} {LOCATION_SQL}")
def normal_locations(spark, sf_dir):
    return spark_table(spark, sf_dir, "locations").select("location_id", places.normal_address("address").alias("address"), places.normal_hours("hours").alias("hours"))


# ---- contact rows


@query(f"""WITH {with_sql('contacts')}, n AS (SELECT contact_id, nullif(trim(regexp_replace(name, '\\s+', ' ', 'g')), '') AS name, nullif(trim(regexp_replace(trim(regexp_replace(title, '\\s+', ' ', 'g')), '^(?i)email\\s+', ''), ' -:;,.'), '') AS title, lower(nullif(trim(email), '')) AS email, nullif(trim(phone), '') AS phone, confidence FROM contacts)
SELECT contact_id, name, title, email, phone, round(confidence, 6) AS confidence FROM n WHERE name IS NOT NULL AND regexp_matches(lower(name), '[a-z]') AND NOT contains(lower(name), 'staff directory') AND NOT regexp_matches(lower(name), '\\b(email|phone|contact|vacant)\\b')""")
def normalized_contacts(spark, sf_dir):
    return gather.normalize_contacts(spark_table(spark, sf_dir, "contacts")).select("contact_id", "name", "title", "email", "phone", F.round("confidence", 6).alias("confidence"))


RICH = "(4 * f_name::INT + 4 * f_title::INT + 2 * f_dept::INT + 5 * f_email::INT + 3 * f_phone::INT + (coalesce(trim(phone_ext), '') <> '')::INT + (coalesce(trim(address), '') <> '')::INT + (coalesce(trim(hours), '') <> '')::INT)"


@query(f"WITH {ENRICHED} SELECT contact_id, round(least(0.995, coalesce(confidence, 0) + 0.01 * {RICH}), 6) AS confidence FROM n")
def effective_confidence(spark, sf_dir):
    return spark_table(spark, sf_dir, "contacts").select("contact_id", F.round(gather.effective_confidence(), 6).alias("confidence"))


TUPLE = ("name", "title", "department", "email", "phone")


@query(f"WITH {with_sql('contacts')} SELECT contact_id FROM contacts QUALIFY row_number() OVER (PARTITION BY municipality_id, {', '.join(f'lower(trim(coalesce({f}, chr(32))))' for f in TUPLE)} ORDER BY seq) = 1")
def first_contact_rows(spark, sf_dir):
    return gather.first_of(spark_table(spark, sf_dir, "contacts"), TUPLE, "municipality_id").select("contact_id")


_ws = lambda f: f"nullif(trim(regexp_replace({f}, '\\s+', ' ', 'g')), '')"
_unlabelled = lambda f: f"nullif(trim(regexp_replace({_ws(f)}, '^(?i)email\\s+', ''), ' -:;,.'), '')"
_keyed = lambda x: f"trim(regexp_replace(lower(coalesce({x}, '')), '[^a-z0-9]+', ' ', 'g'))"
_rich = lambda t: "(" + " + ".join(f"CASE WHEN coalesce(trim({t}.{f}), '') <> '' THEN {w} ELSE 0 END" for f, w in gather.RICHNESS.items()) + ")"
_lead = lambda f: f"CASE WHEN n.rich > r.rich OR (n.rich = r.rich AND n.confidence >= r.confidence) THEN CASE WHEN coalesce(trim(n.{f}), '') <> '' THEN n.{f} ELSE r.{f} END ELSE CASE WHEN coalesce(trim(r.{f}), '') <> '' THEN r.{f} ELSE n.{f} END END AS {f}"
PAGE_FOLD = f"""{with_sql('contacts')}, mc AS (SELECT seq, source_url, {_ws('name')} AS name, {_unlabelled('title')} AS title, {_unlabelled('department')} AS department, lower(nullif(trim(email), '')) AS email, email_type, nullif(trim(phone), '') AS phone, nullif(trim(phone_ext), '') AS phone_ext, {_ws('address')} AS address, {_ws('hours')} AS hours, {_ws('source_context')} AS source_context, coalesce(confidence, {gather.DEFAULT_CONFIDENCE}) AS confidence FROM contacts),
mk AS (SELECT *, CASE WHEN email IS NOT NULL THEN 'email|' || email ELSE concat_ws('|', 'row', {_keyed('name')}, coalesce(nullif({_keyed('coalesce(title, department)')}, ''), {_keyed('phone')}), {_keyed('source_url')}) END AS k FROM mc WHERE name IS NOT NULL AND regexp_matches(lower(name), '[a-z]') AND NOT contains(lower(name), 'staff directory') AND NOT regexp_matches(lower(name), '\\b(email|phone|contact|vacant)\\b')),
mo AS (SELECT *, row_number() OVER (PARTITION BY source_url, k ORDER BY seq) AS i, count(*) OVER (PARTITION BY source_url, k) AS sightings, {_rich('mk')} AS rich FROM mk),
mr AS (SELECT source_url, k, i, sightings, confidence, {', '.join(gather.MERGED)}, rich FROM mo WHERE i = 1 UNION ALL SELECT *, {_rich('x')} AS rich FROM (SELECT r.source_url, r.k, n.i, r.sightings, greatest(r.confidence, n.confidence) AS confidence, {', '.join(map(_lead, gather.MERGED))} FROM mr r JOIN mo n ON n.source_url IS NOT DISTINCT FROM r.source_url AND n.k = r.k AND n.i = r.i + 1) x)"""


@query(f"WITH RECURSIVE {PAGE_FOLD} SELECT source_url, sightings::INT AS sightings, confidence, {', '.join(gather.MERGED)} FROM mr WHERE i = sightings")
def merged_page_contacts(spark, sf_dir):
    """A fold in order; also held against brute force in the tests."""
    return gather.merge_contacts(gather.normalize_contacts(spark_table(spark, sf_dir, "contacts")))


@query(f"WITH {with_sql('contacts')} SELECT contact_id, CASE WHEN coalesce(trim(email), '') <> '' THEN 'true' ELSE 'false' END AS has_email FROM contacts")
def exported_flags(spark, sf_dir):
    return enrich.enrich_contacts(spark_table(spark, sf_dir, "contacts")).select("contact_id", gather.true_false("has_email").alias("has_email"))


# ---- links


RANKED_SQL = "r AS (SELECT municipality_id, url, service_page_type AS part, row_number() OVER (PARTITION BY municipality_id, service_page_type ORDER BY confidence DESC, seq) AS rank FROM service_links WHERE service_page_type IS NOT NULL)"


@query(f"WITH {with_sql('service_links')}, {RANKED_SQL}, p AS (SELECT municipality_id, url, min((CASE WHEN part = 'internal_page' THEN CASE WHEN rank <= 9 THEN 1 ELSE 3 END ELSE CASE WHEN rank <= 3 THEN 2 ELSE 4 END END, rank)) AS spot FROM r WHERE coalesce(trim(url), '') <> '' GROUP BY ALL) SELECT municipality_id, url, CAST(row_number() OVER (PARTITION BY municipality_id ORDER BY spot, url) AS INT) AS place FROM p QUALIFY place <= 12")
def composed_links(spark, sf_dir):
    links = spark_table(spark, sf_dir, "service_links").filter("service_page_type IS NOT NULL")
    ranked = links.withColumn("rank", F.expr("row_number() OVER (PARTITION BY municipality_id, service_page_type ORDER BY confidence DESC, seq)"))
    kind = lambda k: ranked.filter(F.col("service_page_type") == k)
    return gather.compose_links(kind("internal_page"), kind("external_portal"), "municipality_id", 12)


@query(f"WITH {with_sql('service_links')}, o AS (SELECT municipality_id, url, min(seq) AS seq FROM service_links WHERE coalesce(trim(url), '') <> '' AND NOT regexp_matches(lower(url), '[.](jpg|jpeg|png|gif|svg|css|js|ico|zip)$') GROUP BY ALL) SELECT municipality_id, url, CAST(row_number() OVER (PARTITION BY municipality_id ORDER BY seq, url) AS INT) AS place, CAST(0.5 AS DOUBLE) AS score, 'internal_fallback' AS reasons FROM o QUALIFY place <= 25")
def unscored_links(spark, sf_dir):
    return gather.unscored_links(spark_table(spark, sf_dir, "service_links"), "municipality_id").withColumn("score", F.col("score").cast("double"))


@query(f"WITH {with_sql('service_links')} SELECT contact.municipality_id, contact.url, CAST(row_number() OVER (PARTITION BY municipality_id ORDER BY coalesce(category, ''), confidence DESC, seq) AS INT) AS place FROM service_links contact")
def ordered_candidates(spark, sf_dir):
    from pyspark.sql import Window

    order = gather.candidate_order(F.coalesce("category", F.lit("")), F.col("confidence"), F.col("seq"))
    return spark_table(spark, sf_dir, "service_links").withColumn("place", F.row_number().over(Window.partitionBy("municipality_id").orderBy(*order))).select("municipality_id", "url", "place")


PROBED_SQL = f"""{with_sql('service_links')}, {TOWN_DOMAINS}, pk AS (SELECT municipality_id, url, td.domain, lower(coalesce(url, '')) AS u, ' ' || trim(regexp_replace(lower(coalesce(url, '')), '[^a-z0-9]+', ' ', 'g')) || ' ' AS k, {_hostof} AS h FROM service_links JOIN td ON mid = municipality_id),
pc AS (SELECT *, {_has(extract.DIRECTORY_KEYWORDS + extract.CONTACT_KEYWORDS + extract.OFFICIAL_KEYWORDS + extract.DEPARTMENT_KEYWORDS)} AS contact, {' + '.join(f"contains(u, '{x}')::INT" for x in gather.PROBE_HINTS)} AS hints FROM pk WHERE (h = domain OR ends_with(h, '.' || domain)) AND NOT regexp_matches(u, {_files(gather.FILE_SUFFIXES)})),
pb AS (SELECT municipality_id, url, round(max(hints + CASE WHEN contact THEN 1.5::DOUBLE ELSE 0 END + 0.15::DOUBLE), 3) AS score FROM pc WHERE contact OR hints > 0 GROUP BY ALL)"""


@query(f"WITH {PROBED_SQL} SELECT *, CAST(row_number() OVER (PARTITION BY municipality_id ORDER BY score DESC, url) AS INT) AS place FROM pb QUALIFY place <= 4")
def discovered_probe_urls(spark, sf_dir):
    """Top four of each town."""
    links = spark_table(spark, sf_dir, "service_links").join(towns(spark, sf_dir).select("municipality_id", F.col("domain").alias("town_domain")), "municipality_id")
    return gather.discovered_probes(links.withColumn("kind", F.lit("sitemap")), "municipality_id", "town_domain")


@query(f"WITH {with_sql('service_links')} SELECT municipality_id, vendor, url, round(confidence, 6) AS confidence FROM service_links WHERE coalesce(trim(vendor), '') <> '' QUALIFY row_number() OVER (PARTITION BY municipality_id, vendor ORDER BY coalesce(confidence, 0) DESC, seq) = 1")
def vendor_best(spark, sf_dir):
    return gather.vendor_best(spark_table(spark, sf_dir, "service_links"), "municipality_id").withColumn("confidence", F.round("confidence", 6))


WORDS = ("tax", "building", "permit", "jobs", "staff directory", "clerk", "agenda")


@query(f"WITH {with_sql('service_links')}, b AS (SELECT concat(' ', trim(regexp_replace(lower(concat(coalesce(label, ''), ' ', coalesce(url, ''))), '[^a-z0-9]+', ' ', 'g')), ' ') AS t FROM service_links), h AS (SELECT unnest({list(WORDS)!r}) AS reason) SELECT reason, count(*) AS n FROM h JOIN b ON contains(t, CASE WHEN contains(reason, ' ') THEN reason ELSE concat(' ', reason, ' ') END) GROUP BY reason")
def reason_histogram(spark, sf_dir):
    from townlens.operators.extract import link_blob

    return gather.reason_histogram(spark_table(spark, sf_dir, "service_links").select(gather.listed_keywords(link_blob("url", "label"), WORDS).alias("reasons")))


# ---- attempts and towns


@query(f"WITH {with_sql('attempts')} SELECT event_id, CASE WHEN kind = 'blocked' OR status IN (401, 403, 429) THEN 'blocked_or_forbidden' WHEN status = 404 THEN 'not_found' WHEN status IS NULL THEN 'other_http_error' WHEN status IN (301, 302, 303, 307, 308) THEN 'redirect_only' WHEN status >= 500 THEN 'other_http_error' WHEN coalesce(body, '') = '' THEN 'empty_response' WHEN kind = 'js_shell' THEN 'ok_js_shell' WHEN kind = 'directory' THEN 'ok_directory' WHEN redirects > 0 AND final_url <> '' AND final_url <> url THEN 'redirect_only' ELSE 'other_http_error' END AS outcome FROM attempts")
def attempt_outcomes(spark, sf_dir):
    c = F.col
    return spark_table(spark, sf_dir, "attempts").select("event_id", gather.attempt_outcome(c("status"), c("kind"), F.coalesce(c("body"), F.lit("")) != "", c("redirects"), c("final_url"), c("url"), c("status").isNotNull()).alias("outcome"))


@query(f"WITH {with_sql('attempts')} SELECT event_id, CASE WHEN status = 403 THEN CASE WHEN contains(headers, 'cf-ray') OR contains(headers, 'cloudflare') THEN 'cloudflare_403' WHEN regexp_matches(lower(headers), 'akamai|incapsula') THEN 'bot_protection_403' END END AS guard FROM attempts")
def blocked_homepages(spark, sf_dir):
    headers = F.str_to_map("headers", F.lit("; *"), F.lit(": *"))
    return spark_table(spark, sf_dir, "attempts").select("event_id", gather.blocked_homepage(F.col("status"), headers).alias("guard"))


FLAGS_SQL = """f AS (SELECT municipality_id, max((signal_type = 'blocked_homepage' AND value IS NOT NULL)::INT) AS blocked_homepage, arg_min(lower(trim(value)), seq) FILTER (signal_type = 'blocked_homepage' AND value IS NOT NULL) AS blocked_homepage_value,
 max((signal_type = 'crawl_status' AND lower(trim(value)) = 'homepage_fetch_failed')::INT) AS homepage_fetch_failed, max((signal_type = 'alternate_seed_attempted' AND lower(trim(value)) IN ('true', '1', 'yes', 'attempted'))::INT) AS alternate_seed_attempted FROM fallback_signals GROUP BY 1)"""


@query(f"WITH {with_sql('municipalities', 'fallback_signals', 'locations')}, {FLAGS_SQL} SELECT m.municipality_id, coalesce(f.blocked_homepage, 0)::INT AS blocked_homepage, f.blocked_homepage_value, coalesce(f.homepage_fetch_failed, 0)::INT AS homepage_fetch_failed, coalesce(f.alternate_seed_attempted, 0)::INT AS alternate_seed_attempted, (coalesce(f.homepage_fetch_failed, 0) * EXISTS (SELECT 1 FROM locations l WHERE l.municipality_id = m.municipality_id)::INT)::INT AS recovered_after_homepage_failure FROM municipalities m LEFT JOIN f USING (municipality_id)")
def fallback_flags(spark, sf_dir):
    return gather.fallback_status(towns(spark, sf_dir), spark_table(spark, sf_dir, "fallback_signals"), spark_table(spark, sf_dir, "locations"))


@query(f"WITH {with_sql('vendor_names')} SELECT p_partkey, CASE WHEN coalesce(trim(vendor), '') = '' THEN '(blank)' WHEN lower(trim(vendor)) LIKE 'quasar internet%' THEN 'Quasar Internet Solutions' ELSE CASE lower(trim(vendor)) WHEN 'revize' THEN 'Revize' WHEN 'town web' THEN 'TownWeb' WHEN 'townweb' THEN 'TownWeb' WHEN 'quasar' THEN 'Quasar' WHEN 'wordpress' THEN 'Wordpress' ELSE trim(vendor) END END AS vendor FROM vendor_names")
def vendor_names(spark, sf_dir):
    return spark_table(spark, sf_dir, "vendor_names").select("p_partkey", reports.vendor_name("vendor").alias("vendor"))


@query(f"WITH {with_sql('contacts')} SELECT contact_id, coalesce(name, '') AS name, coalesce(email, '') AS email FROM contacts WHERE contact_id NOT IN (SELECT contact_id FROM contacts WHERE email IS NULL)")
def evidence_for_new_contacts(spark, sf_dir):
    df = spark_table(spark, sf_dir, "contacts")
    claim = lambda f: F.get_json_object("field_claims_json", f"$.{f}").alias(f)
    return reports.evidence(df, df.filter("email IS NULL")).select("contact_id", claim("name"), claim("email"))


@query(f"WITH {SCORED} SELECT municipality_id, role_normalized, name, email, phone, department, source_url FROM winners WHERE NOT f_email OR (role_normalized = 'Assessor' AND contains(ul, 'tax')) OR (role_normalized = 'Tax Collector' AND contains(ul, 'clerk')) OR (role_normalized = 'Town Clerk' AND contains(ul, 'planning')) OR contains(nl, 'assistant')")
def legacy_suspicious_winners(spark, sf_dir):
    return reports.legacy_suspicious(winners(spark, sf_dir))


CLEANED = {f: f"coalesce(trim(regexp_replace({f}, ' +', ' ', 'g')), '')" for f in ("title", "department", "source_context", "role_family", "role_normalized", "department_normalized")}


@query(f"WITH {MISSING}, x AS (SELECT municipality_id, {', '.join(f'{v} AS {k}' for k, v in CLEANED.items())} FROM enriched) SELECT x.municipality_id, town_name, array_to_string(list_sort(string_split(missing_role_groups, '; ')), '; ') AS missing_role_groups, {', '.join(CLEANED)}, count(*) AS count_rows FROM x JOIN missing m ON m.municipality_id = x.municipality_id WHERE title <> '' OR department <> '' GROUP BY ALL")
def role_gap_inventory(spark, sf_dir):
    df = settled_enriched(spark, sf_dir)
    return reports.role_gaps(df, reports.missing_key_roles(towns(spark, sf_dir), cand.best_role_per_town(cand.score_candidates(df))))


# ---- manifests, names and signals of crawls


@query(f"WITH {with_sql('municipalities')} SELECT municipality_id, name AS town_name, county, 'batch_x' AS batch_id, '1' AS priority, 'pending' AS status, '' AS notes FROM municipalities WHERE lower(trim(coalesce(platform, ''))) <> 'civicplus' AND coalesce(trim(platform), '') <> ''")
def manifest_of_other_platforms(spark, sf_dir):
    return files.manifest_of(towns(spark, sf_dir), "CivicPlus", "batch_x", exclude=True, keep_blank=False)


@query(f"WITH {with_sql('manifest')} SELECT municipality_id, batch_id, status FROM manifest WHERE lower(trim(batch_id)) = 'batch_2'")
def manifest_batch(spark, sf_dir):
    return files.select_manifest(spark_table(spark, sf_dir, "manifest"), " Batch_2 ").select("municipality_id", "batch_id", "status")


@query(f"WITH {with_sql('municipalities')} SELECT municipality_id, array_to_string(list_transform(string_split(replace(substr(municipality_id, 4), '_', ' '), ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS shown, concat('https://', domain) AS homepage FROM municipalities")
def shown_towns(spark, sf_dir):
    return towns(spark, sf_dir).select("municipality_id", text.display_name("municipality_id").alias("shown"), urls.with_scheme("domain").alias("homepage"))


@query(f"WITH {with_sql('contacts')}, p AS (SELECT contact_id, lower(regexp_extract(coalesce(source_url, ''), '^(?:[a-zA-Z]+://[^/?#]*)?([^?#]*)', 1)) AS p FROM contacts) SELECT contact_id, CASE WHEN contains(p, 'building-department') THEN 'Building Department' WHEN contains(p, 'tax-collector') THEN 'Tax Collector' WHEN contains(p, 'assessor') THEN 'Assessor' WHEN contains(p, 'town-clerk') THEN 'Town Clerk' WHEN contains(p, 'planning') THEN 'Planning' WHEN contains(p, 'zoning') THEN 'Zoning' WHEN contains(p, 'public-works') THEN 'Public Works Department' WHEN contains(p, 'human-resources') THEN 'Human Resources' END AS department FROM p")
def url_departments(spark, sf_dir):
    return spark_table(spark, sf_dir, "contacts").select("contact_id", extract.url_department("source_url").alias("department"))


@query(f"WITH {with_sql('attempts')}, a AS (SELECT *, concat(kind, ' Access DENIED') AS title, CASE WHEN redirects = 1 THEN 'please enable javascript' ELSE coalesce(body, '') END AS t, (event_id % 3000)::INT AS n, (event_id % 4)::INT AS links FROM attempts) SELECT event_id, CASE WHEN kind = 'blocked' OR contains(lower(t), 'cloudflare') THEN 1 ELSE 0 END AS block, CASE WHEN status = 200 AND (contains(t, 'enable javascript') OR n <= 1200 OR (n > 0 AND links <= 1)) THEN 1 ELSE 0 END AS shell, round(least(0.99, 0.35 + n / 10.0 + 0.4 * 0.5), 6)::DOUBLE AS confidence FROM a")
def crawl_signals(spark, sf_dir):
    df = spark_table(spark, sf_dir, "attempts").withColumns({"t": F.when(F.col("redirects") == 1, "please enable javascript").otherwise(F.coalesce("body", F.lit(""))), "n": (F.col("event_id") % 3000).cast("int"), "links": (F.col("event_id") % 4).cast("int")})
    title = F.when(F.col("kind") == "blocked", "Access DENIED").otherwise(F.col("kind"))
    confidence = F.round(extract.service_confidence(F.col("n"), F.lit(0.5)), 6).alias("confidence")
    return df.select("event_id", extract.block_signal(title, "t").alias("block"), extract.shell_signal(F.col("status"), F.lit(""), "t", F.col("n"), F.col("links")).alias("shell"), confidence)


@query(f"WITH {with_sql('attempts')} SELECT event_id, concat_ws(';', 'status=' || status, 'kind=' || kind, 'final=' || final_url) AS notes FROM attempts")
def recovery_notes(spark, sf_dir):
    return spark_table(spark, sf_dir, "attempts").select("event_id", recovery.notes_of(status=F.col("status"), kind=F.col("kind"), final=F.col("final_url")).alias("notes"))


@query(f"WITH {with_sql('service_links')}, k AS (SELECT *, concat(municipality_id, '|', coalesce(category, '')) AS id FROM service_links) SELECT id AS service_id, arg_min_null(url, seq) AS url, arg_max(label, seq) AS label, arg_max(vendor, seq) AS vendor, CASE WHEN count(confidence) = count(*) THEN round(max(confidence), 6) END AS confidence FROM k GROUP BY id")
def upsert_service_links(spark, sf_dir):
    df = spark_table(spark, sf_dir, "service_links").withColumn("service_id", F.concat("municipality_id", F.lit("|"), F.coalesce("category", F.lit(""))))
    return merge.upsert_service_links(df).select("service_id", "url", "label", "vendor", F.round("confidence", 6).alias("confidence"))


@query(f"WITH {with_sql('service_links')} SELECT municipality_id, arg_max_null(label, seq) AS label, arg_max_null(vendor, seq) AS vendor FROM service_links GROUP BY 1")
def upsert_municipalities(spark, sf_dir):
    return merge.upsert_municipalities(spark_table(spark, sf_dir, "service_links").select("municipality_id", "label", "vendor", "seq"))


def _held(words: tuple[str, ...], weight: float) -> str:
    return " + ".join(f"CASE WHEN contains(b, '{w if ' ' in w else f' {w} '}') THEN {weight} ELSE 0 END" for w in words)


DEPARTMENT_SQL = f"""d AS (SELECT contact_id, x, trim(lower(trim(regexp_replace(coalesce(x, ''), '\\s+', ' ', 'g'), ' -:;,.'))) AS l FROM (SELECT contact_id, unnest([title, department]) AS x FROM contacts)),
e AS (SELECT *, concat(' ', trim(regexp_replace(l, '[^a-z0-9]+', ' ', 'g')), ' ') AS b FROM d),
s AS (SELECT *, CASE WHEN length(l) < 3 OR length(l) > 120 OR list_contains({list(gather.MENU_TEXTS)!r}, l) OR contains(l, 'click here') THEN 0 ELSE {_held(gather.STRONG_DEPARTMENTS, 2.2)} + {_held(gather.ENTITIES, 1.3)} + {_held(gather.FUNCTIONS, 1.0)} + CASE WHEN l LIKE 'board of %' THEN 1.2 ELSE 0 END END AS score FROM e)"""


@query(f"WITH {with_sql('contacts')}, {DEPARTMENT_SQL} SELECT contact_id, x AS text, round(score, 6)::DOUBLE AS score, score >= CASE WHEN regexp_matches(b, ' (assessor|clerk|collector|treasurer|registrar) ') AND len(list_filter(string_split(trim(coalesce(x, '')), ' '), lambda w: w <> '')) <= 4 THEN 0.9 ELSE 2.4 END AS is_department FROM s")
def department_scores(spark, sf_dir):
    df = spark_table(spark, sf_dir, "contacts").select("contact_id", F.explode(F.array("title", "department")).alias("text"))
    return df.select("contact_id", "text", gather.department_score("text").alias("score"), gather.reads_as_department("text").alias("is_department"))


ROLLED = "r AS (SELECT municipality_id, max((signal_type = 'blocked_homepage')::INT) AS b, max(CASE WHEN signal_type = 'blocked_homepage' THEN value END) AS v, max((signal_type = 'crawl_status' AND lower(trim(value)) = 'homepage_fetch_failed')::INT) AS f, max((signal_type = 'alternate_seed_attempted' AND lower(trim(value)) IN ('true', '1', 'yes', 'attempted'))::INT) AS a FROM fallback_signals GROUP BY 1)"


@query(f"WITH {with_sql('municipalities', 'fallback_signals')}, {ROLLED} SELECT m.municipality_id, m.name, CASE WHEN coalesce(b, 0) = 1 THEN 'true' ELSE 'false' END AS blocked_homepage, coalesce(v, '') AS blocked_homepage_value, CASE WHEN coalesce(a, 0) = 1 THEN 'true' ELSE 'false' END AS alternate_seed_attempted, 'false' AS alternate_seed_recovered FROM municipalities m LEFT JOIN r USING (municipality_id) WHERE coalesce(b, 0) = 1 OR coalesce(f, 0) = 1 OR coalesce(a, 0) = 1")
def troubled_towns(spark, sf_dir):
    return gather.troubled_towns(towns(spark, sf_dir), spark_table(spark, sf_dir, "fallback_signals"))


COUNTED = ("contacts", "service_links", "locations", "signals", "diagnostics")


@query(f"WITH {with_sql('municipalities', *COUNTED)} SELECT m.municipality_id, {', '.join(f'(SELECT count(*) FROM {n} x WHERE x.municipality_id = m.municipality_id) AS {n}' for n in COUNTED)} FROM municipalities m")
def table_counts(spark, sf_dir):
    return gather.table_counts(towns(spark, sf_dir), **{n: spark_table(spark, sf_dir, n) for n in COUNTED})


@query(f"WITH {with_sql('signals')} SELECT coalesce(signal_type, 'unknown') AS signal_type, count(*) AS n FROM signals GROUP BY 1")
def signal_type_counts(spark, sf_dir):
    return spark_table(spark, sf_dir, "signals").groupBy(F.coalesce("signal_type", F.lit("unknown")).alias("signal_type")).agg(F.count("*").alias("n"))


@query(f"WITH {ENRICHED}, {with_sql('manifest')} SELECT contact_id, role_normalized, record_rank FROM enriched WHERE municipality_id IN (SELECT municipality_id FROM manifest WHERE batch_id = 'batch_3')")
def enriched_batch(spark, sf_dir):
    """Only the contacts of a batch are enriched: ranks are by a key that holds the town."""
    return enrich.enrich_contacts(gather.of_batch(spark_table(spark, sf_dir, "contacts"), spark_table(spark, sf_dir, "manifest"), "batch_3")).select("contact_id", "role_normalized", "record_rank")


@query(f"""WITH {SCORED}, w AS (SELECT cl, lower(coalesce(page_type, '')) AS p, forced_fallback FROM winners WHERE cl LIKE 'revize:%')
SELECT (SELECT count(*) FROM cand WHERE tagged) AS candidates_scored, (SELECT count(*) FROM cand WHERE tagged AND candidate_state = 'candidate_for_review') AS candidates_for_review, (SELECT count(*) FROM cand WHERE tagged AND invalid_candidate_disqualified = 1) AS invalid_candidates_disqualified,
 (SELECT count(*) FROM w) AS winners_selected, (SELECT count(*) FROM w WHERE cl LIKE '%page_class=staff_directory%' OR p = 'staff_directory') AS winners_from_staff_directory, (SELECT count(*) FROM w WHERE cl LIKE '%page_class=department_page%' OR p = 'department_page') AS winners_from_department_pages, (SELECT count(*) FROM w WHERE cl LIKE '%page_class=contact_hub%' OR p = 'contact_hub') AS winners_from_contact_hubs,
 (SELECT count(*) FROM w WHERE cl LIKE 'revize:reconstructed_contact_block%') AS reconstructed_winners, (SELECT count(*) FROM w WHERE forced_fallback = 1) AS forced_fallback_winners,
 (SELECT count(*) FROM (SELECT DISTINCT municipality_id, role_normalized FROM cand WHERE tagged EXCEPT SELECT municipality_id, role_normalized FROM winners)) AS roles_with_no_winner""")
def tagged_metrics(spark, sf_dir):
    df = settled_enriched(spark, sf_dir)
    sc = cand.score_candidates(df)
    return reports.tagged_metrics(sc, cand.best_role_per_town(sc), df)
