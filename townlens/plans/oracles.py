"""DuckDB twins of the queries, written by hand: a wrong rule table cannot hide in both sides."""

from __future__ import annotations

from townlens.sources.staging import with_sql

#: Contacts with every derived column. f_* say whether a text holds anything but spaces.
ENRICHED = f"""
{with_sql("contacts")},
n AS (
  SELECT *, coalesce(trim(name), '') <> '' AS f_name, coalesce(trim(title), '') <> '' AS f_title, coalesce(trim(department), '') <> '' AS f_dept,
    coalesce(trim(email), '') <> '' AS f_email, coalesce(trim(phone), '') <> '' AS f_phone,
    lower(trim(coalesce(name, ''))) AS nn, lower(trim(coalesce(title, ''))) AS tt, lower(trim(coalesce(department, ''))) AS dd,
    lower(coalesce(name, '')) AS nl, lower(coalesce(title, '')) AS tl, lower(coalesce(department, '')) AS dl,
    lower(coalesce(source_url, '')) AS ul, lower(coalesce(source_context, '')) AS cl
  FROM contacts
), n2 AS (
  SELECT *, CASE WHEN f_title THEN tt ELSE dd END AS rr, CASE WHEN f_dept THEN dd ELSE tt END AS xx,
    regexp_matches(nn, 'email|contact|office|department|town hall|click here|phone|fax|hours|board of|commission|committee') AS odd_name,
    length(trim(coalesce(source_url, ''))) - length(replace(trim(coalesce(source_url, '')), '/', '')) AS slashes
  FROM n
), n3 AS (
  SELECT *,
    f_name::INT AS has_name, f_email::INT AS has_email, f_phone::INT AS has_phone, f_dept::INT AS has_department,
    CASE WHEN f_name AND NOT odd_name THEN 'person' WHEN f_title THEN 'role' WHEN f_dept THEN 'department_contact' ELSE 'unknown' END AS entity_type,
    (nl LIKE 'email %' OR tl LIKE 'email %' OR dl LIKE 'email %' OR regexp_matches(nl, 'click here|title:') OR regexp_matches(tl, 'click here|title:') OR regexp_matches(dl, 'click here|title:')
      OR ((nl LIKE '%phone%' OR tl LIKE '%phone%') AND (regexp_matches(nl, 'board|commission|committee') OR regexp_matches(tl, 'board|commission|committee')))) AS action,
    CASE WHEN regexp_matches(ul, 'staff|directory|departments') OR regexp_matches(cl, 'staff|directory|departments') THEN 'staff_directory'
      WHEN regexp_matches(ul, 'assessor|tax|clerk|building|planning|zoning') THEN 'department_page'
      WHEN trim(ul) <> '' AND (slashes <= 3 OR regexp_matches(ul, '/index\\.|/home')) THEN 'homepage'
      WHEN regexp_matches(ul, 'board|commission|committee') OR regexp_matches(cl, 'board|commission|committee') THEN 'board_page'
      ELSE 'other' END AS page_type_legacy
  FROM n2
), n4 AS (
  SELECT *, (entity_type = 'role' OR (NOT f_name AND (f_title OR f_dept)))::INT AS is_role_only,
    (action OR nn LIKE 'the %' OR regexp_matches(nl, 'google maps|requested|hours|office|department|click|view|faq') OR length(trim(coalesce(name, ''))) > 80
      OR (f_name AND NOT regexp_matches(nn, '[a-z]'))
      OR (f_name AND f_title AND trim(replace(replace(replace(replace(nl, '.', ''), ',', ''), '-', ' '), '  ', ' ')) = trim(replace(replace(replace(replace(tl, '.', ''), ',', ''), '-', ' '), '  ', ' '))))::INT AS is_likely_noise,
    (action OR (f_name AND trim(regexp_replace(name, '[0-9()]', '', 'g')) = '') OR (f_title AND trim(regexp_replace(title, '[0-9()]', '', 'g')) = ''))::INT AS noise_legacy,
    coalesce(nullif(regexp_extract(cl, 'page_class=(staff_directory|department_page|contact_hub|generic)', 1), ''), page_type_legacy) AS page_type,
    CASE WHEN rr LIKE '%selectman%' THEN 'First Selectman' WHEN rr LIKE '%mayor%' THEN 'Mayor' WHEN rr LIKE '%town manager%' THEN 'Town Manager' WHEN rr LIKE '%town administrator%' THEN 'Town Administrator'
      WHEN rr LIKE '%assessor%' THEN 'Assessor'
      WHEN rr LIKE '%tax collector%' OR (tt IN ('revenue collector', 'tax office clerk', 'delinquent & deferral tax clerk') AND regexp_matches(dd, 'tax|revenue')) THEN 'Tax Collector'
      WHEN tt IN ('town and city clerk, registrar of vital statistics', 'town and city clerk', 'deputy town and city clerk', 'deputy town and city clerk, cctc', 'city clerk') OR rr LIKE '%town clerk%' THEN 'Town Clerk'
      WHEN rr LIKE '%building%' OR (dd LIKE '%building%' AND tt IN ('code official', 'code enforcement officer', 'zoning/code enforcement officer', 'zoning/ code enforcement officer')) THEN 'Building Official'
      WHEN tt = 'land use administrator' AND regexp_matches(dd, 'land use|planning|zoning') THEN 'Planner'
      WHEN tt = 'zoning administrator' AND regexp_matches(dd, 'planning|zoning') THEN 'Planner'
      WHEN rr LIKE '%land use%' THEN 'Land Use'
      WHEN regexp_matches(rr, 'planner|planning|zoning') THEN 'Planner'
      WHEN tt IN ('director of finance', 'title: director of finance', 'assistant director of finance', 'director of finance and revenue', 'director of finance and administration', 'administrative officer / director of finance')
        OR tt LIKE 'assistant director of finance -%' OR (tt IN ('finance manager', 'finance administrator', 'accounting manager') AND regexp_matches(dd, 'finance|treasurer')) OR rr LIKE '%finance director%' THEN 'Finance Director'
      WHEN rr LIKE '%treasurer%' THEN 'Treasurer' END AS role_normalized,
    CASE WHEN regexp_matches(rr, 'selectman|mayor|town manager|town administrator') THEN 'chief_executive' WHEN rr LIKE '%assessor%' THEN 'assessor'
      WHEN rr LIKE '%tax collector%' OR (tt IN ('revenue collector', 'tax office clerk', 'delinquent & deferral tax clerk') AND regexp_matches(dd, 'tax|revenue')) THEN 'tax_collector'
      WHEN rr LIKE '%town clerk%' THEN 'town_clerk' WHEN rr LIKE '%building%' THEN 'building' WHEN regexp_matches(rr, 'planner|planning|zoning|land use') THEN 'planning_zoning'
      WHEN regexp_matches(rr, 'treasurer|finance') OR (tt = 'accounting manager' AND regexp_matches(dd, 'finance|treasurer')) THEN 'finance' END AS role_family,
    CASE WHEN xx LIKE '%assessor%' THEN 'Assessor' WHEN xx LIKE '%tax collector%' THEN 'Tax Collector' WHEN xx LIKE '%town clerk%' THEN 'Town Clerk' WHEN xx LIKE '%building%' THEN 'Building'
      WHEN regexp_matches(xx, 'planning|zoning') THEN 'Planning & Zoning' WHEN regexp_matches(xx, 'finance|treasurer') THEN 'Finance' WHEN xx LIKE '%land use%' THEN 'Land Use'
      WHEN xx LIKE '%selectmen%' THEN 'Board of Selectmen' WHEN xx LIKE '%mayor%' THEN 'Mayor''s Office' WHEN regexp_matches(xx, 'town manager|town administrator') THEN 'Town Manager'
      WHEN f_dept THEN trim(department) END AS department_normalized
  FROM n3
), n5 AS (
  SELECT *, cl LIKE 'revize:%' AS tagged,
    CASE WHEN page_type IN ('staff_directory', 'directory') THEN NULL
      WHEN role_normalized = 'Finance Director' AND NOT f_dept THEN 'low_context'
      WHEN f_dept AND dd NOT IN ('staff', 'directory', 'staff directory') AND (
        (role_normalized = 'Assessor' AND NOT regexp_matches(dl, 'assessor|assessment')) OR (role_normalized = 'Tax Collector' AND NOT regexp_matches(dl, 'tax|revenue'))
        OR (role_normalized = 'Town Clerk' AND dl NOT LIKE '%clerk%') OR (role_normalized = 'Building Official' AND dl NOT LIKE '%building%')
        OR (role_normalized = 'Finance Director' AND NOT regexp_matches(dl, 'finance|treasurer'))) THEN 'role_department_mismatch' END AS s1
  FROM n4
), n6 AS (
  SELECT *, CASE WHEN s1 IS NOT NULL OR role_normalized IS NULL OR NOT tagged THEN s1
      WHEN NOT f_name OR regexp_matches(nl, ' street| avenue| road| lane| drive| ct | connecticut|[0-9][0-9][0-9][0-9][0-9]') THEN 'invalid_person_name'
      WHEN entity_type <> 'person' THEN 'non_person_role_candidate'
      WHEN page_type = 'contact_hub' AND (NOT f_title OR department_normalized IS NULL OR (NOT f_email AND NOT f_phone)) THEN 'contact_hub_candidate'
      WHEN ul LIKE '%contact%' AND (tl LIKE '%contact%' OR regexp_matches(nl, 'request|information')) THEN 'contact_hub_candidate'
      WHEN role_normalized IN ('First Selectman', 'Mayor', 'Town Manager', 'Town Administrator') AND (nl LIKE '%assistant%' OR tl LIKE '%assistant%') THEN 'assistant_role_contamination' END AS s2
  FROM n5
), n7 AS (
  SELECT *, CASE WHEN NOT tagged THEN s2
      WHEN regexp_matches(nn, 'affidavit|vacanc') OR nn IN ('building', 'tax collector', 'department', 'office') OR regexp_matches(' ' || nn || ' ', ' department | office ') THEN 'invalid_person_name'
      WHEN f_name AND (nn = tt OR nn = lower(coalesce(role_normalized, ''))) THEN 'role_only_name' ELSE s2 END AS suspicious_reason,
    coalesce(confidence, 0.0) + 0.15::DOUBLE * has_name + 0.10::DOUBLE * has_email + 0.05::DOUBLE * has_phone + 0.10::DOUBLE * (role_normalized IS NOT NULL)::INT + 0.05::DOUBLE * (department_normalized IS NOT NULL)::INT AS sc
  FROM n6
), n8 AS (
  SELECT *, greatest(0.0::DOUBLE, least(1.0::DOUBLE, sc + CASE page_type WHEN 'staff_directory' THEN 0.12::DOUBLE WHEN 'department_page' THEN 0.06::DOUBLE WHEN 'contact_hub' THEN -0.10::DOUBLE WHEN 'board_page' THEN 0.0::DOUBLE ELSE -0.12::DOUBLE END
      - 0.25::DOUBLE * is_likely_noise - 0.10::DOUBLE * (entity_type = 'unknown')::INT)) AS semantic_confidence,
    greatest(0.0::DOUBLE, least(1.0::DOUBLE, sc - 0.25::DOUBLE * noise_legacy - 0.10::DOUBLE * (entity_type = 'unknown')::INT)) AS semantic_legacy,
    lower(coalesce(trim(municipality_id), '') || '|' || coalesce(role_normalized, nullif(trim(title), ''), '') || '|' || coalesce(nullif(trim(email), ''), nullif(trim(phone), ''), nullif(trim(name), ''), '')) AS dedupe_key
  FROM n7
), n9 AS (
  SELECT *,
    row_number() OVER (PARTITION BY dedupe_key ORDER BY is_likely_noise, has_name DESC, has_email DESC, has_phone DESC, round(semantic_confidence, 9) DESC, coalesce(source_url, ''), contact_id)::INT AS record_rank,
    row_number() OVER (PARTITION BY dedupe_key ORDER BY has_name DESC, has_email DESC, has_phone DESC, noise_legacy, round(semantic_legacy, 9) DESC, coalesce(source_url, ''), contact_id)::INT AS rank_legacy,
    min(is_likely_noise) OVER (PARTITION BY dedupe_key) AS key_noise
  FROM n8
), enriched AS (
  SELECT * EXCLUDE (title), title AS raw_title,
    CASE WHEN record_rank = 1 THEN semantic_confidence ELSE greatest(0.0::DOUBLE, least(1.0::DOUBLE, semantic_confidence - 0.20::DOUBLE)) END AS display_confidence,
    CASE WHEN NOT f_title OR tl LIKE '%is responsible for%' OR len(string_split(trim(title), ' ')) > 12 OR (regexp_matches(title, '[.?!]') AND len(string_split(trim(title), ' ')) >= 6) THEN NULL ELSE trim(title) END AS title
  FROM n9
), clean AS (
  SELECT * FROM enriched e WHERE record_rank = 1 AND (is_likely_noise = 0 OR NOT EXISTS (SELECT 1 FROM enriched o WHERE o.dedupe_key = e.dedupe_key AND o.is_likely_noise = 0))
)"""

#: Candidates, winners and unresolved groups on top of ENRICHED.
SCORED = f"""{ENRICHED},
b AS (
  SELECT * EXCLUDE (tt), lower(trim(coalesce(title, ''))) AS tt, coalesce(trim(title), '') <> '' AS g_title, tagged::INT AS is_revize, lower(role_normalized) AS rn_, coalesce(suspicious_reason, '') AS sr,
    page_type = 'staff_directory' OR cl LIKE '%page_class=staff_directory%' AS on_staff, page_type = 'department_page' OR cl LIKE '%page_class=department_page%' AS on_dept, page_type = 'contact_hub' AS on_hub, f_email OR f_phone AS reach
  FROM enriched WHERE role_normalized IS NOT NULL
), s AS (
  SELECT *,
    CASE WHEN regexp_matches(cl, '^revize:(contact_card|profile_block)') THEN 'revize_profile_card' WHEN cl LIKE 'revize:reconstructed_contact_block%' OR (cl LIKE 'revize:labeled_staff%' AND on_staff) THEN 'revize_staff_table'
      WHEN cl LIKE 'revize:labeled_staff%' AND on_dept AND reach THEN 'revize_sidebar_contact' WHEN cl LIKE 'revize:department_section%' OR (cl LIKE 'revize:labeled_staff%' AND on_dept) THEN 'revize_content_body' ELSE '' END AS source_structure_type,
    4 * (entity_type = 'person')::INT + 4 * (f_name AND trim(name) LIKE '% %')::INT + 2 * (f_name AND trim(name) GLOB '[A-Z]* [A-Z]*')::INT + (f_name AND length(trim(name)) BETWEEN 5 AND 60)::INT
      - 8 * (nn = rn_ OR nn = tt OR nn = dd)::INT AS person_name_score,
    CASE WHEN on_staff THEN 5 WHEN cl LIKE 'revize:reconstructed_contact_block%' THEN 4 WHEN on_dept THEN 2 WHEN on_hub THEN -3 WHEN page_type IN ('generic', 'homepage', 'other') THEN -5 ELSE 0 END AS source_score,
    4 * (cl LIKE 'revize:reconstructed_contact_block%')::INT AS reconstruction_score,
    2 * f_email::INT + 2 * f_phone::INT + g_title::INT + f_dept::INT + (f_email AND f_phone)::INT AS contact_score,
    CASE WHEN sr = 'role_department_mismatch' THEN -6
      WHEN (role_normalized = 'Assessor' AND regexp_matches(dd, 'assessor|assessment')) OR (role_normalized = 'Tax Collector' AND regexp_matches(dd, 'tax|revenue')) OR (role_normalized = 'Town Clerk' AND dd LIKE '%clerk%')
        OR (role_normalized = 'Building Official' AND regexp_matches(dd, 'building|inspection|zoning')) OR (role_normalized IN ('Land Use', 'Planner') AND regexp_matches(dd, 'land use|planning|zoning'))
        OR (role_normalized IN ('Finance Director', 'Treasurer') AND regexp_matches(dd, 'finance|treasurer|accounting')) OR (role_normalized = 'First Selectman' AND regexp_matches(dd, 'selectman|board of selectmen'))
        OR (role_normalized = 'Mayor' AND dd LIKE '%mayor%') OR (role_normalized IN ('Town Manager', 'Town Administrator') AND regexp_matches(dd, 'town manager|town administrator')) THEN 3 ELSE 0 END AS department_score,
    CASE WHEN (role_normalized = 'Assessor' AND regexp_matches(tt || '~' || dd || '~' || ul, 'assessor')) OR (role_normalized = 'Assessor' AND dd LIKE '%assessment%')
        OR (role_normalized = 'Tax Collector' AND (regexp_matches(tt || '~' || dd, 'tax|revenue') OR ul LIKE '%tax%')) OR (role_normalized = 'Town Clerk' AND tt || '~' || dd || '~' || ul LIKE '%clerk%')
        OR (role_normalized = 'Building Official' AND (regexp_matches(tt || '~' || ul, 'building|inspection') OR regexp_matches(dd, 'building|inspection|zoning')))
        OR (role_normalized IN ('Land Use', 'Planner') AND (regexp_matches(tt, 'land use|planner|planning|zoning') OR regexp_matches(dd, 'land use|planning|zoning') OR regexp_matches(ul, 'land-use|planning|zoning')))
        OR (role_normalized = 'Finance Director' AND (regexp_matches(tt || '~' || dd, 'finance|treasurer|accounting') OR regexp_matches(ul, 'finance|treasurer')))
        OR (role_normalized = 'Treasurer' AND (regexp_matches(tt || '~' || dd || '~' || ul, 'treasurer') OR dd LIKE '%finance%')) OR (role_normalized = 'First Selectman' AND tt || '~' || dd || '~' || ul LIKE '%selectman%')
        OR (role_normalized = 'Mayor' AND tt || '~' || dd || '~' || ul LIKE '%mayor%')
        OR (role_normalized = 'Town Manager' AND (tt || '~' || dd LIKE '%town manager%' OR ul LIKE '%town_manager%')) OR (role_normalized = 'Town Administrator' AND (tt || '~' || dd LIKE '%town administrator%' OR ul LIKE '%town_administrator%')) THEN 6
      WHEN contains(tt, rn_) OR contains(dd, rn_) THEN 5 ELSE 0 END AS role_match_score,
    CASE sr WHEN 'role_department_mismatch' THEN -5 WHEN 'invalid_person_name' THEN -8 WHEN 'role_only_name' THEN -8 WHEN 'contact_hub_candidate' THEN -4 WHEN 'assistant_role_contamination' THEN -4 WHEN 'low_context' THEN -3 WHEN 'non_person_role_candidate' THEN -2 ELSE 0 END AS suspicious_score,
    tagged AND NOT f_name AS blank,
    tagged AND (regexp_matches(nn, 'your link name|click here|email me|affidavit|vacanc') OR nn IN ('link name', 'building', 'land use', 'tax collector', 'assessor', 'department', 'office') OR regexp_matches(' ' || nn || ' ', ' department | office ')) AS artifact,
    tagged AND entity_type = 'person' AND f_name AND (nn = rn_ OR nn = dd OR (nn IN ('building', 'land use', 'planning', 'assessor', 'tax', 'clerk', 'finance', 'zoning', 'office', 'department')
      AND (rn_ LIKE '%' || replace(nn, ' ', '%') || '%' OR dd LIKE '%' || replace(nn, ' ', '%') || '%' OR (nn IN ('land use', 'planning', 'zoning') AND coalesce(role_family, '') = 'planning_zoning')))) AS role_only,
    tagged AND cl LIKE '%page_class=department_page%' AND regexp_matches(cl, '^revize:(department_section|labeled_staff)')
      AND (nn IN ('adopted march', 'form') OR regexp_matches(nn, 'zoning regulations|certificate of zoning compliance|ordinance|regulations|application|permit|cover page|fees|requirements')) AS document,
    tagged AND is_likely_noise = 0 AND page_type <> 'contact_hub' AND NOT regexp_matches(nn, 'your link name|click here|email me|affidavit|vacanc') AND nn <> 'link name' AND NOT regexp_matches(tt, 'vacanc|share this page|click here') AND NOT regexp_matches(cl, 'share this page|copy and paste this code') AS allow_artifact,
    tagged AND is_likely_noise = 0 AND reach AS allow_source
  FROM b
), d AS (
  SELECT *, person_name_score + role_match_score + source_score + reconstruction_score + contact_score + department_score + suspicious_score AS candidate_score,
    CASE WHEN NOT tagged THEN '' WHEN role_only THEN 'invalid_person_name' WHEN document THEN 'revize_department_page_artifact' WHEN artifact AND NOT allow_artifact THEN 'artifact_name' WHEN blank THEN 'blank_name'
      WHEN sr IN ('invalid_person_name', 'role_only_name') AND NOT (artifact AND allow_artifact) THEN sr WHEN entity_type <> 'person' THEN 'non_person_contact'
      WHEN sr IN ('contact_hub_candidate', 'role_department_mismatch', 'assistant_role_contamination', 'low_context') THEN sr
      WHEN on_hub AND cl NOT LIKE 'revize:reconstructed_contact_block%' THEN 'contact_hub_candidate' WHEN NOT reach THEN 'missing_email_and_phone'
      WHEN person_name_score < 7 AND NOT (artifact AND allow_artifact) THEN 'weak_name_quality' WHEN role_match_score < 5 THEN 'weak_role_match'
      WHEN source_score + reconstruction_score < 3 AND NOT allow_source THEN 'weak_source_match' ELSE '' END AS winner_disqualifier_reason
  FROM s
), k AS (
  SELECT *, (tagged AND blank AND reach AND is_likely_noise = 0) AS fallback_ok,
    (NOT tagged OR (NOT artifact AND NOT document AND NOT role_only AND NOT blank AND entity_type = 'person' AND sr = '' AND person_name_score >= 7 AND role_match_score >= 5 AND source_score + reconstruction_score >= 3 AND contact_score >= 3 AND candidate_score >= 12))::INT AS high_confidence_eligible,
    (tagged AND NOT document AND NOT role_only AND NOT blank AND (NOT artifact OR allow_artifact) AND (sr NOT IN ('invalid_person_name', 'role_only_name') OR (artifact AND allow_artifact)) AND (f_name OR g_title OR f_dept) AND (reach OR g_title OR f_dept))::INT AS review_candidate_eligible
  FROM d
), r AS (
  SELECT *, row_number() OVER (PARTITION BY municipality_id, role_normalized ORDER BY candidate_score DESC, round(display_confidence, 9) DESC, contact_id)::INT AS candidate_rank,
    row_number() OVER (PARTITION BY municipality_id, role_normalized, high_confidence_eligible ORDER BY candidate_score DESC, round(display_confidence, 9) DESC, contact_id)::INT AS high_confidence_rank,
    (sum(high_confidence_eligible) OVER (PARTITION BY municipality_id, role_normalized))::BIGINT AS eligible_candidate_count
  FROM k
), cand AS (
  SELECT *, CASE WHEN high_confidence_eligible = 1 AND high_confidence_rank = 1 THEN 'high_confidence_winner' WHEN tagged AND review_candidate_eligible = 1 THEN 'candidate_for_review' WHEN tagged AND fallback_ok THEN 'role_only_fallback' ELSE 'disqualified' END AS candidate_state,
    (tagged AND (role_only OR document OR (artifact AND NOT allow_artifact) OR (sr IN ('invalid_person_name', 'role_only_name') AND NOT (artifact AND allow_artifact) AND NOT fallback_ok)))::INT AS invalid_candidate_disqualified,
    CASE WHEN NOT tagged THEN role_normalized WHEN role_family = 'building' THEN CASE WHEN regexp_matches(tt, 'assistant|inspector') THEN 'building_secondary' ELSE 'building_primary' END
      WHEN role_family = 'planning_zoning' THEN CASE WHEN regexp_matches(tt, 'director|planner') THEN 'planning_zoning_primary' WHEN regexp_matches(' ' || tt || ' ', 'assistant|zoning enforcement officer| zeo ') THEN 'planning_zoning_secondary' ELSE 'planning_zoning_primary' END
      WHEN role_family = 'assessor' THEN CASE WHEN tt LIKE '%assistant%' THEN 'assessor_secondary' ELSE 'assessor_primary' END ELSE coalesce(role_family, role_normalized) END AS role_group
  FROM r
), w0 AS (
  SELECT *, CASE candidate_state WHEN 'high_confidence_winner' THEN 1 WHEN 'candidate_for_review' THEN 2 ELSE 3 END AS tier FROM cand
  WHERE candidate_state = 'high_confidence_winner' OR candidate_state = 'role_only_fallback' OR (candidate_state = 'candidate_for_review' AND is_likely_noise = 0 AND winner_disqualifier_reason = '')
), winners AS (
  SELECT *, (tier <> 1)::INT AS forced_fallback FROM w0 QUALIFY row_number() OVER (PARTITION BY municipality_id, role_group ORDER BY tier,
    CASE WHEN f_name AND reach THEN 1 WHEN f_name THEN 2 WHEN reach THEN 3 ELSE 4 END,
    coalesce(list_position(['revize_profile_card', 'revize_staff_table', 'revize_sidebar_contact', 'revize_content_body'], source_structure_type), 5), candidate_score DESC, round(display_confidence, 9) DESC,
    CASE WHEN tt LIKE '%director%' THEN 1 WHEN tt LIKE '%chief%' THEN 2 WHEN tt LIKE '%official%' THEN 3 WHEN tt LIKE '%manager%' THEN 4 WHEN tt LIKE '%planner%' THEN 5 WHEN tt LIKE '%assistant%' THEN 6 ELSE 7 END, contact_id) = 1
)"""

UNRESOLVED = f"""{SCORED},
g AS (SELECT *, row_number() OVER (PARTITION BY municipality_id, role_group ORDER BY candidate_score DESC, round(display_confidence, 9) DESC, contact_id) AS gr FROM cand WHERE tagged),
unresolved AS (
  SELECT municipality_id, role_group, count(*) AS candidate_count, sum((candidate_state = 'candidate_for_review')::INT)::BIGINT AS review_candidate_count, sum(invalid_candidate_disqualified)::BIGINT AS invalid_candidate_disqualified_count,
    max(CASE WHEN gr = 1 THEN role_normalized END) AS role_normalized, max(CASE WHEN gr = 1 THEN contact_id END) AS top_candidate_contact_id, max(CASE WHEN gr = 1 THEN candidate_score END) AS top_candidate_score, max(CASE WHEN gr = 1 THEN candidate_state END) AS top_candidate_state,
    max(CASE WHEN gr = 1 THEN winner_disqualifier_reason END) AS top_candidate_winner_block_reason,
    CASE WHEN bool_or(reach AND (blank OR artifact OR sr IN ('invalid_person_name', 'role_only_name'))) AND bool_or(reach) THEN 'fragmented_contact_structure'
      WHEN bool_or(f_dept AND (NOT f_name OR blank) AND (NOT g_title OR regexp_matches(tt, 'department|office'))) AND NOT bool_or(f_name AND NOT blank AND NOT artifact) THEN 'department_only'
      WHEN NOT bool_or(f_name AND NOT blank AND NOT artifact) AND NOT bool_or(reach) THEN 'no_person_contact_available' ELSE 'no_valid_candidates_after_filtering' END AS unresolved_reason
  FROM g WHERE NOT EXISTS (SELECT 1 FROM winners w WHERE w.tagged AND w.municipality_id = g.municipality_id AND w.role_group = g.role_group) GROUP BY municipality_id, role_group
)"""
