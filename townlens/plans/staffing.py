"""Queries over staff pages: contacts from scattered text nodes, titles near names, links, kinds of pages. Those over html read
the given `pages` as well as the staged ones, whose parts are known to their twins."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from townlens.functions import people
from townlens.operators import candidates as cand
from townlens.operators import enrich, fragments, merge, nearest, normalize_staff, page_evidence, recovery, reports, routes, trace
from townlens.operators import recovery_rows as recovery_rows_op
from townlens.operators import staff_pages as staff_pages_op
from townlens.plans.oracles import SCORED, UNRESOLVED
from townlens.plans.queries import query, settled_enriched
from townlens.sources.shared import settled
from townlens.sources.staging import pool, spark_table, spread, with_sql


def staff_pages(spark, sf_dir):
    """The given pages and the staged staff pages, told apart by the sign of their id."""
    given = spark.read.parquet(f"{sf_dir}/pages.parquet").select((-F.col("page_id").cast("long") - 1).alias("page_id"), "url", "html")
    return given.unionByName(spark_table(spark, sf_dir, "staff_pages").select(F.col("page_id").cast("long").alias("page_id"), "url", "html"))


#: The staged blocks with what the rules make of them. No given page has a block of a staff class.
REBUILT = rf"""{with_sql('staff_pages')},
parts AS (SELECT page_id, url, heading, CASE WHEN heading IS NOT NULL THEN heading_title END AS span, line, more, mail, tel, page_title FROM staff_pages WHERE class NOT IN ('news', 'resource-link staff')),
listed AS (SELECT *, list_filter([regexp_replace(heading, '\s+', ' ', 'g'), span, line, more, CASE WHEN mail IS NOT NULL THEN 'write' END, CASE WHEN tel IS NOT NULL THEN 'call' END], lambda x: x IS NOT NULL) AS lines FROM parts),
found AS (SELECT *, array_to_string(lines, ' ') AS t0 FROM listed WHERE mail IS NOT NULL OR tel IS NOT NULL OR contains(more, '@') OR regexp_matches(array_to_string(lines, ' | '), '[2-9][0-9]{{2}}\)?[\s.-]?[0-9]{{3}}[\s.-]?[0-9]{{4}}') OR (heading IS NOT NULL AND regexp_matches(array_to_string(lines, ' '), '[0-9]'))),
j1 AS (SELECT *, regexp_replace(t0, '\b([0-9]{{2}})\s+([0-9][\s.\-]?[0-9]{{3}}[\s.\-]?[0-9]{{4}})', '\1\2', 'g') AS t1, len(regexp_extract_all(t0, '\b([0-9]{{2}})\s+([0-9][\s.\-]?[0-9]{{3}}[\s.\-]?[0-9]{{4}})')) AS n1 FROM found),
j2 AS (SELECT *, regexp_replace(t1, '([0-9])\s+((?:x|ext\.?|extension)\s*[0-9]{{1,6}}\b)', '\1\2', 'g') AS t2, len(regexp_extract_all(t1, '([0-9])\s+((?:x|ext\.?|extension)\s*[0-9]{{1,6}}\b)')) AS n2 FROM j1),
j3 AS (SELECT *, regexp_replace(t2, '\b([0-9]{{3}})\s+([0-9]{{3}})\s+([0-9]{{4}})\b', '\1-\2-\3', 'g') AS t3, len(regexp_extract_all(t2, '\b([0-9]{{3}})\s+([0-9]{{3}})\s+([0-9]{{4}})\b')) AS n3 FROM j2),
named AS (SELECT *, n1 + n2 + n3 AS joins, CASE WHEN heading IS NOT NULL THEN regexp_replace(heading, '\s+', ' ', 'g') WHEN line LIKE 'Ann Bell%' THEN 'Ann Bell' WHEN more LIKE 'Robert%' THEN 'Cruz III' END AS name,
  coalesce(CASE WHEN mail IS NOT NULL THEN 'pat.lee@t.example.org' END, CASE WHEN contains(more, '@') THEN 'jane.doe@t.example.org' END) AS email FROM j3),
titled AS (SELECT *, coalesce(span, list_filter(lines[1:5], lambda x: regexp_matches(lower(x), 'clerk|assessor') AND x IS DISTINCT FROM name)[1]) AS title,
  CASE WHEN tel LIKE '%0199' THEN '2035550199' WHEN tel IS NOT NULL THEN '8605550101' WHEN line LIKE '20 3%' THEN '2035550142' WHEN line LIKE '203 555%' THEN '2035550143' WHEN line LIKE 'Fax%' THEN '2035550000' WHEN line LIKE '(860)%' THEN '8605550144' WHEN line LIKE 'fax%' THEN '2035550002' END AS phone,
  CASE WHEN tel IS NOT NULL THEN NULL WHEN line LIKE '20 3%' THEN '12' WHEN line LIKE '(860)%' THEN '9' END AS phone_ext,
  CASE WHEN page_title = 'Assessor Department' THEN 'Assessor' WHEN page_title = 'Welcome' THEN 'Welcome' WHEN page_title LIKE 'Office of%' THEN 'Of Land Use'
    WHEN span IN ('Town Clerk', 'Chief Assessor') THEN array_to_string(list_transform(string_split(replace(lower(concat(regexp_replace(heading, '\s+', ' ', 'g'), ' ', span)), '-', ' '), ' '), lambda w: upper(w[1]) || w[2:]), ' ') WHEN url LIKE '%land_use%' THEN 'Land Use' WHEN url LIKE '%building%' THEN 'Building Inspection' WHEN url LIKE '%police%' THEN NULL END AS department FROM named),
judged AS (SELECT *, CASE WHEN joins = 0 AND mail IS NOT NULL AND tel IS NOT NULL THEN 'already_structured_sidebar' WHEN name = 'Position Vacant' THEN 'vacancy_name' WHEN name IS NULL THEN 'missing_name' WHEN name = 'Madonna' AND title IS NULL THEN 'invalid_person_name' WHEN coalesce(title, email, phone) IS NULL THEN 'missing_supporting_signal' END AS rejection_reason FROM titled)"""


@query(f"WITH {REBUILT} SELECT page_id::BIGINT AS page_id, name, title, department, email, phone, phone_ext, t3 AS source_context, 'reconstructed_contact_block' AS source_kind FROM judged WHERE rejection_reason IS NULL")
def reconstructed_contacts(spark, sf_dir):
    fields = ("page_id", "name", "title", "department", "email", "phone", "phone_ext", "source_context", "source_kind")
    return fragments.reconstructed_contacts(staff_pages(spark, sf_dir)).select(*fields)


@query(f"WITH {REBUILT} SELECT coalesce(rejection_reason, 'accepted') AS reason, count(*) AS blocks, sum(joins)::BIGINT AS joins FROM judged GROUP BY 1")
def reconstruction_reasons(spark, sf_dir):
    return fragments.rejection_counts(fragments.reconstruct(fragments.staff_blocks(staff_pages(spark, sf_dir))))


# ---- links: every href of the given pages, and relative forms of all kinds on urls of all kinds


#: References as pages write them, bases that they are read against.
HREFS = ("../staff_directory.php", "./contact_us?x=1", "//Other.example.org/government/a/../b", "/departments/finance/#top", "tax-collector.php#top", "?page=2", "mailto:x@y.z", "https://t.example.org/assessor/./land-use", "read-more", "../../../town-clerk/..", "a//b/../profile", "", "#top", "/x/./y/../planning/")
HREF_LABELS = ("Staff", "Tax &amp; more", "<b>Read</b> more", "", "Employee Profile", "Town Clerk", "Contact us", "x", "Mayor")
BASES = ("https://t.example.org/departments/index.php", "https://T.example.org/a/b/c?x=1", "http://t.example.org", "https://t.example.org/town/", "https://t.example.org/staff/a/b/")


def _anchor(k: int) -> str:
    return f"'<a class=\"l\" href=\"', {pool(HREFS, f'c_custkey * 3 + {k} * 5 + c_nationkey')}, '\">', {pool(HREF_LABELS, f'c_custkey + {k} * 2 + c_nationkey')}, '</a> '"


ANCHORS = f"concat({_anchor(0)}, {_anchor(1)}, {_anchor(2)})"

def linked_pages(spark, sf_dir):
    """The given pages, and one for each customer with three anchors of the kinds above."""
    spread(spark.read.parquet(f"{sf_dir}/customer.parquet"), "c_custkey").createOrReplaceTempView("stage_customer")
    given = spark.read.parquet(f"{sf_dir}/pages.parquet").select((-F.col("page_id").cast("long") - 1).alias("page_id"), "url", "html")
    return given.unionByName(spark.sql(f"SELECT CAST(c_custkey AS BIGINT) AS page_id, {pool(BASES, 'c_custkey')} AS url, {ANCHORS} AS html FROM stage_customer"))


#: Anchors with their targets: the cases of a reference one by one, dot segments by a fold over strings.
RESOLVED = rf"""staged AS (SELECT CAST(c_custkey AS BIGINT) AS page_id, ['{"', '".join(BASES)}'][c_custkey % {len(BASES)} + 1] AS base, unnest([0, 1, 2]) AS k, c_custkey, c_nationkey FROM customer),
asked AS (SELECT page_id, base, k::INT AS place, ['{"', '".join(HREFS)}'][(c_custkey * 3 + k * 5 + c_nationkey) % {len(HREFS)} + 1] AS href, ['{"', '".join(HREF_LABELS)}'][(c_custkey + k * 2 + c_nationkey) % {len(HREF_LABELS)} + 1] AS raw_label FROM staged
  UNION ALL SELECT -page_id::BIGINT - 1, url, unnest(range(len(hs)))::INT, unnest(hs), unnest(ls) FROM (SELECT page_id, url, regexp_extract_all(html, '(?is)<a\b[^>]*?href="([^"]+)"[^>]*>(.*?)</a>', 1) AS hs, regexp_extract_all(html, '(?is)<a\b[^>]*?href="([^"]+)"[^>]*>(.*?)</a>', 2) AS ls FROM pages)),
split AS (SELECT * REPLACE (CAST(row_number() OVER (PARTITION BY page_id ORDER BY place) - 1 AS INT) AS place), trim(regexp_replace(replace(regexp_replace(raw_label, '<[^>]*>', ' ', 'g'), '&amp;', '&'), '\s+', ' ', 'g')) AS label, regexp_extract(base, '^(https?)://([^/?#]*)([^?#]*)', ['scheme', 'host', 'path']) AS b, regexp_extract(href, '^([^?#]*)', 1) AS p, regexp_extract(href, '(\?[^#]*)', 1) AS q FROM asked WHERE href <> ''),
whole AS (SELECT *, CASE WHEN regexp_matches(href, '^[a-z]+:') THEN href WHEN starts_with(href, '//') THEN b.scheme || ':' || p || q WHEN p = '' THEN b.scheme || '://' || b.host || b.path || CASE WHEN q <> '' THEN q ELSE regexp_extract(base, '(\?[^#]*)', 1) END END AS fixed,
  CASE WHEN starts_with(p, '/') THEN string_split(p[2:], '/') ELSE list_filter(string_split(regexp_replace(b.path, '^/|[^/]*$', '', 'g'), '/'), lambda x: x <> '') || list_filter(string_split(p, '/')[:-2], lambda x: x <> '') || string_split(p, '/')[-1:] END AS segments FROM split),
folded AS (SELECT *, list_reduce(list_prepend('', segments), lambda acc, x: CASE WHEN x = '..' THEN regexp_replace(acc, '/[^/]*$', '') WHEN x = '.' THEN acc ELSE acc || '/' || x END) || CASE WHEN segments[-1] IN ('.', '..') THEN '/' ELSE '' END AS path FROM whole),
targets AS (SELECT page_id, base, place, href, nullif(label, '') AS label, regexp_replace(CASE WHEN fixed IS NOT NULL THEN CASE WHEN starts_with(fixed, 'http') THEN fixed END ELSE b.scheme || '://' || b.host || CASE WHEN path = '' THEN '/' ELSE path END || q END, '#.*$', '') AS found FROM folded),
links AS (SELECT page_id, base, place, href, coalesce(label, '') AS label, regexp_extract(found, '^https?://', 0) || lower(regexp_extract(found, '^https?://([^/?#]*)', 1)) || regexp_replace(found, '^https?://[^/?#]*', '') AS url FROM targets)"""


@query(f"WITH {RESOLVED} SELECT page_id, place, href, label, url FROM links")
def resolved_links(spark, sf_dir):
    return routes.anchors(linked_pages(spark, sf_dir)).select("page_id", "place", "href", "label", "url")


_any = lambda x, words: "regexp_matches(" + x + ", '" + "|".join(words) + "')"
CHOSEN = rf"""{RESOLVED}, once AS (SELECT *, lower(url || ' ' || label) AS said FROM links WHERE url IS NOT NULL QUALIFY row_number() OVER (PARTITION BY page_id, url ORDER BY place) = 1),
kinds AS (SELECT *, CASE WHEN {_any('said', ('read more', 'profile'))} THEN 'single_profile_page' WHEN contains(said, 'staff_directory.php') THEN 'staff_directory_php' WHEN contains(said, 'departments/index') THEN 'department_index_page' WHEN contains(said, 'contact_us') THEN 'contact_hub_path' WHEN contains(said, 'contact') THEN 'contact_path' ELSE 'unknown' END AS source_kind FROM once),
classed AS (SELECT *, CASE WHEN {_any("said || ' ' || source_kind", ('staff_directory', 'staff directory'))} THEN 'staff_directory' WHEN contains(lower(url), '/departments/') THEN 'department_page' WHEN {_any("said || ' ' || source_kind", ('contact_us', '/contact', 'contact us', 'services'))} THEN 'contact_hub' ELSE 'generic' END AS class, {_any('said', routes.ROLE_TERMS)} AS role FROM kinds),"""
_score = "CASE page_class WHEN 'staff_directory' THEN 126 WHEN 'department_page' THEN 85 WHEN 'contact_hub' THEN 45 ELSE 15 END"
_rank = "CAST(row_number() OVER (PARTITION BY page_id ORDER BY CASE page_class WHEN 'staff_directory' THEN 0 WHEN 'department_page' THEN 1 WHEN 'contact_hub' THEN 2 ELSE 3 END, score DESC, place) AS INT)"


@query(f"WITH {CHOSEN} kept AS (SELECT *, class AS page_class FROM classed WHERE {_any('said', routes.HARVEST)}), scored AS (SELECT *, {_score} + 5 + CASE WHEN role THEN 10 ELSE 0 END AS score FROM kept) SELECT page_id, url, label, source_kind, page_class, score::INT AS score, {_rank} AS rank FROM scored QUALIFY rank <= {routes.MOST}")
def profile_links(spark, sf_dir):
    return routes.profile_links(linked_pages(spark, sf_dir))


@query(f"WITH {CHOSEN} kept AS (SELECT *, CASE WHEN class = 'generic' THEN 'department_page' ELSE class END AS page_class FROM classed WHERE role OR regexp_matches(lower(url), '/departments/|/government/')), scored AS (SELECT *, {_score} + 12 + CASE WHEN role THEN 18 ELSE 0 END AS score FROM kept) SELECT page_id, url, label, source_kind, page_class, score::INT AS score, {_rank} AS rank FROM scored QUALIFY rank <= {routes.MOST}")
def department_links(spark, sf_dir):
    return routes.department_links(linked_pages(spark, sf_dir))


# ---- titles near names: addresses of mail in the given texts, the capitalised word before each as its name, and as titles the
# capitalised words of eight letters or more, for these texts name no office


@query(r"""WITH t AS (SELECT doc_id, unnest(string_split(text, ' ')) AS w, unnest(range(len(string_split(text, ' ')))) AS place FROM documents WHERE text IS NOT NULL),
n AS (SELECT *, CASE WHEN regexp_matches(w, '^[A-Z][a-z]') THEN place END AS cap FROM t),
a AS (SELECT doc_id, place AS anchor, max(cap) OVER (PARTITION BY doc_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS name, w FROM n),
l AS (SELECT doc_id, place, w AS title FROM t WHERE regexp_matches(w, '^[A-Z][a-z]{7,}$')),
c AS (SELECT a.doc_id, anchor, a.name, place, title, 10 * abs(place - coalesce(a.name, anchor)) + abs(place - anchor) AS cost FROM (SELECT * FROM a WHERE contains(w, '@')) a LEFT JOIN l ON a.doc_id = l.doc_id)
SELECT doc_id, anchor, name, place AS title_at, title FROM c QUALIFY row_number() OVER (PARTITION BY doc_id, anchor ORDER BY cost, place) = 1""")
def nearest_titles(spark, sf_dir):
    words = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.posexplode(F.split("text", " ", -1)).alias("place", "w")).withColumn("place", F.col("place").cast("long"))
    before = Window.partitionBy("doc_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    named = words.withColumn("name", F.max(F.when(F.col("w").rlike("^[A-Z][a-z]"), F.col("place"))).over(before))
    asks = named.filter(F.col("w").contains("@")).select("doc_id", F.col("place").alias("anchor"), "name")
    return nearest.nearest_titles(words.filter(F.col("w").rlike("^[A-Z][a-z]{7,}$")).select("doc_id", "place", F.col("w").alias("title")), asks)


# ---- kinds of staff pages: given pages, staff blocks and contact pages with further parts


PARTS = ("", "<aside id=\"staff-dr\"><div class=\"staff\">a</div><div class=\"x staff\">b</div><div class=\"staffed\">c</div></aside>", "<h2>Finance <b>Department</b></h2>", "<p>Home > Departments > Tax</p>", "<p>Contact Us</p><p>Directory of Services</p>", "<p>Clerk: Ann</p>", "<p>Email a@b.org 203-555-0100 read more c@d.org 203-555-0101 READ more</p>", "<p>Staff directory: email and phone</p>", "<table><tr><td>Name</td><td>Office phone</td></tr></table>", "<p>read more</p>", "<strong>Town Hall</strong>")
KIND_URLS = ("https://t.example.org/staff_directory.php", "https://t.example.org/departments/x/", "https://t.example.org/contact_us", "https://t.example.org/x", "https://t.example.org/staff-directory/a", "https://t.example.org/contacts", None)


def kind_pages(spark, sf_dir):
    """The given pages; and contact pages with a part of every kind behind them, some without their own text."""
    rows = spark_table(spark, sf_dir, "contact_pages").createOrReplaceTempView("stage_contact_pages")  # noqa: F841
    given = spark.read.parquet(f"{sf_dir}/pages.parquet").select((-F.col("page_id").cast("long") - 1).alias("page_id"), "url", "html", F.lit(None).cast("int").alias("status"))
    return given.unionByName(spark.sql(f"SELECT CAST(page_id AS BIGINT) AS page_id, {KIND_COLUMNS} FROM stage_contact_pages"))


KIND_COLUMNS = f"{pool(KIND_URLS, 'page_id * 2')} AS url, concat(CASE WHEN page_id % 3 = 0 THEN html ELSE '' END, {pool(PARTS, 'page_id')}, CASE WHEN page_id % 5 = 0 THEN {pool(PARTS, 'page_id * 7 + 3')} ELSE '' END) AS html, {pool((200, None, 404, 302), 'page_id', 'INT')} AS status"
_count = lambda x, p: f"len(regexp_extract_all({x}, {p}))"
KINDS = rf"""{with_sql('contact_pages')},
kp AS (SELECT page_id::BIGINT AS page_id, {KIND_COLUMNS.replace('STRING', 'VARCHAR').replace('AS string', 'AS VARCHAR')} FROM contact_pages UNION ALL SELECT -page_id::BIGINT - 1, url, html, NULL FROM pages),
kt AS (SELECT *, lower(coalesce(url, '')) AS u, trim(regexp_replace(regexp_replace(html, '(?s)<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS t, regexp_extract_all(html, '(?is)<table[^>]*>(.*?)</table>', 1) AS tables FROM kp),
kc AS (SELECT *, lower(t) AS b, {_count("regexp_extract(html, '(?is)<aside[^>]*id=.staff-dr.[^>]*>(.*?)</aside>', 1)", "'(?is)<div[^>]*class=.([^>]* )?staff( [^>]*)?.>'")} AS sidebar_staff_hits, {_count('html', "'contact-name'")} AS contact_card_hits,
  (contains(lower(html), 'mailto:') AND regexp_matches(t, '\b[A-Z][a-zA-Z''`.-]+(?:\s+[A-Z][a-zA-Z''`.-]+){{1,2}}\s*,\s*[A-Za-z]'))::INT AS inline_staff_hits, regexp_matches(t, '(?i)\b(manager|clerk|director|administrator|assessor|collector|chief)\s*:\s*[A-Z]')::INT AS labeled_staff_hits,
  coalesce(list_max(list_transform(tables, lambda x: len(list_filter(['name', 'title', 'department', 'phone', 'email', 'location', 'profession', 'office'], lambda w: contains(lower(CASE WHEN contains(x, '<th') THEN array_to_string(regexp_extract_all(x, '<th>(.*?)</th>', 1), '|') ELSE regexp_extract(x, '<tr>(.*?)</tr>', 1) END), w))))), 0) AS header_hits,
  least(len(list_distinct(list_transform(regexp_extract_all(html, '(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{{2,}}\b'), lambda x: lower(x)))), len(list_distinct(list_transform(regexp_extract_all(t, '\(?[2-9][0-9]{{2}}\)?[\s.-]?[0-9]{{3}}[\s.-]?[0-9]{{4}}'), lambda x: x))), greatest({_count('lower(t)', "'read more'")}, 1)) AS profile_block_hits,
  len(list_filter(regexp_extract_all(html, '(?is)<(?:h1|h2|h3|h4|strong)[^>]*>(.*?)</(?:h1|h2|h3|h4|strong)>', 1), lambda x: regexp_matches(lower(regexp_replace(x, '<[^>]*>', ' ', 'g')), 'administration|finance|police|fire|public works|clerk|assessor|tax collector|zoning|planning|human resources|department|office|division|town hall|city hall'))) AS department_section_hits,
  (contains(lower(t), 'departments') AND (contains(t, ' > ') OR contains(lower(t), 'breadcrumb')))::INT AS breadcrumb_department_hits, CASE WHEN contains(u, 'contact_us') THEN 2 ELSE 0 END + contains(lower(t), 'contact us')::INT + contains(lower(t), 'directory of services')::INT AS contact_hub_hits,
  len(list_filter(['name', 'title', 'department', 'phone', 'email', 'location', 'profession'], lambda k: regexp_matches(lower(t), '\b' || k || '\s*[:-]'))) AS key_value_hits, {_count('lower(t)', "'read more'")} AS read_more_hits FROM kt),
ks AS (SELECT *, CASE WHEN sidebar_staff_hits > 0 THEN 'sidebar_staff' WHEN contact_card_hits > 0 THEN 'contact_card' WHEN inline_staff_hits > 0 THEN 'inline_staff_list' WHEN labeled_staff_hits > 0 THEN 'labeled_staff' WHEN key_value_hits >= 3 AND profile_block_hits <= 1 AND header_hits = 0 THEN 'single_profile_page' WHEN header_hits >= 2 THEN 'table_directory' WHEN profile_block_hits >= 2 THEN 'profile_block' WHEN department_section_hits > 0 THEN 'department_section' ELSE 'unknown' END AS source_type,
  (status IS NULL OR status BETWEEN 200 AND 399) AND (sidebar_staff_hits + contact_card_hits + inline_staff_hits + labeled_staff_hits > 0 OR header_hits >= 2 OR profile_block_hits >= 2 OR key_value_hits >= 3 OR ((contains(b, 'staff directory') OR contains(u, 'directory')) AND contains(b, 'email') AND contains(b, 'phone')) OR (regexp_matches(u, 'staff_directory.php|/staff-directory') AND regexp_matches(b, 'email|phone'))) AS matched FROM kc),
kf AS (SELECT *, CASE WHEN regexp_matches(u || ' ' || b || ' ' || source_type, 'staff_directory|staff-directory|staff contacts|staff directory') THEN 'staff_directory' WHEN contains(u, '/departments/') OR (contains(b, 'breadcrumb') AND contains(b, 'departments')) THEN 'department_page' WHEN regexp_matches(u || ' ' || b, 'contact_us|directory_of_services|/contact|contact us|services') THEN 'contact_hub' ELSE 'generic' END AS f FROM ks)"""
HITS = "sidebar_staff_hits contact_card_hits inline_staff_hits labeled_staff_hits header_hits profile_block_hits department_section_hits breadcrumb_department_hits contact_hub_hits key_value_hits read_more_hits".split()


@query(rf"""WITH {KINDS}, kk AS (SELECT *, CASE WHEN header_hits >= 2 OR sidebar_staff_hits > 0 THEN 'staff_directory' WHEN f <> 'staff_directory' AND (contains(u, '/departments/') OR breadcrumb_department_hits > 0 OR (department_section_hits > 0 AND contact_card_hits + inline_staff_hits + labeled_staff_hits > 0)) THEN 'department_page'
 WHEN f NOT IN ('staff_directory', 'department_page') AND (contact_hub_hits >= 2 OR (contains(u, 'contact') AND profile_block_hits <= 1 AND header_hits <= 1 AND sidebar_staff_hits = 0)) THEN 'contact_hub' WHEN NOT matched THEN 'generic' ELSE f END AS page_class FROM kf)
SELECT page_id, CASE WHEN matched THEN 'staff_directory_or_profile' ELSE 'unknown' END AS page_kind, source_type, page_class, CASE page_class WHEN 'staff_directory' THEN 1.0 WHEN 'department_page' THEN 0.75 WHEN 'contact_hub' THEN 0.4 ELSE 0.2 END::DOUBLE AS page_priority_score, {', '.join(f'{h}::INT AS {h}' for h in HITS)} FROM kk""")
def staff_page_kinds(spark, sf_dir):
    return page_evidence.staff_page_kinds(kind_pages(spark, sf_dir), status="status").drop("signals")


@query(f"WITH {KINDS} SELECT source_type, count(*) AS pages, count(*) FILTER (matched) AS matched FROM kf GROUP BY 1")
def source_type_counts(spark, sf_dir):
    rows = page_evidence.staff_page_kinds(kind_pages(spark, sf_dir), status="status")
    return rows.groupBy("source_type").agg(F.count("*").alias("pages"), F.count_if(F.col("page_kind") != "unknown").alias("matched"))


# ---- what a recovery does with its attempts: a town for each user of the events


#: Phases, answers and pages of attempts; a town has as many as its user has events.
ATTEMPT_COLUMNS = "CAST(user_id AS BIGINT) AS municipality_id, CAST(event_id AS BIGINT) AS ordinal, " + ", ".join((
    pool(("known", "deep", "discovered", "deep", "home", "known", "sitemap", "deep", "known", "api", "robots", "deep", "discovered"), "event_id * 7 + user_id") + " AS phase",
    pool(("/a", "/b", None, "/c", "/d", "/a", "/e", "/f"), "event_id * 3") + " AS url", pool(("/Tax", "/tax/", "/clerk", "/Clerk", "/finance", "/x", "/y"), "event_id * 5") + " AS path",
    pool(("tax", "directory", "other", "Clerk", "departments_root"), "event_id") + " AS category", pool((200, 403, 200, 429, 403, 403, None, 200, 404), "event_id * 2 + user_id", "INT") + " AS status",
    pool(("text/html", "application/pdf", "text/HTML; x"), "event_id") + " AS content_type", f"repeat('z', {pool((600, 20, 500), 'event_id * 2', 'INT')}) AS text", pool((0, 4, None, 7), "event_id", "INT") + " AS contacts",
))
PLAN = rf"""a AS (SELECT {ATTEMPT_COLUMNS} FROM events),
o AS (SELECT *, (status = 200)::INT AS hit, list_position(['home', 'fallback', 'api', 'deep', 'sitemap', 'robots', 'discovered', 'known'], phase) AS ph, CASE WHEN phase = 'deep' THEN coalesce(list_position({list(recovery.DEEP_ORDER)!r}, lower(category)), 99) ELSE 0 END AS sub, CASE WHEN phase IN ('deep', 'api') THEN phase ELSE 'outer' END AS lane, CASE WHEN phase = 'deep' THEN lower(rtrim(path, '/')) WHEN phase IN ('discovered', 'known') THEN url END AS k FROM a),
l AS (SELECT *, row_number() OVER (PARTITION BY municipality_id ORDER BY ph, sub, ordinal) AS i, phase = 'discovered' AND row_number() OVER (PARTITION BY municipality_id, phase ORDER BY ordinal) > 4 AS late FROM o),
d AS (SELECT *, NOT late AND k IS NOT NULL AND row_number() OVER (PARTITION BY municipality_id, lane, k, late ORDER BY i) > 1 AS again FROM l),
b AS (SELECT *, count(*) FILTER (NOT late AND NOT again) OVER (PARTITION BY municipality_id, CASE WHEN phase IN ('discovered', 'known') THEN 'p' ELSE phase END ORDER BY i) AS nth FROM d),
u AS (SELECT *, CASE WHEN late THEN 'over_limit' WHEN again THEN 'duplicate' WHEN (phase = 'deep' AND nth > 20) OR (phase IN ('discovered', 'known') AND nth > 10) THEN 'over_budget' END AS gone FROM b),
s AS (SELECT *, coalesce(status IN (403, 429), false) AND coalesce(lag(status, 1) OVER w IN (403, 429), false) AND coalesce(lag(status, 2) OVER w IN (403, 429), false) AS third FROM u WHERE gone IS NULL WINDOW w AS (PARTITION BY municipality_id, lane ORDER BY i)),
f AS (SELECT *, coalesce(i > min(CASE WHEN third THEN i END) OVER (PARTITION BY municipality_id, lane), false) AND lane <> 'api' AS blocked FROM s),
g AS (SELECT *, coalesce(sum(CASE WHEN phase = 'deep' AND NOT blocked AND hit = 1 AND lower(category) IN {tuple(recovery.EXTRACTABLE)!r} AND contains(lower(content_type), 'html') AND length(text) >= 500 THEN coalesce(contacts, 0) ELSE 0 END) OVER (PARTITION BY municipality_id, lane ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) >= 10 AND phase = 'deep' AS enough FROM f),
j AS (SELECT municipality_id, ordinal, phase, i, CASE WHEN blocked THEN 'blocked' WHEN enough THEN 'enough_contacts' ELSE 'done' END AS outcome FROM g UNION ALL SELECT municipality_id, ordinal, phase, i, gone FROM u WHERE gone IS NOT NULL)"""


def attempts(spark, sf_dir):
    spark.read.parquet(f"{sf_dir}/events.parquet").createOrReplaceTempView("stage_events")
    return spark.sql(f"SELECT {ATTEMPT_COLUMNS} FROM stage_events").withColumn("hit", (F.col("status") == 200).cast("int"))


@query(f"WITH {PLAN} SELECT municipality_id, ordinal, phase, outcome, (CASE WHEN outcome = 'done' THEN row_number() OVER (PARTITION BY municipality_id, outcome = 'done' ORDER BY i) END)::INT AS place FROM j")
def recovery_plan(spark, sf_dir):
    return recovery.recovery_plan(attempts(spark, sf_dir)).select("municipality_id", "ordinal", "phase", "outcome", "place")


@query(f"WITH {PLAN} SELECT phase, outcome, count(*) AS attempts FROM j GROUP BY ALL")
def recovery_outcomes(spark, sf_dir):
    return recovery.recovery_plan(attempts(spark, sf_dir)).groupBy("phase", "outcome").agg(F.count("*").alias("attempts"))


# ---- contact rows that are text of documents


#: Contexts of the contacts with what documents say in them.
NOTED = pool(("permit application: see code. Call now. ", "", "a: b c: d ", "certificate ", "Hours. Days. ", "x" * 130 + " "), "seq * 3")
DOCUMENT_SQL = rf"""{with_sql('contacts')}, e AS (SELECT contact_id, lower(coalesce(nullif(regexp_extract(source_context, 'revize:([a-z_]+)', 1), ''), 'unknown')) AS kind, concat({NOTED.replace('AS string', 'AS VARCHAR')}, coalesce(source_context, '')) AS context, name, title, department, email, phone, phone_ext FROM contacts),
f AS (SELECT *, trim(regexp_replace(coalesce(name, ''), '\s+', ' ', 'g')) AS n, trim(regexp_replace(concat_ws(' ', nullif(trim(context), ''), nullif(trim(name), ''), nullif(trim(title), ''), nullif(trim(department), '')), '\s+', ' ', 'g'))[1:500] AS t, coalesce(trim(email), '') <> '' OR coalesce(trim(phone), '') <> '' OR coalesce(trim(phone_ext), '') <> '' OR coalesce(trim(title), '') <> '' AS structured FROM e),
g AS (SELECT *, lower(n) IN ('development permit', 'adopted march', 'cover page', 'international code council') OR (n <> '' AND NOT contains(n, ' ') AND NOT regexp_full_match(n, '[A-Z][a-zA-Z''`.-]{{1,40}}')) AS odd, regexp_matches(lower(t), 'permit|regulation|code|application|certificate|affidavit|cover page') AS words, kind = 'department_section' OR (kind = 'labeled_staff' AND NOT structured) AS weak, length(t) > 120 OR len(regexp_extract_all(t, '[.!?](\s|$)')) >= 2 OR len(string_split(t, ':')) > 2 AS dense FROM f)"""


@query(rf"""WITH {DOCUMENT_SQL} SELECT contact_id, CASE WHEN words OR odd THEN 'document_content' WHEN kind IN ('contact_card', 'profile_block', 'single_profile_page', 'department_contact_block', 'reconstructed_contact_block') THEN 'contact_card' WHEN kind IN ('table_directory', 'sidebar_staff', 'inline_staff_list') OR (kind = 'labeled_staff' AND structured) THEN 'staff_row'
 WHEN kind IN ('labeled_staff', 'department_section') THEN 'department_content' ELSE 'unknown' END AS block_type, odd OR (weak AND (dense OR words)) OR (words AND dense) AS non_contact FROM g""")
def non_contact_rows(spark, sf_dir):
    rows = spark_table(spark, sf_dir, "contacts").withColumn("source_kind", F.regexp_extract(F.coalesce("source_context", F.lit("")), "revize:([a-z_]+)", 1))
    rows = rows.withColumn("source_context", F.concat(F.expr(NOTED), F.coalesce("source_context", F.lit(""))))
    return page_evidence.non_contacts(rows).select("contact_id", "block_type", "non_contact")


# ---- staff pages read whole: structural parts go, sections, profiles and fields are read, rows of one person merge


#: Parts that hold no contacts, with the footer, hours and other blocks that each has.
STRUCTURAL = {"": (0, 0, 0), "<footer><p>Zed Zoe 203-555-0111</p></footer>": (1, 0, 1), "<div id=\"hours-wrap\">Robert Roe 203-555-0112</div>": (0, 1, 1), "<div>Office hours: Al Roe 203-555-0113<div>Resources</div></div>": (0, 1, 1), "<ul class=\"x resource-link\"><li>203-555-0114</li></ul>": (0, 0, 1), "<nav>Related links <a href=\"/y\">z</a></nav>": (0, 0, 1), "<script>RZ.module(1)</script>": (0, 0, 1), "<div class=\"rz-btns-container\"><footer>x</footer></div>": (1, 0, 2), "<p>Office hours</p>": (0, 0, 0)}
SECTION_HEADS = ("Building Department", "Town Clerk", "Finance", "Police Division")
WHOLE_HTML = f"concat('<body>', CASE page_id % 3 WHEN 0 THEN concat('<h2>', {pool(SECTION_HEADS, 'page_id')}, '</h2><p>', name, '</p><p>', title, '</p><p>', dialled, '</p>') WHEN 1 THEN concat('<div class=\"person\"><h3>', name, '</h3> reached at ', email, ' or ', dialled, '</div>') ELSE concat('<p>Name: ', name, '</p><p>Title: ', title, '</p><p>Office phone: ', dialled, '</p><p>Email: ', email, '</p>') END, {pool(tuple(STRUCTURAL), 'page_id')}, '</body>')"


def whole_pages(spark, sf_dir):
    """The given pages; and one page for each customer with a section, a profile or fields, and a structural part behind it."""
    spark_table(spark, sf_dir, "contact_pages").createOrReplaceTempView("stage_contact_pages")
    given = spark.read.parquet(f"{sf_dir}/pages.parquet").select((-F.col("page_id").cast("long") - 1).alias("page_id"), "url", "html")
    return given.unionByName(spark.sql(f"SELECT CAST(page_id AS BIGINT) AS page_id, url, {WHOLE_HTML} AS html FROM stage_contact_pages"))


_blocks = lambda k: pool(tuple(v[k] for v in STRUCTURAL.values()), "page_id", "INT")


@query(f"WITH {with_sql('contact_pages')} SELECT page_id::BIGINT AS page_id, {_blocks(0)} AS footer_blocks, {_blocks(1)} AS hours_blocks, {_blocks(2)} AS structural_blocks FROM contact_pages UNION ALL SELECT -page_id::BIGINT - 1, len(regexp_extract_all(html, '<footer'))::INT, 0, len(regexp_extract_all(html, '<footer'))::INT FROM pages")
def structural_blocks(spark, sf_dir):
    return staff_pages_op.sanitized(whole_pages(spark, sf_dir)).select("page_id", *staff_pages_op.COUNTED)


TRUTH = rf"""{with_sql('contact_pages')}, w AS (SELECT page_id::BIGINT AS page_id, page_id % 3 AS kind, name, CASE WHEN page_id % 3 = 1 OR (page_id % 3 = 0 AND title IN ('Building Official', 'Town Planner')) THEN NULL ELSE title END AS title, CASE WHEN page_id % 3 = 0 THEN {pool(SECTION_HEADS, 'page_id', 'VARCHAR')} END AS department, CASE WHEN page_id % 3 <> 0 THEN email END AS email, phone FROM contact_pages)"""


@query(f"WITH {TRUTH} SELECT page_id, CASE kind WHEN 0 THEN 'department_section' WHEN 1 THEN 'profile_block' ELSE 'single_profile_page' END AS source_kind, name, title, department, email, phone FROM w")
def outline_contacts(spark, sf_dir):
    rows = staff_pages_op.read_outlines(staff_pages_op.outlines(whole_pages(spark, sf_dir)))
    return rows.select("page_id", "source_kind", "name", "title", "department", "email", "phone")


@query(rf"""WITH {TRUTH} SELECT page_id, name, title, CASE kind WHEN 0 THEN department ELSE NULL END AS department, email, phone, CASE kind WHEN 0 THEN 'department_section' WHEN 1 THEN 'profile_block' ELSE 'single_profile_page' END AS source_kind, CASE kind WHEN 0 THEN 0.74 WHEN 1 THEN 0.79 ELSE 0.78 END::DOUBLE AS confidence, 1::BIGINT AS sightings FROM w""")
def assembled_contacts(spark, sf_dir):
    return staff_pages_op.assembled(whole_pages(spark, sf_dir)).select("page_id", "name", "title", "department", "email", "phone", "source_kind", "confidence", "sightings")


# ---- where rows are lost


FINGERPRINT = "concat('rtrace_', substr(sha256(concat_ws('||', lower(trim(municipality_id)), " + ", ".join(f"lower(trim(regexp_replace(coalesce({f}, ''), '\\s+', ' ', 'g')))" for f in trace.FIELDS) + ")), 1, 18))"
_rows = lambda k, name, why: f"SELECT municipality_id, {FINGERPRINT} AS fingerprint, {k} AS k, {why} AS why FROM {name}"
TRACED = rf"""{SCORED}, tu AS ({_rows(1, 'enriched', "CASE WHEN record_rank > 1 THEN 'duplicate_rank' WHEN is_likely_noise = 1 THEN 'likely_noise' ELSE 'other' END")} UNION ALL {_rows(2, 'clean', "'failed_role_mapping'")} UNION ALL {_rows(3, 'cand', "coalesce(nullif(trim(winner_disqualifier_reason), ''), 'failed_role_mapping_or_scoring')")} UNION ALL {_rows(4, 'winners', 'NULL')}),
tg AS (SELECT municipality_id, fingerprint, count(*) FILTER (k = 1) AS n1, count(*) FILTER (k = 2) AS n2, count(*) FILTER (k = 3) AS n3, count(*) FILTER (k = 4) AS n4, min(why) FILTER (k = 1) AS w1, min(why) FILTER (k = 2) AS w2, min(why) FILTER (k = 3) AS w3 FROM tu GROUP BY ALL),
tr AS (SELECT *, CASE WHEN n1 = 0 THEN 'loaded' WHEN n2 = 0 THEN 'clean' WHEN n3 = 0 THEN 'candidates' WHEN n4 = 0 THEN 'winners' END AS drop_stage, CASE WHEN n1 = 0 THEN 'not_loaded' WHEN n2 = 0 THEN w1 WHEN n3 = 0 THEN w2 WHEN n4 = 0 THEN w3 END AS drop_reason, CASE WHEN n2 = 0 THEN n1 WHEN n3 = 0 THEN n2 ELSE n3 END AS lost FROM tg)"""


def traced(spark, sf_dir):
    df = settled_enriched(spark, sf_dir)
    sc = settled(cand.score_candidates(df), "scored")
    return trace.contact_trace(df, enrich.clean_contacts(df), sc, cand.best_role_per_town(sc))


@query(f"WITH {TRACED} SELECT municipality_id, fingerprint, drop_stage, drop_reason FROM tr")
def row_traces(spark, sf_dir):
    return traced(spark, sf_dir).select("municipality_id", "fingerprint", "drop_stage", "drop_reason")


@query(f"WITH {TRACED} SELECT municipality_id, drop_stage, drop_reason, sum(lost)::BIGINT AS rows FROM tr WHERE drop_stage IS NOT NULL AND drop_reason <> 'not_loaded' GROUP BY ALL")
def trace_losses(spark, sf_dir):
    return trace.trace_losses(traced(spark, sf_dir))


KEPT_SQL = rf"""{DOCUMENT_SQL}, r AS (SELECT municipality_id, coalesce(source_url, '') AS page, odd OR (weak AND (dense OR words)) OR (words AND dense) AS gone FROM g JOIN (SELECT contact_id AS id, municipality_id, source_url FROM contacts) ON id = contact_id)"""


def judged_contacts(spark, sf_dir):
    rows = spark_table(spark, sf_dir, "contacts").withColumn("source_kind", F.regexp_extract(F.coalesce("source_context", F.lit("")), "revize:([a-z_]+)", 1))
    rows = page_evidence.non_contacts(rows.withColumn("source_context", F.concat(F.expr(NOTED), F.coalesce("source_context", F.lit("")))))
    return rows.withColumns({"kept": ~F.col("non_contact"), "page": F.coalesce("source_url", F.lit(""))})


@query(f"WITH {KEPT_SQL}, k AS (SELECT municipality_id, page, count(*) AS seen, count(*) FILTER (NOT gone) AS kept FROM r GROUP BY ALL) SELECT *, kept / seen AS ratio, kept / seen < 0.25 AS alarm FROM k")
def kept_ratio_alarms(spark, sf_dir):
    return trace.kept_ratios(judged_contacts(spark, sf_dir), ["municipality_id", "page"])


@query(f"WITH {KEPT_SQL}, k AS (SELECT municipality_id, count(*) AS seen, count(*) FILTER (NOT gone) AS kept FROM r GROUP BY ALL) SELECT *, kept / seen AS ratio, seen >= 8 AND kept / seen < 0.25 AS alarm FROM k")
def kept_ratio_towns(spark, sf_dir):
    return trace.kept_ratios(judged_contacts(spark, sf_dir), ["municipality_id"], fewest=trace.TOWN_ROWS)


# ---- contact rows in one form, doubtful ones demoted


STAFF_ROWS = "regexp_extract(coalesce(source_context, ''), 'revize:([a-z_]+)', 1) AS source_kind, regexp_extract(coalesce(source_context, ''), 'page_class=([a-z_]+)', 1) AS page_class"


def staff_rows(spark, sf_dir):
    """The staged contacts as rows of readers: kind and page class out of their context."""
    pattern = lambda p: F.regexp_extract(F.coalesce("source_context", F.lit("")), p, 1)
    return spark_table(spark, sf_dir, "contacts").withColumns({"source_kind": pattern("revize:([a-z_]+)"), "page_class": pattern("page_class=([a-z_]+)")})


_re = lambda x, words: "regexp_matches(" + x + ", '" + "|".join(w.replace("'", "''") for w in words) + "')"
_low = lambda x: f"lower(coalesce({x}, ''))"
_place = lambda x: f"(regexp_matches({_low(x)}, '\\b[0-9]{{1,5}}\\b|\\bct\\b|\\bconnecticut\\b') OR {_re(_low(x), people.PLACE_TOKENS)})"
_tokens = lambda x: f"len(list_filter(string_split({x}, ' '), lambda w: regexp_matches(w, '[A-Za-z]')))"
_flag = lambda name, rules: f"CASE WHEN {' OR '.join(rules)} THEN '{name}' END"
_sql_list = lambda values: "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"
NORMAL_SQL = rf"""{with_sql('contacts')}, s0 AS (SELECT contact_id, {STAFF_ROWS}, source_url AS url, confidence, nullif(trim(regexp_replace(coalesce(name, ''), '\s+', ' ', 'g')), '') AS name, nullif(trim(title), '') AS title, nullif(trim(department), '') AS department, nullif(lower(trim(email)), '') AS email, phone, nullif(phone_ext, '') AS phone_ext, coalesce(source_context, '') AS context FROM contacts),
s1 AS (SELECT *, coalesce(nullif(source_kind, ''), 'unknown') AS kind0, coalesce(nullif(page_class, ''), 'generic') AS class0, name IS NOT NULL AS named, coalesce({_re(_low('name'), ('email me', 'click here', 'request', 'office hours'))}, false) AS clear FROM s0),
s2 AS (SELECT *, CASE WHEN NOT clear THEN name END AS n1, concat('revize:', kind0, '|page_class=', class0, '|page_priority=', CASE class0 WHEN 'staff_directory' THEN '1.00' WHEN 'department_page' THEN '0.75' WHEN 'contact_hub' THEN '0.40' ELSE '0.20' END, CASE WHEN context <> '' THEN ' | ' || context ELSE '' END)[1:240] AS tagged,
  CASE WHEN kind0 = 'department_contact_block' THEN 'office_contact_block' WHEN name IN ('Jane Doe', 'John Smith', 'Mary Ann Jones', 'Your Link Name', 'Filling Vacancies', 'Land Use') AND coalesce(title, email, phone) IS NOT NULL THEN 'person_block' WHEN coalesce(email, phone) IS NOT NULL THEN 'office_contact_block' ELSE 'structural_block' END AS block0 FROM s1),
s3 AS (SELECT *, {_re(_low('n1'), people.DEPARTMENT_HINTS)} AS is_d, {_re(_low('n1'), people.TITLE_HINTS)} AND NOT {_re(_low('n1'), people.DEPARTMENT_HINTS)} AS is_t, {_low('n1')} IN {_sql_list(people.GENERIC_HEADINGS)} AS is_g FROM s2),
s4 AS (SELECT *, named AND clear AS r1, named AND {_place('n1')} AS r2, named AND ({_low('n1')} IN {_sql_list(people.NAME_LITERALS)} OR {_re(_low('n1'), people.NAME_PHRASES + people.NAME_FRAGMENTS)}) AS r3, named AND is_d AS r4, named AND is_t AS r5, named AND is_g AND NOT is_d AND NOT is_t AS r6, named AND NOT is_d AND NOT is_t AND NOT is_g AND NOT (coalesce({_tokens('n1')}, 0) >= 2 OR (n1 IS NOT NULL AND title IS NOT NULL)) AS r7, CASE WHEN NOT is_d AND NOT is_t THEN n1 END AS n2, coalesce(title, CASE WHEN is_t THEN n1 END) AS t2, coalesce(department, CASE WHEN is_d THEN n1 END) AS d2 FROM s3),
s5 AS (SELECT *, t2 IS NOT NULL AND ({_low('t2')} IN {_sql_list(people.ACTION_TEXTS)} OR {_re(_low('t2'), people.ACTION_PARTS)}) AS r8, CASE WHEN d2 IS NULL THEN 0 WHEN {_low('d2')} IN {_sql_list(people.ACTION_TEXTS)} OR {_re(_low('d2'), people.ACTION_PARTS)} THEN 9 WHEN {_place('d2')} THEN 10 WHEN lower(d2) = 'education' AND NOT contains({_low('url')}, 'education') AND NOT contains(lower(tagged), 'education department') THEN 11 WHEN {_re(_low('d2'), ('bids and rfp', 'rfp', ', ct', ' main street'))} THEN 12 ELSE 0 END AS rd FROM s4),
s6 AS (SELECT *, CASE WHEN NOT r8 THEN t2 END AS t3, CASE WHEN rd > 0 THEN NULL ELSE CASE d2 WHEN 'Town Clerk Office' THEN 'Town Clerk' WHEN 'Assessor''s Office' THEN 'Assessor''s' WHEN 'Building Department' THEN 'Building' WHEN 'Revenue Department' THEN 'Revenue' WHEN 'Planning and Zoning' THEN 'Planning And Zoning' WHEN 'Board of Selectmen' THEN 'Board Of Selectmen' WHEN 'Board of Education' THEN 'Board Of Education' ELSE d2 END END AS d3 FROM s5),
s7 AS (SELECT *, n2 IS NULL AND coalesce(email, phone, t3, d3) IS NOT NULL AS r13, list_filter(string_split(regexp_replace(coalesce(url, ''), '^https?://[^/]*|[?#].*$', '', 'g'), '/'), lambda x: x <> '') AS segs FROM s6),
s8 AS (SELECT *, CASE WHEN r13 AND (t3 IS NULL OR {_re(_low('t3'), people.TITLE_HINTS)}) THEN 'Department Contact' ELSE t3 END AS t4, CASE WHEN r13 THEN coalesce(d3, CASE list_filter(list_reverse(segs), lambda x: regexp_matches(lower(x), 'department|building|assessor|clerk|finance|planning|zoning|police|fire'))[1] WHEN 'assessor' THEN 'Assessor' WHEN 'clerk' THEN 'Clerk' WHEN 'building' THEN 'Building' WHEN 'planning' THEN 'Planning' END) ELSE d3 END AS d35, CASE WHEN r13 THEN 'department_contact_block' ELSE kind0 END AS kind, CASE WHEN r13 THEN 'office_contact_block' ELSE block0 END AS block FROM s7),
s9 AS (SELECT *, CASE WHEN r13 AND {_re(_low('d35'), people.TITLE_HINTS)} THEN NULL ELSE d35 END AS d4, coalesce({_tokens('n2')}, 0) >= 2 OR (n2 IS NOT NULL AND t4 IS NOT NULL) AS ok FROM s8),
s10 AS (SELECT *, n2 IS NOT NULL AND coalesce(t4, email, phone) IS NULL AS bare, email IS NULL AND phone IS NULL AS none FROM s9),
s11 AS (SELECT *, list_filter([{_flag('department_contamination', ['rd > 0'])}, {_flag('invalid_name', ['r1'])}, {_flag('missing_contact_method', ['(bare AND ok)', 'none'])}, {_flag('role_only_row', ['r4', 'r5', 'r13'])}, {_flag('weak_person_name', ['r2', 'r3', 'r6', 'r7', 'r8', '(bare AND NOT ok)', '(n2 IS NOT NULL AND NOT ok)'])}], lambda x: x IS NOT NULL) AS flags,
  CASE WHEN {_re(_low('name'), ('vacant', 'vacancy'))} THEN 'vacancy' WHEN coalesce(n2, t4, d4) IS NULL THEN 'missing_person_and_context' END AS gone FROM s10),
s12 AS (SELECT *, len(flags) > 0 AS noise FROM s11)"""


@query(rf"""WITH {NORMAL_SQL} SELECT contact_id, n2 AS name, t4 AS title, d4 AS department, email, phone, phone_ext, kind AS source_kind, block AS block_class, noise::INT AS is_likely_noise, CASE WHEN noise THEN array_to_string(flags, ',') END AS normalization_flag, gone AS "drop",
 round(least(round(confidence, 3), CASE WHEN block = 'office_contact_block' THEN 0.62::DOUBLE END, CASE WHEN {_re(_low('url'), ('/contact', 'contact_us', 'contact-us', 'staff_directory', 'directory'))} AND (n2 IS NULL OR block <> 'person_block') THEN 0.54::DOUBLE END, CASE WHEN kind = 'department_contact_block' AND {_re(_low('t4'), people.TITLE_HINTS)} THEN 0.5::DOUBLE END, CASE WHEN noise THEN 0.46::DOUBLE END), 6) AS confidence,
 CASE WHEN noise THEN (tagged || ' | noise=1;norm_flag=' || array_to_string(flags, ','))[1:240] ELSE tagged END AS source_context FROM s12""")
def normalized_staff_rows(spark, sf_dir):
    rows = normalize_staff.normalized(staff_rows(spark, sf_dir))
    return rows.select("contact_id", "name", "title", "department", "email", "phone", "phone_ext", "source_kind", "block_class", "is_likely_noise", "normalization_flag", "drop", F.round("confidence", 6).alias("confidence"), "source_context")


@query(rf"""WITH {NORMAL_SQL}, l AS (SELECT unnest(list_filter([CASE WHEN r1 THEN 'name_clear_reject' END, CASE WHEN r2 THEN 'name_address_like' END, CASE WHEN r3 THEN 'name_non_person_label' END, CASE WHEN r4 THEN 'name_is_department' END, CASE WHEN r5 THEN 'name_is_title' END, CASE WHEN r6 THEN 'name_generic_heading' END, CASE WHEN r7 THEN 'name_invalid_pattern' END, CASE WHEN r8 THEN 'title_action_label' END,
 CASE rd WHEN 9 THEN 'department_action_label' WHEN 10 THEN 'department_address_like' WHEN 11 THEN 'department_ambiguous_education' WHEN 12 THEN 'department_context_noise' END, CASE WHEN r13 THEN 'office_contact' END, CASE WHEN bare AND ok THEN 'name_without_contact' END, CASE WHEN bare AND NOT ok THEN 'name_without_support' END, CASE WHEN none THEN 'no_contact_method' END, CASE WHEN n2 IS NOT NULL AND NOT ok THEN 'name_not_accepted' END, 'drop_' || gone], lambda x: x IS NOT NULL)) AS rule FROM s12) SELECT rule, count(*) AS rows FROM l GROUP BY 1""")
def staff_row_ledger(spark, sf_dir):
    return normalize_staff.ledger_counts(normalize_staff.normalized(staff_rows(spark, sf_dir)))


# ---- what recoveries find: trust, interfaces, their endpoints, pages


HINTS = {"tax": ("tax",), "clerk": ("clerk",), "directory": ("directory", "clerk")}
OLD_PATHS = ("/x", "archive")


@query(rf"""WITH {PLAN}, e AS (SELECT *, lower(path) AS p, CASE lower(category) WHEN 'tax' THEN contains(lower(path), 'tax') WHEN 'clerk' THEN contains(lower(path), 'clerk') WHEN 'directory' THEN regexp_matches(lower(path), 'directory|clerk') ELSE false END AS aligned FROM o),
m AS (SELECT municipality_id, max(hit) AS h, max((hit = 1 AND aligned)::INT) AS al, max((hit = 1 AND rtrim(p, '/') <> '')::INT) AS k, max((hit = 1 AND regexp_matches(p, '/x|archive'))::INT) AS l, max((coalesce(contacts, 0) > 0)::INT) AS x FROM e GROUP BY 1)
SELECT municipality_id, CASE WHEN coalesce(h, 0) = 0 THEN 'none' WHEN x = 1 AND al = 1 AND k = 1 AND l = 0 THEN 'high' WHEN x = 1 THEN 'medium' ELSE 'low' END AS trust, CASE WHEN h = 1 THEN l ELSE 0 END AS legacy_suspected FROM m""")
def recovery_trust(spark, sf_dir):
    rows = attempts(spark, sf_dir).withColumn("hit", F.coalesce("hit", F.lit(0))).withColumn("extracted", F.col("contacts"))
    return recovery.trust(rows, HINTS, OLD_PATHS)


SPOKEN = pool(('{"Swagger": 2}', "<html>", "x OpenAPI", "", None), "event_id") + " AS text, " + pool(("/api/v1", "/x", "/API", "/tax"), "event_id * 3 + user_id") + " AS path, " + pool((200, 404, 200, None, 403, 200, 500), "event_id", "INT") + " AS status"


@query(f"WITH e AS (SELECT CAST(user_id AS BIGINT) AS municipality_id, {SPOKEN} FROM events), m AS (SELECT municipality_id, max(coalesce(status = 200 AND regexp_matches(lower(coalesce(text, '')), 'swagger|openapi'), false)::INT) AS s, max(coalesce(status = 200 AND contains(lower(path), 'api'), false)::INT) AS r FROM e GROUP BY 1) SELECT municipality_id, greatest(s, r) AS api_hit, CASE WHEN s = 1 THEN 'swagger' WHEN r = 1 THEN 'rest_root' ELSE 'none' END AS api_type FROM m")
def api_presence(spark, sf_dir):
    spark.read.parquet(f"{sf_dir}/events.parquet").createOrReplaceTempView("stage_events")
    return recovery.api_presence(spark.sql(f"SELECT CAST(user_id AS BIGINT) AS municipality_id, {SPOKEN} FROM stage_events"))


#: Endpoints of interfaces: paths, summaries and tags; each event documents two and a POST.
ENDPOINTS = ("/staff/contacts", "/departments", "/tax/bills", "/auth/token", "/meetings/{id}", "/records/id", "/health", "/agenda", "/a")
SUMMARIES, ENDPOINT_TAGS = ("", "List staff", "Login", "Tax assessor data", " Meetings "), ("contact", "x", "records", "planning")
_endpoint = lambda k: (pool(ENDPOINTS, f"event_id * 2 + {k} * 5"), pool(SUMMARIES, f"event_id + {k}"), pool(ENDPOINT_TAGS, f"event_id * 3 + {k}"))
_op = lambda k: "'\"', {}, '\": {{\"get\": {{\"summary\": \"', {}, '\", \"tags\": [\"', {}, '\"]}}}}'".format(*_endpoint(k))
DOCUMENT = f"concat('{{\"paths\": {{', {_op(0)}, ', ', {_op(1)}, ', \"/post/staff\": {{\"post\": {{}}}}}}}}')"
_points = lambda words, w: f"CASE WHEN regexp_matches(hay, '{'|'.join(words)}') THEN {w} ELSE 0 END"


@query(rf"""WITH e AS (SELECT CAST(user_id AS BIGINT) AS municipality_id, unnest([{_endpoint(0)[0]}, {_endpoint(1)[0]}]) AS path, unnest([{_endpoint(0)[1]}, {_endpoint(1)[1]}]) AS summary, unnest([{_endpoint(0)[2]}, {_endpoint(1)[2]}]) AS tag FROM events),
h AS (SELECT *, lower(path || ' ' || trim(summary) || '  ' || tag) AS hay FROM e), s AS (SELECT *, {_points(('directory', 'staff', 'contact'), 3)} + {_points(('department',), 2)} + {_points(('tax', 'assessor', 'clerk', 'building', 'planning', 'finance'), 2)} + {_points(('agenda', 'meeting', 'minutes', 'publicrecords'), 1)} - {_points(('auth', 'login', 'account', 'token', 'admin'), 5)} - {_points(('health', 'ping', 'telemetry'), 3)} AS score,
 CASE WHEN regexp_matches(hay, 'directory|staff|contact|official|clerk') THEN 'contact_like' WHEN regexp_matches(hay, 'department|tax|assessor|building|planning|finance') THEN 'department_like' WHEN regexp_matches(hay, 'agenda|meeting|minutes') THEN 'meeting_like' WHEN contains(hay, 'records') THEN 'records_like' ELSE 'other' END AS endpoint_class FROM h),
k AS (SELECT municipality_id, path, endpoint_class, score::INT AS score, CASE endpoint_class WHEN 'contact_like' THEN 3 WHEN 'department_like' THEN 2 WHEN 'other' THEN 0 ELSE 1 END AS c FROM s WHERE score > 0 AND NOT regexp_matches(lower(path), '[{{}}]|auth|login|account|token|admin|health|ping|telemetry|/ids?$'))
SELECT municipality_id, path, endpoint_class, score, row_number() OVER (PARTITION BY municipality_id ORDER BY c DESC, score DESC, length(path), path)::INT AS rank FROM k QUALIFY rank <= 3""")
def top_endpoints(spark, sf_dir):
    spark.read.parquet(f"{sf_dir}/events.parquet").createOrReplaceTempView("stage_events")
    documents = spark.sql(f"SELECT CAST(user_id AS BIGINT) AS municipality_id, {DOCUMENT} AS text FROM stage_events")
    return recovery.select_endpoints(recovery.swagger_endpoints(documents)).select("municipality_id", "path", "endpoint_class", "score", "rank")


@query(f"WITH {with_sql('service_links')}, p AS (SELECT concat(municipality_id, '|', coalesce(url, '')) AS page_id, * FROM service_links) SELECT page_id, arg_min(url, seq) AS url, arg_max(label, seq) AS title, arg_max(vendor, seq) AS discovered_from, arg_max_null(service_page_type, seq) AS page_type FROM p GROUP BY 1")
def upsert_pages(spark, sf_dir):
    rows = spark_table(spark, sf_dir, "service_links").select("municipality_id", "url", F.col("label").alias("title"), F.col("vendor").alias("discovered_from"), F.col("service_page_type").alias("page_type"), "seq")
    return merge.upsert_pages(rows.withColumn("page_id", F.concat("municipality_id", F.lit("|"), F.coalesce("url", F.lit(""))))).select("page_id", "url", "title", "discovered_from", "page_type")


# ---- the full recovery row of each blocked town: a town for each user of the events


RECOVERED = {
    "batch_id": ("b1", "", "b2"), "recovery_mode_attempted": ("yes", "TRUE", "0", "1"), "recovery_result": ("partial_recovery", "odd", "recovered_deep_path"), "known_path_hits": ("3", "x", "2.7", ""), "deep_path_hits": ("4", "", "n"), "deep_path_trust": ("HIGH", "odd", "", "low"),
    "api_type": ("swagger", "odd", "", "rest_root", ""), "api_inventory_type": ("swagger_ui", "", "none"), "api_inventory_paths": ("/a, /b,,/c", "", "/x"), "deep_extraction_paths": ("", "/p,/q", " "), "playwright_success": ("1", "0", ""), "first_deep_path": ("/d", ""), "homepage_status": ("403", ""),
}
NOTED_FIELDS = ("deep_path_hits=7; first_deep_path = /n ;api_hit=0", "API_TYPE=rest_root;api_paths_hit=/api;deep_hit_tax=2", "deep_extraction_zero_reason=blocked;deep_path_trust=medium;playwright_success=2", "", "directory_hit=1;directory_source=known;documented_get_count=5;best_api_endpoint_class=contact_like")
_json = lambda fields: "concat('{', " + ", ', ', ".join(f"'\"{k}\": \"', {v}, '\"'" for k, v in fields.items()) + ", '}')"
STATUS_JSON = _json({**{k: pool(v, f"event_id * {i + 1} + user_id") for i, (k, v) in enumerate(RECOVERED.items())}, "notes": pool(NOTED_FIELDS, "event_id + user_id")})
STATUS_COLUMNS = f"CAST(user_id AS BIGINT) AS municipality_id, event_id AS seq, CASE event_id % 6 WHEN 0 THEN '' WHEN 1 THEN 'no json' ELSE {STATUS_JSON} END AS value"
INVENTORY_COLUMNS = "CAST(user_id AS BIGINT) AS municipality_id, event_id AS seq, CASE event_id % 3 WHEN 0 THEN NULL ELSE " + _json({"documented_get_count": pool(("9", "", "x"), "event_id"), "selected_probe_count": pool(("2", ""), "event_id"), "best_endpoint_path": pool(("/staff", "", "/a"), "event_id * 2"), "best_endpoint_class": pool(("other", ""), "event_id + user_id")}) + " END AS value"

_x = lambda f: f"json_extract_string(p, '$.{f}')"
_note = lambda f: f"nullif(trim(regexp_extract(n, '(?i)(?:^|;)\\s*{f}=([^;]*)', 1)), '')"
_int = lambda x: f"CAST(trunc(TRY_CAST(trim({x}) AS DOUBLE)) AS INT)"
_full = lambda x: f"CASE WHEN trim({x}) <> '' THEN {x} END"
_plain = {f: (f"coalesce({_int(_x(f))}, {_int(_note(f))}, 0)" if isinstance(d, int) else f"coalesce({_full(_x(f))}, {_note(f)}, '{d}')") for f, d in recovery_rows_op.FIELDS.items() if f not in recovery_rows_op.NO_NOTE}
_trust = lambda f, values: f"CASE WHEN lower(trim({_plain[f]})) IN {values} THEN lower(trim({_plain[f]})) ELSE 'none' END"
_special = {
    "batch_id": f"coalesce({_full(_x('batch_id'))}, 'b0')", "blocked_reason": f"coalesce({_full(_x('blocked_reason'))}, 'http_forbidden')", "recovery_mode_attempted": f"CASE WHEN lower(trim({_x('recovery_mode_attempted')})) IN ('1', 'true', 'yes') THEN 'true' ELSE 'false' END",
    "recovery_result": f"CASE WHEN {_x('recovery_result')} IN ('partial_recovery', 'recovered_deep_path') THEN {_x('recovery_result')} ELSE '' END", **{f: f"coalesce({_full(_x(f))}, '')" for f in ("homepage_status", "fallback_status", "sitemap_status", "robots_status")}, **{f: f"coalesce({_int(_x(f))}, 0)" for f in ("known_path_hits", "recovered_contact_count", "recovered_role_winner_count")},
    "deep_path_trust": _trust("deep_path_trust", ("none", "low", "medium", "high")), "api_type": _trust("api_type", ("swagger", "rest_root")), "api_inventory_type": _trust("api_inventory_type", ("swagger_json", "swagger_ui", "rest_json", "html_only", "none")), "notes": "CASE WHEN p IS NULL THEN 'recovery_not_attempted' ELSE n END",
    "api_hit": f"greatest(coalesce({_int(_x('api_hit'))}, {_int(_note('api_hit'))}, ({_plain['api_paths_hit']} <> '')::INT), ({_trust('api_type', ('swagger', 'rest_root'))} <> 'none')::INT)",
    **{f: f"CASE WHEN {_plain[f]} <= 0 THEN len(list_filter(string_split({_plain[g]}, ','), lambda x: trim(x) <> ''))::INT ELSE {_plain[f]} END" for f, g in (("deep_extraction_path_count", "deep_extraction_paths"), ("api_endpoint_count", "api_inventory_paths"))},
    "playwright_attempted": f"CASE WHEN {_plain['playwright_attempted']} <= 0 AND {_plain['playwright_success']} > 0 THEN 1 ELSE {_plain['playwright_attempted']} END",
    "documented_get_count": f"coalesce({_int('i1')}, {_plain['documented_get_count']})", "selected_api_probe_count": f"coalesce({_int('i2')}, {_plain['selected_api_probe_count']})", "best_api_endpoint": f"coalesce({_full('i3')}, {_plain['best_api_endpoint']})", "best_api_endpoint_class": f"coalesce({_full('i4')}, {_plain['best_api_endpoint_class']})",
}


@query(f"""WITH s AS (SELECT {STATUS_COLUMNS} FROM events), v AS (SELECT {INVENTORY_COLUMNS} FROM events), sl AS (SELECT municipality_id, CASE WHEN starts_with(value, '{{') THEN value END AS p FROM s QUALIFY row_number() OVER (PARTITION BY municipality_id ORDER BY seq DESC) = 1),
il AS (SELECT municipality_id, json_extract_string(value, '$.documented_get_count') AS i1, json_extract_string(value, '$.selected_probe_count') AS i2, json_extract_string(value, '$.best_endpoint_path') AS i3, json_extract_string(value, '$.best_endpoint_class') AS i4 FROM v QUALIFY row_number() OVER (PARTITION BY municipality_id ORDER BY seq DESC) = 1),
b AS (SELECT *, coalesce({_x('notes')}, '') AS n FROM (SELECT DISTINCT CAST(user_id AS BIGINT) AS municipality_id FROM events) LEFT JOIN sl USING (municipality_id) LEFT JOIN il USING (municipality_id))
SELECT municipality_id, {', '.join(f'{_special.get(f) or _plain[f]} AS {f}' for f in recovery_rows_op.FIELDS)} FROM b""")
def recovery_rows(spark, sf_dir):
    spark.read.parquet(f"{sf_dir}/events.parquet").createOrReplaceTempView("stage_events")
    blocked = spark.sql("SELECT DISTINCT CAST(user_id AS BIGINT) AS municipality_id, 'b0' AS batch_id, 'http_forbidden' AS blocked_reason FROM stage_events")
    return recovery_rows_op.recovery_rows(blocked, spark.sql(f"SELECT {STATUS_COLUMNS} FROM stage_events"), spark.sql(f"SELECT {INVENTORY_COLUMNS} FROM stage_events"))


@query(f"""WITH {UNRESOLVED}, dm AS (SELECT *, lower(coalesce(source_context, '')) LIKE 'revize:%' AS mine, coalesce(suspicious_reason, '') AS why, lower(trim(coalesce(name, ''))) AS who FROM enriched)
SELECT (SELECT count(*) FROM dm WHERE coalesce(trim(entity_type), '') <> '') AS contacts_with_entity_type, (SELECT count(*) FROM dm WHERE coalesce(trim(role_normalized), '') <> '') AS contacts_with_role_normalized, (SELECT count(*) FROM dm WHERE mine AND why = 'invalid_person_name') AS penalty_non_person_name, (SELECT count(*) FROM dm WHERE mine AND why = 'role_department_mismatch') AS penalty_role_department_mismatch,
 (SELECT count(*) FROM dm WHERE mine AND why = 'non_person_role_candidate') AS penalty_office_row, (SELECT count(*) FROM dm WHERE mine AND (why IN ('invalid_person_name', 'role_only_name') OR who LIKE '%affidavit%' OR who LIKE '%vacanc%' OR who IN ('building', 'tax collector', 'department', 'office'))) AS garbage_rows_demoted, (SELECT count(*) FROM unresolved) AS roles_unresolved, (SELECT count(*) FROM unresolved) AS forced_fallback_blocked""")
def demotion_metrics(spark, sf_dir):
    df = settled_enriched(spark, sf_dir)
    sc = settled(cand.score_candidates(df), "scored")
    return reports.demotion_metrics(df, cand.unresolved_roles(sc, cand.best_role_per_town(sc)))
