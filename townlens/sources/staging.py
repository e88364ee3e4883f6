"""Municipal tables staged from the driver's tables by expressions that Spark and DuckDB run alike.

Each column is a pool of literals indexed by a key; a pool's length is unlike the others', so combinations spread.
spark_tables() gives DataFrames, SQL the same as common table expressions for the twins of the queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NAMES = ("Jane Doe", "John Smith", None, "", "  ", "Your Link Name", "Click Here", "Building", "Tax Collector", "Filling Vacancies", "Town Clerk Office", "12 Main Street", "The Assessor", "Land Use", "Mary Ann Jones", "assessor", "J. Q. Public", "Zoning Regulations", "Assistant Pat Lee")
TITLES = ("Town Clerk", "Assistant Town Clerk", "Assessor", "Tax Collector", "Revenue Collector", "Tax Office Clerk", "City Clerk", "Chief Building Official", "Building Inspector", "Code Official", "Zoning/Code Enforcement Officer", "Building Official", "Land Use Administrator", "Zoning Administrator", "Land Use Director", "Town Planner", "Director of Finance", "Assistant Director of Finance - Operations", "Finance Manager", "Accounting Manager", "Comptroller", "Town Treasurer", "First Selectman", "Mayor", "Town Manager", None, "", "This office is responsible for keeping the records of the town.", "Click Here")
DEPARTMENTS = ("Assessor's Office", "Tax Collector", "Revenue Department", "Town Clerk", "Building Department", "Planning and Zoning", "Land Use", "Finance", "Treasurer", "Board of Selectmen", "Mayor", "Town Manager", None, "", "Staff", "Board of Education", "Public Works")
URLS = ("https://t.example.org/", "https://t.example.org/staff-directory", "https://t.example.org/town/assessor/info", "https://t.example.org/town/tax/bills", "https://t.example.org/gov/clerk/x", "https://t.example.org/gov/board/x", "https://t.example.org/gov/town-manager/x", None, "https://t.example.org/gov/building/x", "https://t.example.org/a/b/contact-us", "https://t.example.org/a/b/index.html", "https://t.example.org/a/finance/b", "https://t.example.org/a/planning/c")
CONTEXTS = ("revize:contact_card|page_class=staff_directory", "revize:profile_block|page_class=department_page", "revize:labeled_staff|page_class=staff_directory", "revize:labeled_staff|page_class=department_page", "revize:reconstructed_contact_block|page_class=contact_hub", "revize:department_section|page_class=department_page", "revize:labeled_staff|page_class=generic", "plain text", None, "staff list", "committee page")
LABELS = ("GIS Maps", "Property Card Lookup", "Pay Tax Bill", "Job Openings", "Building Permit Forms", "Agendas and Minutes", "Contact Us", "Staff Directory", "Town Clerk", None, "Meeting Calendar", "Field Card", "Tax Payment")
LINKS = ("https://town.axisgis.com/map", "https://t1.example.org/property-record", "https://www.mytaxbill.org/inet/bill", "https://www.governmentjobs.com/careers/t", "https://t2.example.org/permits/building", "https://t3.example.org/AgendaCenter", "https://t4.example.org/departments/town-clerk", "https://t5.example.org/Directory.aspx?EID=370", "http://T6.Example.org/jobs.pdf#top", None, "https://recdesk.com/x?page=1")
CATEGORIES = ("gis", "Property", "tax_payment", "jobs", None, "permits", "agendas_minutes")
VENDORS = ("CivicPlus LLC", "GovernmentJobs", "Vision Government Solutions", None, "Other Vendor")
PAGE_KINDS = ("internal_page", "external_portal", None)
SIGNALS = ("crawl_diagnostics", "blocked_recovery_status", "agenda_vendor", "jobs_vendor", "gis_vendor", "tax_vendor", "email_pattern", None)
STATUSES = ("active", "Active", "done", "skipped")
#: Parts of staff blocks whose digits and words are spread over text nodes.
STAFF_CLASSES = ("staff-card", "contact-box", "employee profile", "news", "resource-link staff")
STAFF_HEADINGS = ("Jane Doe", "Position Vacant", "Madonna", None, "Mary-Ann O'Neil, Jr.", "Quick Links", "Jane  Doe")
STAFF_TITLES = (None, "Town Clerk", "Friend", "Chief Assessor")
STAFF_LINES = ("20 3-555-0142 x 12", "203 555 0143", "Fax: 203-555-0000", "Ann Bell, office of the clerk", "no digits here", "(860) 555-0144 ext. 9", "fax 203-555-0001 or 203-555-0002", "Room 5", "44 5")
STAFF_MORE = (None, "write jane.doe@t.example.org", "Robert de la Cruz III")
STAFF_MAILS = (None, "mailto:Pat.Lee@T.example.org?subject=x")
STAFF_TELS = (None, "tel:+1-203-555-0199", None, "tel:8605550101", None)
STAFF_PAGES = ("Assessor Department", "Town Hall", "Welcome", "Town of Avon | Tax Collector", None, "Office of Land Use", "Departments")
STAFF_URLS = ("https://t.example.org/departments/land_use/index.php", "https://t.example.org/departments/staff_directory.php", "https://t.example.org/town/building-inspection/index.php", "https://t.example.org/x/police-department")

#: Code, links, services, contacts, text length, block signal, shell signal of a crawl.
CRAWLS = ((200, 30, 4, 9, 9000, 0, 0), (403, 0, 0, 0, 300, 1, 0), (200, 1, 0, 0, 500, 1, 0), (200, 0, 0, 0, 800, 0, 1), (200, 40, 0, 0, 9000, 0, 0), (200, 20, 3, 0, 7000, 0, 0), (429, 9, 9, 9, 100, 0, 0), (None, 0, 0, 0, 0, 0, 0), (503, 1, 1, 0, 10, 0, 0), (404, 2, 0, 0, 2000, 1, 1), (401, 0, 0, 0, 0, 0, 0))


def pool(values: tuple, index: str, kind: str = "string") -> str:
    """CASE over the pool, in words that both engines know."""
    quote = lambda v: "NULL" if v is None else str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"
    arms = " ".join(f"WHEN {i} THEN {quote(v)}" for i, v in enumerate(values))
    return f"CAST(CASE ({index}) % {len(values)} {arms} END AS {kind})"


def _pools(spark: bool) -> dict[str, str]:
    text = "STRING" if spark else "VARCHAR"
    p = lambda values, index: pool(values, index, text)
    num = lambda k, index: pool(tuple(x[k] for x in CRAWLS), index, "INT")
    s = lambda x: f"CAST({x} AS {text})"
    key = lambda x: f"concat('ct_', lower(replace({x}, ' ', '_')))"
    return {
        "municipalities": f"SELECT {key('n_name')} AS municipality_id, n_name AS name, r_name AS county, concat('https://t', {s('n_nationkey')}, '.example.org/') AS website_url, concat('t', {s('n_nationkey')}, '.example.org') AS domain, CASE WHEN n_nationkey % 3 = 0 THEN concat('https://jobs', {s('n_nationkey')}, '.example.com/') END AS jobs_url, CASE WHEN n_nationkey % 4 = 0 THEN concat('https://t', {s('n_nationkey')}, '.example.org/directory') END AS directory_url, CASE WHEN n_nationkey % 5 = 0 THEN concat('https://x.t', {s('n_nationkey')}, '.example.org/assessor') END AS assessor_url, CASE WHEN n_nationkey % 2 = 0 THEN '' END AS tax_url, n_nationkey AS town_no, {p(('CivicPlus', 'Revize', 'Granicus', '', 'CivicPlus'), 'n_nationkey')} AS platform FROM nation JOIN region ON n_regionkey = r_regionkey",
        "contacts": f"SELECT concat('c', {s('c_custkey')}) AS contact_id, {key('n_name')} AS municipality_id, {p(NAMES, 'c_custkey')} AS name, {p(TITLES, 'c_custkey * 5 + c_nationkey')} AS title, {p(DEPARTMENTS, 'c_custkey * 3 + c_nationkey * 2')} AS department, CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE concat({p(('user', 'tax', 'jane.doe', 'info', 'clerk', 'j.smith2'), 'c_custkey')}, CASE WHEN c_custkey % 5 < 3 THEN {s('c_custkey % 60')} ELSE '' END, '@t', {s('c_nationkey')}, '.example.org') END AS email, 'unknown' AS email_type, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE concat('860555', {s('1000 + c_custkey % 500')}) END AS phone, {p((None, '12', '', '7'), 'c_custkey')} AS phone_ext, {p((None, '1 Main St', '2 Elm Ave.'), 'c_custkey')} AS address, {p((None, 'Mon-Fri 9-5'), 'c_custkey')} AS hours, {p(CONTEXTS, 'c_custkey * 2 + c_nationkey')} AS source_context, {p(URLS, 'c_custkey * 7')} AS source_url, CAST(0.4 AS DOUBLE) + CAST(c_custkey % 50 AS DOUBLE) / CAST(100 AS DOUBLE) AS confidence, c_custkey AS seq FROM customer JOIN nation ON c_nationkey = n_nationkey",
        "service_links": f"SELECT concat('s', {s('p_partkey')}) AS service_id, {key('n_name')} AS municipality_id, {p(CATEGORIES, 'p_partkey')} AS category, {p(LABELS, 'p_partkey * 3')} AS label, {p(LINKS, 'p_partkey * 5')} AS url, {p(('t1.example.org', 'x.t2.example.org', 'axisgis.com', None, 'example.org'), 'p_partkey')} AS domain, {p(VENDORS, 'p_partkey * 2')} AS vendor, {p(PAGE_KINDS, 'p_partkey')} AS service_page_type, CAST(0.5 AS DOUBLE) + CAST(p_partkey % 46 AS DOUBLE) / CAST(100 AS DOUBLE) AS confidence, {p(URLS, 'p_partkey')} AS source_url, p_partkey AS seq FROM part JOIN nation ON p_partkey % 25 = n_nationkey",
        "locations": f"SELECT concat('l', {s('s_suppkey')}) AS location_id, {key('n_name')} AS municipality_id, {p((None, '1 Main Street', '2 Elm Ave.', '203 Middlesex Avenue , Connecticut'), 's_suppkey')} AS address, {p((None, 'Mon-Fri 9-5', 'and Mon ,Tue;8 -4', '9–5'), 's_suppkey + s_nationkey')} AS hours, {p(URLS, 's_suppkey')} AS source_url, s_suppkey AS seq FROM supplier JOIN nation ON s_nationkey = n_nationkey",
        "signals": f"SELECT concat('g', {s('CAST(floor(event_id / 4) AS BIGINT)')}) AS signal_id, {key('n_name')} AS municipality_id, {p(SIGNALS, 'event_id * 3')} AS signal_type, CASE WHEN event_id % 2 = 0 THEN event_type ELSE props END AS value, CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST(event_id % 90 AS DOUBLE) / CAST(100 AS DOUBLE) END AS confidence, {p(URLS, 'event_id')} AS source_url, event_id AS seq FROM events JOIN nation ON user_id % 25 = n_nationkey",
        "diagnostics": f"SELECT {key('n_name')} AS municipality_id, event_id AS seq, " + ", ".join(f"{num(k, 'event_id * 7 + user_id')} AS {name}" for k, name in enumerate(("http_status", "extracted_link_count", "candidate_service_link_count", "contact_rows_extracted", "response_text_length", "detected_block_signal", "detected_js_shell_signal"))) + " FROM events JOIN nation ON user_id % 25 = n_nationkey WHERE event_id % 5 = 0",
        "contact_pages": f"SELECT *, CASE layout WHEN 0 THEN concat('<h1>Staff</h1><table><tr><th>Name</th><th>Title</th><th>Phone</th><th>Email</th></tr><tr><td>', name, '</td><td>', title, '</td><td>', dialled, '</td><td><a href=\"mailto:', email, '\">mail</a></td></tr></table><p>', address, '</p><p>', hours, '</p>') WHEN 1 THEN concat('<div><div class=\"contact-name\">', name, '</div><div class=\"contact-position\">', title, '</div><span>', dialled, '</span> <a href=\"mailto:', email, '\">write</a></div><p>', address, '</p><p>', hours, '</p>') WHEN 2 THEN concat('<p>', name, ', ', title, ' - <a href=\"mailto:', email, '\">', email, '</a> ', dialled, '</p><p>', address, '</p><p>', hours, '</p>') ELSE concat('<div>Name: ', name, '<br>Title: ', title, '<br>Phone: ', dialled, '<br>Email: ', email, '</div><p>', address, '</p><p>', hours, '</p>') END AS html FROM (SELECT c_custkey AS page_id, concat('https://t', {s('c_nationkey')}, '.example.org/people/', {s('c_custkey')}) AS url, {pool((0, 1, 2, 3), 'c_custkey', 'INT')} AS layout, {p(('Jane Doe', 'John Smith', 'Mary Ann Jones', 'Ann Bell', 'Carl Dow'), 'c_custkey')} AS name, {p(('Town Clerk', 'Assessor', 'Tax Collector', 'Building Official', 'Town Planner', 'Finance Director', 'Mayor'), 'c_custkey')} AS title, concat('(860) 555-', {s('1000 + c_custkey % 500')}) AS dialled, concat('860555', {s('1000 + c_custkey % 500')}) AS phone, concat('p', {s('c_custkey')}, '@t', {s('c_nationkey')}, '.example.org') AS email, {p(('12 Main Ave.', '7 Elm Street', '203 Middlesex Rd', '1 Oak blvd.'), 'c_custkey * 3')} AS address, 'Hours: Monday-Friday 9 am - 5 pm' AS hours FROM customer ) people",
        "staff_pages": f"SELECT *, concat('<html><head>', CASE WHEN page_title IS NULL THEN '' ELSE concat('<title>', page_title, '</title>') END, '</head><body><div class=\"', class, '\">', CASE WHEN heading IS NULL THEN '' ELSE concat('<h4>', heading, CASE WHEN heading_title IS NULL THEN '' ELSE concat(' <span>', heading_title, '</span>') END, '</h4>') END, '<p>', line, '</p>', CASE WHEN more IS NULL THEN '' ELSE concat('<p><b>', more, '</b></p>') END, CASE WHEN mail IS NULL THEN '' ELSE concat('<a href=\"', mail, '\">write</a>') END, CASE WHEN tel IS NULL THEN '' ELSE concat('<a href=\"', tel, '\">call</a>') END, '</div></body></html>') AS html FROM (SELECT c_custkey AS page_id, {p(STAFF_URLS, 'c_custkey * 3 + c_nationkey')} AS url, {p(STAFF_CLASSES, 'c_custkey')} AS class, {p(STAFF_HEADINGS, 'c_custkey + c_nationkey')} AS heading, {p(STAFF_TITLES, 'c_custkey * 3')} AS heading_title, {p(STAFF_LINES, 'c_custkey * 2 + c_nationkey')} AS line, {p(STAFF_MORE, 'c_custkey + 2 * c_nationkey')} AS more, {p(STAFF_MAILS, 'c_nationkey')} AS mail, {p(STAFF_TELS, 'c_nationkey * 3 + c_custkey * 2')} AS tel, {p(STAFF_PAGES, 'c_custkey * 5 + c_nationkey')} AS page_title FROM customer ) staff",
        "fallback_signals": f"SELECT {key('n_name')} AS municipality_id, event_id AS seq, {p(('blocked_homepage', 'crawl_status', 'alternate_seed_attempted', 'email_pattern', None, 'gis_vendor', 'crawl_status'), 'event_id')} AS signal_type, {p(('cloudflare_403', 'homepage_fetch_failed', ' Yes', 'ok', None, 'false', 'Attempted', 'bot_protection_403', 'x', 'true', '1'), 'event_id * 3 + user_id')} AS value FROM events JOIN nation ON user_id % 25 = n_nationkey",
        "attempts": f"SELECT event_id, {pool((200, 403, 404, 301, 503, 200, None, 429, 500, 200, 418), 'event_id', 'INT')} AS status, {p(('directory', 'js_shell', 'unknown', 'blocked', 'unknown'), 'event_id')} AS kind, {p((None, '<p>x</p>', '', '<p>y</p>', '<p>z</p>', '<p>w</p>', '<p>v</p>'), 'event_id')} AS body, {pool((0, 0, 1), 'event_id', 'INT')} AS redirects, {p(('https://a/x', 'https://b/y', ''), 'event_id * 2')} AS final_url, {p(('https://a/x', 'https://b/y'), 'event_id')} AS url, {p(('server: cloudflare', 'cf-ray: 1; server: x', 'server: nginx', 'x-cdn: Incapsula', 'server: AkamaiGHost; via: y', ''), 'event_id')} AS headers FROM events",
        "vendor_names": f"SELECT p_partkey, {p(('Revize', 'revize ', ' TOWN WEB', 'townweb', 'Quasar Internet Solutions LLC', 'quasar', '', None, 'Acme', 'AWR Web Design', 'egovlink', 'WordPress', 'CivicLift'), 'p_partkey')} AS vendor FROM part ",
        "manifest": f"SELECT {key('n_name')} AS municipality_id, n_name AS town_name, r_name AS county, concat('batch_', {s('n_nationkey % 5')}) AS batch_id, {s('1 + n_nationkey % 3')} AS priority, {p(STATUSES, 'n_nationkey')} AS status, '' AS notes FROM nation JOIN region ON n_regionkey = r_regionkey",
    }


SQL = {name: f"{name} AS ({body})" for name, body in _pools(False).items()}
TABLES = ("nation", "region", "customer", "part", "supplier", "events")
#: Tables whose few short columns become long rows and pages, with their keys.
SPREAD = {"customer": "c_custkey", "part": "p_partkey", "supplier": "s_suppkey"}


def spread(df: DataFrame, key: str) -> DataFrame:
    """df dealt by its key over as many tasks as shuffles have. A file is read by no more tasks than it has row groups, and one
    group may hold a million short rows: the rules over them would all run in one task."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), key)


def spark_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One staged table; the driver tables are read as views of a name of their own."""
    body = _pools(True)[name]
    for t in TABLES:
        if f" {t} " in f"{body} ":
            given = spark.read.parquet(f"{sf_dir}/{t}.parquet")
            (spread(given, SPREAD[t]) if t in SPREAD else given).createOrReplaceTempView(f"stage_{t}")
            for word in ("FROM", "JOIN"):
                body = body.replace(f"{word} {t} ", f"{word} stage_{t} ").replace(f"{word} {t}\n", f"{word} stage_{t}\n")
            if body.endswith(f" {t}"):
                body = body[: -len(t)] + f"stage_{t}"
    return spark.sql(body)


def with_sql(*names: str) -> str:
    return ", ".join(SQL[n] for n in names)
