"""Contact and service enrichment: one chain of projections, computed from the raw columns, then one ranking shuffle.

Rules are data: tokens, outcomes and their order are fixed values; how they are tested is up to the plan. The town-wide
rank partitions by dedupe_key, whose groups are the few copies of one contact; a null key cannot occur (blank parts join
to a key of bars).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from townlens.functions.text import blank_to_null, chain, clamp, filled, flag, has_any, low, norm, one_of, word_count

# Tokens of the rules, in the order in which the rules apply.
NOT_A_PERSON = ("email", "contact", "office", "department", "town hall", "click here", "phone", "fax", "hours", "board of", "commission", "committee")
NOISE_NAMES = ("google maps", "requested", "hours", "office", "department", "click", "view", "faq")
TAX_TITLES = ("revenue collector", "tax office clerk", "delinquent & deferral tax clerk")
CLERK_TITLES = ("town and city clerk, registrar of vital statistics", "town and city clerk", "deputy town and city clerk", "deputy town and city clerk, cctc", "city clerk")
BUILDING_TITLES = ("chief building official", "acting building official", "assistant building official")
BUILDING_TITLES_WITH_DEPARTMENT = ("building inspector", "code official", "code enforcement officer", "zoning/code enforcement officer", "zoning/ code enforcement officer")
FINANCE_TITLES = ("director of finance", "title: director of finance", "assistant director of finance", "assistant director of finance - budget & grants", "assistant director of finance - operations", "director of finance and revenue", "director of finance and administration", "administrative officer / director of finance")
FINANCE_TITLES_WITH_DEPARTMENT = ("finance manager", "finance administrator", "accounting manager")
FINANCE_FALLBACK = ("comptroller", "chief financial officer", "cfo")
TREASURER_TITLES = ("treasurer", "town treasurer", "city treasurer", "borough treasurer")
CHIEF_ROLES = ("First Selectman", "Mayor", "Town Manager", "Town Administrator")
PLAIN_DEPARTMENTS = ("staff", "directory", "staff directory")
DEPARTMENT_OF_ROLE = {"Assessor": ("assessor", "assessment"), "Tax Collector": ("tax", "revenue"), "Town Clerk": ("clerk",), "Building Official": ("building",), "Finance Director": ("finance", "treasurer")}
STREET_WORDS = (" street", " avenue", " road", " lane", " drive", " ct ", " connecticut")
VENDOR_TAG = "revize:"
PAGE_CLASSES = ("staff_directory", "department_page", "contact_hub", "generic")


def role_text() -> Column:
    """Title, or the department where there is no title."""
    return F.lower(F.coalesce(blank_to_null("title"), blank_to_null("department"), F.lit("")))


def presence(df: DataFrame) -> DataFrame:
    return df.withColumns({f"has_{f}": flag(filled(f)) for f in ("name", "email", "phone", "department")})


def entity_type() -> Column:
    person = filled("name") & ~has_any(norm("name"), *NOT_A_PERSON)
    return chain((person, "person"), (filled("title"), "role"), (filled("department"), "department_contact"), default="unknown")


def is_role_only() -> Column:
    return flag((F.col("entity_type") == "role") | ((F.col("has_name") == 0) & (filled("title") | filled("department"))))


def _fields(test) -> Column:
    return test(low("name")) | test(low("title")) | test(low("department"))


def _board_with_phone() -> Column:
    either = lambda *t: has_any(low("name"), *t) | has_any(low("title"), *t)
    return either("phone") & either("board", "commission", "committee")


def _action_text() -> Column:
    return _fields(lambda x: x.startswith("email ") | has_any(x, "click here", "title:"))


def is_likely_noise() -> Column:
    squeezed = lambda x: F.lower(F.trim(F.replace(F.replace(F.translate(F.coalesce(F.col(x), F.lit("")), ".,", ""), F.lit("-"), F.lit(" ")), F.lit("  "), F.lit(" "))))
    no_letter = filled("name") & ~norm("name").rlike("[a-z]")
    same = filled("name") & filled("title") & (squeezed("name") == squeezed("title"))
    long_name = F.length(F.trim(F.coalesce("name", F.lit("")))) > 80
    return flag(_action_text() | _board_with_phone() | norm("name").startswith("the ") | has_any(low("name"), *NOISE_NAMES) | long_name | no_letter | same)


def is_likely_noise_legacy() -> Column:
    """The earlier rule: no name list; a name or title of digits and brackets alone is noise."""
    bare = lambda x: filled(x) & (F.trim(F.translate(F.coalesce(F.col(x), F.lit("")), "0123456789()", "")) == "")
    return flag(_action_text() | _board_with_phone() | bare("name") | bare("title"))


def _url_page_type() -> list[tuple[Column, str]]:
    url, context, trimmed = low("source_url"), low("source_context"), norm("source_url")
    slashes = F.length(trimmed) - F.length(F.replace(trimmed, F.lit("/"), F.lit("")))
    home = filled("source_url") & ((slashes <= 3) | has_any(trimmed, "/index.", "/home"))
    return [
        (has_any(url, "staff", "directory", "departments") | has_any(context, "staff", "directory", "departments"), "staff_directory"),
        (has_any(url, "assessor", "tax", "clerk", "building", "planning", "zoning"), "department_page"),
        (home, "homepage"),
        (has_any(url, "board", "commission", "committee") | has_any(context, "board", "commission", "committee"), "board_page"),
    ]


def page_type() -> Column:
    return chain(*[(low("source_context").contains(f"page_class={k}"), k) for k in PAGE_CLASSES], *_url_page_type(), default="other")


def page_type_legacy() -> Column:
    return chain(*_url_page_type(), default="other")


def role_normalized() -> Column:
    role, title, dept = role_text(), norm("title"), F.lower(F.coalesce(blank_to_null("department"), F.lit("")))
    return chain(
        (has_any(role, "selectman"), "First Selectman"),
        (has_any(role, "mayor"), "Mayor"),
        (has_any(role, "town manager"), "Town Manager"),
        (has_any(role, "town administrator"), "Town Administrator"),
        (has_any(role, "assessor"), "Assessor"),
        (has_any(role, "tax collector") | (one_of(title, *TAX_TITLES) & has_any(dept, "tax", "revenue")), "Tax Collector"),
        (one_of(title, *CLERK_TITLES) | has_any(role, "town clerk"), "Town Clerk"),
        (one_of(title, *BUILDING_TITLES) | (one_of(title, *BUILDING_TITLES_WITH_DEPARTMENT) & has_any(dept, "building")) | has_any(role, "building"), "Building Official"),
        ((title == "land use administrator") & has_any(dept, "land use", "planning", "zoning"), "Planner"),
        ((title == "zoning administrator") & has_any(dept, "planning", "zoning"), "Planner"),
        (has_any(role, "land use"), "Land Use"),
        (has_any(role, "planner", "planning", "zoning"), "Planner"),
        (one_of(title, *FINANCE_TITLES) | title.startswith("assistant director of finance -") | (one_of(title, *FINANCE_TITLES_WITH_DEPARTMENT) & has_any(dept, "finance", "treasurer")) | has_any(role, "finance director"), "Finance Director"),
        (one_of(title, *TREASURER_TITLES) | has_any(role, "treasurer"), "Treasurer"),
    )


def role_family() -> Column:
    role, title, dept = role_text(), norm("title"), F.lower(F.coalesce(blank_to_null("department"), F.lit("")))
    return chain(
        (has_any(role, "selectman", "mayor", "town manager", "town administrator"), "chief_executive"),
        (has_any(role, "assessor"), "assessor"),
        (has_any(role, "tax collector") | (one_of(title, *TAX_TITLES) & has_any(dept, "tax", "revenue")), "tax_collector"),
        (has_any(role, "town clerk"), "town_clerk"),
        (has_any(role, "building"), "building"),
        (has_any(role, "planner", "planning", "zoning", "land use"), "planning_zoning"),
        (has_any(role, "treasurer", "finance") | ((title == "accounting manager") & has_any(dept, "finance", "treasurer")), "finance"),
    )


def role_with_fallback() -> Column:
    """Roles that stayed empty in the finance family get one by exact title."""
    title = norm("title")
    late = chain((one_of(title, *FINANCE_TITLES, *FINANCE_FALLBACK) | title.startswith("assistant director of finance -"), "Finance Director"), (one_of(title, *TREASURER_TITLES), "Treasurer"))
    return F.when(F.col("role_normalized").isNull() & (F.col("role_family") == "finance"), late).otherwise(F.col("role_normalized"))


def department_normalized() -> Column:
    d = F.lower(F.coalesce(blank_to_null("department"), blank_to_null("title"), F.lit("")))
    return chain(
        (has_any(d, "assessor"), "Assessor"),
        (has_any(d, "tax collector"), "Tax Collector"),
        (has_any(d, "town clerk"), "Town Clerk"),
        (has_any(d, "building"), "Building"),
        (has_any(d, "planning", "zoning"), "Planning & Zoning"),
        (has_any(d, "finance", "treasurer"), "Finance"),
        (has_any(d, "land use"), "Land Use"),
        (has_any(d, "selectmen"), "Board of Selectmen"),
        (has_any(d, "mayor"), "Mayor's Office"),
        (has_any(d, "town manager", "town administrator"), "Town Manager"),
        default=blank_to_null("department"),
    )


def suspicious_by_department() -> Column:
    """A department that contradicts the role; directories mix departments and are left alone."""
    role, dept = F.col("role_normalized"), norm("department")
    telling = filled("department") & ~one_of(dept, *PLAIN_DEPARTMENTS)
    mismatch = [((role == r) & telling & ~has_any(dept, *tokens), "role_department_mismatch") for r, tokens in DEPARTMENT_OF_ROLE.items()]
    return chain((one_of(norm("page_type"), "staff_directory", "directory"), None), ((role == "Finance Director") & ~filled("department"), "low_context"), *mismatch).cast("string")


def suspicious_reason() -> Column:
    """Three layers: the department rule, then rules for vendor-tagged rows, then names that are no names (these win)."""
    name, title, tagged = low("name"), low("title"), low("source_context").startswith(VENDOR_TAG)
    not_person, first = F.col("entity_type") != "person", suspicious_by_department()
    hub = (norm("page_type") == "contact_hub") & (not_person | ~filled("name") | ~filled("title") | ~filled("department_normalized") | (~filled("email") & ~filled("phone")))
    contact_page = low("source_url").contains("contact") & (has_any(title, "contact") | has_any(name, "request", "information"))
    second = chain(
        (~filled("name") | has_any(name, *STREET_WORDS) | name.rlike("[0-9]{5}"), "invalid_person_name"),
        (not_person, "non_person_role_candidate"),
        (hub | contact_page, "contact_hub_candidate"),
        (one_of(F.col("role_normalized"), *CHIEF_ROLES) & (has_any(name, "assistant") | has_any(title, "assistant")), "assistant_role_contamination"),
    )
    layered = F.when(first.isNotNull() | F.col("role_normalized").isNull() | ~tagged, first).otherwise(second)
    n = norm("name")
    padded = F.concat(F.lit(" "), n, F.lit(" "))
    artifact = has_any(n, "affidavit", "vacanc") | one_of(n, "building", "tax collector", "department", "office") | has_any(padded, " department ", " office ")
    role_name = filled("name") & ((n == norm("title")) | (n == norm("role_normalized")))
    return F.when(tagged & artifact, "invalid_person_name").when(tagged & role_name, "role_only_name").otherwise(layered)


def semantic_confidence(page_term: bool = True) -> Column:
    page = low("page_type")
    total = F.coalesce("confidence", F.lit(0.0)) + F.when(F.col("has_name") == 1, 0.15).otherwise(0.0)
    total = total + F.when(F.col("has_email") == 1, 0.10).otherwise(0.0) + F.when(F.col("has_phone") == 1, 0.05).otherwise(0.0)
    total = total + F.when(filled("role_normalized"), 0.10).otherwise(0.0) + F.when(filled("department_normalized"), 0.05).otherwise(0.0)
    if page_term:
        total = total + chain((page == "staff_directory", 0.12), (page == "department_page", 0.06), (page == "contact_hub", -0.10), (one_of(page, "homepage", "generic", "other"), -0.12), default=0.0)
    total = total - F.when(F.col("is_likely_noise") == 1, 0.25).otherwise(0.0) - F.when(F.col("entity_type") == "unknown", 0.10).otherwise(0.0)
    return clamp(total)


def dedupe_key() -> Column:
    role = F.coalesce(blank_to_null("role_normalized"), blank_to_null("title"), F.lit(""))
    who = F.coalesce(blank_to_null("email"), blank_to_null("phone"), blank_to_null("name"), F.lit(""))
    return F.lower(F.concat(F.coalesce(F.trim("municipality_id"), F.lit("")), F.lit("|"), role, F.lit("|"), who))


def clean_title() -> Column:
    """Sentences and overlong titles go."""
    t, words = F.coalesce("title", F.lit("")), word_count("title")
    sentence = F.lower(t).contains("is responsible for") | (words > 12) | (t.rlike(r"[.?!]") & (words >= 6))
    return F.when(~filled("title") | sentence, None).otherwise(F.trim("title"))


def rank_order(legacy: bool = False) -> list[Column]:
    noise = F.coalesce("is_likely_noise", F.lit(0)).asc()
    has = [F.coalesce(f"has_{f}", F.lit(0)).desc() for f in ("name", "email", "phone")]
    tail = [F.round(F.coalesce("semantic_confidence", F.lit(0.0)), 9).desc(), F.coalesce("source_url", F.lit("")).asc(), F.coalesce("contact_id", F.lit("")).asc()]
    return [*has, noise, *tail] if legacy else [noise, *has, *tail]


def enrich_contacts(contacts: DataFrame, legacy: bool = False) -> DataFrame:
    """All derived columns of the contacts. legacy: the earlier noise, page, confidence and rank rules."""
    df = presence(contacts).withColumn("entity_type", entity_type())
    df = df.withColumns({"is_role_only": is_role_only(), "is_likely_noise": is_likely_noise_legacy() if legacy else is_likely_noise(), "page_type": page_type_legacy() if legacy else page_type(), "role_normalized": role_normalized(), "role_family": role_family(), "department_normalized": department_normalized()})
    df = df.withColumn("role_normalized", role_with_fallback())
    df = df.withColumns({"suspicious_reason": suspicious_reason(), "semantic_confidence": semantic_confidence(not legacy), "dedupe_key": dedupe_key()})
    best = Window.partitionBy("dedupe_key").orderBy(*rank_order(legacy))
    df = df.withColumns({"record_rank": F.row_number().over(best), "key_is_noise": F.min("is_likely_noise").over(Window.partitionBy("dedupe_key"))})
    lower = clamp(F.col("semantic_confidence") - 0.20)
    return df.withColumns({"display_confidence": F.when(F.col("record_rank") == 1, F.col("semantic_confidence")).otherwise(lower), "title": clean_title()})


CLEAN = ("contact_id", "municipality_id", "entity_type", "name", "title", "role_normalized", "role_family", "department", "department_normalized", "email", "email_type", "phone", "phone_ext", "address", "hours", "page_type", "source_url", "display_confidence")


def clean_contacts(enriched: DataFrame) -> DataFrame:
    """The best record of each key; a noisy one only where the key has no clean record."""
    return enriched.filter((F.col("record_rank") == 1) & ((F.col("is_likely_noise") == 0) | (F.col("key_is_noise") == 1))).select(*CLEAN)


def service_type() -> Column:
    cat, label, url = low("category"), low("label"), low("url")
    return chain(
        (cat.contains("gis") | label.contains("gis") | url.contains("gis"), "gis"),
        (has_any(cat, "property", "field card") | has_any(label, "property card", "field card") | url.contains("property"), "property_cards"),
        (cat.contains("tax") | label.contains("tax payment") | url.contains("tax"), "tax_payment"),
        (has_any(cat, "job", "employment") | has_any(label, "job", "employment"), "jobs"),
        (cat.contains("permit") | label.contains("permit") | url.contains("permit"), "permits"),
        (has_any(cat, "agenda", "minute") | has_any(label, "agenda", "minute") | has_any(url, "agenda", "minute"), "agendas_minutes"),
        default=blank_to_null("category"),
    )


def provider() -> Column:
    v = low("vendor")
    return chain((v.contains("civicplus"), "CivicPlus"), (v.contains("governmentjobs"), "GovernmentJobs"), (v.contains("vision"), "Vision"), default=blank_to_null("vendor"))


def enrich_services(services: DataFrame, municipalities: DataFrame) -> DataFrame:
    """Service types, providers, whether a link leaves the town's domain, and a confidence."""
    towns = municipalities.select(F.col("municipality_id"), norm("domain").alias("_town")).dropDuplicates(["municipality_id"])
    df = services.join(towns, "municipality_id", "left")
    host = norm("domain")
    apart = (host != "") & (F.coalesce("_town", F.lit("")) != "") & ~host.endswith(F.col("_town")) & ~F.col("_town").endswith(host)
    df = df.withColumns({"service_type": blank_to_null("category"), "service_type_normalized": service_type(), "provider_normalized": provider(), "is_external": flag(has_any(low("service_page_type"), "external", "vendor", "third") | apart)})
    first = F.coalesce("confidence", F.lit(0.0)) + F.when(filled("provider_normalized"), 0.05).otherwise(0.0) + F.when(filled("service_type_normalized"), 0.05).otherwise(0.0)
    return df.withColumn("display_confidence", clamp(first)).drop("_town")
