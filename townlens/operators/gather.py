"""What stands between reading pages and loading rows: contact rows made comparable and merged, links composed into a
budget, the outcome of attempts, and what a town's fallback signals say."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from townlens.functions import urls
from townlens.functions.text import any_keyword, c, chain, filled, flag, has_any, keyword_blob, low, normalize_whitespace
from townlens.operators import extract
from townlens.operators.merge import RICHNESS

# Names that are no person's, labels before a value, status codes, words of protection services.
NO_NAMES, NO_NAME_WORDS = ("staff directory",), r"\b(email|phone|contact|vacant)\b"
BLOCK_CODES, REDIRECT_CODES = (401, 403, 429), (301, 302, 303, 307, 308)
GUARDS = ("akamai", "incapsula", "imperva", "sucuri", "bot", "challenge")
ASSET_SUFFIXES = (".jpg", ".jpeg", ".png", ".gif", ".svg", ".css", ".js", ".ico", ".zip")
FILE_SUFFIXES = (".pdf", ".doc", ".docx", ".xls", ".xlsx", ".jpg", ".jpeg", ".png", ".gif", ".zip")
PROBE_HINTS = ("directory", "staff", "department", "government", "town-clerk", "tax", "assessor", "building", "planning", "zoning", "finance", "contact")
TRUE_WORDS = ("true", "1", "yes", "attempted")
DEFAULT_CONFIDENCE, MOST_CONFIDENCE, RICHNESS_STEP = 0.45, 0.995, 0.01
MERGED = ("name", "title", "department", "email", "phone", "phone_ext", "address", "hours", "source_context")


# ---- contact rows


def normalize_contacts(df: DataFrame) -> DataFrame:
    """Rows that name somebody, their fields without spare spaces or labels; the others are left out."""
    name = normalize_whitespace("name")
    named = name.isNotNull() & low(name).rlike("[a-z]") & ~has_any(low(name), *NO_NAMES) & ~low(name).rlike(NO_NAME_WORDS)
    unlabelled = lambda f: F.nullif(F.btrim(F.regexp_replace(normalize_whitespace(f), r"(?i)^email\s+", ""), F.lit(" -:;,.")), F.lit(""))
    bare = lambda f: F.nullif(F.trim(c(f)), F.lit(""))
    fields = {"name": name, "title": unlabelled("title"), "department": unlabelled("department"), "email": F.lower(bare("email")), "phone": bare("phone"), "phone_ext": bare("phone_ext"), "address": normalize_whitespace("address"), "hours": normalize_whitespace("hours"), "source_context": normalize_whitespace("source_context"), "confidence": F.coalesce("confidence", F.lit(DEFAULT_CONFIDENCE))}
    return df.filter(named).withColumns(fields)


def row_key(page: Column | str) -> Column:
    """Rows of one page are one contact by their email, else by name with title, department or phone."""
    key = lambda x: F.coalesce(F.trim(keyword_blob(x)), F.lit(""))
    second = F.coalesce(F.nullif(key(F.coalesce(F.nullif("title", F.lit("")), F.col("department"))), F.lit("")), key("phone"))
    return F.when(filled("email"), F.concat(F.lit("email|"), F.lower(F.trim("email")))).otherwise(F.concat_ws("|", F.lit("row"), key("name"), second, key(page)))


def _richness(row: Column) -> Column:
    return sum((F.when(filled(row[f]), w).otherwise(0) for f, w in RICHNESS.items()), F.lit(0))


def merge_contacts(df: DataFrame, page: str = "source_url", seq: str = "seq") -> DataFrame:
    """Contacts of each page, merged by row_key in order: the richer row leads (of equals the more confident, the later
    of these too), the other fills its blanks, the highest confidence stays. A page's rows are its own: groups are small."""
    kept = ("confidence", *MERGED)
    rows = df.withColumn("_key", row_key(page)).groupBy(page, "_key").agg(F.array_sort(F.collect_list(F.struct(F.col(seq).alias("_seq"), *kept))).alias("rows"))

    def step(old: Column, new: Column) -> Column:
        a, b = _richness(old), _richness(new)
        new_leads = (b > a) | ((a == b) & (new["confidence"] >= old["confidence"]))
        filled_in = lambda f: F.when(new_leads, F.when(filled(new[f]), new[f]).otherwise(old[f])).otherwise(F.when(filled(old[f]), old[f]).otherwise(new[f]))
        return F.struct(old["_seq"].alias("_seq"), F.greatest(old["confidence"], new["confidence"]).alias("confidence"), *[filled_in(f).alias(f) for f in MERGED])

    out = F.aggregate(F.slice("rows", F.lit(2), F.size("rows")), F.element_at("rows", 1), step)
    return rows.select(page, F.size("rows").alias("sightings"), out.alias("r")).select(page, "sightings", *[f"r.{f}" for f in kept])


def effective_confidence() -> Column:
    return F.least(F.lit(MOST_CONFIDENCE), F.coalesce("confidence", F.lit(0.0)) + RICHNESS_STEP * sum((F.when(filled(f), w).otherwise(0) for f, w in RICHNESS.items()), F.lit(0)))


def first_of(df: DataFrame, fields: tuple[str, ...], within: str, seq: str = "seq") -> DataFrame:
    """Of rows that agree in all fields (case and spaces aside) within a group, the first."""
    keys = [F.coalesce(F.lower(normalize_whitespace(f)), F.lit("")) for f in fields]
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(within, *keys).orderBy(seq))).filter("_rn = 1").drop("_rn")


# ---- links


def compose_links(knowledge: DataFrame, service: DataFrame, group: str, limit: int = 25) -> DataFrame:
    """Ranked links of two kinds (group, url, rank) in one list of limit: the first of the one, a quarter (three at least)
    of the other, then the rest of each; the first place of a url counts."""
    quarter = min(max(3, limit // 4), limit)
    placed = lambda df, budget, first: df.filter(filled("url")).select(group, "url", F.when(F.col("rank") <= budget, first).otherwise(first + 2).alias("part"), "rank")
    both = placed(knowledge, limit - quarter, 1).unionByName(placed(service, quarter, 2))
    best = both.groupBy(group, "url").agg(F.min(F.struct("part", "rank")).alias("at"))
    return best.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy("at", "url"))).filter(F.col("place") <= limit).select(group, "url", "place")


def unscored_links(links: DataFrame, group: str, limit: int = 25, seq: str = "seq") -> DataFrame:
    """The first links of a group that are no assets, each url once, where none has a score."""
    suffix = "(" + "|".join(s.replace(".", r"\.") for s in ASSET_SUFFIXES) + ")$"
    once = links.filter(filled("url") & ~low("url").rlike(suffix)).groupBy(group, "url").agg(F.min(seq).alias("_seq"))
    ranked = once.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy("_seq", "url"))).filter(F.col("place") <= limit)
    return ranked.select(group, "url", "place", F.lit(0.5).alias("score"), F.lit("internal_fallback").alias("reasons"))


def candidate_order(routes: Column, priority: Column, seq: Column) -> list[Column]:
    """By route, then by falling priority, then as found."""
    return [routes.asc(), priority.desc(), seq.asc()]


def discovered_probes(found: DataFrame, group: str, town_domain: str, limit: int = 4) -> DataFrame:
    """Of the urls (group, url, kind) found in site maps and robots files, the best inside the town's domain."""
    host, kind = urls.domain("url"), extract.page_class("url", F.lit(""))
    contact = kind.isin(*extract.CONTACT_ORIENTED)
    hints = sum((low("url").contains(h).cast("int") for h in PROBE_HINTS), F.lit(0))
    file = low("url").rlike("(" + "|".join(s.replace(".", r"\.") for s in FILE_SUFFIXES) + ")$")
    score = hints + F.when(contact, 1.5).otherwise(0.0) + F.when(F.col("kind") == "sitemap", 0.15).otherwise(0.0)
    inside = found.filter(host.isNotNull() & urls.is_internal(host, F.col(town_domain)) & ~file & (contact | (hints > 0)))
    best = inside.withColumn("score", score).groupBy(group, "url").agg(F.round(F.max("score"), 3).alias("score"))
    return best.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("score"), "url"))).filter(F.col("place") <= limit)


def vendor_best(services: DataFrame, group: str, seq: str = "seq") -> DataFrame:
    """Of each vendor the most confident link; of equals the first."""
    best = F.max_by(F.struct("url", "confidence"), F.struct(F.coalesce("confidence", F.lit(0.0)), -F.col(seq))).alias("b")
    return services.filter(filled("vendor")).groupBy(group, "vendor").agg(best).select(group, "vendor", "b.url", "b.confidence")


# ---- attempts


def attempt_outcome(status: Column, kind: Column, has_body: Column, redirects: Column, final_url: Column, url: Column, answered: Column) -> Column:
    """What came of fetching a directory page."""
    moved = (redirects > 0) & filled(final_url) & filled(url) & (final_url != url)
    return chain(
        ((kind == "blocked") | status.isin(*BLOCK_CODES), "blocked_or_forbidden"),
        (status == 404, "not_found"),
        (~answered, "other_http_error"),
        (status.isin(*REDIRECT_CODES), "redirect_only"),
        (status >= 500, "other_http_error"),
        (~has_body, "empty_response"),
        (kind == "js_shell", "ok_js_shell"),
        (kind == "directory", "ok_directory"),
        (moved, "redirect_only"),
        default="other_http_error",
    )


def blocked_homepage(status: Column, headers: Column) -> Column:
    """Who refuses a home page, from the headers (a map) of a 403; null where nobody is known."""
    names = F.transform(F.map_keys(headers), F.lower)
    values = F.lower(F.array_join(F.map_values(headers), " "))
    return F.when(status == 403, F.when(F.array_contains(names, "cf-ray") | values.contains("cloudflare"), "cloudflare_403").when(has_any(values, *GUARDS), "bot_protection_403"))


def fallback_status(towns: DataFrame, signals: DataFrame, has_data: DataFrame, seq: str = "seq") -> DataFrame:
    """Five flags of a town from its signals; has_data: the towns that have a page, contact, link or location."""
    value = F.lower(F.trim("value"))
    of = lambda kind: (F.col("signal_type") == kind) & F.col("value").isNotNull()
    seen = signals.groupBy("municipality_id").agg(
        F.max(flag(of("blocked_homepage"))).alias("blocked_homepage"),
        F.min_by(value, F.when(of("blocked_homepage"), F.col(seq))).alias("blocked_homepage_value"),
        F.max(flag(of("crawl_status") & (value == "homepage_fetch_failed"))).alias("homepage_fetch_failed"),
        F.max(flag(of("alternate_seed_attempted") & value.isin(*TRUE_WORDS))).alias("alternate_seed_attempted"),
    )
    data = has_data.select("municipality_id").distinct().withColumn("_data", F.lit(1))
    out = towns.select("municipality_id").join(seen, "municipality_id", "left").join(data, "municipality_id", "left")
    out = out.fillna(0, ["blocked_homepage", "homepage_fetch_failed", "alternate_seed_attempted", "_data"])
    return out.withColumn("recovered_after_homepage_failure", F.col("homepage_fetch_failed") * F.col("_data")).drop("_data")


def true_false(x: Column | str) -> Column:
    """A flag as exports write it."""
    return F.when(F.coalesce(c(x).cast("int"), F.lit(0)) != 0, "true").otherwise("false")


def listed_keywords(blob: Column, keywords: tuple[str, ...]) -> Column:
    """The keywords that a text holds, joined: the reasons of a score."""
    return F.array_join(F.array_compact(F.array(*[F.when(any_keyword(blob, (k,)), F.lit(k)) for k in keywords])), "; ")


def reason_histogram(df: DataFrame, reasons: str = "reasons") -> DataFrame:
    """How often each reason of a joined list occurs."""
    one = F.explode(F.split(F.coalesce(c(reasons), F.lit("")), r"\s*;\s*")).alias("reason")
    return df.select(one).filter("reason <> ''").groupBy("reason").agg(F.count("*").alias("n"))


# ---- departments and towns

# Words of departments, texts of menus, and the weights of what a text holds.
STRONG_DEPARTMENTS = ("inland wetlands and watercourses agency", "assessor", "tax collector", "building department", "planning and zoning commission", "public works department", "human resources", "town clerk", "board of selectmen")
ENTITIES = ("department", "office", "agency", "board", "commission", "committee", "authority", "division", "bureau")
FUNCTIONS = ("clerk", "assessor", "collector", "treasurer", "finance", "hr", "human resources", "public works", "planning", "zoning", "land use", "wetlands", "building", "permitting", "recreation", "library", "police", "fire", "emergency management", "registrar", "health")
MENU_TEXTS = ("contact us", "phone numbers", "staff directory", "home", "government", "departments", "services", "view map", "click here", "email us", "hours", "physical address", "mailing address", "quick links", "popular links")
SHORT_ROLES = ("assessor", "clerk", "collector", "treasurer", "registrar")
LEAST_SCORE, LEAST_SCORE_OF_ROLE = 2.4, 0.9


def department_score(x: Column | str) -> Column:
    """How much a text reads like the name of a department; 0 for menus, addresses and texts of another length."""
    t = F.regexp_replace(F.regexp_replace(F.coalesce(c(x), F.lit("")), extract.EMAIL, " "), extract.PHONE, " ")
    t = F.lower(F.btrim(F.regexp_replace(F.regexp_replace(t, r"[|•]+", " "), r"\s+", " "), F.lit(" -:;,.")))
    blob = keyword_blob(t)
    held = lambda words, weight: sum((F.when(any_keyword(blob, (w,)), weight).otherwise(0.0) for w in words), F.lit(0.0))
    score = held(STRONG_DEPARTMENTS, 2.2) + held(ENTITIES, 1.3) + held(FUNCTIONS, 1.0) + F.when(t.startswith("board of "), 1.2).otherwise(0.0)
    out = ~F.length(t).between(3, 120) | t.isin(*MENU_TEXTS) | has_any(t, "http://", "https://", "www.", ".gov/", "click here")
    return F.when(out, 0.0).otherwise(F.round(score, 6))


def reads_as_department(x: Column | str) -> Column:
    """Whether the score is enough: less of it for a role in few words."""
    words = F.size(F.filter(F.split(F.trim(F.coalesce(c(x), F.lit(""))), r"\s+"), lambda w: w != ""))
    least = F.when(any_keyword(keyword_blob(x), SHORT_ROLES) & (words <= 4), LEAST_SCORE_OF_ROLE).otherwise(LEAST_SCORE)
    return department_score(x) >= least


def troubled_towns(towns: DataFrame, signals: DataFrame) -> DataFrame:
    """Towns whose home page is blocked or failed, or whose other seed did not help."""
    value = F.lower(F.trim("value"))
    seen = lambda kind, *values: F.max(flag((F.col("signal_type") == kind) & (value.isin(*values) if values else F.lit(True)))).alias(kind)
    rolled = signals.groupBy("municipality_id").agg(
        seen("blocked_homepage"), F.max(F.when(F.col("signal_type") == "blocked_homepage", F.col("value"))).alias("blocked_homepage_value"),
        seen("crawl_status", "homepage_fetch_failed"), seen("alternate_seed_attempted", *TRUE_WORDS), seen("alternate_seed_recovered", *TRUE_WORDS[:3]),
    )
    df = towns.select("municipality_id", "name").join(rolled, "municipality_id", "left")
    is_ = lambda f: F.coalesce(F.col(f), F.lit(0)) == 1
    shown = is_("blocked_homepage") | is_("crawl_status") | (is_("alternate_seed_attempted") & ~is_("alternate_seed_recovered"))
    return df.filter(shown).select("municipality_id", "name", true_false("blocked_homepage").alias("blocked_homepage"), F.coalesce("blocked_homepage_value", F.lit("")).alias("blocked_homepage_value"), *[true_false(f).alias(f) for f in ("alternate_seed_attempted", "alternate_seed_recovered")])


def table_counts(towns: DataFrame, **tables: DataFrame) -> DataFrame:
    """Rows of each table by town, from one tagged union."""
    tagged = None
    for name, df in tables.items():
        part = df.select("municipality_id", F.lit(name).alias("table"))
        tagged = part if tagged is None else tagged.unionByName(part)
    counts = tagged.groupBy("municipality_id").agg(*[F.sum(flag(F.col("table") == n)).alias(n) for n in tables])
    return towns.select("municipality_id").join(counts, "municipality_id", "left").fillna(0)


def of_batch(df: DataFrame, manifest: DataFrame, batch_id: str) -> DataFrame:
    """The rows of the towns of one batch."""
    mine = manifest.filter(F.lower(F.trim("batch_id")) == batch_id.strip().lower()).select("municipality_id")
    return df.join(mine.distinct(), "municipality_id", "left_semi")
