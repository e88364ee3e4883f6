"""Decisions about blocked sites: probe plans, trust, API inventories, the outcome of a recovery and its notes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from townlens.functions import urls
from townlens.functions.text import c, chain, flag, has_any, low, one_of

# Probe paths in priority order, word lists, enumerations.
DEEP_PATHS = {
    "directory": ("/Directory", "/Directory.aspx", "/directory", "/directory.aspx", "/StaffDirectory.aspx", "/staffdirectory.aspx"),
    "departments_root": ("/Departments", "/departments", "/government", "/Government"),
    "finance": ("/Departments/Finance", "/departments/finance", "/finance", "/finance-department", "/treasurer", "/comptroller"),
    "clerk": ("/Departments/Town-Clerk", "/departments/town-clerk", "/town-clerk", "/town-clerks-office", "/city-clerk", "/clerk"),
    "assessor": ("/Departments/Assessor", "/departments/assessor", "/assessor", "/assessors-office"),
    "tax": ("/Departments/Tax-Collector", "/departments/tax-collector", "/tax-collector", "/tax"),
    "building": ("/Departments/Building", "/departments/building", "/building-department", "/building", "/inspectional-services"),
    "planning": ("/Departments/Planning", "/departments/planning", "/planning-zoning", "/planning", "/land-use", "/zoning"),
}
BUDGET, STREAK = 20, 3
API_TYPES = ("swagger", "rest_root")
INVENTORY_TYPES = ("swagger_json", "swagger_ui", "rest_json", "html_only", "none")
CLASS_PRIORITY = {"contact_like": 3, "department_like": 2, "meeting_like": 1, "records_like": 1, "other": 0}
EXTRACTABLE = ("directory", "finance", "clerk", "assessor", "tax", "building", "planning")


def deep_paths(budget: int = BUDGET) -> list[tuple[int, str, str]]:
    """(ordinal, category, path): the paths by category in their order of priority, equal ones (case and a last slash apart) once,
    as many as the budget."""
    first: dict[str, tuple[str, str]] = {}
    for category in sorted(DEEP_PATHS, key=DEEP_ORDER.index):
        for path in DEEP_PATHS[category]:
            first.setdefault(path.lower().rstrip("/"), (category, path))
    return [(i, *x) for i, x in enumerate(list(first.values())[:budget], 1)]


def deep_path_plan(towns: DataFrame, home: str = "website_url", budget: int = BUDGET) -> DataFrame:
    """(municipality_id, ordinal, category, path, url): what to probe on each town's site; towns without one have no plan."""
    listed = F.array(*[F.struct(F.lit(i).alias("ordinal"), F.lit(k).alias("category"), F.lit(p).alias("path")) for i, k, p in deep_paths(budget)])
    rows = towns.filter(F.trim(F.coalesce(home, F.lit(""))) != "").select("municipality_id", F.col(home).alias("_home"), F.inline(listed))
    return rows.select("municipality_id", "ordinal", "category", "path", urls.normalize("path", "_home").alias("url"))


def behind_streak(rows: DataFrame, group: str, order: str, streak: int = STREAK) -> DataFrame:
    """rows with `blocked`: whether a run of `streak` refused attempts (403, 429) stands before a row in its group."""
    w = Window.partitionBy(group).orderBy(order)
    refused = F.coalesce(F.col("status").isin(403, 429), F.lit(False))
    df = rows.withColumn("_run", F.sum(flag(~refused)).over(w)).withColumn("_len", F.when(refused, F.count(F.when(refused, 1)).over(Window.partitionBy(group, "_run").orderBy(order))).otherwise(0))
    before = F.max(flag(F.col("_len") >= streak)).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn("blocked", F.coalesce(before, F.lit(0)) == 1).drop("_run", "_len")


def until_blocked(results: DataFrame, group: str = "municipality_id", order: str = "ordinal", streak: int = STREAK) -> DataFrame:
    """The probes of each town up to the end of the first run of refused ones (403, 429)."""
    return behind_streak(results, group, order, streak).filter(~F.col("blocked")).drop("blocked")


#: The phases of a recovery in their order, the discovered links tried, the probes that both kinds share, the
#: contacts after which deep paths end.
PHASES = ("home", "fallback", "api", "deep", "sitemap", "robots", "discovered", "known")
DEEP_ORDER = ("directory", "finance", "clerk", "assessor", "tax", "building", "planning", "departments_root")
DISCOVERED, PROBES, ENOUGH = 4, 10, 10


def recovery_plan(attempts: DataFrame, group: str = "municipality_id", budget: int = PROBES, deep_budget: int = BUDGET) -> DataFrame:
    """What a recovery of each town does with its attempts (phase, ordinal, url, path, category, status, hit, content_type,
    text, contacts): every attempt with `outcome`, and `place`, its place among those done.

    Home, fallback and api are always asked. Deep paths come by category, equal paths once, up to their own budget, their own
    run of refused answers, or enough contacts from pages that pass the extraction gate. Then sitemap, robots, discovered links
    (the first few) and known paths, equal urls once; the last two share a budget, and all of these end behind a run of refused
    answers, in which home and fallback count too. outcome: done, duplicate, over_limit, over_budget, blocked or
    enough_contacts; unknown_phase for a phase that is none. Ordinals are distinct within a town and phase."""
    by = Window.partitionBy(group)
    phase = chain(*[(F.col("phase") == p, i) for i, p in enumerate(PHASES)])
    category = chain(*[(low("category") == k, i) for i, k in enumerate(DEEP_ORDER)], default=len(DEEP_ORDER))
    lane = F.when(F.col("phase") == "deep", "deep").when(F.col("phase") == "api", "api").otherwise("outer")
    path = F.lower(F.trim(F.coalesce("path", F.lit(""))))
    key = F.when(F.col("phase") == "deep", F.when(path == "/", path).otherwise(F.regexp_replace(path, "/+$", ""))).when(F.col("phase").isin("discovered", "known"), F.col("url"))
    # key and gains are known of a row alone: no window needs texts and urls, and where they are not asked for none sorts them
    gains = F.when(extraction_gate() & (F.col("phase") == "deep"), F.coalesce("contacts", F.lit(0))).otherwise(0)
    rows = attempts.withColumns({"_phase": phase, "_lane": lane, "_sub": F.when(F.col("phase") == "deep", category).otherwise(0), "_gains": gains, "_key": key})
    line = by.orderBy("_phase", "_sub", "ordinal")
    rows = rows.withColumns({"_order": F.row_number().over(line), "_probe": F.col("phase").isin("discovered", "known")})
    rows = rows.withColumn("_limit", (F.col("phase") == "discovered") & (F.row_number().over(Window.partitionBy(group, "phase").orderBy("ordinal")) > DISCOVERED))
    same = Window.partitionBy(group, "_lane", "_key", "_limit").orderBy("_order")
    rows = rows.withColumn("outcome", chain((phase.isNull(), "unknown_phase"), (F.col("_limit"), "over_limit"), (F.col("_key").isNotNull() & (F.row_number().over(same) > 1), "duplicate")))
    counted = Window.partitionBy(group, "_budget").orderBy("_order")
    rows = rows.withColumn("_budget", F.when(F.col("outcome").isNotNull(), "none").when(F.col("_probe"), "probe").when(F.col("phase") == "deep", "deep").otherwise("free"))
    nth = F.row_number().over(counted)
    most = F.when(F.col("_budget") == "probe", budget).when(F.col("_budget") == "deep", deep_budget)
    rows = rows.withColumn("outcome", F.coalesce("outcome", F.when(nth > most, "over_budget")))
    live, out = rows.filter("outcome IS NULL").withColumn("_line", F.concat_ws("|", F.col(group).cast("string"), "_lane")), rows.filter("outcome IS NOT NULL")
    live = behind_streak(live, "_line", "_order")
    gained = F.when(~F.col("blocked"), F.col("_gains")).otherwise(0)
    so_far = F.sum(gained).over(Window.partitionBy("_line").orderBy("_order").rowsBetween(Window.unboundedPreceding, -1))
    enough = (F.col("phase") == "deep") & (F.coalesce(so_far, F.lit(0)) >= ENOUGH)
    live = live.withColumn("outcome", chain((F.col("blocked") & (F.col("_lane") != "api"), "blocked"), (enough, "enough_contacts"), default="done")).drop("blocked", "_line")
    both = live.unionByName(out)
    place = F.when(F.col("outcome") == "done", F.row_number().over(Window.partitionBy(group, F.col("outcome") == "done").orderBy("_order")))
    return both.withColumn("place", place).drop("_phase", "_lane", "_sub", "_order", "_key", "_probe", "_limit", "_budget", "_gains")


def extraction_gate() -> Column:
    """Whether a probed page is worth reading: a hit of a telling category with a body of html."""
    return (F.col("hit") == 1) & one_of(low("category"), *EXTRACTABLE) & low("content_type").contains("html") & (F.length(F.coalesce("text", F.lit(""))) >= 500)


def trust(results: DataFrame, hints: dict[str, tuple[str, ...]], legacy_hints: tuple[str, ...]) -> DataFrame:
    """Trust in each town's deep-path hits: high, medium, low or none, and whether old pages are suspected."""
    path, body, hit = low("path"), F.substring(low("text"), 1, 4000), F.col("hit") == 1
    aligned = chain(*[(low("category") == k, has_any(F.concat(path, F.lit(" "), body), *v)) for k, v in hints.items()], default=False)
    clean = (urls.normalized_path("path") != "/") & ~path.rlike("[?=]") & ~path.rlike("/[0-9]+(/|$)")
    old = path.rlike("/[0-9]{2,}(/|$)") | has_any(path, *legacy_hints) | has_any(body, *legacy_hints)
    most = lambda test: F.max(flag(hit & test))
    out = results.groupBy("municipality_id").agg(F.max(flag(hit)).alias("h"), most(aligned).alias("a"), most(clean).alias("k"), most(old).alias("l"), F.max(flag(F.coalesce("extracted", F.lit(0)) > 0)).alias("x"))
    level = chain((F.col("h") == 0, "none"), ((F.col("x") == 1) & (F.col("a") == 1) & (F.col("k") == 1) & (F.col("l") == 0), "high"), (F.col("x") == 1, "medium"), default="low")
    return out.select("municipality_id", level.alias("trust"), F.when(F.col("h") == 1, F.col("l")).otherwise(0).alias("legacy_suspected"))


def api_presence(results: DataFrame) -> DataFrame:
    """(municipality_id, api_hit, api_type): swagger before a plain api root."""
    ok, sample = F.col("status") == 200, F.substring(low("text"), 1, 500)
    swagger, rest = F.max(flag(ok & has_any(sample, "swagger", "openapi"))), F.max(flag(ok & low("path").contains("api")))
    return results.groupBy("municipality_id").agg(swagger.alias("s"), rest.alias("r")).select("municipality_id", F.greatest("s", "r").alias("api_hit"), chain((F.col("s") == 1, "swagger"), (F.col("r") == 1, "rest_root"), default="none").alias("api_type"))


def swagger_endpoints(documents: DataFrame, text: str = "text") -> DataFrame:
    """One row for each GET operation of a swagger document: path, summary, operation and tags."""
    shape = "struct<paths: map<string, struct<get: struct<summary: string, description: string, operationId: string, tags: array<string>>>>>"
    parsed = documents.withColumn("_doc", F.from_json(text, shape)).select("municipality_id", F.explode("_doc.paths").alias("path", "op")).filter("op.get is not null")
    return parsed.select("municipality_id", F.trim("path").alias("path"), F.coalesce(F.trim("op.get.summary"), F.lit("")).alias("summary"), F.coalesce(F.trim("op.get.operationId"), F.lit("")).alias("operation_id"), F.coalesce("op.get.tags", F.array().cast("array<string>")).alias("tags"))


def endpoint_score() -> tuple[Column, Column]:
    """(score, class) of an endpoint row."""
    hay = F.concat_ws(" ", low("path"), low("summary"), low("operation_id"), F.lower(F.array_join("tags", " ")))
    when = lambda words, w: F.when(has_any(hay, *words), w).otherwise(0)
    score = when(("directory", "staff", "contact"), 3) + when(("department",), 2) + when(("tax", "assessor", "clerk", "building", "planning", "finance"), 2) + when(("agenda", "meeting", "minutes", "publicrecords"), 1) + when(("auth", "login", "account", "token", "admin"), -5) + when(("health", "ping", "telemetry"), -3)
    kind = chain((has_any(hay, "directory", "staff", "contact", "official", "clerk"), "contact_like"), (has_any(hay, "department", "tax", "assessor", "building", "planning", "finance"), "department_like"), (has_any(hay, "agenda", "meeting", "minutes"), "meeting_like"), (hay.contains("records"), "records_like"), default="other")
    return score, kind


def select_endpoints(endpoints: DataFrame, most: int = 3, excluded: tuple[str, ...] = ("auth", "login", "account", "token", "admin", "health", "ping", "telemetry")) -> DataFrame:
    """Of each town the endpoints worth a call: class, then score, then the shortest path."""
    score, kind = endpoint_score()
    df = endpoints.withColumns({"score": score, "endpoint_class": kind})
    p = F.lower("path")
    df = df.filter((F.col("score") > 0) & (p != "") & ~p.rlike(r"[{}]") & ~has_any(p, *excluded) & ~p.rlike("/ids?$"))
    rank = chain(*[(F.col("endpoint_class") == k, v) for k, v in CLASS_PRIORITY.items()], default=0)
    order = Window.partitionBy("municipality_id").orderBy(rank.desc(), F.desc("score"), F.length("path"), "path")
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def recovery_result() -> Column:
    """The outcome of a recovery from its counters; deep paths and APIs override the first verdict."""
    n = lambda x: F.coalesce(F.col(x).cast("int"), F.lit(0))
    contacts, winners, known, found = n("recovered_contact_count"), n("recovered_role_winner_count"), n("known_path_hits"), n("discovered_path_hits")
    first = chain(
        ((n("directory_hit") == 1) & (contacts > 0) & (winners == 0), "partial_directory_recovery"),
        ((n("directory_hit") == 1) & (contacts > 0), "recovered_directory_hit"),
        (n("directory_hit") == 1, "directory_present_no_extract"),
        ((contacts > 0) & (n("recovered_from_sitemap") == 1), "recovered_sitemap_path"),
        ((contacts > 0) & (n("recovered_from_known") == 1), "recovered_known_path"),
        (contacts > 0, "partial_recovery"),
        ((n("has_any_200") == 1) & (known > 0), "discovery_failure"),
        ((known > 0) | (found > 0), "partial_recovery"),
        (n("blocked_responses") >= STREAK, "unrecovered_http_block"),
        default="recovered_manual_seed_needed",
    )
    deep, api = n("deep_path_hits") > 0, contacts == 0
    return chain(
        (deep & (contacts > 0) & (winners > 0), "recovered_deep_path"),
        (deep & ((contacts > 0) | (n("deep_extraction_contact_total") > 0)), "partial_deep_path_recovery"),
        (deep, "deep_path_present_no_extract"),
        (api & (n("successful_api_probe_count") > 0) & (n("likely_structured_endpoint_count") > 0), "api_structured_data_found"),
        (api & (F.coalesce("swagger_json_path", F.lit("")) != "") & (n("documented_get_count") > 0), "api_inventory_viable"),
        (api & (n("api_hit") == 1), "api_available_no_scrape"),
        default=first,
    )


def zero_reason() -> Column:
    n = lambda x: F.coalesce(F.col(x).cast("int"), F.lit(0))
    return F.when(n("deep_path_hits") > 0, chain((n("deep_html_candidate_count") <= 0, "no_html_candidate"), (n("deep_extraction_attempt_count") <= 0, "guard_filtered_all_html"), (n("deep_extraction_contact_total") <= 0, "extractor_returned_zero"), (n("recovered_contact_count") <= 0, "upsert_no_net_new"), default="none"))


def note(notes: Column | str, key: str) -> Column:
    """The value of a key in `k=v;k=v` notes; the first wins, keys in any case, empty where absent."""
    return F.trim(F.regexp_extract(F.coalesce(c(notes), F.lit("")), rf"(?i)(?:^|;)\s*{key}=([^;]*)", 1))


def note_int(notes: Column | str, key: str) -> Column:
    return F.coalesce(note(notes, key).try_cast("double").cast("int"), F.lit(0))


def note_enum(notes: Column | str, key: str, values: tuple[str, ...], default: str) -> Column:
    v = F.lower(note(notes, key))
    return F.when(v.isin(*values), v).otherwise(default)


def notes_of(**parts: Column) -> Column:
    """`k=v;` text of the parts that are not null."""
    return F.concat_ws(";", *[F.when(v.isNotNull(), F.concat(F.lit(f"{k}="), v.cast("string"))) for k, v in parts.items()])
