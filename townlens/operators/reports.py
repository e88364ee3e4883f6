"""Directories, profiles, QA reports and roll-ups over the enriched tables.

Town-grained sides (towns, counts, signals) are joined by town; nothing is broadcast by hand: adaptive execution does so
where a side is small enough by its measured size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from townlens.functions.text import c, chain, filled, flag, has_any, low, normalize_whitespace, one_of
from townlens.operators.extract import effectively_blocked

# Role groups in report order, roles of the saved queries, operational signals.
ROLE_GROUPS = {"executive": ("First Selectman", "Mayor", "Town Manager", "Town Administrator"), "assessment": ("Assessor",), "tax": ("Tax Collector",), "clerk": ("Town Clerk",), "building": ("Building Official",), "planning": ("Planner", "Land Use", "Zoning Enforcement Officer", "ZEO"), "finance": ("Finance Director", "Treasurer")}
FAMILIES = ("chief_executive", "assessor", "tax_collector", "town_clerk", "building", "planning_zoning", "finance")
DEPARTMENT_WORD = {"Assessor": "assessor", "Tax Collector": "tax", "Town Clerk": "clerk", "Building Official": "building", "Finance Director": "finance"}
OPERATIONAL_SIGNALS = ("crawl_diagnostics", "blocked_recovery_status", "crawl_error", "page_fetch")


def role_directory(clean: DataFrame) -> DataFrame:
    return clean.filter(one_of(F.col("entity_type"), "person", "role", "department_contact") & filled("role_normalized")).select("municipality_id", "role_normalized", "role_family", "name", "email", "phone", "department_normalized", "source_url", "display_confidence")


def service_directory(services: DataFrame) -> DataFrame:
    return services.select("service_id", "municipality_id", "service_type_normalized", "label", "url", "provider_normalized", "domain", "is_external", "display_confidence", "source_url")


def town_profile(towns: DataFrame, clean: DataFrame, services: DataFrame) -> DataFrame:
    """One wide row a town: of each role family the name, email and phone of its most confident contact, and one link of
    each service type; one aggregation a table instead of a lookup for each cell."""
    best = lambda value, test, conf, url: F.min_by(F.struct(*value), F.when(test, F.struct(-F.round(F.coalesce(conf, F.lit(0.0)), 9), F.coalesce(url, F.lit("")), F.col("_id"))))
    people = clean.withColumn("_id", F.col("contact_id")).groupBy("municipality_id").agg(*[best(("name", "email", "phone"), F.col("role_family") == f, F.col("display_confidence"), F.col("source_url")).alias(f) for f in FAMILIES])
    kinds = ("gis", "property_cards", "tax_payment", "jobs", "permits", "agendas_minutes")
    links = services.withColumn("_id", F.col("service_id")).groupBy("municipality_id").agg(*[best(("url", "label"), F.col("service_type_normalized") == k, F.col("display_confidence"), F.col("source_url")).alias(k) for k in kinds])
    joined = towns.select("municipality_id").join(people, "municipality_id", "left").join(links, "municipality_id", "left")
    return joined.select("municipality_id", *[F.col(f"{f}.{x}").alias(f"{f}_{x}") for f in FAMILIES for x in ("name", "email", "phone")], *[F.col(f"{k}.url").alias(f"{k}_url") for k in kinds])


def suspicious_winners(winners: DataFrame) -> DataFrame:
    """Winners that a reviewer should see, with the first reason that applies."""
    role, dept, url = F.col("role_normalized"), low("department"), low("source_url")
    unreachable = ~filled("email") & ~filled("phone")
    mismatch = None
    for r, word in DEPARTMENT_WORD.items():
        test = (role == r) & ~dept.contains(word)
        mismatch = test if mismatch is None else mismatch | test
    tax = (role == "Assessor") & (url.contains("tax") | low("email").contains("tax")) & ~dept.contains("tax assessor") & ~low("title").contains("tax assessor")
    page = (role == "Tax Collector") & has_any(url, "clerk", "planning")
    clerk = (role == "Town Clerk") & url.contains("planning")
    first = (role == "First Selectman") & has_any(url, "finance", "building")
    helper = one_of(role, "First Selectman", "Mayor", "Town Manager") & (has_any(low("name"), "assistant", "administrative") | has_any(low("title"), "assistant", "administrative") | dept.contains("assistant"))
    noise = F.coalesce("is_likely_noise", F.lit(0)) == 1
    shown = unreachable | filled("suspicious_reason") | mismatch | tax | page | clerk | first | helper | noise
    reason = chain((unreachable, "missing_email_and_phone"), (filled("winner_disqualifier_reason"), F.trim("winner_disqualifier_reason")), (filled("suspicious_reason"), F.trim("suspicious_reason")), (mismatch, "role_department_mismatch"), (tax, "assessor_tax_mismatch"), (page, "tax_collector_role_page_mismatch"), (clerk, "town_clerk_planning_mismatch"), (first, "first_selectman_role_page_mismatch"), (helper, "chief_role_assistant_contamination"), (noise, "likely_noise_flag"), default="review")
    return winners.filter(shown).select("municipality_id", "role_normalized", "contact_id", "name", "email", "phone", "department", "page_type", "source_url", "is_likely_noise", "candidate_score", "winner_disqualifier_reason", reason.alias("suspicious_reason"))


def missing_key_roles(towns: DataFrame, winners: DataFrame) -> DataFrame:
    """Towns that lack a role group, with the groups they lack and have, in report order; complete towns are left out."""
    roles = winners.groupBy("municipality_id").agg(F.collect_set("role_normalized").alias("roles"))
    df = towns.join(roles, "municipality_id", "left").withColumn("roles", F.coalesce("roles", F.array().cast("array<string>")))
    has = {g: F.arrays_overlap("roles", F.array(*[F.lit(r) for r in members])) for g, members in ROLE_GROUPS.items()}
    listed = lambda want: F.array_compact(F.array(*[F.when(test if want else ~test, F.lit(g)) for g, test in has.items()]))
    shown = F.array_compact(F.array(*[F.when(has[g], F.concat(F.lit(f"{g}: "), F.array_join(F.filter(F.array(*[F.lit(m) for m in members]), lambda m: F.array_contains("roles", m)), ", "))) for g, members in ROLE_GROUPS.items()]))
    df = df.withColumns({"_missing": listed(False), "_present": listed(True), "_shown": shown}).filter(F.size("_missing") > 0)
    return df.select("municipality_id", F.col("name").alias("town_name"), F.array_join("_missing", "; ").alias("missing_role_groups"), F.size("_missing").alias("missing_group_count"), F.array_join("_present", "; ").alias("present_role_groups"), F.array_join("_shown", "; ").alias("present_group_roles"))


def counts(df: DataFrame, name: str) -> DataFrame:
    return df.groupBy("municipality_id").agg(F.count("*").alias(name))


def batch_summary(towns: DataFrame, **tables: DataFrame) -> DataFrame:
    """Rows of each table by town, zero where there are none."""
    out = towns.select("municipality_id", F.col("name").alias("town_name"))
    for name, df in tables.items():
        out = out.join(counts(df, name), "municipality_id", "left")
    return out.fillna(0, list(tables))


def latest(df: DataFrame, seq: str = "seq") -> DataFrame:
    """The newest row of each town."""
    order = Window.partitionBy("municipality_id").orderBy(F.desc(seq))
    return df.withColumn("_rn", F.row_number().over(order)).filter("_rn = 1").drop("_rn")


def coverage_summary(summary: DataFrame, missing: DataFrame, diagnostics: DataFrame, batch_id: str = "") -> DataFrame:
    """One row of a batch: towns, blocked, unblocked, without yield, with a missing group, fully covered."""
    blocked = latest(diagnostics).select("municipality_id", effectively_blocked().alias("blocked"))
    df = summary.join(blocked, "municipality_id", "left").join(missing.select("municipality_id", F.lit(True).alias("lacks")), "municipality_id", "left")
    df = df.select(F.coalesce("blocked", F.lit(False)).alias("b"), F.coalesce("lacks", F.lit(False)).alias("m"), ((F.col("raw") == 0) & (F.col("clean") == 0) & (F.col("winners") == 0)).alias("z"))
    n = lambda test: F.coalesce(F.sum(flag(test)), F.lit(0))
    out = df.agg(F.count("*").alias("municipalities_total"), n(F.col("b")).alias("municipalities_blocked"), n(~F.col("b")).alias("municipalities_unblocked"), n(~F.col("b") & F.col("z")).alias("municipalities_with_zero_yield_unblocked"), n(~F.col("b") & F.col("m")).alias("municipalities_with_any_missing_groups_unblocked"))
    full = F.greatest(F.lit(0).cast("long"), F.col("municipalities_unblocked") - F.col("municipalities_with_any_missing_groups_unblocked"))
    return out.select(F.lit(batch_id).alias("batch_id"), "*", full.alias("municipalities_fully_covered_unblocked"))


def vendor_rollup(towns: DataFrame, summary: DataFrame, missing: DataFrame, diagnostics: DataFrame, column: str = "platform") -> DataFrame:
    """Conditional counts of towns by platform vendor; a blank vendor is named."""
    blocked = latest(diagnostics).select("municipality_id", effectively_blocked().alias("blocked"))
    vendor = vendor_name(column).alias("vendor")
    df = towns.select("municipality_id", vendor).join(summary.drop("town_name"), "municipality_id", "left").join(blocked, "municipality_id", "left").join(missing.select("municipality_id", "missing_group_count"), "municipality_id", "left")
    b, gaps = F.coalesce("blocked", F.lit(False)), F.coalesce("missing_group_count", F.lit(0))
    n = lambda test: F.sum(flag(test))
    return df.groupBy("vendor").agg(F.count("*").alias("towns"), n(b).alias("blocked"), n(~b & (gaps == 0)).alias("fully_covered"), n(gaps > 0).alias("with_missing_groups"), F.sum("raw").alias("raw_contacts"), F.sum("winners").alias("role_winners"))


def signal_pivot(signals: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """The largest value of each signal kind by town."""
    return signals.groupBy("municipality_id").agg(*[F.max(F.when(F.col("signal_type") == k, F.col("value"))).alias(k) for k in kinds])


def public_signals(signals: DataFrame) -> DataFrame:
    return signals.filter(~F.col("signal_type").isin(*OPERATIONAL_SIGNALS))


def customer_contacts(enriched: DataFrame) -> DataFrame:
    return enriched.filter((F.col("is_likely_noise") == 0) & (F.col("record_rank") == 1) & (filled("email") | filled("phone")))


def role_gaps(enriched: DataFrame, missing: DataFrame) -> DataFrame:
    """Contacts with a title or department in towns that lack a role group, counted over all that describes them."""
    gaps = missing.select("municipality_id", "town_name", F.array_join(F.array_sort(F.split("missing_role_groups", "; ")), "; ").alias("missing_role_groups"))
    text = lambda f: F.coalesce(normalize_whitespace(f), F.lit("")).alias(f)
    fields = ("title", "department", "source_context", "role_family", "role_normalized", "department_normalized")
    rows = enriched.select("municipality_id", *[text(f) for f in fields]).join(gaps, "municipality_id")
    # counted instead of filtered: a filter would be pushed into the long rules below and make code too long to compile
    described = F.sum(flag((F.col("title") != "") | (F.col("department") != ""))).alias("count_rows")
    return rows.groupBy("municipality_id", "town_name", "missing_role_groups", *fields).agg(described).filter("count_rows > 0")


def orphans(child: DataFrame, towns: DataFrame) -> DataFrame:
    """Rows whose town does not exist."""
    return child.join(towns.select("municipality_id"), "municipality_id", "left_anti")


def dropped_before_clean(enriched: DataFrame, clean: DataFrame) -> DataFrame:
    """Rows the clean view leaves out, counted by town and reason."""
    lost = enriched.join(clean.select("contact_id"), "contact_id", "left_anti")
    reason = chain((F.col("record_rank") > 1, "duplicate_rank"), (F.col("is_likely_noise") == 1, "likely_noise"), default="other")
    return lost.groupBy("municipality_id", reason.alias("drop_reason")).agg(F.count("*").alias("dropped"))


def evidence(contacts: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One evidence row for each contact that existing evidence does not know, its claims as valid JSON."""
    fields = ("name", "title", "department", "email", "phone", "address", "hours", "source_url")
    fresh = contacts if existing is None else contacts.join(existing.select("contact_id"), "contact_id", "left_anti")
    return fresh.select("contact_id", F.lit("initial_backfill").alias("extraction_method"), F.to_json(F.struct(*[F.coalesce(c(f), F.lit("")).alias(f) for f in fields])).alias("field_claims_json"))


def legacy_suspicious(winners: DataFrame) -> DataFrame:
    """Winners that the first review query would show."""
    role, url = F.col("role_normalized"), F.lower("source_url")
    shown = ~filled("email") | ((role == "Assessor") & url.contains("tax")) | ((role == "Tax Collector") & url.contains("clerk")) | ((role == "Town Clerk") & url.contains("planning")) | low("name").contains("assistant")
    return winners.filter(F.coalesce(shown, F.lit(False))).select("municipality_id", "role_normalized", "name", "email", "phone", "department", "source_url")


#: Vendors as reports name them.
VENDORS = {"apptegy": "Apptegy", "aptuitiv": "Aptuitiv", "awr web design": "AWR Web Design", "catalis": "Catalis", "catalisgov": "Catalisgov", "civiclift": "CivicLift", "corebt": "CoreBT", "egovlink": "egovlink", "evogov": "EvoGov", "finalsite": "finalsite", "granicus": "Granicus", "ifsight": "ifsight", "purpledog": "PurpleDog", "quasar": "Quasar", "revize": "Revize", "town web": "TownWeb", "townweb": "TownWeb", "web solutions": "Web Solutions", "wordpress": "Wordpress"}
VENDOR_PREFIX = "Quasar Internet Solutions"


def vendor_name(x: Column | str) -> Column:
    """A vendor by the name of the map, else as written; a blank one is named."""
    bare = F.trim(F.coalesce(c(x), F.lit("")))
    known = F.create_map(*[F.lit(y) for pair in VENDORS.items() for y in pair])
    return F.when(bare == "", "(blank)").when(F.lower(bare).startswith(VENDOR_PREFIX.lower()), VENDOR_PREFIX).otherwise(F.coalesce(F.try_element_at(known, F.lower(bare)), bare))


def manual_review(suspicious: DataFrame, candidates: DataFrame, unresolved: DataFrame, missing: DataFrame) -> DataFrame:
    """All that a person should look at, by town and kind of review."""
    row = lambda df, kind, role, contact, groups: df.select("municipality_id", F.lit(kind).alias("review_type"), role.alias("role_normalized"), contact.alias("contact_id"), groups.alias("missing_role_groups"))
    none = F.lit("")
    review = candidates.filter((F.col("is_revize") == 1) & (F.col("candidate_state") == "candidate_for_review"))
    out = row(suspicious, "suspicious_winner", F.col("role_normalized"), F.col("contact_id"), none)
    out = out.unionByName(row(review, "candidate_for_review", F.col("role_normalized"), F.col("contact_id"), none))
    out = out.unionByName(row(unresolved, "unresolved_role", F.col("role_normalized"), F.col("top_candidate_contact_id"), none))
    return out.unionByName(row(missing.filter("missing_group_count >= 2"), "missing_role_groups_2plus", none, none, F.col("missing_role_groups")))


def town_sample(towns: DataFrame, enriched: DataFrame, services: DataFrame, locations: DataFrame, signals: DataFrame) -> DataFrame:
    """One row a town: rows of each table, contacts with each field, and whether a fallback signal was seen."""
    people = enriched.groupBy("municipality_id").agg(F.count("*").alias("contacts"), *[F.sum(f"has_{f}").alias(f"with_{f}") for f in ("name", "email", "phone", "department")])
    seen = lambda kind: F.max(flag(F.col("signal_type") == kind))
    flags = signals.groupBy("municipality_id").agg(F.count("*").alias("signals"), seen("crawl_diagnostics").alias("has_diagnostics"), seen("blocked_recovery_status").alias("has_recovery"))
    out = towns.select("municipality_id").join(people, "municipality_id", "left").join(flags, "municipality_id", "left")
    for name, df in (("service_links", services), ("locations", locations)):
        out = out.join(counts(df, name), "municipality_id", "left")
    return out.fillna(0)


def stage_counts(enriched: DataFrame, clean: DataFrame, candidates: DataFrame, winners: DataFrame) -> DataFrame:
    """Rows that reach each stage, by town; one pass over the tagged union instead of a join for each stage."""
    stages = {"loaded": enriched, "clean": clean, "candidates": candidates, "winners": winners}
    tagged = None
    for name, df in stages.items():
        part = df.select("municipality_id", F.lit(name).alias("stage"))
        tagged = part if tagged is None else tagged.unionByName(part)
    return tagged.groupBy("municipality_id").agg(*[F.sum(flag(F.col("stage") == s)).alias(s) for s in stages])


def missing_ids(manifest: DataFrame, towns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The towns of a manifest that exist, and those that do not."""
    known = towns.select("municipality_id")
    return manifest.join(known, "municipality_id", "left_semi"), manifest.join(known, "municipality_id", "left_anti")


def enum_counts(df: DataFrame, column: str, values: tuple[str, ...]) -> DataFrame:
    """Rows of each value of an enumeration, zero where there are none."""
    have = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    listed = df.sparkSession.createDataFrame([(v,) for v in values], "value string")
    return listed.join(have, "value", "left").fillna(0, ["n"])


def recovery_status(towns: DataFrame, statuses: DataFrame, fields: dict[str, str]) -> DataFrame:
    """A status row for each town: the newest JSON payload over the defaults. fields: name and type of each."""
    shape = ", ".join(f"{k} {v}" for k, v in fields.items())
    newest = latest(statuses).select("municipality_id", F.from_json("value", shape).alias("p"))
    default = {"int": F.lit(0), "string": F.lit("")}
    return towns.select("municipality_id").join(newest, "municipality_id", "left").select("municipality_id", *[F.coalesce(F.col(f"p.{k}"), default[v]).alias(k) for k, v in fields.items()])


def validate(**frames: DataFrame) -> DataFrame:
    """(name, rows, ok): whether each table of a finished run has rows."""
    out = None
    for name, df in frames.items():
        one = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("name"), "rows", (F.col("rows") > 0).alias("ok"))
        out = one if out is None else out.unionByName(one)
    return out


def tagged_metrics(candidates: DataFrame, winners: DataFrame, contacts: DataFrame) -> DataFrame:
    """One row about the rows of one page reader: candidates, and winners by the pages they come from. contacts: enriched."""
    mine = candidates.filter("is_revize = 1")
    n = lambda test: F.coalesce(F.sum(flag(test)), F.lit(0)).cast("long")
    scored = mine.agg(F.count("*").alias("candidates_scored"), n(F.col("candidate_state") == "candidate_for_review").alias("candidates_for_review"), n(F.col("invalid_candidate_disqualified") == 1).alias("invalid_candidates_disqualified"))
    won = winners.select("contact_id", "forced_fallback").join(contacts.select("contact_id", low("source_context").alias("context"), low("page_type").alias("page")), "contact_id").filter(F.col("context").startswith("revize:"))
    on = lambda kind: n(F.col("context").contains(f"page_class={kind}") | (F.col("page") == kind))
    chosen = won.agg(F.count("*").alias("winners_selected"), on("staff_directory").alias("winners_from_staff_directory"), on("department_page").alias("winners_from_department_pages"), on("contact_hub").alias("winners_from_contact_hubs"), n(F.col("context").startswith("revize:reconstructed_contact_block")).alias("reconstructed_winners"), n(F.col("forced_fallback") == 1).alias("forced_fallback_winners"))
    key = ["municipality_id", "role_normalized"]
    open_roles = mine.select(*key).distinct().join(winners.filter(filled("role_normalized")).select(*key), key, "left_anti").agg(F.count("*").alias("roles_with_no_winner"))
    return scored.join(chosen).join(open_roles)  # one row each


#: Words and names of rows that no winner should be made of.
GARBAGE_PARTS, GARBAGE_NAMES = ("affidavit", "vacanc"), ("building", "tax collector", "department", "office")


def demotion_metrics(enriched: DataFrame, unresolved: DataFrame) -> DataFrame:
    """One row: how far enrichment reached, what it held against the rows of one page reader, and the roles left open."""
    n = lambda test: F.coalesce(F.sum(flag(test)), F.lit(0)).cast("long")
    mine, reason, name = low("source_context").startswith("revize:"), F.coalesce("suspicious_reason", F.lit("")), F.trim(low("name"))
    why = lambda kind: n(mine & (reason == kind))
    garbage = reason.isin("invalid_person_name", "role_only_name") | has_any(name, *GARBAGE_PARTS) | name.isin(*GARBAGE_NAMES)
    rows = enriched.agg(
        n(filled("entity_type")).alias("contacts_with_entity_type"), n(filled("role_normalized")).alias("contacts_with_role_normalized"), why("invalid_person_name").alias("penalty_non_person_name"),
        why("role_department_mismatch").alias("penalty_role_department_mismatch"), why("non_person_role_candidate").alias("penalty_office_row"), n(mine & garbage).alias("garbage_rows_demoted"),
    )
    left = unresolved.agg(F.count("*").alias("roles_unresolved"), n(F.coalesce("forced_fallback_blocked", F.lit(0)) == 1).alias("forced_fallback_blocked"))
    return rows.join(left)  # one row each
