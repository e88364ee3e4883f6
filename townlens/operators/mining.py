"""Mining of url paths and of titles that role rules do not know yet: inventories, scored candidates, recommendations.

Candidates are aggregates by (category, path) or (group, title, department); examples are the first few of a sorted set,
so that results do not depend on the order of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from townlens.functions import urls
from townlens.functions.text import any_keyword, chain, filled, flag, has_any, keyword_blob, norm, normalize_whitespace, one_of
from townlens.operators.reports import ROLE_GROUPS

# Path hints, noise and the signals of each role group.
CATEGORIES = ("directory", "finance", "clerk", "assessor", "tax", "building", "planning", "departments_root")
HIGH_VALUE = CATEGORIES[:7]
PATH_HINTS = {"directory": ("directory", "staff-directory", "staffdirectory"), "finance": ("finance", "treasurer", "comptroller", "board-of-finance"), "clerk": ("town-clerk", "city-clerk", "town-clerks-office", "clerk"), "assessor": ("assessor", "assessment"), "tax": ("tax-collector", "tax-office", "tax"), "building": ("building", "inspectional", "code-enforcement"), "planning": ("planning", "zoning", "land-use"), "departments_root": ("/departments", "/government")}
GENERIC_PATHS = ("/", "/home", "/index", "/contact-us")
NOISY_PATHS = ("news", "calendar", "events", "bid", "alert")
USEFUL_URLS = ("directory", "department", "departments", "government", "finance", "clerk", "assessor", "tax", "building", "planning", "zoning", "land-use", "staff")
GROUP_FAMILY = {"finance": "finance", "clerk": "town_clerk", "building": "building", "planning": "planning_zoning", "assessment": "assessor", "tax": "tax_collector"}
GROUP_DEPARTMENTS = {"finance": ("finance",), "clerk": ("town clerk", "clerk"), "building": ("building",), "planning": ("planning & zoning", "planning", "land use", "zoning"), "assessment": ("assessor",), "tax": ("tax collector", "tax")}
GROUP_SIGNALS = {
    "finance": ("finance", "financial", "chief financial officer", "cfo", "comptroller", "director of administrative services", "finance administrator", "business manager", "treasurer"),
    "clerk": ("clerk", "town clerk", "city clerk", "borough clerk"),
    "building": ("building", "inspection", "inspector", "code enforcement", "building official"),
    "planning": ("planning", "planner", "land use", "zoning", "zoning enforcement", "zeo"),
    "assessment": ("assessor", "assessment", "appraiser"),
    "tax": ("tax collector", "collector of taxes", "revenue collector", "tax office"),
}
FINANCE_TITLES = ("finance", "financial", "chief financial officer", "cfo", "comptroller", "administrative services", "business manager", "finance administrator")


def path_category() -> Column:
    """Category of a contact's page: its path decides, then role, family and words of the contact."""
    path = F.col("canonical_path")
    role, family = norm("role_normalized"), norm("role_family")
    blob = F.concat_ws(" ", *[F.nullif(norm(c), F.lit("")) for c in ("role_normalized", "role_family", "department_normalized", "title")])
    rules = [(has_any(path, *hints), k) for k, hints in PATH_HINTS.items()]
    rules += [
        (one_of(role, "finance director", "treasurer") | (family == "finance") | has_any(blob, "finance", "treasurer", "comptroller"), "finance"),
        (one_of(role, "town clerk", "city clerk") | (family == "town_clerk") | blob.contains("clerk"), "clerk"),
        ((family == "assessor") | blob.contains("assessor"), "assessor"),
        ((role == "tax collector") | (family == "tax_collector") | F.concat(F.lit(" "), blob, F.lit(" ")).contains(" tax ") | blob.contains("tax-collector"), "tax"),
        ((role == "building official") | (family == "building") | has_any(blob, "building", "inspectional", "inspection", "code enforcement"), "building"),
        ((role == "planner") | (family == "planning_zoning") | has_any(blob, "planning", "zoning", "land-use", "land use"), "planning"),
    ]
    return chain(*rules, default="other")


def numeric_slug(path: Column) -> Column:
    return path.rlike("/[0-9]+(/|$)")


def clean_slug(path: Column) -> Column:
    return (path != "/") & ~numeric_slug(path) & path.rlike(r"^/[a-z0-9][a-z0-9\-/.]*$")


def path_inventory(enriched: DataFrame) -> DataFrame:
    """Contacts found on telling pages, with the path of their page and its category."""
    useful = one_of(norm("page_type"), "staff_directory", "department_page", "contact_hub") | ((norm("page_type") == "other") & has_any(norm("source_url"), *USEFUL_URLS))
    df = enriched.filter(filled("source_url") & useful & (F.col("is_likely_noise") == 0)).withColumn("canonical_path", urls.normalized_path("source_url"))
    return df.withColumn("category", path_category()).select("municipality_id", "contact_id", "source_url", "canonical_path", "category", "role_normalized", "role_family", "department_normalized", "page_type")


def path_candidates(inventory: DataFrame, winners: DataFrame) -> DataFrame:
    """Score and recommendation of each path in its category."""
    won = winners.select("municipality_id", F.lit(True).alias("_won")).distinct()
    df = inventory.join(won, "municipality_id", "left")
    path = F.col("canonical_path")
    out = df.groupBy("category", "canonical_path").agg(
        F.count_distinct("municipality_id").alias("municipality_count"),
        F.count("*").alias("row_count"),
        F.count_distinct(F.when(F.col("_won"), F.col("municipality_id"))).alias("winner_backed_count"),
        F.sum(flag(one_of(norm("page_type"), "staff_directory", "department_page"))).alias("_preferred"),
        F.slice(F.sort_array(F.collect_set("municipality_id")), 1, 8).alias("_towns"),
    )
    when = lambda test, w: F.when(test, w).otherwise(0)
    score = when(F.col("municipality_count") >= 2, 3) + when(F.col("winner_backed_count") > 0, 3) + when(one_of(F.col("category"), *HIGH_VALUE), 2) + when(F.col("_preferred") > 0, 1) - when(one_of(path, *GENERIC_PATHS), 2) - when(has_any(path, *NOISY_PATHS), 2)
    out = out.withColumn("score", score)
    advice = chain((one_of(path, *GENERIC_PATHS), "too_generic"), (F.col("score") >= 7, "add_to_probe_list"), (F.col("score") <= 1, "too_generic"), default="review_manually")
    return out.select("category", "canonical_path", "score", "municipality_count", "row_count", "winner_backed_count", flag(clean_slug(path)).alias("is_clean_slug"), flag(numeric_slug(path)).alias("is_numeric_slug"), F.array_join("_towns", "; ").alias("example_municipalities"), advice.alias("recommendation"))


def probe_paths(candidates: DataFrame, most: int = 10) -> DataFrame:
    """The paths of each category that are worth a probe, best first."""
    towns = F.col("municipality_count")
    # One test on aggregates: split, its part on the category would be pushed into the rules below and blow the plan up.
    test = (F.col("recommendation") == "add_to_probe_list") & (F.col("score") >= 6) & (towns >= 2) & ((F.col("is_numeric_slug") == 0) | (towns >= 3)) & one_of(F.col("category"), *CATEGORIES)
    good = candidates.filter(F.when(towns >= 2, test).otherwise(False))
    order = Window.partitionBy("category").orderBy(F.desc("is_clean_slug"), F.desc("score"), F.desc("municipality_count"), F.desc("row_count"), "canonical_path")
    return good.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most).select("category", "rank", "canonical_path")


def missing_groups(towns: DataFrame, winners: DataFrame) -> DataFrame:
    """(municipality_id, role_group_target) of the groups without a winner."""
    groups = towns.sparkSession.createDataFrame([(g, list(ROLE_GROUPS[g])) for g in GROUP_FAMILY], "role_group_target string, members array<string>")
    grid = towns.select("municipality_id", F.explode(F.array(*[F.lit(g) for g in GROUP_FAMILY])).alias("role_group_target"))
    have = winners.join(groups, F.array_contains("members", F.col("role_normalized"))).select("municipality_id", "role_group_target").distinct()
    return grid.join(have, ["municipality_id", "role_group_target"], "left_anti")


def synonym_candidates(enriched: DataFrame, missing: DataFrame) -> DataFrame:
    """Titles and departments that point at a group their town lacks, scored, with a proposed role."""
    df = enriched.filter(filled("title") | filled("department")).join(missing, "municipality_id")
    group, blob = F.col("role_group_target"), keyword_blob(F.concat_ws(" ", "title", "department", "source_context"))
    signal = lambda test: chain(*[(group == g, test(g)) for g in GROUP_FAMILY], default=False)
    family = signal(lambda g: norm("role_family") == GROUP_FAMILY[g])
    department = signal(lambda g: one_of(norm("department_normalized"), *GROUP_DEPARTMENTS[g]))
    df = df.withColumns({"_family": family, "_department": department}).filter(F.col("_family") | F.col("_department") | signal(lambda g: any_keyword(blob, GROUP_SIGNALS[g])))
    known = signal(lambda g: one_of(F.coalesce("role_normalized", F.lit("")), *ROLE_GROUPS[g]))
    key = lambda c: F.lower(F.coalesce(normalize_whitespace(c), F.lit("")))
    out = df.groupBy("role_group_target", key("title").alias("title_key"), key("department").alias("department_key")).agg(
        F.count_distinct("municipality_id").alias("municipality_count"), F.count("*").alias("contact_count"), F.sum(flag(known)).alias("normalized_match_count"), F.sum(flag(F.col("_family"))).alias("_f"),
        F.sum(flag(F.col("_department"))).alias("_d"), F.sum("is_likely_noise").alias("_n"), F.slice(F.sort_array(F.collect_set("municipality_id")), 1, 8).alias("_towns"),
    )
    text = F.trim(F.concat_ws(" ", "title_key", "department_key"))
    advice = chain(
        ((F.col("_n") > 0) | has_any(text, "board", "page"), "likely_noise"),
        ((group == "finance") & text.contains("treasurer"), "map_to_treasurer"),
        ((group == "finance") & has_any(text, *FINANCE_TITLES), "map_to_finance_director"),
        ((group == "clerk") & text.contains("clerk"), "map_to_town_clerk"),
        ((group == "building") & has_any(text, "building", "inspector", "inspection", "code enforcement"), "map_to_building_official"),
        ((group == "planning") & has_any(text, "planning", "planner", "land use", "zoning", "zeo"), "map_to_planner"),
        default="review_manually",
    )
    when = lambda test, w: F.when(test, w).otherwise(0)
    score = when(F.col("_f") > 0, 3) + when(F.col("_d") > 0, 3) + when(F.col("municipality_count") >= 2, 2) + 2 - when(text.contains("board"), 3) - when(text.contains("page"), 3) - when(F.col("_n") > 0, 2) - when(F.col("normalized_match_count") == F.col("contact_count"), 4)
    out = out.withColumns({"recommendation": advice, "score": score})
    proposed = F.when(F.col("recommendation") == "map_to_treasurer", "Treasurer").otherwise(chain(*[(group == g, r) for g, r in {"finance": "Finance Director", "clerk": "Town Clerk", "building": "Building Official", "planning": "Planner", "assessment": "Assessor", "tax": "Tax Collector"}.items()], default="Unknown"))
    return out.select("role_group_target", proposed.alias("proposed_role_normalized"), "title_key", "department_key", "municipality_count", "contact_count", "normalized_match_count", "score", "recommendation", F.array_join("_towns", "; ").alias("example_municipalities"))
